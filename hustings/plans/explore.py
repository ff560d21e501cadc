"""One browsable table of all winners: votes where ballots give them, dictionary-coded columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.functions.offices import NATIONAL_SEATS
from hustings.functions.text import pretty_office
from hustings.operators.groups import collapse_max
from hustings.operators.reshape import align_union, encode_columns
from hustings.plans.winners import national_winners

# Fixed values.
NATIONAL_YEARS = (2016, 2019, 2022, 2025)
NATIONWIDE = "Nationwide"
COLUMNS = ["year", "position", "region", "province", "full_name", "party", "votes"]
CODED = ["position", "region", "province", "party"]


def with_votes(winners: DataFrame, elected: DataFrame) -> DataFrame:
    """Winners with the vote total of their seat; the greater one where a name holds two seats of
    an office in a province; null for cycles without ballots."""
    keys = ["year", "province", "position", "full_name"]
    votes = collapse_max(elected.withColumnRenamed("candidate_name", "full_name")
                         .select(*keys, "votes"), keys, "votes")
    return winners.join(votes, keys, "left")


def explore_rows(winners: DataFrame, elected: DataFrame, ballots: DataFrame,
                 years: Sequence[int] = NATIONAL_YEARS) -> DataFrame:
    """Local winners with votes, and nationwide winners summed from the ballots."""
    local = with_votes(winners.filter(
        ~F.coalesce(F.col("position").isin(list(NATIONAL_SEATS)), F.lit(False))), elected)
    national = national_winners(ballots.filter(F.col("year").isin(list(years))), keep_null=False) \
        .withColumn("full_name", F.col("candidate_name")) \
        .withColumns({"region": F.lit(NATIONWIDE), "province": F.lit(NATIONWIDE)})
    return align_union([national.select(*COLUMNS), local.select(*COLUMNS)]) \
        .withColumn("position", pretty_office("position"))


def explore_table(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(coded rows, dictionary)."""
    return encode_columns(rows, CODED)
