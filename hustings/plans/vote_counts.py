"""Raw ballot rows of all cycles to one canonical vote-counts table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.functions import names, offices, parties, places
from hustings.functions.text import number_value, percent_value
from hustings.operators.groups import drop_duplicate_rows
from hustings.operators.reshape import align_union, require_known, sort_nulls_last
from hustings.sources.sinks import VOTE_COUNT_ORDER

VOTE_COUNT_COLUMNS = [
    "year", "region", "province", "city", "district", "position", "candidate_name", "last_name",
    "first_name", "middle_name", "title", "party", "votes", "percentage", "rank",
    "is_national_race", "is_geographic", "raw_position", "reported_name", "reported_party",
]


def canonical_ballots(raw: DataFrame, prefixes: list[tuple[str, str]] | None = None) -> DataFrame:
    """Offices, places, names and parties of raw rows in canonical form, the raw values beside
    them. One narrow pass: no shuffle."""
    df = raw.withColumns({
        "raw_position": F.col("position"), "reported_name": F.col("candidate_name"),
        "__office": offices.split_office("position", prefixes),
    }).withColumns({"position": F.col("__office.office"), "district": F.col("__office.district")})
    df = df.withColumns({
        "__region": places.canonical_region("region"),
        "__province": places.resolve_province("province", "city"),
        "__city": places.canonical_city("city"),
    }).withColumns({"region": F.col("__region"), "province": F.col("__province"),
                    "city": F.col("__city")})
    person = offices.is_person_office("position")
    df = df.withColumns({
        "is_geographic": places.is_geographic("province", "region"),
        "is_national_race": offices.is_national_race("position"),
        "__person": person,
        "__name": F.when(person, names.standardize_name("reported_name", "party")),
        "__found": F.when(person, names.clean_reported_name("reported_name", "party")["recovered"]),
    })
    full = names.canonical_full_name("__name.last", "__name.first", "__name.middle")
    own = names.strip_ballot_number("reported_name")
    df = df.withColumns({
        "last_name": F.col("__name.last"), "first_name": F.col("__name.first"),
        "middle_name": F.col("__name.middle"), "title": F.col("__name.title"),
        "candidate_name": F.when(F.col("__person"), full).otherwise(own),
        "reported_party": F.coalesce("__found", "party"),
    })
    return df.withColumns({
        "party": F.when(F.col("__person"), parties.canonical_party("reported_party")),
        "percentage": percent_value(F.col("percentage").cast("string")),
        "votes": number_value("votes"),
        "rank": number_value("rank").cast("int"),
    }).select(*VOTE_COUNT_COLUMNS)


def build_vote_counts(frames: Sequence[DataFrame], check: bool = True) -> DataFrame:
    """Frames of raw rows (with ``year``) to the published table, exact duplicates removed.

    With ``check`` an unknown office stops the build, with the names that are not known; the
    table is written once for that, and the sources are read once.
    """
    text = [f.withColumns({c: F.col(c).cast("string")
                           for c in ("rank", "votes", "percentage") if c in f.columns})
            for f in frames]
    rows = canonical_ballots(align_union(text))
    once = drop_duplicate_rows(rows)
    return require_known(once, "position", "raw_position") if check else once


def published_order(df: DataFrame) -> DataFrame:
    return sort_nulls_last(df, VOTE_COUNT_ORDER)
