"""Result cells: for each race and place a total and its leading candidates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.operators.groups import top_n

TOP = 6


def result_cells(rows: DataFrame, cell: Sequence[str], candidate: Sequence[str], votes: str,
                 top: int = TOP, nested: bool = True) -> DataFrame:
    """Cells with a positive total and their ``top`` candidates, nested or one row for each.

    Totals are taken from all rows, not from the leaders; ``others`` counts the candidates that are
    not shown. Ties go to the least candidate key.
    """
    keys = list(cell)
    tally = rows.groupBy(*keys, *candidate).agg(F.sum(votes).alias("votes"))
    totals = tally.groupBy(*keys).agg(
        F.sum("votes").alias("total"), F.greatest(F.lit(0), F.count(F.lit(1)) - top).alias("others")).filter(F.col("total") > 0)
    leaders = top_n(tally, keys, [F.col("votes").desc(), *[F.col(c).asc() for c in candidate]],
                    top)
    if not nested:
        return leaders.join(totals, keys)
    lists = leaders.groupBy(*keys).agg(F.transform(
        F.sort_array(F.collect_list(F.struct("place", *candidate, "votes"))),
        lambda e: F.struct(*[e[c].alias(c) for c in candidate], e["votes"].alias("votes")))
        .alias("top"))
    return totals.join(lists, keys)


def fill_missing_cells(cells: DataFrame, fallback: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fallback cells only where the key has none yet."""
    gaps = fallback.join(cells.select(*keys), list(keys), "left_anti")
    return cells.unionByName(gaps)


def with_province_totals(cells: DataFrame, reported: DataFrame, keys: Sequence[str],
                         candidate: Sequence[str], votes: str, top: int = TOP) -> DataFrame:
    """Roll-up cells completed by totals that a source reports for a whole province."""
    return fill_missing_cells(cells, result_cells(reported, keys, candidate, votes, top), keys)


def placement_metrics(rows: DataFrame, code: str, votes: str,
                      pair: Sequence[str]) -> DataFrame:
    """One row: pairs, resolved pairs, votes, unplaced votes and their percentage."""
    per_pair = rows.groupBy(*pair).agg(
        F.max(F.col(code).isNotNull()).alias("placed"), F.sum(votes).alias("v"))
    lost = F.coalesce(F.sum(F.when(~F.col("placed"), F.col("v"))), F.lit(0))
    return per_pair.agg(
        F.count(F.lit(1)).alias("pairs"), F.count_if("placed").alias("resolved"),
        F.sum("v").alias("votes"), lost.alias("unplaced"),
        F.round(F.lit(100.0) * lost / F.sum("v"), 3).alias("unplaced_pct"))


def unresolved_votes(rows: DataFrame, code: str, votes: str, pair: Sequence[str]) -> DataFrame:
    """Votes of each pair that found no code."""
    return rows.filter(F.col(code).isNull()).groupBy(*pair).agg(F.sum(votes).alias("votes"))
