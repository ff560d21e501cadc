"""Votes summed where the seat is decided, seats estimated, winners elected."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.operators.groups import top_n


def jurisdiction_tally(df: DataFrame, office: str, jurisdiction: Mapping[str, Sequence[str]],
                       candidate: Sequence[str], votes: str, carry: Sequence[str] = (),
                       carry_order: Sequence[Column] | None = None,
                       by: Sequence[str] = ()) -> DataFrame:
    """Votes of each candidate in the jurisdiction that elects the office, all offices in one pass.

    Place columns an office is not elected by become null before grouping, so one grouping serves
    every office. Null keys are kept. ``carry`` columns give their first non-null value by
    ``carry_order``, or the least one without an order.
    """
    places = sorted({c for cols in jurisdiction.values() for c in cols})
    masked = df.filter(F.col(office).isin(list(jurisdiction)))
    aliased = {}
    for place in places:
        used = [o for o, cols in jurisdiction.items() if place in cols]
        aliased[f"__at_{place}"] = F.when(F.col(office).isin(used), F.col(place))
    masked = masked.withColumns(aliased)

    def first(c: str) -> Column:
        if carry_order is None:
            return F.min(c)
        return F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(*carry_order)))
    keys = [*by, office, *[f"__k_{p}" for p in places], *candidate]
    carried = [c for c in carry if c not in places]
    rows = masked.withColumnsRenamed({f"__at_{p}": f"__k_{p}" for p in places})
    total = F.sum(votes)
    if carry_order is None and carried and not set(carried) & set(keys):
        # texts have no hashed minimum: rows that differ in nothing else are added up first, so that
        # the sort for it holds these sums, not all rows of a task
        rows = rows.groupBy(*keys, *carried).agg(F.sum(votes).alias(votes))
        total = F.sum(votes).cast(rows.schema[votes].dataType)
    grouped = rows.groupBy(*keys).agg(total.alias(votes), *[first(c).alias(c) for c in carried])
    return grouped.withColumnsRenamed({f"__k_{p}": p for p in places})


def pooled_tally(df: DataFrame, keys: Sequence[str], candidate: Sequence[str], votes: str,
                 carry: Sequence[str] = (), keep_null: bool = True) -> DataFrame:
    """One tally over all places. With ``keep_null`` off, rows with a null key drop out first."""
    if not keep_null:
        df = df.dropna(subset=[*keys, *candidate])
    return df.groupBy(*keys, *candidate).agg(
        F.sum(votes).alias(votes), *[F.min(c).alias(c) for c in carry])


def holders_per_area(df: DataFrame, area: str, out: str = "holders") -> DataFrame:
    """Seats filled in each area, counted from the people who held them."""
    return df.filter(F.col(area).isNotNull()).groupBy(area).agg(F.count(F.lit(1)).alias(out))


def seat_estimate(holders: DataFrame, contests: DataFrame, area: str, district: str,
                  default_total: int = 8, by: Sequence[str] = ()) -> DataFrame:
    """Seats for each district of an area: holders divided evenly, half-even, at least one.

    ``holders`` has one row for each seat held in the base cycle. ``default_used`` tells where the
    base cycle does not know the area. Pass the cycle in ``by`` to count its own districts only;
    without it districts are pooled over all cycles.
    """
    totals = holders_per_area(holders, area, "__held")
    districts = contests.filter(F.col(area).isNotNull()).groupBy(*by, area).agg(
        F.count_distinct(district).alias("districts"))
    total = F.coalesce(F.col("__held"), F.lit(default_total))
    even = F.bround(total.cast("double") / F.greatest(F.col("districts"), F.lit(1)), 0)
    return districts.join(totals, area, "left").select(
        *by, area, "districts", total.cast("bigint").alias("total"),
        F.greatest(F.lit(1), even).cast("int").alias("seats"),
        F.col("__held").isNull().alias("default_used"))


def elect(tally: DataFrame, race: Sequence[str], votes: str, seats: str | int,
          tie_break: Sequence[str], tie_flag: bool = True) -> DataFrame:
    """The candidates of each race with the most votes, as many as there are seats.

    Ties are broken by ``tie_break`` so that results repeat; ``tie_at_cutoff`` shows where that
    decided a seat.
    """
    order = [F.col(votes).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break]]
    n = seats if isinstance(seats, int) else F.col(seats)
    return top_n(tally, race, order, n, tie_on=votes if tie_flag else None)
