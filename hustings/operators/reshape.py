"""Wide to long, long to wide, dictionary codes, schema alignment, sorting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import chain

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from hustings.operators.groups import drop_duplicate_rows, global_codes, top_n
from hustings.session import checkpointed


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str,
         value: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def count_matrix(df: DataFrame, rows: Sequence[str], column: str,
                 values: Sequence[str], drop_null_keys: bool = True) -> DataFrame:
    """Row counts, one column for each listed value; combinations without rows are 0."""
    if drop_null_keys:
        df = df.dropna(subset=[*rows, column])
    return df.groupBy(*rows).pivot(column, list(values)).count().na.fill(0, list(values))


def encode_columns(df: DataFrame, columns: Sequence[str],
                   missing: int = -1) -> tuple[DataFrame, DataFrame]:
    """(encoded, dictionary): each column replaced by the 0-based position of its value among the
    column's sorted values, -1 for null. All columns are numbered in one sort."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in columns])).alias("e")).select("e.*")
    dictionary = global_codes(long, ["column"], "value")
    encoded = df
    for c in columns:
        codes = dictionary.filter(F.col("column") == c).select(
            F.col("value").alias(f"__v_{c}"), F.col("code").alias(f"__c_{c}"))
        encoded = encoded.join(codes, F.col(c).cast("string") == F.col(f"__v_{c}"), "left")
    return encoded.select(*[
        F.coalesce(f"__c_{c}", F.lit(missing)).alias(c) if c in columns else F.col(c)
        for c in df.columns]), dictionary


def surrogate_ids(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Rows with a 0-based id of their key in sorted order, the same on every run. Null key parts
    sort first."""
    packed = df.withColumn("__key", F.struct(*keys))
    ids = global_codes(packed, [], "__key", out).select(
        *[F.col("__key")[k].alias(f"__{k}") for k in keys], out)
    meet = reduce(lambda a, b: a & b, [df[k].eqNullSafe(F.col(f"__{k}")) for k in keys])
    return df.join(ids, meet, "left").drop(*[f"__{k}" for k in keys])


def align_union(frames: Sequence[DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """Union by name; columns a frame lacks are null there."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out if columns is None else out.select(*columns)


def replace_periods(inherited: DataFrame, fresh: DataFrame, period: str,
                    periods: Sequence[int]) -> DataFrame:
    """Inherited rows of all periods but the given ones, and the fresh rows."""
    return align_union([inherited.filter(~F.col(period).isin(list(periods))), fresh])


def exclude_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose composite key is not in a list of withheld keys."""
    return df.join(keys, list(keys.columns), "left_anti")


def sort_nulls_last(df: DataFrame, columns: Sequence[tuple[str, bool]]) -> DataFrame:
    """Sort by (column, ascending), nulls last in either direction."""
    return df.orderBy(*[F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last()
                        for c, up in columns])


def by_severity(df: DataFrame, column: str = "severity",
                order: Mapping[str, int] | None = None) -> DataFrame:
    """Sort by the mapped weight of a severity."""
    order = {"high": 0, "medium": 1, "low": 2, "info": 3} if order is None else order
    weights = F.create_map(*[F.lit(x) for x in chain.from_iterable(order.items())])
    return df.orderBy(weights[F.col(column)].asc_nulls_last(), *[
        c for c in df.columns if c != column])


def sample_values(df: DataFrame, keys: Sequence[str], column: str, n: int,
                  out: str = "sample") -> DataFrame:
    """The n least distinct values of each key as a list, for a message."""
    distinct = df.filter(F.col(column).isNotNull()).select(*keys, column).distinct()
    return top_n(distinct, keys, [F.col(column)], n).groupBy(*keys).agg(
        F.sort_array(F.collect_list(column)).alias(out))


def require_known(df: DataFrame, known: str, raw: str, n: int = 20) -> DataFrame:
    """``df``, written once to the checkpoint folder; fails when ``known`` is null in any row.

    The unknown rows are counted while the table is written, so its sources are read once. The
    error names the ``n`` most frequent raw values, out of a sketch of bounded size, and about how
    many others there are.
    """
    seen, unknown = Observation(), F.col(known).isNull()
    value = F.when(unknown, F.coalesce(F.col(raw).cast("string"), F.lit("(null)")))
    done = checkpointed(df.observe(
        seen, F.count_if(unknown).alias("rows"), F.approx_count_distinct(value).alias("values"),
        F.call_function("approx_top_k", value, F.lit(n + 1), F.lit(100 * n)).alias("top")))  # the known rows are one item
    if seen.get["rows"]:
        bad = [item.item for item in seen.get["top"] if item.item is not None][:n]
        more = max(seen.get["values"] - len(bad), 0)
        raise ValueError(f"unrecognised {raw}: {bad}" + f" and about {more} more" * (more > 0))
    return done


def drop_and_count(df: DataFrame) -> tuple[DataFrame, int]:
    """Exact duplicates removed, written once, and how many there were, counted in that pass."""
    before, after = Observation(), Observation()
    count = F.count(F.lit(1)).alias("rows")
    done = checkpointed(drop_duplicate_rows(df.observe(before, count)).observe(after, count))
    return done, before.get["rows"] - after.get["rows"]
