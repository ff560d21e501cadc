"""Group operators that stay balanced when one group holds much of the data.

Aggregates combine before the shuffle; totals are joined back instead of computed by a window over
the whole group; top-n keeps the best rows of every task first, and ranks are computed in ranges
that are cut where the rows are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hustings.session import checkpointed


def attach(df: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join a table with one row per key. Null keys meet null keys.

    Adaptive execution broadcasts the table when its measured size allows and otherwise splits
    the partitions of hot keys.
    """
    named = {k: f"__key_{i}" for i, k in enumerate(keys)}
    right = dim.withColumnsRenamed(named)
    meet = reduce(lambda a, b: a & b, [df[k].eqNullSafe(right[n]) for k, n in named.items()])
    return df.join(right, meet, how).drop(*named.values())


def group_total(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Each row with the total of its group."""
    return attach(df, df.groupBy(*keys).agg(F.sum(value).alias(out)), keys)


def share_of_total(df: DataFrame, keys: Sequence[str], value: str, out: str = "percentage",
                   digits: int = 2, total: str | None = None) -> DataFrame:
    """Percentage of the group total, half-even; null where the total is not positive. ``total``
    names a column that has it already."""
    summed = df if total else group_total(df, keys, value, "__total")
    of = F.col(total or "__total")
    share = F.bround((F.lit(100) * F.col(value) / F.when(of > 0, of)).cast("double"), digits)
    return summed.withColumn(out, share).drop("__total")


def standing(df: DataFrame, keys: Sequence[str], value: str, out: str = "rank",
             ranges: int | None = None) -> DataFrame:
    """Place within the group by descending value; ties share the better place, nulls get none.

    Equal values are counted first. The counts are cut into ranges by a sample sort over (group,
    value): the splitters lie where the rows are, so a group that holds most of them is cut into
    most of the ranges. Places within a range are shifted by the size of the group's ranges above
    it. The ranges are checkpointed, so a task that is run again cannot cut them differently.
    """
    fixed = value_ranges(df, keys, value, ranges)
    above = Window.partitionBy(*keys, "__range").orderBy(F.col(value).desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    inside = fixed.withColumn("__above", F.coalesce(F.sum("__n").over(above), F.lit(0)))
    earlier = Window.partitionBy(*keys).orderBy("__range") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = fixed.groupBy(*keys, "__range").agg(F.sum("__n").alias("__size")) \
        .withColumn("__offset", F.coalesce(F.sum("__size").over(earlier), F.lit(0))).drop("__size")
    places = attach(inside, offsets, [*keys, "__range"]).select(
        *keys, value, (F.col("__above") + F.col("__offset") + 1).cast("int").alias(out))
    return attach(df, places, [*keys, value])


def value_ranges(df: DataFrame, keys: Sequence[str], value: str,
                 ranges: int | None = None) -> DataFrame:
    """(keys, value, __n, __range): how often each value of a group occurs, cut into even ranges,
    four for each shuffle partition unless ``ranges`` says otherwise. Descending values have
    ascending ranges."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value) \
        .agg(F.count(F.lit(1)).alias("__n"))
    if ranges is None:
        ranges = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = counts.repartitionByRange(ranges, *keys, F.col(value).desc())
    return checkpointed(cut.withColumn("__range", F.spark_partition_id()))


def best_in_task(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: str) -> DataFrame:
    """The first ``n`` rows of each group within each task, before any exchange; n is a column.

    Every task sorts its rows, and a row passes as long as fewer than n of its group have passed, so
    at most tasks x groups x n rows are left. Only the last key and its count are remembered.
    """
    names = list(keys)

    def changes(column: pa.Array) -> np.ndarray:
        now, before = column[1:], column[:-1]
        differs = pc.fill_null(pc.not_equal(now, before), False).to_numpy(zero_copy_only=False)
        nulls = pc.xor(pc.is_null(now), pc.is_null(before)).to_numpy(zero_copy_only=False)
        return differs | nulls

    def first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, passed = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, bool)
            for name in names:
                new[1:] |= changes(batch.column(name))
            first = tuple(batch.column(name)[0].as_py() for name in names)
            new[0] = first != last
            at = np.arange(batch.num_rows)
            starts = np.maximum.accumulate(np.where(new, at, -1))
            place = np.where(starts < 0, at + passed, at - starts)
            last = tuple(batch.column(name)[-1].as_py() for name in names)
            passed = int(place[-1]) + 1
            yield batch.filter(pc.less(pa.array(place), batch.column(n)))

    return df.sortWithinPartitions(*keys, *order).mapInArrow(first_rows, df.schema)


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int | Column,
          out: str = "place", tie_on: str | None = None) -> DataFrame:
    """The first ``n`` rows of each group, ``n`` fixed or a column that is constant in the group.

    Tasks keep their own best rows before the exchange: for a fixed n the planner limits each
    group, otherwise ``best_in_task`` does. ``order`` must be total for a repeatable result. With
    ``tie_on`` a flag ``tie_at_cutoff`` tells that the first row left out has the same value as the
    last one kept. Groups whose n is null have no rows.
    """
    extra = 1 if tie_on else 0
    if isinstance(n, int):
        best, most = df, F.lit(n)
    else:
        best = best_in_task(df.withColumn("__most", (n + extra).cast("int")).filter("__most > 0"), keys, order, "__most")
        most = F.col("__most") - extra
    final = Window.partitionBy(*keys).orderBy(*order)
    ranked = best.withColumn(out, F.row_number().over(final)) \
        .filter(F.col(out) <= (n + extra if isinstance(n, int) else F.col("__most")))
    if tie_on:
        whole = Window.partitionBy(*keys)
        last_in = F.max(F.when(F.col(out) == most, F.col(tie_on))).over(whole)
        first_out = F.max(F.when(F.col(out) == most + 1, F.col(tie_on))).over(whole)
        ranked = ranked.withColumn("tie_at_cutoff",
                                   F.coalesce(last_in == first_out, F.lit(False)))
    return ranked.filter(F.col(out) <= most).drop("__most")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row for each key, the least by ``order``; an aggregate, so pieces combine early."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return first.select(*[F.col(k) if k in keys else F.col("__row")[k].alias(k)
                          for k in df.columns])


def flag_top_row(df: DataFrame, keys: Sequence[str], value: str, row_id: str,
                 out: str = "is_top") -> DataFrame:
    """Marks one row of each group: the greatest value (null counts as -1), the least id on ties."""
    best = df.groupBy(*keys).agg(
        F.min_by(row_id, F.struct((-F.coalesce(F.col(value), F.lit(-1))).alias("v"),
                                  F.col(row_id).alias("i"))).alias("__best"))
    return attach(df, best, keys).withColumn(out, F.col(row_id) == F.col("__best")).drop("__best")


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Exact duplicates removed; nulls are equal."""
    return df.dropDuplicates()


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row: how many rows ``drop_duplicate_rows`` removes."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("removed"))


def group_mode(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Most frequent non-null value for each key, the least on ties. Rows without key drop out."""
    counts = df.filter(F.col(key).isNotNull() & F.col(value).isNotNull()) \
        .groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(key).agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(out))


def fill_from_mode(df: DataFrame, key: str, value: str) -> DataFrame:
    """Missing values filled with the mode of their key; rows without key stay as they are."""
    modes = group_mode(df, key, value, "__mode")
    return df.join(modes, key, "left").select(
        *[F.coalesce(value, "__mode").alias(value) if c == value else F.col(c)
          for c in df.columns])


def collapse_max(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One value for each key, the greatest; rows with a null in the key drop out."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.max(value).alias(value))


def global_codes(values: DataFrame, scope: Sequence[str], value: str,
                 out: str = "code") -> DataFrame:
    """0-based position of each distinct value in sorted order, separately for each scope.

    The rows are range-partitioned and numbered inside their partition; a checkpoint fixes the
    partitions before the partition sizes are added up, so a recomputed task cannot renumber.
    """
    distinct = values.select(*scope, value).filter(F.col(value).isNotNull()).distinct()
    ordered = distinct.repartitionByRange(*scope, value).sortWithinPartitions(*scope, value)
    fixed = checkpointed(ordered.withColumn("__id", F.monotonically_increasing_id()))
    split = F.shiftright("__id", 33).alias("__part")
    rank_in = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = fixed.select("*", split, rank_in.alias("__rank"))
    sizes = numbered.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    placed = numbered.join(F.broadcast(offsets), "__part") \
        .withColumn("__pos", F.col("__rank") + F.col("__off"))
    if not scope:
        return placed.select(value, F.col("__pos").cast("bigint").alias(out))
    start = placed.groupBy(*scope).agg(F.min("__pos").alias("__start"))
    return placed.join(start, list(scope)).select(
        *scope, value, (F.col("__pos") - F.col("__start")).cast("bigint").alias(out))
