"""Published outputs. Tables between stages are Parquet; CSV is an export."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.operators.reshape import by_severity, sort_nulls_last
from hustings.session import checkpointed
from hustings.sources.ballots import path_exists

VOTE_COUNT_ORDER = [("year", True), ("region", True), ("province", True), ("city", True),
                    ("position", True), ("votes", False)]
WINNER_ORDER = [("year", True), ("province", True), ("position", True), ("last_name", True)]


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ("year",)) -> None:
    """Parquet, one folder for each partition value. Rows are dealt out by folder first, so a small
    folder is one file, and a large one is split over several tasks."""
    df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def export_csv(df: DataFrame, path: str, columns: Sequence[str],
               order: Sequence[tuple[str, bool]]) -> None:
    """Sorted gzip CSV parts with a header, in a fixed column order; nulls last."""
    sort_nulls_last(df.select(*columns), order).write.mode("overwrite").options(
        header="true", compression="gzip").csv(path)


def write_localities(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """CSV folders by region, province and city; only the places in ``df`` are replaced."""
    place = ["region", "province", "city"]
    df.select(*place, *columns).hint("rebalance", *place).write.mode("overwrite").options(
        header="true", partitionOverwriteMode="dynamic").partitionBy(*place).csv(path)


def write_payload(df: DataFrame, path: str, unit: str | None = None) -> None:
    """Compact JSON documents, one for each row; with ``unit`` one folder for each unit."""
    dealt = df.hint("rebalance", unit) if unit else df
    writer = dealt.write.mode("overwrite").option("ignoreNullFields", "false")
    (writer.partitionBy(unit) if unit else writer).json(path)


def write_report(issues: DataFrame, path: str) -> None:
    by_severity(issues).write.mode("overwrite").option("header", "true").csv(path)


def append_audit(spark: SparkSession, log: DataFrame, folder: str, version: int,
                 buckets: int = 64) -> DataFrame:
    """Filled cells added to the log of earlier runs, each once; a re-run adds nothing.

    Rows lie in buckets by a hash of all columns. A run reads the buckets that its rows fall into
    and writes those that get new rows, as folders of its own version; the manifest of a version
    tells which version holds each bucket, and is written last. Nothing that an earlier manifest
    names is ever changed. Returns the log.
    """
    bucket = F.pmod(F.xxhash64(*log.columns), F.lit(buckets)).cast("int")
    held = manifest_of(spark, folder, version - 1)
    rows = checkpointed(log.dropDuplicates().withColumn("bucket", bucket))
    touched = [r.bucket for r in rows.select("bucket").distinct().collect()]  # all buckets at most
    earlier = read_buckets(spark, folder, {b: held[b] for b in touched if b in held}, log)
    known = earlier.withColumn("bucket", bucket)
    fresh = rows.alias("r").join(known.alias("k"), reduce(and_, (
        F.col(f"r.{c}").eqNullSafe(F.col(f"k.{c}")) for c in rows.columns)), "left_anti")
    fresh = checkpointed(fresh)
    grown = [r.bucket for r in fresh.select("bucket").distinct().collect()]
    if grown:
        known.filter(F.col("bucket").isin(grown)).unionByName(fresh).hint("rebalance", "bucket") \
            .write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/data/version={version}")
    held |= dict.fromkeys(grown, version)
    spark.createDataFrame(sorted(held.items()), "bucket int, version int").coalesce(1) \
        .write.mode("overwrite").parquet(f"{folder}/manifest/version={version}")
    return read_buckets(spark, folder, held, log)


def manifest_of(spark: SparkSession, folder: str, version: int) -> dict[int, int]:
    """Which version holds each bucket of the log, as of a version; one entry a bucket."""
    path = f"{folder}/manifest/version={version}"
    if not path_exists(spark, path):
        return {}
    return {r.bucket: r.version for r in spark.read.schema("bucket int, version int").parquet(path).collect()}


def read_buckets(spark: SparkSession, folder: str, held: dict[int, int], like: DataFrame) -> DataFrame:
    paths = [f"{folder}/data/version={v}/bucket={b}" for b, v in sorted(held.items())]
    return spark.read.schema(like.schema).parquet(*paths) if paths else like.limit(0)


def nested_rows(df: DataFrame, group: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows as arrays of values, all as text, for a table that ships column names once."""
    return df.select(*group, F.array(*[F.col(c).cast("string") for c in columns]).alias("row"))
