"""Resumable landing: files that arrive are taken once, the latest file of a locality stands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hustings.operators.audit import incomplete_localities
from hustings.operators.groups import attach
from hustings.sources.ballots import BALLOT_COLUMNS, BALLOT_SCHEMA

PLACE = ["region", "province", "city"]


def latest_files(rows: DataFrame, place: Sequence[str], file: str, arrived: str) -> DataFrame:
    """Rows of the latest file of each place; equal times go to the greater file name."""
    newest = rows.groupBy(*place).agg(
        F.max_by(file, F.struct(arrived, file)).alias("__file"))
    return attach(rows, newest, place, "inner").filter(F.col(file) == F.col("__file")) \
        .drop("__file")


def newest_per_place(rows: DataFrame, place: Sequence[str], file: str, arrived: str) -> DataFrame:
    """(place, newest, fresh): the newest file of each place; equal times go to the greater name.

    On a stream the newest file is the state of its place, kept over batches and restarts, and the
    batch returns the places it has touched; ``fresh`` tells that this batch brought the newest
    file, and not an earlier one. The aggregate combines within tasks, so a place that holds most
    of the rows sends one row a task.
    """
    taken = rows.withColumn("__taken", F.current_timestamp())  # one time for all of a batch
    newest = F.max_by(F.struct(F.col(file).alias("file"), "__taken"), F.struct(arrived, file))
    return taken.groupBy(*place).agg(newest.alias("__newest"), F.max("__taken").alias("__now")).select(
        *place, F.col("__newest.file").alias("newest"),
        (F.col("__newest.__taken") == F.col("__now")).alias("fresh"))


def read_landed(spark: SparkSession, paths: str | list[str], arrived: Column | None) -> DataFrame:
    """Rows of landed files with their file and its time of arrival."""
    return spark.read.schema(BALLOT_SCHEMA).csv(paths, header=True) \
        .select(*BALLOT_COLUMNS, *arrival(arrived))


def arrival(arrived: Column | None) -> list[Column]:
    at = F.col("_metadata.file_modification_time") if arrived is None else arrived
    return [F.col("_metadata.file_path").alias("source_file"), at.alias("arrived")]


def land_batch(touched: DataFrame, target: str, arrived: Column | None = None) -> None:
    """Replace the folders of places whose newest file came with this batch, and no other.

    Only those files are read again, and only the places for which they are the newest are written.
    Running it again with the same batch leaves the same table.
    """
    fresh = touched.filter("fresh").drop("fresh").persist()
    paths = [r.newest for r in fresh.select("newest").distinct().collect()]  # max_files at most
    if paths:
        rows = read_landed(touched.sparkSession, paths, arrived)
        newest = attach(rows, fresh, PLACE, "inner").filter(F.col("source_file") == F.col("newest"))
        newest.drop("newest").hint("rebalance", *PLACE).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy(*PLACE).parquet(target)
    fresh.unpersist()


def land_stream(spark: SparkSession, source: str, target: str, checkpoint: str,
                max_files: int = 1000, arrived: Column | None = None,
                max_age: str = "3650d") -> StreamingQuery:
    """Take all files below ``source`` that have not been taken, then stop.

    The checkpoint folder remembers the files and the newest one of each place, so a later call
    only takes what has arrived since, and an old file that comes late, in any batch, never
    replaces a newer one; the order of the batches does not matter. A new checkpoint folder takes
    everything again. ``arrived`` is an expression over ``_metadata``, the file's time by default.
    Files older than the newest by more than ``max_age`` are not taken.
    """
    files = spark.readStream.schema(BALLOT_SCHEMA).options(
        header="true", recursiveFileLookup="true", pathGlobFilter="*.csv", maxFileAge=max_age,
        maxFilesPerTrigger=str(max_files)).csv(source)
    rows = files.select(*PLACE, *arrival(arrived))
    return newest_per_place(rows, PLACE, "source_file", "arrived") \
        .writeStream.outputMode("update").option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True) \
        .foreachBatch(lambda batch, _: land_batch(batch, target, arrived)).start()


def refetch_worklist(landed: DataFrame, roster: DataFrame, same_everywhere: Column,
                     has_race: Column) -> DataFrame:
    """Localities of the roster that were never landed or fail the completeness check, with the
    reasons."""
    short = incomplete_localities(landed, ["province", "city"], "position", same_everywhere,
                                  has_race, "no MAYOR race")
    absent = roster.select("province", "city").distinct().join(
        landed.select("province", "city").distinct(), ["province", "city"], "left_anti") \
        .withColumn("reason", F.lit("not landed"))
    return short.unionByName(absent)


def refetched(landed: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Landed rows with the places of a fresh fetch replaced."""
    kept = landed.join(fresh.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)
