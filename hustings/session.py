"""Session and checkpoint-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and the benchmark. Clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hustings")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def growing(df: DataFrame) -> DataFrame:
    """The side of a join that grows with the data: the join is sorted and merged. Adaptive execution
    would else send it out as soon as its compressed size allows, and the driver would hold all of it
    unpacked, several such sides at a time."""
    return df.hint("merge")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder reliable checkpoints go to.

    The cluster's ``spark.checkpoint.dir`` is used as it is. A folder of our own is made only on a
    local master, where driver and executors share one disk; elsewhere a missing setting is an
    error, since a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="hustings-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder, its lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder as compressed columns, its lineage cut. For long tables
    that are read more than once: a checkpoint writes whole rows as they lie in memory, and every
    reader takes all of them."""
    folder = f"{ensure_checkpoint_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    untyped = [c for c, kind in df.dtypes if kind == "void"]  # Parquet has no column that is null alone
    kept = df.drop(*untyped)
    kept.write.parquet(folder)
    again = df.sparkSession.read.schema(kept.schema).parquet(folder)
    return again.withColumns({c: F.lit(None) for c in untyped}).select(*df.columns) if untyped else again
