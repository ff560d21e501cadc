"""Shared pieces of the training-data operators: stored tables, words and their hashes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.session import ensure_checkpoint_dir

A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def store(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and read again.

    Cuts the lineage: what comes after survives the loss of an executor without the steps before,
    and the planner knows the true size. The table stays until ``discard``.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes a stored table that nothing reads any more."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def documents(docs: DataFrame, doc_id: str, text: str, *more: str) -> DataFrame:
    """Only the columns an operator reads, under fixed names: (doc_id, data, ...); null text is empty.

    Narrowing first keeps extra columns, whatever their names, out of every later step.
    """
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("data"), *more)


def schema_of(df: DataFrame, names: Sequence[str]) -> str:
    """The types of some columns as text, with a comma after each."""
    return "".join(f"`{n}` {df.schema[n].dataType.simpleString()}, " for n in names)


class Remembered(dict):
    """Values of ``make``, worked out once for as long as they are remembered.

    Holds two generations of ``limit`` keys at most: when one is full it becomes the older one, and
    what is asked for again moves back, so frequent keys stay.
    """

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.older = limit, {}

    def make(self, key):
        raise NotImplementedError

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class WordHashes(Remembered):
    """64-bit hashes of words (bytes)."""

    def __init__(self, limit: int = 100_000):
        super().__init__(limit)

    def make(self, word: bytes) -> int:
        return xxhash.xxh3_64_intdigest(word)

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


@cache
def word_hashes() -> WordHashes:
    """The one table of a Python worker, kept from task to task."""
    return WordHashes()


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of a 64-bit value over all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hashes(words: np.ndarray, width: int, factor: np.uint64 = A) -> np.ndarray:
    """One hash for each ``width`` consecutive words; empty if there are fewer."""
    n = len(words) - width + 1
    if n < 1:
        return np.empty(0, np.uint64)
    h = np.full(n, np.uint64(width), np.uint64)
    for k in range(width):
        h *= factor
        h += words[k:k + n]
    return mixed(h)


def rows_of(batches: Iterator, *names: str, some: int = 512) -> Iterator[Iterator[tuple]]:
    """The rows of Arrow batches as tuples of Python values, some at a time."""
    for batch in (whole.slice(k, some) for whole in batches for k in range(0, whole.num_rows, some)):
        yield zip(*(batch.column(n).to_pylist() for n in names))


def id_cells(ids: Column, bits: int) -> Column:
    """Two cells of a bit table for an id."""
    return F.array(*[F.shiftrightunsigned(F.xxhash64(F.lit(k), ids), 64 - bits) for k in range(2)])


def id_table(ids: DataFrame, count: int, most_bytes: int) -> tuple[np.ndarray, int]:
    """A bit table of the column ``id`` and the logarithm of its size: 16 cells to an id as far as
    ``most_bytes`` goes. It has every id, and lets some others through."""
    bits = int(min(max(10, (16 * count).bit_length()), (8 * most_bytes).bit_length() - 1))
    cells = ids.select(F.explode(id_cells(F.col("id"), bits)).alias("c"))
    one = F.expr("shiftleft(1L, cast(c % 64 as int))")
    words = cells.groupBy(F.shiftright("c", 6).alias("w")).agg(F.bit_or(one).alias("b")).toArrow()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return table, bits


def with_cells(rows: DataFrame, name: str, bits: int) -> DataFrame:
    cells = id_cells(F.col(name), bits)
    return rows.withColumns({"c0": cells[0], "c1": cells[1]})


def in_table(batch: pa.RecordBatch, table: np.ndarray) -> np.ndarray:
    """Which rows of a batch ``with_cells`` the table lets through."""
    out = np.ones(batch.num_rows, bool)
    for column in ("c0", "c1"):
        cells = batch.column(column).to_numpy()
        out &= (table[cells >> 6] >> (cells & 63) & 1).astype(bool)
    return out
