"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns what the next one works on: the rows that stay,
with all their columns, and at the end the pieces of packed sequences. Stages take rows out by an
anti-join with the rows they reject, told apart by id and text, so rows that share an id or have
none are judged each by their own text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.llm.common import store
from hustings.llm.decontamination import benchmark_leaks
from hustings.llm.exact_dedup import exact_dedup
from hustings.llm.language_id import identify, train_profiles
from hustings.llm.near_dedup import near_dedup
from hustings.llm.packing import pack

CONTEXT = 2048
#: SQL has neither the classifier, nor the tokenizer, nor connected components.
ORACLE_SQL = None


def marked(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a column that tells them apart by id and text, and its name."""
    name = "row_mark"
    while name in docs.columns:
        name += "_"
    of_null = F.lit("")  # a null text counts as empty
    return docs.withColumn(name, F.xxhash64(F.col("doc_id").cast("string"), F.lit("/"), F.coalesce("text", of_null))), name


def without(rows: DataFrame, mark: str, rejected: DataFrame) -> DataFrame:
    """The rows whose mark is not among the rejected ones, without the mark."""
    return rows.join(rejected.withColumnRenamed(rejected.columns[0], mark).distinct(), mark, "left_anti").drop(mark)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go: no letters, or no language likely enough."""
    rows, mark = marked(docs)
    found = identify(rows, train_profiles(docs, "lang", "text"), mark, declared="lang", host="source")
    return without(rows, mark, found.where("NOT accepted").select("doc_id"))


def exactly_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays; of rows repeated with id and text, one."""
    rows, mark = marked(docs)
    verdicts = store(exact_dedup(rows, more=[mark]).select(mark, "doc_id", "text_sha256", "kept"))
    alike = verdicts.where("kept").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("n"), F.min(mark).alias("stays")) \
        .where("n > 1")
    if alike.isEmpty():
        return without(rows, mark, verdicts.where("NOT kept").select(mark))
    again = verdicts.join(alike, (verdicts.doc_id.eqNullSafe(alike.doc_id)) & (verdicts.text_sha256 == alike.text_sha256)).select(mark)
    once = rows.join(verdicts.where("NOT kept").select(mark).union(again).distinct(), mark, "left_anti")
    single = rows.join(alike.select(F.col("stays").alias(mark)), mark, "left_semi").dropDuplicates([mark])
    return once.unionByName(single).drop(mark)


def unlike_others(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) the document with the least id stays."""
    rows, mark = marked(docs)
    found = near_dedup(rows, more=[mark])
    return without(rows, mark, found.where("NOT kept").select(mark))


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    rows, mark = marked(docs)
    found = benchmark_leaks(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc_id=mark)
    return without(rows, mark, store(found.select("doc_id")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, in sequences of the context's length."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), CONTEXT)


STAGES = [("language_id", known_language), ("exact_dedup", exactly_once), ("near_dedup", unlike_others),
          ("decontamination", unleaked), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
