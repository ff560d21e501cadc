"""Queries over the standard tables, one for each operator, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.llm.decontamination import benchmark_leaks
from hustings.llm.exact_dedup import exact_dedup
from hustings.llm.hidden_markov import score_texts
from hustings.llm.language_id import identify, train_profiles
from hustings.llm.line_dedup import line_dedup
from hustings.llm.merkle import lower_ascii, manifest
from hustings.llm.near_dedup import near_dedup
from hustings.llm.packing import pack
from hustings.llm.quality_rules import quality_rules
from hustings.llm.secret_scan import secret_scan
from hustings.llm.substring_dedup import substring_dedup
from hustings.llm.token_counts import token_counts
from hustings.llm.tokenizer_alignment import align_tokenizers

CONTEXT = 2048
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"), width=4)


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=CONTEXT)


@query("op3_substring_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


@query("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), CONTEXT)


@query("op5_exact_dedup", """
  WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
  g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
  SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
    sha256(norm) AS text_sha256 FROM d JOIN g USING (norm)""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("n_bytes")


@query("op7_lm_scores")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.crc32(F.col("doc_id").cast("string")) % 7
    return score_texts(table(spark, sf_dir, "documents"), learn=turn != 2, held_out=turn == 2,
                       own=1 << 15, classes=None)


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, by text, markup, address and host, and all documents, by text, label and source."""
    documents = table(spark, sf_dir, "documents")
    profiles = train_profiles(documents, "lang", "text")
    pages = identify(table(spark, sf_dir, "pages"), profiles, "page_id", "html", address="url", markup=True)
    docs = identify(documents, profiles, declared="lang", host="source")
    return docs.withColumn("page_id", F.lit(None).cast("long")).unionByName(
        pages.withColumnRenamed("doc_id", "page_id").withColumn("doc_id", F.lit(None).cast("long")))


@query("op8_secret_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


@query("op9_benchmark_leaks")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_line_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edits grow with the length of the lines, whatever it is."""
    return line_dedup(table(spark, sf_dir, "documents"), most=None)


#: CRC-32 of a text of ASCII characters, bit by bit.
CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({}, ''), lambda c: ascii(c)::BIGINT)),
    lambda v, c: list_reduce(list_prepend(xor(v, c), range(8)), lambda w, k: xor(w >> 1, 3988292384 * (w & 1)))), 4294967295::BIGINT)"""


def framed(value: str) -> str:
    return f"coalesce(strlen({value})::VARCHAR || ':' || {value}, '-')"


def runs(tree: str, path: str) -> str:
    """The siblings of every node of a tree, and the paths from its leaves up, as recursive SQL."""
    return f"""
  {tree}_runs AS (SELECT lvl, g, place, n,
      coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
      coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM {tree} WINDOW run AS (PARTITION BY lvl, g, place // 8 ORDER BY place)),
  {path} AS (SELECT * FROM {path}_start UNION ALL
    SELECT p.id, p.lvl + 1, p.g, p.place // 8, p.proof || before || after, sha256(before || p.h || after)
    FROM {path} p JOIN {tree}_runs r ON p.lvl = r.lvl AND p.g = r.g AND p.place = r.place AND r.n > 1)"""


@query("op11_merkle_manifest", f"""
  WITH RECURSIVE d AS (SELECT *, doc_id::VARCHAR AS i, n_chars::VARCHAR AS n FROM documents),
  e AS (SELECT doc_id, lang, {framed("i")} || {framed("source")} || {framed("lang")} || {framed("n")} AS head, text,
      CASE WHEN {CRC.format("i")} % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
        ELSE text END AS low FROM d),
  rows AS (SELECT coalesce('=' || lang, '-') AS g, doc_id, sha256(head || {framed("text")}) AS h,
      sha256(head || {framed("low")}) AS checked FROM e),
  leaves AS (SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS place,
      count(*) OVER (PARTITION BY g) AS n FROM rows),
  tree AS (SELECT 0 AS lvl, g, place, n, h FROM leaves UNION ALL
    SELECT lvl + 1, g, place // 8, max((n + 7) // 8), sha256(string_agg(h, '' ORDER BY place))
    FROM tree WHERE n > 1 GROUP BY lvl, g, place // 8),
  tops AS (SELECT g AS name, h, row_number() OVER (ORDER BY g) - 1 AS place, count(*) OVER () AS n FROM tree WHERE n = 1),
  over AS (SELECT 0 AS lvl, '' AS g, place, n, h FROM tops UNION ALL
    SELECT lvl + 1, g, place // 8, max((n + 7) // 8), sha256(string_agg(h, '' ORDER BY place))
    FROM over WHERE n > 1 GROUP BY lvl, g, place // 8),
  path_start AS (SELECT id, 0 AS lvl, g, place, '' AS proof, checked AS h FROM leaves), {runs("tree", "path")},
  found AS (SELECT p.* FROM path p JOIN tree t ON p.lvl = t.lvl AND p.g = t.g AND t.n = 1),
  upper_start AS (SELECT id, 0 AS lvl, '' AS g, t.place, proof, f.h FROM found f JOIN tops t ON f.g = t.name), {runs("over", "upper")},
  ends AS (SELECT u.* FROM upper u JOIN over o ON u.lvl = o.lvl AND o.n = 1)
  SELECT doc_id, l.h AS leaf, t.h AS subroot, (SELECT h FROM over WHERE n = 1) AS root, sha256(proof) AS proof_sha256,
    ends.h AS folded_root, ends.h = (SELECT h FROM over WHERE n = 1) AS verified
  FROM leaves l JOIN ends USING (id) JOIN tops t ON t.name = l.g""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document, by a checksum of its id, is checked with its text in small letters."""
    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    changed = F.when(third, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    return manifest(table(spark, sf_dir, "documents"), "lang", "doc_id", ["doc_id", "source", "lang", "n_chars", "text"],
                    {"text": changed})


@query("op12_quality_rules")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_tokenizer_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.path("piece_bpe_32k.model"))
