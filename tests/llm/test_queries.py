"""The registered queries against their SQL, and their contracts' columns, on the smallest tables."""

from pathlib import Path

import pytest

from hustings.llm import queries
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
COLUMNS = {
    "op1_near_dedup": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op2_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op3_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op4_best_fit_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
                             "sequence_id": "bigint", "offset": "bigint"},
    "op5_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op7_lm_scores": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint",
                      "base_score": "double", "score": "double"},
    "op11_merkle_manifest": {"doc_id": "bigint", "verified": "boolean"} | dict.fromkeys(
        ["leaf", "subroot", "root", "proof_sha256", "folded_root"], "string"),
    "op12_quality_rules": dict.fromkeys(["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"], "bigint")
    | {"base_failed": "boolean", "kept": "boolean"},
    "op13_tokenizer_alignment": dict.fromkeys(["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"], "bigint")
    | {"groups_sha256": "string"},
}


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    assert df.count() >= (0 if name == "op9_benchmark_leaks" else 1)
    kinds = dict(df.dtypes)
    assert all(kinds[c] == k for c, k in COLUMNS.get(name, {}).items())


@pytest.mark.parametrize("name", list(queries.SQL))
def test_sql(spark, name):
    _, problem = compare(spark, FOLDER, queries.QUERIES[name], queries.SQL[name], connect(FOLDER))
    assert problem is None, problem


def test_model_beats_the_base_on_held_out_texts(spark):
    rows = queries.op7(spark, FOLDER).where("held_out").selectExpr("sum(score)", "sum(base_score)").first()
    assert rows[0] > rows[1]
