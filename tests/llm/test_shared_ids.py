"""Rows that share an id but not the text."""

import random

from hustings.llm import line_dedup, near_dedup, substring_dedup
from tests.llm import corpora


def test_unlike_texts_under_one_id_each_keep_their_own(spark):
    """A row with an id that another, repeated text has as well loses nothing of its own."""
    rng = random.Random(12)
    a, b = corpora.passage(rng, 40), " ".join(f"z{k}" for k in range(40))
    near = " ".join(["other", *a.split(" ")[1:]])
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_dedup(
        corpora.frame(spark, [(7, near), (500, a), (500, b)]), width=4).collect()}
    assert {(i, c, k) for i, _, c, k in got} == {(7, 7, True), (500, 7, False), (500, 500, True)}
    rows = [(1, a), (9, a), (9, b), (None, b), (None, a + " " + b)]
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(corpora.frame(spark, rows)).collect())
    assert got == [(0, 40, 40), (0, 80, 80), (1, 40, 0), (9, 40, 0), (9, 40, 40)]
    lines = [(1, "first line here\nsame"), (2, "same\nother one"), (2, "unique text\nsecond unique"), (2, "same\nother one"), (3, None)]
    got = sorted((r.doc_id, r.kept_text, r.n_removed) for r in line_dedup.without_repeated_lines(corpora.frame(spark, lines)).collect() if r.kept_text is not None)
    assert got == [(1, "first line here\nsame", 0), (2, "other one", 1), (2, "other one", 1), (2, "unique text\nsecond unique", 0)]
