"""The Merkle manifest, the learned quality rules and the tokenizer alignment against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hustings.llm import merkle, quality_rules, tokenizer_alignment
from tests.llm import corpora

A_PATH, B_PATH = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


# ---- manifest

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def row_leaf(values):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """The root, and for every leaf its siblings level by level as (left, right)."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for k, place in enumerate(at):
            run = nodes[place // 8 * 8:place // 8 * 8 + 8]
            paths[k].append(("".join(run[:place % 8]), "".join(run[place % 8 + 1:])))
        at = [p // 8 for p in at]
        nodes = [H(*nodes[k:k + 8]) for k in range(0, len(nodes), 8)]
    return (nodes[0] if nodes else None), paths


def plain_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row, row_leaf(row)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subroots, inner = [], {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        root, paths = tree([leaf for _, leaf in groups[g]])
        subroots.append(root)
        inner[g] = paths
    root, upper = tree(subroots)
    out = []
    for k, g in enumerate(names):
        for (row, leaf), path in zip(groups[g], inner[g]):
            i, text = row[0], row[4]
            if i is not None and text is not None and zlib.crc32(str(i).encode()) % 3 == 0:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            h = row_leaf((*row[:4], text))
            for left, right in path + upper[k]:
                h = H(left, h, right)
            proof = H(*(x for both in path + upper[k] for x in both))
            out.append((i, leaf, subroots[k], root, proof, h, h == root))
    return out


def spark_manifest(spark, rows):
    df = spark.createDataFrame([(*r, *corpora.CLASH) for r in rows], corpora.SCHEMA.replace("text string, lang string, source string, n_chars long",
                               "source string, lang string, n_chars long, text string")).repartition(3)
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.lower_ascii(F.col("text"))).otherwise(F.col("text"))
    got = merkle.manifest(df, "lang", "doc_id", ["doc_id", "source", "lang", "n_chars", "text"], {"text": changed})
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return [tuple(r) for r in got.collect()]


def languages(n, seed=3):
    rng = random.Random(seed)
    sizes = {"en": n, "de": 9, "fr": 8, "es": 1, "": 65, None: 7, "ü": 2, "zz": 64}
    return [(k, rng.choice(["a", None, "ß"]), lang, rng.choice([None, k]), f"Text {rng.randrange(40)} Ä É" + "X" * (k % 5))
            for lang, size in sizes.items() for k in range(size)]


def key(row):
    return tuple((x is not None, x if x is not None else 0) for x in row)


@pytest.mark.parametrize("rows", [languages(600), languages(520, 4) + [(k, "s", f"l{k}", 1, None) for k in range(70)],
                                  [(1, None, None, None, "A")], [(k, "s", "en", k, "T") for k in range(9)], []],
                         ids=["several", "many groups", "one row", "one group", "empty"])
def test_manifest(spark, rows):
    assert sorted(spark_manifest(spark, rows), key=key) == sorted(plain_manifest(rows), key=key)


def test_manifest_of_odd_rows(spark):
    """Null and repeated ids, equal rows, null texts, very long texts; equal rows may change places."""
    rows = [(i, "s", "en", None, t) for i, t in corpora.odd_texts()] + [(7, None, None, None, None)] * 200
    assert sorted(spark_manifest(spark, rows), key=key) == sorted(plain_manifest(rows), key=key)


# ---- quality rules

def plain_counts(data):
    words = WORD.findall(data)
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    times = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in data.split(b"\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(len(w.decode("utf-8", "replace")) for w in words), len(re.findall(rb"[#*$%&|<>]", data)), dup, len(covered)


def test_statistics(spark):
    rows = corpora.odd_texts() + corpora.texts(9, 60) + [(1, "a b c a b c\na b\na b\n\n \n# x"), (2, "a a a a"), (3, "*|*\v b\fc\r\nd é日")]
    got = quality_rules.text_statistics(corpora.frame(spark, rows)).collect()
    want = [(i, *plain_counts((t or "").encode())) for i, t in rows]
    assert sorted((tuple(r[:6]) for r in got), key=key) == sorted(want, key=key)


def test_windows_of_many_different_words():
    rng = np.random.default_rng(1)
    numbers = rng.integers(0, 1 << 40, 500)
    numbers[300:320] = numbers[10:30]
    assert quality_rules.repeated_words(numbers, 1 << 40) == 40
    assert quality_rules.longest_run(np.array([1, 1, 2, 2, 2, 1])) == 3


def planted(n, seed):
    """Clean prose, and two kinds of junk: symbols behind words, and the same few words over and over."""
    rng = random.Random(seed)
    for k in range(n):
        words = corpora.passage(rng, rng.randint(60, 300)).split(" ")
        kind = k % 6
        if kind == 0:
            words = [w + "***" if rng.random() < 0.6 else w for w in words]
        if kind == 1:
            words = [words[j % 40] + "aeiou"[(j // 40) % 5] for j in range(len(words))]
            words = [w.upper() + "!!" for w in words]
        yield k, " ".join(words), int(kind > 1)


def test_rules_find_planted_junk(spark):
    rows = list(planted(900, 1))
    docs = corpora.frame(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, q, 1) for i, _, q in rows if i < 600], "doc_id long, quality int, text int")
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs, labels).collect()}
    held_out = [(got[i], q) for i, _, q in rows if i >= 600 and not got[i].base_failed]
    wrong = [r for r, q in held_out if r.kept != bool(q)]
    assert len(held_out) > 250 and len(wrong) <= 0.02 * len(held_out)
    assert all((r.rule is None) == r.kept for r, _ in held_out)
    assert {r.rule for r, q in held_out if not q} - {None}


def test_verdicts_follow_the_rules_on_held_out_tables(spark):
    """Rules from two thirds of the labelled documents, judged on the others."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    got = quality_rules.quality_rules(docs, labels.where(~out)).join(labels.where(out), "doc_id").where("NOT base_failed")
    n = {(r.quality, r.kept): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    assert n[1, True] >= 0.99 * (n[1, True] + n.get((1, False), 0))
    assert n[0, False] >= 0.9 * (n[0, False] + n.get((0, True), 0))


def test_rules_without_labels_and_odd_labels(spark):
    docs = corpora.frame(spark, corpora.odd_texts() + [(1, "a b c " * 30), (2, corpora.passage(random.Random(3), 80))])
    labels = "doc_id long, quality int"
    for rows in ([], [(2, 0), (2, 1), (None, 0), (1, None)], [(2, 1)]):
        got = quality_rules.quality_rules(docs, spark.createDataFrame(rows, labels)).collect()
        assert all(r.rule is None and r.kept == (not r.base_failed) for r in got)
        assert {r.doc_id: r.kept for r in got if r.doc_id in (1, 2)} == {1: False, 2: True}
    none = quality_rules.quality_rules(docs.limit(0), spark.createDataFrame([(1, 0)], labels))
    assert none.count() == 0


def test_sequential_covering():
    """Two regions of bad rows; a tie takes the first feature; precision decides whether a rule stays."""
    rng = np.random.default_rng(2)
    rows = rng.random((3000, len(quality_rules.FEATURES)))
    bad = (rows[:, 2] > 0.8) | ((rows[:, 5] < 0.2) & (rows[:, 0] > 0.5))
    turn = rng.integers(0, 1 << 30, len(rows))
    rules = quality_rules.learned(rows, bad, turn, 0.9)
    found = np.logical_or.reduce([r.holds(rows) for r in rules])
    assert (found != bad).mean() < 0.01
    assert quality_rules.learned(rows, rng.random(len(rows)) < 0.1, turn, 0.9) == []
    assert quality_rules.learned(rows, np.zeros(len(rows), bool), turn, 0.9) == []


# ---- alignment

def token_bytes():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    letters = tokenizer_alignment.byte_letters()
    entries = {n: bytes(letters[c] for c in t) for t, n in a.get_vocab(with_added_tokens=False).items() if all(c in letters for c in t)}
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    return a, entries, b


def plain_alignment(rows):
    a, entries, b = token_bytes()
    links, texts = Counter(), []
    for i, text in rows:
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        xs = [entries[n] for n in x]
        ys = [bytes([int(p[3:5], 16)]) if b.is_byte(n) else p.replace("▁", " ").encode() for n, p in ((n, b.id_to_piece(n)) for n in y)]
        if text and not b"".join(xs) == b"".join(ys) == (" " + text).encode():
            x = y = xs = ys = []
        ends = lambda parts: list(np.cumsum([len(p) for p in parts])) if parts else []
        ex, ey = ends(xs), ends(ys)
        own, k = [], 0
        for n, (to, part) in enumerate(zip(ex, xs)):
            start = to - len(part)
            while k < len(ey) and ey[k] <= start:
                k += 1
            j = k
            while j < len(ey) and ey[j] - len(ys[j]) < to:
                own.append((x[n], y[j]))
                j += 1
        cuts = sorted(set(ex) & set(ey))
        groups, p, q = [], 0, 0
        for cut in cuts:
            p1, q1 = ex.index(cut, p) + 1, ey.index(cut, q) + 1
            groups.append(",".join(map(str, x[p:p1])) + "|" + ",".join(map(str, y[q:q1])))
            p, q = p1, q1
        links.update(own)
        texts.append((i, len(x), len(y), len(groups), own, hashlib.sha256(";".join(groups).encode()).hexdigest() if x else ""))
    best = defaultdict(int)
    for (m, n), times in links.items():
        best[n] = max(best[n], times)
    return [(i, n_a, n_b, n_groups, len(own), sum(links[o] == best[o[1]] for o in own), sum(links[o] for o in own), sha)
            for i, n_a, n_b, n_groups, own, sha in texts]


ODD = [(2000, "▁a"), (2001, "<s> </s> <unk> <0x0A>"), (2002, "a b\x00 c"), (2003, "  two  spaces \n\n\t x "), (2004, "😀😀 日本語 ﬁ"),
       (2005, "don't I'LL <|endoftext|> 123456"), (2006, " "), (2007, "\n"), (2008, "\n \n a\n"), (2009, "aa▁"), (2010, "é" * 300)]


@pytest.mark.parametrize("block_bytes", [1, 3000, 4 << 20])
def test_alignment(spark, block_bytes):
    rows = corpora.odd_texts() + corpora.texts(11, 50) + ODD + ODD[:3]
    got = tokenizer_alignment.align_tokenizers(corpora.frame(spark, rows), A_PATH, B_PATH, block_bytes=block_bytes).collect()
    assert sorted(map(tuple, got), key=key) == sorted(plain_alignment(rows), key=key)


def test_alignment_on_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = tokenizer_alignment.align_tokenizers(docs, A_PATH, B_PATH).collect()
    want = plain_alignment([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_alignment_without_texts(spark):
    assert tokenizer_alignment.align_tokenizers(corpora.frame(spark, []), A_PATH, B_PATH).count() == 0
    got = tokenizer_alignment.align_tokenizers(corpora.frame(spark, [(1, None), (1, ""), (None, "▁")]), A_PATH, B_PATH).collect()
    assert sorted(map(tuple, got), key=key) == [(None, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, "")]
