"""Every operator against a brute-force version, on small corpora and on odd rows."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hustings.llm import exact_dedup as exact
from hustings.llm import hidden_markov as hmm
from hustings.llm.components import components
from hustings.llm.near_dedup import near_dedup
from hustings.llm.packing import cuts, pack, packing_plan
from hustings.llm.substring_dedup import substring_dedup
from hustings.llm.token_counts import token_counts, whole_tokens
from tests.llm.corpora import frame, odd_texts, texts

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ROWS = texts() + odd_texts()


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def normal(text):
    return (text or "").encode().lower()


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def ordered(expected):
    return sorted(expected, key=repr)


def test_exact_dedup(docs, none):
    groups = {}
    for i, t in ROWS:
        groups.setdefault(normal(t), []).append(i)
    expected = []
    for i, t in ROWS:
        same = groups[normal(t)]
        keep = max((x for x in same if x is not None), default=None)
        expected.append((i, keep, len(same), i == keep, hashlib.sha256(normal(t)).hexdigest()))
    assert rows(exact.exact_dedup(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == ordered(expected)
    assert exact.exact_dedup(none).count() == 0


def test_cuckoo_filter_holds_inserts_deletes_and_grows():
    digests = [hashlib.sha256(str(k).encode()).digest() for k in range(5000)]
    index = exact.DigestIndex(4)
    for k, d in enumerate(digests):
        index.add(d, k, k, 1)
    assert index.resizes > 0 and all(d in index.filter for d in digests) and len(index.content) == 5000
    for d in digests[:2500]:
        index.remove(d)
    assert all(d in index.filter for d in digests[2500:]) and len(index.content) == 2500
    assert sum(d in index.filter for d in digests[:2500]) < 25
    index.add(digests[3000], 3000, 9_000_000, 4)
    assert index.content[digests[3000]] == [3000, 9_000_000, 5]


def test_false_hits_are_told_apart():
    a = bytes(range(32))
    b = bytes([99]) + a[1:]  # same fingerprint and places, another digest
    index = exact.DigestIndex()
    index.add(a, 5, 1, 1)
    index.add(b, 5, 2, 1)
    assert index.false_hits == 1 and len(index.content) == 2


def test_index_takes_changes(spark, docs):
    empty = spark.createDataFrame([], exact.INDEX)
    entries = exact.index_entries(exact.text_digests(docs), 8).cache()
    index = exact.change_index(empty, added=entries)
    gone = index.where("group_size > 1").limit(2)
    left = exact.change_index(index, removed=gone)
    assert left.count() == index.count() - 2 and left.join(gone, "digest").count() == 0
    assert rows(exact.change_index(left, added=gone), "digest", "keep_id", "group_size") == rows(index, "digest", "keep_id", "group_size")


def test_token_counts(docs, none):
    tokenizer = Tokenizer.from_file(WORDS)
    expected = [(i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS]
    got = token_counts(docs, WORDS, limit=100)
    assert rows(got, "doc_id", "n_bytes", "n_tokens") == ordered(expected)
    assert got.where("over_limit <> (n_tokens > 100)").count() == 0 and token_counts(none, WORDS).count() == 0


def test_whole_tokens_are_proved():
    whole, tokenizer = whole_tokens(WORDS), Tokenizer.from_file(WORDS)
    assert len(whole) > 10_000
    assert all(len(tokenizer.encode(w, add_special_tokens=False).ids) == 1 for w in sorted(whole)[::500])


def test_near_dedup(docs, none):
    sets, ids = [], [i for i, _ in ROWS]
    for _, t in ROWS:
        w = normal(t).split()
        sets.append({tuple(w[k:k + 4]) for k in range(max(1, len(w) - 3))} if w else set())
    links = []
    for a in range(len(ROWS)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and ids[a] is not None and ids[b] is not None and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                links.append((ids[a], ids[b]))
    best = reachable([i for i in ids if i is not None], links)
    expected = [(i, len(s), best.get(i), i is None or best[i] == i) for i, s in zip(ids, sets)]
    assert rows(near_dedup(docs, width=4), "doc_id", "n_shingles", "component_id", "kept") == ordered(expected)
    assert near_dedup(none).count() == 0


def reachable(nodes, links):
    best = {n: n for n in nodes}
    for _ in nodes:
        for a, b in links:
            best[a] = best[b] = min(best[a], best[b])
    return best


def test_near_dedup_of_a_crowd(spark):
    """Many near copies of one text, some of which are linked only through others."""
    rng = np.random.default_rng(2)
    base = [f"b{k}" for k in range(60)]
    crowd = []
    for k in range(120):
        words = list(base)
        for place in rng.integers(0, 60, 1 + k % 4):
            words[place] = f"z{rng.integers(0, 3)}"
        crowd.append((k, " ".join(words)))
    sets = {i: {tuple(w[k:k + 4]) for k in range(len(w) - 3)} for i, t in crowd for w in [t.split()]}
    links = [(a, b) for a in sets for b in sets if b < a and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    best = reachable(sets, links)
    got = near_dedup(spark.createDataFrame(crowd, "doc_id long, text string"), width=4)
    assert dict(rows(got, "doc_id", "component_id")) == best and 1 < len(set(best.values())) < 120


def test_components(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, 90), (90, 95), (95, 100), (7, 7), (None, 3)]
    got = components(spark.createDataFrame(links, "a long, b long"), "a", "b")
    assert rows(got, "node", "component") == ordered([(k, 0) for k in range(1, 41)] + [(95, 90), (100, 90)])


@pytest.mark.parametrize("options", [{}, {"held": 50, "filter_bytes": 1 << 14}])
def test_substring_dedup(docs, none, options):
    last = 1 << 63
    first, where = {}, {}
    for i, t in ROWS:
        w = (t or "").encode().split()
        for k in range(len(w) - 12):
            window, node = tuple(w[k:k + 13]), last if i is None else i
            first[window] = min(first.get(window, last), node)
    expected = []
    for i, t in ROWS:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k:k + 13])] < (last if i is None else i):
                gone[k:k + 13] = [True] * 13
        expected.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    got = substring_dedup(docs, texts=True, **options).cache()
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == ordered(expected)
    for r in got.collect():
        assert sum(r.removed_spans[1::2]) - sum(r.removed_spans[::2]) == r.n_removed
        assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256
    assert substring_dedup(none).count() == 0


def test_packing(docs, none):
    tokenizer, capacity = Tokenizer.from_file(BYTES), 64
    ids = Counter()
    for i, t in ROWS:
        whole = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for k, (start, length) in enumerate(cuts(len(whole), capacity)):
            ids[i, k, start, length, zlib.crc32(np.array(whole[start:start + length], "<u4").tobytes())] += 1
    got = pack(docs, BYTES, capacity, keep_ids=True).toPandas()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(tuple(None if v != v else int(v) for v in r) for r in got[names].itertuples(index=False)) == ids
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in got.itertuples())
    fits(got, capacity)
    assert got.sequence_id.nunique() <= first_fit_decreasing(got.length, capacity)
    assert pack(none, BYTES, capacity).count() == 0


def first_fit_decreasing(lengths, capacity):
    left = []
    for n in sorted(lengths, reverse=True):
        k = next((k for k, room in enumerate(left) if room >= n), None)
        if k is None:
            left.append(capacity - n)
        else:
            left[k] -= n
    return len(left)


def fits(got, capacity):
    got = got.sort_values(["sequence_id", "offset"])
    ends = got.offset + got.length
    assert (ends.groupby(got.sequence_id).shift(fill_value=0) == got.offset).all() and ends.max() <= capacity


@pytest.mark.parametrize("seed", range(5))
def test_packing_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    counts = Counter(rng.integers(1, 101, 3000).tolist())
    fill, placed = Counter(), Counter()
    for length, first, after, sequence, offset in sorted(packing_plan(dict(counts), 100), key=lambda r: r[4]):
        for k in range(after - first):
            assert fill[sequence + k] == offset
            fill[sequence + k] += length
            placed[length, first + k] += 1
    assert placed == Counter({(n, k): 1 for n, c in counts.items() for k in range(c)}) and max(fill.values()) <= 100
    assert len(fill) <= 1.005 * first_fit_decreasing(counts.elements(), 100) + 1


def test_cuts():
    assert cuts(1, 8) == [(0, 1)] and cuts(8, 8) == [(0, 8)] and cuts(16, 8) == [(0, 8), (8, 8)]
    assert cuts(17, 8) == [(0, 1), (1, 8), (9, 8)]


def forward_backward(text, model):
    ahead = [model.start * model.emit[text[0]]]
    for x in text[1:]:
        ahead.append((ahead[-1] @ model.move) * model.emit[x])
    back = [np.ones(len(model.start))]
    for x in text[:0:-1]:
        back.append(model.move @ (model.emit[x] * back[-1]))
    back = back[::-1]
    total = ahead[-1].sum()
    here = [a * b / total for a, b in zip(ahead, back)]
    moves = sum((np.outer(ahead[k - 1], model.emit[text[k]] * back[k]) * model.move / total for k in range(1, len(text))),
                np.zeros_like(model.move))
    emitted = np.zeros_like(model.emit)
    for x, h in zip(text, here):
        emitted[x] += h
    return here[0], moves, emitted, np.log(total)


def test_segments_give_the_exact_recursions():
    rng = np.random.default_rng(0)
    model = hmm.first_model(np.full(30, 1 / 30), 3)
    model = hmm.Model(np.array([0.5, 0.3, 0.2]), model.move, model.emit)
    batch = [rng.integers(0, 30, n) for n in (1, 2, 63, 64, 65, 128, 150, 1)]
    exact_ones = [forward_backward(t, model) for t in batch]
    segments = hmm.Segments(batch, model)
    assert np.allclose(segments.forward()[0], [x[3] for x in exact_ones])
    for k, part in enumerate(segments.expected()):
        assert np.allclose(part, sum(x[k] for x in exact_ones))


def crc(i):
    return zlib.crc32(str(i).encode()) % 7


@pytest.mark.parametrize("classes", [8, None])
def test_language_model(docs, none, classes):
    turn = F.crc32(F.col("doc_id").cast("string")) % 7
    options = {"learn": turn != 2, "held_out": turn == 2, "own": 20, "classes": classes, "known": 40, "rounds": 2, "states": 2}
    counts = Counter()
    for i, t in ROWS:
        if i is not None and crc(i) != 2:
            counts.update([*normal(t).split(), None])
    n, v = sum(counts.values()), len(counts)
    expected = {}
    for i, t in ROWS:
        tokens = [*normal(t).split(), None]
        expected.setdefault((i, i is not None and crc(i) == 2, len(tokens), sum(counts[w] > 0 for w in tokens), n), []).append(
            sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in tokens))
    got = {}
    for r in hmm.score_texts(docs, **options).collect():
        got.setdefault((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens), []).append(r.base_score)
        assert r.score < 0
    assert got.keys() == expected.keys()
    assert all(np.allclose(sorted(got[k]), sorted(expected[k])) for k in got)
    assert hmm.score_texts(none, **options).count() == 0
    unlearned = hmm.score_texts(docs, **options | {"learn": F.lit(False)}).collect()
    assert len(unlearned) == len(ROWS) and all((r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0) for r in unlearned)


def test_training_raises_the_likelihood_and_shares_sum_to_one(spark, docs):
    source = docs.select("doc_id", F.lit(True).alias("learn"), F.lit(False).alias("held_out"),
                         F.coalesce("text", F.lit("")).cast("binary").alias("data"))
    counts = hmm.word_counts(source).cache()
    book = hmm.alphabet(counts, 30, 8, 60)
    encoded = hmm.encoded(source, spark.sparkContext.broadcast(book), 8).cache()
    model, seen = hmm.train(encoded, book.prior(), 3, 4, weight=0.01)
    assert all(a < b + 1e-6 * abs(b) for a, b in zip(seen, seen[1:]))
    assert np.allclose(model.emit.sum(axis=0), 1) and np.allclose(model.move.sum(axis=1), 1) and np.isclose(model.start.sum(), 1)
    # the words of a class and one unknown word share its probability
    logs = np.log10(book.class_counts + book.class_words + 1.0)
    words = {r.word: r.c for r in counts.collect()}
    own = set(book.words[book.symbols >= 0].view(np.int64).tolist()) | {int(hmm.END.view(np.int64))}
    for k in range(8):
        share = sum(10 ** (np.log10(c + 1.0) - logs[k]) for w, c in words.items() if w not in own and w % 8 == k)
        assert np.isclose(share + 10 ** -logs[k], 1)


def test_every_word_has_emissions_of_its_own(docs):
    """How many words are sent to tasks does not change what the model learns."""
    turn = F.crc32(F.col("doc_id").cast("string")) % 7
    got = [rows(hmm.score_texts(docs, learn=turn != 2, held_out=turn == 2, own=own, classes=None, rounds=3, states=2),
                "doc_id", "n_tokens", "base_score", "score") for own in (10, 100_000)]
    assert len(got[0]) == len(ROWS)
    for one, two in zip(*got):
        assert one[:2] == two[:2] and np.allclose(one[2:], two[2:])
