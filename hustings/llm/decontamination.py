"""Benchmark decontamination: BM25 over test items, retrieved by block-max WAND.

The test items are the indexed documents; every passage of the training texts is a query. A passage
is two consecutive half passages of ``half`` words, so that passages overlap by half and cover every
word of a text. Scores are divided by what an item needs to be retrieved (``share`` of the score that
the item, or as much of it as a passage can hold, gives itself), so that one threshold, 1, holds for
all and everything above it is retrieved.

Retrieval never scores what cannot reach the threshold. For whole batches at once, the largest
impacts of a passage's words within each group of items are added up; where no group reaches 1,
nothing is looked at. For what remains, postings in blocks with the largest impact of each block are
walked by the pivot rule: the list of terms is advanced to the first item at which the terms' maxima
can reach 1, the maxima of the blocks there decide whether it is worth scoring, and if not whole
blocks are passed over.

A retrieved item is verified in the passage and as many words around it as the item has: the shares
of its question's and of its answer's word triples that are found there must both reach ``overlap``.
The answer is the last sentence of an item, or the last third of its words if it has but one sentence.

Words are runs of letters and digits in lower case. Null and empty texts have no passages. Items of
fewer than ``least_words`` words say too little for scores; they leak into texts of the same words and no other. Repeated rows give repeated ids
once for each item, since a row of the result is a document and an item. Ids may be null.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.llm import common

LEAKS = "doc_id long, item_id long, passage int, score double, question_overlap double, answer_overlap double"
K1, B = 1.2, 0.75
SPACES = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(SPACES).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The words of an item's question and of its answer."""
    sentences = [w for s in re.split(r"(?<=[.?!])\s+|\n+", text) if (w := words_of(s))]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    words = words_of(text)
    cut = len(words) - max(1, len(words) // 3)
    return words[:cut], words[cut:]


def triples(words: list[bytes]) -> set[tuple[bytes, ...]]:
    n = min(3, len(words))
    return {tuple(words[k:k + n]) for k in range(len(words) - n + 1)} if words else set()


def overlap(part: list[bytes], region: list[bytes]) -> float:
    """The share of a part's word triples that the region has; 1 for an empty part."""
    wanted = triples(part)
    if not wanted:
        return 1.0
    n = min(3, len(part))
    have = {tuple(region[k:k + n]) for k in range(len(region) - n + 1)}
    return len(wanted & have) / len(wanted)


class ItemIndex:
    """Inverted index of test items with the largest impact of each block of postings."""

    def __init__(self, items: list[tuple[int | None, str]], half: int, share: float, least_words: int,
                 block: int = 16, groups: int = 32, statistics: tuple[int, float, dict[bytes, int]] | None = None):
        """``statistics``: number and mean length of all items and how many have each word, where
        ``items`` are but some of them."""
        every = [(i, words_of(t), question_and_answer(t)) for i, t in items]
        self.items = [x for x in every if len(x[1]) >= least_words]
        self.short: dict[tuple[bytes, ...], list] = {}
        for i, words, _ in every:
            if 0 < len(words) < least_words:
                self.short.setdefault(tuple(words), []).append(i)
        counts = [Counter(w) for _, w, _ in self.items]
        own = Counter(w for c in counts for w in c)
        n = len(self.items)
        length = sum(len(w) for _, w, _ in self.items) / max(1, n)
        spread = own
        if statistics is not None:
            n, length, all_spread = statistics
            spread = {w: all_spread[w] for w in own}
        self.terms = {w: k for k, w in enumerate(spread)}
        idf = {w: float(np.log(1 + (n - d + 0.5) / (d + 0.5))) for w, d in spread.items()}
        postings: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for place, ((_, words, _), count) in enumerate(zip(self.items, counts)):
            norm = K1 * (1 - B + B * len(words) / length)
            impact = {w: idf[w] * c * (K1 + 1) / (c + norm) for w, c in count.items()}
            need = share * sum(impact.values()) * min(1.0, 2 * half / len(words))
            for w, x in impact.items():
                postings[self.terms[w]].append((place, x / need))
        self.places = [[p for p, _ in x] for x in postings]
        self.impacts = [[v for _, v in x] for x in postings]
        self.lasts = [[x[min(k + block, len(x)) - 1][0] for k in range(0, len(x), block)] for x in postings]
        self.tops = [[max(v for _, v in x[k:k + block]) for k in range(0, len(x), block)] for x in postings]
        self.most = [max(v) for v in self.impacts]
        self.block = block
        per_group = max(1, -(-len(self.items) // groups))
        self.bounds = np.zeros((len(postings), groups), np.float32)
        for term, x in enumerate(postings):
            for place, v in x:
                self.bounds[term, place // per_group] = max(self.bounds[term, place // per_group], v)

    def retrieve(self, terms: list[int]) -> list[tuple[int, float]]:
        """(place of item, score) of all items whose score for these distinct terms is 1 or more."""
        at, block, out = dict.fromkeys(terms, 0), dict.fromkeys(terms, 0), []
        alive = list(terms)
        while True:
            alive.sort(key=lambda t: self.places[t][at[t]])
            total, pivot = 0.0, -1
            for k, t in enumerate(alive):
                total += self.most[t]
                if total >= 1 - 1e-6:
                    pivot = k
                    break
            if pivot < 0:
                return out
            item = self.places[alive[pivot]][at[alive[pivot]]]
            while pivot + 1 < len(alive) and self.places[alive[pivot + 1]][at[alive[pivot + 1]]] == item:
                pivot += 1
            upper, beyond = 0.0, 1 << 60
            for t in alive[:pivot + 1]:
                lasts, b = self.lasts[t], block[t]
                while b < len(lasts) and lasts[b] < item:
                    b += 1
                block[t] = b
                if b < len(lasts):
                    upper += self.tops[t][b]
                    beyond = min(beyond, lasts[b])
            if upper >= 1 - 1e-6:
                score = 0.0
                for t in alive[:pivot + 1]:
                    if self._advance(t, at, block, item) and self.places[t][at[t]] == item:
                        score += self.impacts[t][at[t]]
                if score >= 1 - 1e-9:
                    out.append((item, score))
                target = item + 1
            else:
                following = self.places[alive[pivot + 1]][at[alive[pivot + 1]]] if pivot + 1 < len(alive) else 1 << 60
                target = max(item + 1, min(beyond + 1, following))
            alive = [t for k, t in enumerate(alive) if k > pivot or self._advance(t, at, block, target)]

    def _advance(self, term: int, at: dict, block: dict, item: int) -> bool:
        """Moves a term to its first posting at ``item`` or later; False if there is none."""
        places, k = self.places[term], at[term]
        while block[term] < len(self.lasts[term]) and self.lasts[term][block[term]] < item:
            block[term] += 1
        k = max(k, block[term] * self.block)
        while k < len(places) and places[k] < item:
            k += 1
        at[term] = min(k, len(places) - 1)
        return k < len(places)


def passages(index: ItemIndex, texts: list[list[bytes]], half: int) -> Iterator[tuple[int, int, list[int]]]:
    """(number of text, passage, distinct terms) of every passage that some group of items allows for."""
    halves = np.array([max(1, -(-len(w) // half)) for w in texts])
    first = np.cumsum(halves) - halves
    size = max(1, len(index.terms))
    ids = np.concatenate([np.fromiter(map(index.terms.get, w, repeat(-1)), np.int64, len(w)) for w in texts])
    at = np.concatenate([f + np.arange(len(w)) // half for f, w in zip(first, texts)])
    keys = np.unique((at * size + ids)[ids >= 0])
    if not len(keys):
        return
    at, terms = keys // size, keys % size
    sums = np.zeros((int(halves.sum()) + 1, index.bounds.shape[1]), np.float32)
    starts = np.flatnonzero(np.concatenate((np.ones(1, bool), at[1:] != at[:-1])))
    sums[at[starts]] = np.add.reduceat(index.bounds[terms], starts, axis=0)
    is_last = np.zeros(len(sums) - 1, bool)
    is_last[first + halves - 1] = True
    both = sums[:-1] + np.where(is_last[:, None], 0, sums[1:])
    alone = np.ones(len(is_last), bool)  # the last half is a passage only where it is the first as well
    alone[first + halves - 1] = halves == 1
    possible = np.flatnonzero((both.max(axis=1) >= 1 - 1e-4) & alone)
    text_of = np.repeat(np.arange(len(texts)), halves)
    begin, after = np.searchsorted(at, possible), np.searchsorted(at, possible + 2 - is_last[possible])
    for p, b, e in zip(possible.tolist(), begin.tolist(), after.tolist()):
        t = int(text_of[p])
        yield t, p - int(first[t]), np.unique(terms[b:e]).tolist()


def leaks(docs: DataFrame, index, half: int, least_overlap: float, least_words: int, held: int = 250_000) -> DataFrame:
    """Verified leaks of the items of a broadcast index, a row for each document and item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, ids, texts, n = index.value, [], [], 0

        def out() -> pa.RecordBatch:
            best: dict[tuple, tuple] = {}
            for t, passage, terms in passages(book, texts, half):
                words = texts[t]
                for place, score in book.retrieve(terms):
                    item, own, (question, answer) = book.items[place]
                    if (seen := best.get((t, place))) and seen[3] >= score:
                        continue
                    around = words[max(0, passage * half - len(own)):(passage + 2) * half + len(own)]
                    asked, answered = overlap(question, around), overlap(answer, around)
                    if asked >= least_overlap and answered >= least_overlap:
                        best[t, place] = (ids[t], item, passage, score, asked, answered)
            for t, words in enumerate(texts if book.short else ()):
                for k, item in enumerate(book.short.get(tuple(words), ()) if len(words) < least_words else ()):
                    best[t, ~k] = (ids[t], item, 0, 1.0, 1.0, 1.0)
            columns = list(zip(*best.values())) or [()] * 6
            types = [pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                              [f.split()[0] for f in LEAKS.split(", ")])

        for rows in common.rows_of(batches, "doc_id", "data"):
            for doc, data in rows:
                ids.append(doc)
                texts.append(words_of(data.decode("utf-8", "replace")))
                n += len(texts[-1])
                if n >= held:
                    yield out()
                    ids, texts, n = [], [], 0
        if texts:
            yield out()

    return docs.mapInArrow(run, LEAKS)


def item_words(items: DataFrame, least_words: int) -> DataFrame:
    """(shard, length, word): a row for each different word of an item, and one without a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.rows_of(batches, "shard", "words"):
            out = []
            for shard, text in rows:
                words = words_of(text)
                if len(words) >= least_words:
                    out += [(shard, len(words), w) for w in (None, *set(words))]
            columns = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.binary()))],
                                             ["shard", "length", "word"])

    return items.select("shard", "words").mapInArrow(run, "shard int, length long, word binary")


def benchmark_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                    item_text: str = "text", half: int = 32, share: float = 0.5, least_overlap: float = 0.6,
                    least_words: int = 5, shard_bytes: int = 8 << 20) -> DataFrame:
    """(doc_id, item_id, passage, score, question_overlap, answer_overlap) of every leak.

    Each task holds the index of one shard of items, ``shard_bytes`` of text at most on average; a
    larger benchmark is cut into more shards by hash, which the documents are read against in turn.
    Number, mean length and document frequencies are counted once over all items, so scores do not
    depend on the shards. Items of fewer than ``least_words`` words leak where a whole text equals them.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("long").alias("item"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("words"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_bytes))
    items = items.withColumn("shard", F.pmod(F.xxhash64("item", "words"), F.lit(shards)).cast("int"))
    found = common.store(item_words(items, least_words))
    size = found.where("word IS NULL").agg(F.count("*").alias("n"), F.coalesce(F.avg("length"), F.lit(0.0)).alias("length")).first()
    spread = common.store(found.where("word IS NOT NULL").groupBy("word").agg(F.count("*").alias("items")))
    out = None
    for k in range(shards):
        own = found.where((F.col("shard") == k) & F.col("word").isNotNull()).select("word").distinct()
        known = {bytes(r.word): r["items"] for r in spread.join(own, "word").collect()}  # the words of one shard
        rows = items.where(F.col("shard") == k).select("item", "words").collect()  # one shard at a time
        index = ItemIndex(sorted(((r.item, r.words) for r in rows), key=lambda x: (x[0] is None, x)), half, share, least_words,
                          statistics=(size.n, size.length, known))
        leaked = leaks(common.documents(docs, doc_id, text), spark.sparkContext.broadcast(index), half, least_overlap, least_words)
        out = leaked if out is None else out.unionByName(leaked)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that no item leaks into."""
    ids = common.store(benchmark_leaks(docs, benchmark, **options).select("doc_id").distinct())
    name = options.get("doc_id", "doc_id")
    return docs.join(ids, docs[name].eqNullSafe(ids["doc_id"]), "left_anti")
