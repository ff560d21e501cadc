"""Best-fit packing with exact complements.

Documents become pieces of at most ``capacity`` tokens. How pieces fill sequences depends only on
how many pieces there are of each length, a table of at most ``capacity`` rows whatever the data, so
the plan is made from that table: for the longest length left, an index of the lengths still
available is asked for one length, then two, then three that fill the gap exactly; all sequences of
that kind are filled at once, as often as the counts allow. What has no exact complement is packed
best fit decreasing. The plan is a list of runs: "pieces number i to j of length n go to
sequences s to s + j - i at this offset"; every step uses up a length or fills a kind of sequence,
so there are a few thousand runs at any scale. Pieces take their number within their length and find
their run by a join; no piece passes through the driver.

Null and empty texts give one piece, the closing token. Repeated rows and ids are packed each. A row
with a null id is packed like any other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hustings.llm import common
from hustings.llm.pretokens import BYTE_PIECES, OTHER, byte_letters

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, turn long"
RUNS = "length long, first long, after long, sequence long, offset long"


class PieceIds(common.Remembered):
    """The ids of a piece as little-endian unsigned 32-bit numbers.

    Single pieces are merged by the same vocabulary as ranks, whole texts by the tokenizer itself.
    """

    def __init__(self, path: str, limit: int = 300_000):
        super().__init__(limit)
        self.tokenizer, letters = Tokenizer.from_file(path), byte_letters()
        ranks = {bytes(letters[c] for c in t): n for t, n in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        self.merged = tiktoken.Encoding("pieces", pat_str="(?s:.+)", mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def make(self, piece: str) -> bytes:
        return np.array(self.merged(piece), "<u4").tobytes()

    def of(self, text: str) -> bytes:
        if OTHER.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.__getitem__, BYTE_PIECES.findall(text)))


@cache
def piece_ids(path: str) -> PieceIds:
    """One table for each Python worker."""
    return PieceIds(path)


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: only the first may be shorter than the capacity."""
    first = length % capacity or min(length, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


def token_pieces(docs: DataFrame, path: str, capacity: int, doc_id: str = "doc_id", text: str = "text",
                 end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Pieces of every whole text, with the number (task, turn) of a piece among those of its length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, task = piece_ids(path), TaskContext.get().partitionId()
        end, turns = np.array([end_id], "<u4").tobytes(), [0] * (capacity + 1)
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "turn"] + ["ids"] * keep_ids
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        types += [pa.binary()] * keep_ids
        for rows in common.rows_of(batches, "doc_id", "data"):
            out = []
            for doc, data in rows:
                ids = ids_of.of(data.decode("utf-8", "replace")) + end
                for k, (start, length) in enumerate(cuts(len(ids) // 4, capacity)):
                    part = ids[4 * start:4 * (start + length)]
                    out.append((doc, k, start, length, zlib.crc32(part), task, turns[length]) + (part,) * keep_ids)
                    turns[length] += 1
            columns = list(zip(*out)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return common.documents(docs, doc_id, text).mapInArrow(run, PIECES + ", ids binary" * keep_ids)


class LengthIndex:
    """How many pieces of each length are left, and which sums of one, two or three they can make."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n

    def largest(self, most: int) -> int:
        found = np.flatnonzero(self.left[:most + 1])
        return int(found[-1]) if len(found) else 0

    def pair(self, total: int, most: int) -> tuple[int, int] | None:
        """Two lengths of this sum, the longer one as long as possible and at most ``most``."""
        high = min(most, total - 1)
        low = (total + 1) // 2
        if high < low:
            return None
        have = (self.left[low:high + 1] > 0) & (self.left[total - high:total - low + 1][::-1] > 0)
        if total % 2 == 0 and self.left[total // 2] < 2:
            have[0] = False
        found = np.flatnonzero(have)
        return (low + int(found[-1]), total - low - int(found[-1])) if len(found) else None

    def exact(self, gap: int, most: int = 3) -> tuple[int, ...] | None:
        """Available lengths, ``most`` at most, that make exactly ``gap``."""
        if self.left[gap] > 0:
            return (gap,)
        if most > 1 and (two := self.pair(gap, gap)):
            return two
        for longest in np.flatnonzero(self.left[-(-gap // 3):gap - 1])[::-1] + -(-gap // 3) if most > 2 else ():
            longest = int(longest)
            self.left[longest] -= 1
            two = self.pair(gap - longest, longest)
            self.left[longest] += 1
            if two:
                return (longest, *two)
        return None

    def take(self, lengths: tuple[int, ...], wanted: int) -> int:
        """How often all of them can be taken, ``wanted`` times at most; takes them."""
        times = min([wanted, *(int(self.left[n]) // lengths.count(n) for n in set(lengths))])
        for n in lengths:
            self.left[n] -= times
        return times


def packing_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first, after, sequence, offset) that place every piece: of the plans that fill gaps
    exactly with up to three, two, one or no pieces before best fit, the one with the fewest sequences."""
    least, best = -(-sum(n * c for n, c in counts.items()) // capacity), None
    for most in (3, 2, 1, 0):
        if best is None or sum(times for _, times in best) > least:
            found = _plan(counts, capacity, most)
            best = found if best is None or sum(t for _, t in found) < sum(t for _, t in best) else best
    used, runs, sequence = dict.fromkeys(counts, 0), [], 0
    for lengths, times in best:
        offset = 0
        for n in lengths:
            runs.append((n, used[n], used[n] + times, sequence, offset))
            used[n] += times
            offset += n
        sequence += times
    return runs


def _plan(counts: dict[int, int], capacity: int, most: int) -> list[tuple[tuple[int, ...], int]]:
    """Kinds of sequences (lengths, how many): exact complements of ``most`` pieces at most, longest
    pieces first, and then best fit for what has none."""
    index, kinds, rest = LengthIndex(counts, capacity), [], {}
    while longest := index.largest(capacity):
        while wanted := int(index.left[longest]):
            gap = capacity - longest
            index.left[longest] -= 1  # the piece itself is no part of its complement
            others = () if gap == 0 else index.exact(gap, most) if most else None
            index.left[longest] += 1
            if others is None:
                rest[longest] = index.take((longest,), wanted)
            else:
                whole = (longest, *others)
                kinds.append((whole, index.take(whole, wanted)))
    return kinds + _best_fit(rest, capacity)


def _best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing, all pieces of a length and all sequences of a kind at once."""
    by_gap: dict[int, list[tuple[tuple[int, ...], int]]] = {capacity: []}
    for n in sorted(counts, reverse=True):
        left = counts[n]
        while left:
            gap = min((g for g, kinds in by_gap.items() if g >= n and kinds), default=capacity)
            if not by_gap[gap]:  # only new sequences have room
                by_gap[gap].append(((), left))
            lengths, times = by_gap[gap].pop()
            taken = min(times, left)
            if taken < times and lengths:
                by_gap[gap].append((lengths, times - taken))
            by_gap.setdefault(gap - n, []).append(((*lengths, n), taken))
            left -= taken
    return [kind for kinds in by_gap.values() for kind in kinds]


def pack(docs: DataFrame, path: str, capacity: int, doc_id: str = "doc_id", text: str = "text",
         end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """A row for each piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset), with
    ``keep_ids`` also the ids themselves as little-endian unsigned 32-bit numbers.

    Pieces are stored once, because their numbers within a length hang on the tasks that made them.
    """
    spark = docs.sparkSession
    pieces = common.store(token_pieces(docs, path, capacity, doc_id, text, end_id, keep_ids))
    per_task = pieces.groupBy("length", "task").agg((F.max("turn") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = common.store(per_task.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))))
    counts = {r.length: r.n for r in base.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    runs = spark.createDataFrame(packing_plan(counts, capacity), RUNS)
    numbered = pieces.join(base.select("length", "task", "base"), ["length", "task"])
    rank = F.col("base") + F.col("turn")
    placed = numbered.join(runs.withColumnRenamed("length", "of"),
                           (F.col("length") == F.col("of")) & (rank >= F.col("first")) & (rank < F.col("after")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32",
                         (F.col("sequence") + rank - F.col("first")).alias("sequence_id"), "offset",
                         *["ids"] * keep_ids)
