"""Exact duplicates by a cuckoo-filter index of live digests.

The index is cut into buckets by digest. Each bucket has a cuckoo filter of 16-bit fingerprints and
the stored content it stands for: full SHA-256 digest, length in bytes, the row that stays and the
number of copies. An insertion asks the filter first. No hit: certainly new. A hit is verified
against the stored content, so a false hit never merges two texts. Deletion takes the digest out of
filter and content alike. When an insertion finds no place, the filter is made anew with twice the
slots from the stored keys, so nothing is lost.

Null counts as empty, and empty texts are equal to each other. Rows that share both id and text are
one document: each gets the same verdict. A null id never stays if a row with an id has the same text.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.llm import common

SLOTS, KICKS = 4, 200
DIGESTS = "doc_id long, digest binary, n_bytes long"
INDEX = "bucket int, digest binary, n_bytes long, keep_id long, group_size long"
CHANGE = f"{INDEX}, kind int"
STORED, REMOVED, ADDED = 0, 1, 2
ARROW = pa.schema([("bucket", pa.int32()), ("digest", pa.binary()), ("n_bytes", pa.int64()),
                   ("keep_id", pa.int64()), ("group_size", pa.int64())])


class CuckooFilter:
    """Fingerprints in one of two buckets of four slots; membership without false negatives."""

    def __init__(self, buckets: int):
        self.mask = (1 << max(2, (buckets - 1).bit_length())) - 1
        self.slots = array("H", bytes(2 * SLOTS * (self.mask + 1)))

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[8:10], "big") or 1
        first = int.from_bytes(digest[10:18], "big") & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, place: int, mark: int) -> int:
        return place ^ (mark * 0x5BD1E995 >> 3 & self.mask)

    def _find(self, place: int, mark: int) -> int:
        start = place * SLOTS
        for k in range(start, start + SLOTS):
            if self.slots[k] == mark:
                return k
        return -1

    def __contains__(self, digest: bytes) -> bool:
        mark, first, second = self._places(digest)
        return self._find(first, mark) >= 0 or self._find(second, mark) >= 0

    def add(self, digest: bytes) -> bool:
        """False if there is no place; the filter has then lost a fingerprint and must be made anew."""
        mark, first, second = self._places(digest)
        for place in (first, second):
            if (k := self._find(place, 0)) >= 0:
                self.slots[k] = mark
                return True
        place = second
        for turn in range(KICKS):
            k = place * SLOTS + turn % SLOTS
            mark, self.slots[k] = self.slots[k], mark
            place = self._other(place, mark)
            if (k := self._find(place, 0)) >= 0:
                self.slots[k] = mark
                return True
        return False

    def remove(self, digest: bytes) -> None:
        mark, first, second = self._places(digest)
        k = self._find(first, mark)
        k = k if k >= 0 else self._find(second, mark)
        if k >= 0:
            self.slots[k] = 0


class DigestIndex:
    """One bucket of the index: a filter in front of the stored content."""

    def __init__(self, buckets: int = 64):
        self.filter = CuckooFilter(buckets)
        self.content: dict[bytes, list] = {}
        self.false_hits = self.resizes = 0

    def add(self, digest: bytes, n_bytes: int, keep_id: int | None, copies: int) -> None:
        if digest in self.filter:
            held = self.content.get(digest)
            if held is not None and held[0] == n_bytes:
                held[1] = keep_id if held[1] is None else held[1] if keep_id is None else max(held[1], keep_id)
                held[2] += copies
                return
            self.false_hits += 1
        self.content[digest] = [n_bytes, keep_id, copies]
        if not self.filter.add(digest):
            self._resize()

    def remove(self, digest: bytes) -> None:
        if digest in self.filter and self.content.pop(digest, None) is not None:
            self.filter.remove(digest)

    def _resize(self) -> None:
        size = self.filter.mask + 1
        while True:
            size *= 2
            self.resizes += 1
            self.filter = CuckooFilter(size)
            if all(self.filter.add(d) for d in self.content):
                return


def lower_ascii(data: bytes) -> bytes:
    return data.lower()  # of bytes: A to Z only


def text_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", more: Sequence[str] = ()) -> DataFrame:
    """(*more, doc_id, digest, n_bytes) of every whole text with A-Z in lower case."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [lower_ascii(x) for x in batch.column("data").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in more), batch.column("doc_id"),
                 pa.array([hashlib.sha256(x).digest() for x in texts], pa.binary()),
                 pa.array(map(len, texts), pa.int64())], [*more, "doc_id", "digest", "n_bytes"])

    return common.documents(docs, doc_id, text, *more).mapInArrow(run, common.schema_of(docs, more) + DIGESTS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW)], schema=ARROW)


def index_entries(digests: DataFrame, buckets: int, held: int = 50_000) -> DataFrame:
    """Rows as index entries, copies put together within each task first, so that a text that a
    third of all rows share reaches its bucket as a few rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = DigestIndex()

        def out() -> pa.RecordBatch:
            return _batch([(int.from_bytes(d[:4], "big") % buckets, d, *c) for d, c in seen.content.items()])

        for rows in common.rows_of(batches, "doc_id", "digest", "n_bytes"):
            for doc, digest, n_bytes in rows:
                seen.add(digest, n_bytes, doc, 1)
                if len(seen.content) >= held:
                    yield out()
                    seen = DigestIndex()
        yield out()

    return digests.mapInArrow(run, INDEX)


def change_index(index: DataFrame, added: DataFrame | None = None, removed: DataFrame | None = None) -> DataFrame:
    """The index after removals and then additions; all three have the columns of the index.

    Each bucket is worked through by one task with that bucket's keys in memory and no others;
    choose the number of buckets for the size wanted.
    """
    changes = index.withColumn("kind", F.lit(STORED))
    for frame, kind in ((removed, REMOVED), (added, ADDED)):
        if frame is not None:
            changes = changes.unionByName(frame.withColumn("kind", F.lit(kind)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, live = None, DigestIndex()

        def out() -> pa.RecordBatch:
            return _batch([(bucket, d, *c) for d, c in live.content.items()])

        for rows in common.rows_of(batches, "bucket", "kind", "digest", "n_bytes", "keep_id", "group_size"):
            for at, kind, digest, n_bytes, keep_id, copies in rows:
                if at != bucket:
                    if bucket is not None:
                        yield out()
                    bucket, live = at, DigestIndex()
                if kind == REMOVED:
                    live.remove(digest)
                else:
                    live.add(digest, n_bytes, keep_id, copies)
        if bucket is not None:
            yield out()

    return changes.repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(run, INDEX)


def bucket_count(rows: int, held: int = 50_000) -> int:
    """Buckets such that one holds about ``held`` keys at most."""
    return max(64, -(-rows // held))


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", more: Sequence[str] = ()) -> DataFrame:
    """A row for each row: (*more, doc_id, keep_id, group_size, kept, text_sha256, n_bytes); ``more``:
    columns of ``docs`` to go along.

    Of equal texts (after lower-casing A-Z) the row with the largest id stays. Texts are hashed where
    they are read; only digests are shuffled. The digests are stored once, since both the index and
    the verdicts read them.
    """
    digests = common.store(text_digests(docs, doc_id, text, more))
    empty = common.empty(docs.sparkSession, INDEX)
    index = change_index(empty, added=index_entries(digests, bucket_count(digests.count())))
    joined = digests.join(index.select("digest", "keep_id", "group_size"), "digest")
    return joined.select(*more, "doc_id", "keep_id", "group_size",
                         F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                         F.lower(F.hex("digest")).alias("text_sha256"), "n_bytes")
