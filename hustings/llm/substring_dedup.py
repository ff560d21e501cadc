"""Repeated passages by a count-min prefilter and exact grouping of what it lets through.

First pass: every task counts the windows (``width`` consecutive words) it reads in count-min
sketches of two rows and sends the cells, block by block. Blocks of all tasks are merged; a merged
cell counts at least as often as any window in it, so a window whose cells are not all at two or more
starts only once in all documents. What remains of the sketch is one bit for each cell.

Second pass: only windows with both bits set are grouped, by 96 bits of their hashes. Each task does
so for what it has read first: a window that starts in an earlier document of the same task is
settled there, so a passage that a third of all documents share leaves each task once. The rest meet
by hash bucket. Nothing that is repeated is lost, whatever the size of the sketch: with more windows
than cells the filter lets more through, and grouping stays exact.

The bits are sent to all executors. Their size does not grow beyond ``filter_bytes``.

Words are runs without ASCII white space, unchanged. Null and empty texts have no words; texts of
fewer words than the width have no windows. Rows that share an id are parts of one document, and a
row with a null id comes after all others; neither makes the other a repetition, and each loses only
its own repeated windows: where unlike texts share an id, places carry a checksum of their text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.llm import common

SKETCH = "row int, block int, cells binary"
STARTS = "block int, nodes binary, starts binary"
OPEN = "bucket int, node long, starts binary, keys binary, more binary, nodes binary"
BLOCK = 18
LAST = (1 << 63) - 1
ROW_FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def nodes_and_data(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(node, doc_id, data); node is an id that sorts null last."""
    return common.documents(docs, doc_id, text).withColumn("node", F.coalesce("doc_id", F.lit(LAST)))


def cells_of(windows: np.ndarray, bits: int) -> list[np.ndarray]:
    """The cell of each window in both rows of the sketch."""
    return [(windows * f) >> np.uint64(64 - bits) for f in ROW_FACTORS]


def sketch_blocks(windows: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For both rows (row, blocks, ends, bytes): sorted cells as gaps in one byte, 255 carrying on."""
    for row, cells in enumerate(cells_of(windows, bits)):
        cells.sort()
        twice = np.concatenate((np.ones(2, bool)[:len(cells)], cells[2:] != cells[:-2]))  # two say enough
        cells = cells[twice]
        blocks = cells >> np.uint64(BLOCK)
        first = np.concatenate((np.ones(1, bool), blocks[1:] != blocks[:-1]))
        gaps = np.empty(len(cells), np.int64)
        gaps[1:] = cells[1:] - cells[:-1]
        gaps[first] = cells[first] & np.uint64((1 << BLOCK) - 1)
        ends = np.cumsum(gaps // 255 + 1)
        out = np.full(ends[-1], 255, np.uint8)
        out[ends - 1] = gaps % 255
        starts = np.flatnonzero(first)
        yield row, blocks[starts].astype(np.int32), np.append(ends[starts[1:] - 1], ends[-1]), out


def block_cells(data: bytes) -> np.ndarray:
    """The cells within a block that ``sketch_blocks`` wrote."""
    gaps = np.frombuffer(data, np.uint8)
    return np.cumsum(gaps, dtype=np.int64)[gaps != 255]


def text_windows(data: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and window hashes."""
    words = common.word_hashes().of(data.split())
    return words, common.window_hashes(words, width)


def partition_sketches(docs: DataFrame, width: int, bits: int, held: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            for row, blocks, ends, data in sketch_blocks(np.concatenate(waiting), bits):
                offsets = np.concatenate(([0], ends)).astype(np.int32)
                cells = pa.Array.from_buffers(pa.binary(), len(blocks), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(blocks), row, np.int32)), pa.array(blocks), cells], ["row", "block", "cells"])

        for rows in common.rows_of(batches, "data"):
            for data, in rows:
                windows = text_windows(data, width)[1]
                waiting.append(windows)
                n += len(windows)
                if n >= held:
                    yield from out()
                    waiting, n = [], 0
        if n:
            yield from out()

    return docs.select("data").mapInArrow(run, SKETCH)


def merged_sketch(parts: DataFrame) -> DataFrame:
    """(row, block, bits): a bit for each cell that counts two or more over all partitions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, counts, done = None, np.zeros(1 << BLOCK, np.uint8), []

        def bits_out() -> None:
            if at is not None:
                done.append((*at, np.packbits(counts >= 2, bitorder="little").tobytes()))

        def out() -> pa.RecordBatch:
            columns = list(zip(*done)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()),
                                               pa.array(columns[2], pa.binary())], ["row", "block", "bits"])

        for rows in common.rows_of(batches, "row", "block", "cells"):
            for row, block, data in rows:
                if at != (row, block):
                    bits_out()
                    at = row, block
                    counts[:] = 0
                    if len(done) >= 256:
                        yield out()
                        done = []
                cells = block_cells(data)
                counts[cells] += 1 - (counts[cells] >> 1)  # up to two, once for each chunk
                again = cells[1:][cells[1:] == cells[:-1]]
                counts[again] = 2
        bits_out()
        yield out()

    return parts.repartition("row", "block").sortWithinPartitions("row", "block") \
        .mapInArrow(run, "row int, block int, bits binary")


def repeated_cells(docs: DataFrame, width: int, bits: int, held: int) -> list[np.ndarray]:
    """Both rows of the sketch as bits, 2^bits / 8 bytes each."""
    out = [np.zeros(1 << (bits - 3), np.uint8) for _ in ROW_FACTORS]
    size = 1 << (BLOCK - 3)
    for r in merged_sketch(partition_sketches(docs, width, bits, held)).collect():
        out[r.row][r.block * size:(r.block + 1) * size] = np.frombuffer(r.bits, np.uint8)[:len(out[0]) - r.block * size]
    return out


def _by_node(nodes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    order = np.argsort(nodes, kind="stable")
    nodes, starts = nodes[order], starts[order]
    firsts = np.flatnonzero(np.concatenate((np.ones(min(1, len(nodes)), bool), nodes[1:] != nodes[:-1])))
    return nodes[firsts], [x.tobytes() for x in np.split(starts, firsts[1:])] if len(firsts) else []


def _grouped(keys: np.ndarray, more: np.ndarray, nodes: np.ndarray, starts: np.ndarray):
    """The arrays in order of window and node, and which entries start in a later node than the first."""
    order = np.lexsort((nodes, more, keys))
    keys, more, nodes, starts = keys[order], more[order], nodes[order], starts[order]
    new = np.concatenate((np.ones(min(1, len(keys)), bool), (keys[1:] != keys[:-1]) | (more[1:] != more[:-1])))
    return keys, more, nodes, starts, nodes > nodes[np.flatnonzero(new)][np.cumsum(new) - 1]


def _open_batch(buckets: np.ndarray, nodes: list | np.ndarray, *binaries: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets, pa.int32()), pa.array(nodes, pa.int64()), *(pa.array(b, pa.binary()) for b in binaries)],
        ["bucket", "node", "starts", "keys", "more", "nodes"])


def start_type(marked: bool) -> type:
    return np.uint64 if marked else np.uint32


def starts_of(at: np.ndarray, data: bytes, marked: bool) -> np.ndarray:
    """Places of windows, with a mark of the text before them where ids do not tell texts apart."""
    return at.astype(np.uint64) | np.uint64(zlib.crc32(data) << 32) if marked else at.astype(np.uint32)


def unlike_texts_share_ids(source: DataFrame) -> bool:
    key = F.xxhash64("data")
    one = source.select("node", key.alias("key")).groupBy("node").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    return not one.where("low <> high").isEmpty()


def window_entries(docs: DataFrame, cells, width: int, bits: int, buckets_log: int, held: int, marked: bool) -> DataFrame:
    """Windows that the filter lets through, settled within each task as far as that goes.

    Rows with keys are open windows of a bucket; rows without are settled starts of one node.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, kept, n = cells.value, [], 0

        def out() -> pa.RecordBatch:
            keys, more, nodes, starts, covered = _grouped(*(np.concatenate(x) for x in zip(*kept)))
            settled, places = _by_node(nodes[covered], starts[covered])
            keys, more, nodes, starts = (x[~covered] for x in (keys, more, nodes, starts))
            bucket = (keys >> np.uint64(64 - buckets_log)).astype(np.int32)
            cut = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), bucket[1:] != bucket[:-1])))
            parts = [[p.tobytes() for p in np.split(x, cut[1:])] for x in (starts, keys, more, nodes)] if len(cut) else [[]] * 4
            none = [None] * len(settled)
            return _open_batch(np.concatenate((bucket[cut], (settled & ((1 << buckets_log) - 1)).astype(np.int32))),
                               np.concatenate((np.full(len(cut), -1), settled)), parts[0] + places,
                               parts[1] + none, parts[2] + none, parts[3] + none)

        for rows_in in common.rows_of(batches, "node", "data"):
            for node, data in rows_in:
                words, windows = text_windows(data, width)
                if not len(windows):
                    continue
                hit = np.ones(len(windows), bool)
                for bit, cell in zip(rows, cells_of(windows, bits)):
                    hit &= (bit[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                at = np.flatnonzero(hit)
                if len(at):
                    more = (common.window_hashes(words, width, common.B)[at] >> np.uint64(32)).astype(np.uint32)
                    kept.append((windows[at], more, np.full(len(at), node, np.int64), starts_of(at, data, marked)))
                    n += len(at)
                if n >= held:
                    yield out()
                    kept, n = [], 0
        if n:
            yield out()

    return docs.select("node", "data").mapInArrow(run, OPEN)


def repeated_starts(entries: DataFrame, blocks_log: int, held: int, marked: bool) -> DataFrame:
    """(node, starts): where windows start that also start in a lesser node; a row for each node."""
    start = start_type(marked)

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting, done, n = None, [], [], 0

        def settle() -> None:
            nonlocal n
            if waiting:
                _, _, nodes, starts, covered = _grouped(*(
                    np.concatenate([np.frombuffer(r[k], t) for r in waiting])
                    for k, t in ((1, np.uint64), (2, np.uint32), (3, np.int64), (0, start))))
                done.append((nodes[covered], starts[covered]))
                n += len(done[-1][0])

        def out() -> pa.RecordBatch:
            nodes, starts = (np.concatenate(x) for x in zip(*done))
            block = (common.mixed(nodes.view(np.uint64)) >> np.uint64(64 - blocks_log)).astype(np.int32)
            order = np.argsort(block, kind="stable")
            block, nodes, starts = block[order], nodes[order], starts[order]
            cut = np.flatnonzero(np.concatenate((np.ones(min(1, len(block)), bool), block[1:] != block[:-1])))
            parts = [[x.tobytes() for x in np.split(y, cut[1:])] if len(cut) else [] for y in (nodes, starts)]
            return pa.RecordBatch.from_arrays([pa.array(block[cut]), *(pa.array(x, pa.binary()) for x in parts)], ["block", "nodes", "starts"])

        for rows in common.rows_of(batches, "bucket", "node", "starts", "keys", "more", "nodes"):
            for bucket, node, starts, keys, more, nodes in rows:
                if bucket != at:
                    settle()
                    at, waiting = bucket, []
                if keys is None:
                    places = np.frombuffer(starts, start)
                    done.append((np.full(len(places), node, np.int64), places))
                    n += len(places)
                else:
                    waiting.append((starts, keys, more, nodes))
                if n >= held:
                    yield out()
                    done, n = [], 0
        settle()
        if done:
            yield out()

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting = None, []

        def out() -> pa.RecordBatch:
            nodes, places = _by_node(*(np.concatenate([np.frombuffer(r[k], t) for r in waiting]) for k, t in ((0, np.int64), (1, start))))
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(places, pa.binary())], ["node", "found"])

        for rows in common.rows_of(batches, "block", "nodes", "starts"):
            for block, nodes, starts in rows:
                if block != at and waiting:
                    yield out()
                    waiting = []
                at = block
                waiting.append((nodes, starts))
        if waiting:
            yield out()

    packed = entries.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(settled, STARTS)
    return packed.repartition("block").sortWithinPartitions("block").mapInArrow(gathered, "node long, found binary")


def without_starts(docs: DataFrame, width: int, texts: bool, marked: bool, others=None) -> DataFrame:
    """Takes the words of repeated windows out of (doc_id, data, found); null: no such windows.

    ``others``: a broadcast bit table; rows that it lets through are left out first, in the same
    worker, so that a task needs but one.
    """
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text", "removed_spans"] * texts
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()] + [pa.string(), pa.list_(pa.int64())] * texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if others is not None:
            batches = (b.filter(pa.array(~common.in_table(b, others.value))) for b in batches)
        for rows in common.rows_of(batches, "doc_id", "data", "found"):
            out = []
            for doc, data, found in rows:
                words = data.split()
                edges = np.zeros(len(words) + width + 1, np.int64)
                if found is not None:
                    places = np.frombuffer(found, start_type(marked))
                    if marked:  # of the texts that share the id only this one's
                        places = places[places >> np.uint64(32) == np.uint64(zlib.crc32(data))] & np.uint64(0xFFFFFFFF)
                    places = np.unique(places).astype(np.int64)
                    np.add.at(edges, places, 1)
                    np.add.at(edges, places + width, -1)
                gone = (np.cumsum(edges) > 0)[:len(words)]
                kept = b" ".join(words if not gone.any() else [w for w, g in zip(words, gone.tolist()) if not g])
                row = [doc, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()]
                if texts:
                    turns = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                    row += [kept.decode("utf-8", "replace"), turns.tolist()]
                out.append(row)
            columns = list(zip(*out)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return docs.mapInArrow(run, schema + ", kept_text string, removed_spans array<long>" * texts)


def only(source: DataFrame, table, bits: int) -> DataFrame:
    """The rows whose node the broadcast bit table lets through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(["node", "doc_id", "data"]).filter(pa.array(common.in_table(batch, table.value)))

    return common.with_cells(source, "node", bits).mapInArrow(run, "node long, doc_id long, data binary")


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 13, texts: bool = False,
                    filter_bytes: int = 1 << 26, held: int = 500_000, table_bytes: int = 1 << 24) -> DataFrame:
    """A row for each row: (doc_id, n_words, n_removed, kept_sha256); with ``texts`` also kept_text
    and removed_spans, which has the first word and the word after the last of each removed run.

    Removes each word covered by a window that also starts in a document with a lesser id. Windows
    are judged on the input. ``filter_bytes`` bounds the sketch's bits as they are sent to executors,
    ``held`` the windows that a task holds at a time, ``table_bytes`` the bit table of the documents
    that lose words; only those, and a few that the table takes for one, are shuffled to their windows.
    """
    spark, source = docs.sparkSession, nodes_and_data(docs, doc_id, text)
    n_bytes = source.agg(F.coalesce(F.sum(F.length("data")), F.lit(0))).first()[0]
    # a cell or two for each word, as far as the bound goes
    bits = int(min(max(BLOCK, (n_bytes // 4).bit_length()), (filter_bytes * 8 // 2).bit_length() - 1))
    cells = spark.sparkContext.broadcast(repeated_cells(source, width, bits, 2 * held))
    buckets_log = int(min(max(8, (n_bytes >> 20).bit_length()), 30))  # about a MB of text to a bucket
    marked = unlike_texts_share_ids(source)
    entries = window_entries(source, cells, width, bits, buckets_log, held, marked)
    found = common.store(repeated_starts(entries, buckets_log, held, marked))
    cells.destroy()  # what it was for is stored
    table, size = common.id_table(found.select(F.col("node").alias("id")), found.count(), table_bytes)
    sent = spark.sparkContext.broadcast(table)
    whole = common.with_cells(source, "node", size).withColumn("found", F.lit(None).cast("binary"))
    cut = only(source, sent, size).join(found, "node", "left").drop("node")
    return without_starts(whole, width, texts, marked, sent).unionByName(without_starts(cut, width, texts, marked))
