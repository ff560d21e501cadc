"""Alignment of two tokenizers over whole texts, in Arrow.

Texts are taken together in blocks of some MB. Both tokenizers' ids come as lists, one for each
text; the lists are flattened with the parent index of every token, token lengths are added up and
the sum at the start of a text is taken off, so that every token has the byte offset within its text
at which it ends. A hash join of the two tables on (text, end), outer on both sides, gives all places
where a token ends: where both do, a group ends; and between two neighbouring places lies exactly
one token of each, a link, so the links come from filling the missing side backwards. Links are
counted for each text and pair of ids, and for each block and pair.

Spark adds up the blocks' counts by pair, works out the highest count of each B id, and hands every
block the totals of its own pairs; the texts' sums follow by a hash join on the pair within the
block. So a pair travels once for each block, however often it occurs, and no table of pairs is
broadcast or collected.

Token bytes: an entry of the byte-level vocabulary A decoded by its letters; a piece of B in UTF-8,
with U+2581 as a space and <0xHH> as that byte. A text whose joined bytes of A or B differ from a space and the
text has no tokens: zeros and ''. So have null and empty texts. Repeated ids and rows are counted
each, and ids may be null. A text is never cut; a block holds one text at least.

Pieces that merges cannot cross are encoded once for as long as a worker remembers them: for A the
vocabulary's own pre-tokens, for B what lies between spaces and line ends, since no piece of B has a
space behind another character, or a line end. A text with characters outside A's quick way goes to
the tokenizer as a whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hustings.llm import common
from hustings.llm.packing import PieceIds
from hustings.llm.pretokens import byte_letters

SPACE = "\N{LOWER ONE EIGHTH BLOCK}"
B_PIECES = re.compile(r" *[^ \n]+| +|\n")
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
#: A row for each text, and for each block one with its pairs.
PARTS = ("block long, of_block boolean, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
         "pair array<int>, times array<int>, a array<int>, b array<int>, n array<long>")
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class ByteIds(PieceIds):
    """Ids of a byte-level vocabulary; strings of special tokens are plain text."""

    def __init__(self, path: str, limit: int = 150_000):
        super().__init__(path, limit)
        self.tokenizer.encode_special_tokens = True
        letters = byte_letters()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        entries = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            if all(c in letters for c in token):
                entries[number] = bytes(letters[c] for c in token)
        self.entries = pa.array(entries, pa.binary())


class SentencePieceIds(common.Remembered):
    """Ids of a model that adds a space in front and keeps all spaces; they are the whole text's."""

    def __init__(self, path: str, limit: int = 150_000):
        super().__init__(limit)
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        #: Whether pieces between spaces and line ends can be encoded apart.
        self.apart = not any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in pieces)
        self.entries = pa.array([bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace(SPACE, " ").encode()
                                 for k, p in enumerate(pieces)], pa.binary())

    def make(self, piece: str) -> bytes:
        ids = self.model.encode("\n" + piece, num_threads=1)[2:]  # without the added space and the line end
        return np.array(ids, "<u4").tobytes()

    def of(self, text: str) -> bytes:
        if not self.apart or SPACE in text:
            return np.array(self.model.encode(text, num_threads=1), "<u4").tobytes()
        return b"".join(map(self.__getitem__, B_PIECES.findall(" " + text)))


@cache
def both(a_path: str, b_path: str) -> tuple[ByteIds, SentencePieceIds]:
    """One pair of tables for each Python worker."""
    return ByteIds(a_path), SentencePieceIds(b_path)


def id_lists(ids: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(x) // 4 for x in ids)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32)))


def spelled(lists: pa.ListArray, entries: pa.Array) -> list[bytes]:
    """The joined bytes of each list."""
    tokens = pc.take(entries, lists.flatten())
    if not len(tokens):
        return [b""] * len(lists)
    _, ends, joined = tokens.buffers()  # the bytes of taken entries lie one after the other
    ends = np.frombuffer(ends, np.int32)
    cuts = ends[lists.offsets.to_numpy()]
    joined = memoryview(joined)
    return [bytes(joined[x:y]) for x, y in zip(cuts, cuts[1:])]


def token_ends(lists: pa.ListArray, entries: pa.Array, name: str) -> pa.Table:
    """(text, end, ``name``: the token's number): where every token ends within its text."""
    text = pc.list_parent_indices(lists)
    sums = pc.cumulative_sum(pc.cast(pc.binary_length(pc.take(entries, lists.flatten())), pa.int64()))
    starts = pc.take(pa.concat_arrays([pa.array([0], pa.int64()), sums]), lists.offsets[:-1])
    return pa.table({"text": text, "end": pc.subtract(sums, pc.take(starts, text)),
                     name: pa.array(np.arange(len(text), dtype=np.int32))})


def joined_lists(values: pa.Array, ends: np.ndarray, mark: str) -> pa.Array:
    """Strings joined by ``mark``, as many as lie before each end and behind the one before."""
    offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, values), mark)


def decimals(ids: pa.Array) -> pa.Array:
    return pc.cast(ids, pa.string())


def aligned(texts: list[bytes], a_ids: ByteIds, b_ids: SentencePieceIds) -> tuple[dict, pa.Table, pa.Table]:
    """For a block of texts: the counts and digest of each; (text, pair, times); (pair, a, b, n)."""
    read = [x.decode("utf-8", "replace") for x in texts]
    a = id_lists([a_ids.of(" " + x) if x else b"" for x in read])
    b = id_lists([b_ids.of(x) if x else b"" for x in read])
    whole = [b" " + x if x else b"" for x in texts]
    kept = [x == y == z for x, y, z in zip(whole, spelled(a, a_ids.entries), spelled(b, b_ids.entries))]
    if not all(kept):
        mask = pa.array(kept)
        a, b = (pc.if_else(mask, x, pa.scalar([], pa.list_(pa.int32()))) for x in (a, b))
    a_of, b_of = a.flatten(), b.flatten()
    ends = token_ends(a, a_ids.entries, "i").join(token_ends(b, b_ids.entries, "j"), ["text", "end"],
                                                  join_type="full outer", use_threads=False)
    ends = ends.sort_by([("text", "ascending"), ("end", "ascending")]).combine_chunks()
    text, i, j = (ends.column(c).combine_chunks() for c in ("text", "i", "j"))
    shared = pc.and_(pc.is_valid(i), pc.is_valid(j))
    # the last place of a text is shared, so nothing is filled across texts
    link_a, link_b = pc.take(a_of, pc.fill_null_backward(i)), pc.take(b_of, pc.fill_null_backward(j))
    key = pc.add(pc.multiply(pc.cast(link_a, pa.int64()), 1 << 32), pc.cast(link_b, pa.int64())).dictionary_encode()
    links = pa.table({"text": text, "pair": key.indices}).group_by(["text", "pair"], use_threads=False).aggregate([([], "count_all")])
    links = links.rename_columns(["text", "pair", "times"])
    pairs = links.group_by(["pair"], use_threads=False).aggregate([("times", "sum")])
    keys = pc.take(key.dictionary, pairs.column("pair"))
    pairs = pa.table({"pair": pairs.column("pair"), "a": pc.cast(pc.shift_right(keys, 32), pa.int32()),
                      "b": pc.cast(pc.bit_wise_and(keys, (1 << 32) - 1), pa.int32()), "n": pairs.column("times_sum")})

    last_a, last_b = (pc.drop_null(pc.if_else(shared, x, None)).to_numpy() + 1 for x in (i, j))
    groups = pc.binary_join_element_wise(joined_lists(decimals(a_of), last_a, ","), joined_lists(decimals(b_of), last_b, ","), "|")
    n_groups = np.bincount(pc.filter(text, shared).to_numpy(), minlength=len(texts))
    spelling = joined_lists(groups, np.cumsum(n_groups), ";").to_pylist()
    counts = {"n_a": pc.list_value_length(a).to_numpy(), "n_b": pc.list_value_length(b).to_numpy(), "n_groups": n_groups,
              "n_links": np.bincount(text.to_numpy(), minlength=len(texts)),
              "groups_sha256": [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in spelling]}
    return counts, links, pairs


def lists_by(keys: np.ndarray, n: int, values: list[np.ndarray]) -> list[pa.ListArray]:
    """``values`` as lists, one for each of the keys 0 to n - 1."""
    order = np.argsort(keys, kind="stable")
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(keys, minlength=n))]), pa.int32())
    return [pa.ListArray.from_arrays(offsets, pa.array(v[order], pa.int32())) for v in values]


def parts(docs: DataFrame, a_path: str, b_path: str, block_bytes: int) -> DataFrame:
    """A row for each text, and one for each block of texts, see ``PARTS``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_ids, b_ids = both(a_path, b_path)
        schema = pa.schema([(n, {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "array<int>": pa.list_(pa.int32()),
                                 "array<long>": pa.list_(pa.int64())}[k]) for n, k in (x.split(" ") for x in PARTS.split(", "))])
        task, turn = TaskContext.get().partitionId(), 0

        def rows(ids: list, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
            counts, links, pairs = aligned(texts, a_ids, b_ids)
            block, n = (task << 32) + turn, len(texts)
            pair, times = lists_by(links.column("text").to_numpy(), n, [links.column(c).to_numpy() for c in ("pair", "times")])
            own = {"block": pa.array([block] * n, pa.int64()), "of_block": pa.array([False] * n), "doc_id": pa.array(ids, pa.int64()),
                   **{k: pa.array(v, schema.field(k).type) for k, v in counts.items()}, "pair": pair, "times": times}
            yield pa.RecordBatch.from_arrays([own.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)
            by = np.argsort(pairs.column("pair").to_numpy())  # the pair's number is its place in the list
            whole = {"block": block, "of_block": True} | {k: pairs.column(k).to_numpy()[by] for k in ("a", "b", "n")}
            yield pa.RecordBatch.from_arrays([pa.array([whole.get(f.name)], f.type) for f in schema], schema=schema)

        ids, texts, size = [], [], 0
        for some in common.rows_of(batches, "doc_id", "data", some=64):
            for doc, data in some:
                ids.append(doc)
                texts.append(data)
                size += len(data)
                if size >= block_bytes:
                    yield from rows(ids, texts)
                    ids, texts, size, turn = [], [], 0, turn + 1
        if ids:
            yield from rows(ids, texts)
        pa.default_memory_pool().release_unused()  # workers live on between tasks

    return docs.mapInArrow(run, PARTS)


def summed(texts: pa.Table, pairs: pa.Table) -> pa.Table:
    """A block's texts with the sums over their links; ``pairs`` has the totals of its pairs."""
    lists = texts.column("pair").combine_chunks()
    links = pa.table({"text": pc.list_parent_indices(lists), "pair": lists.flatten(),
                      "times": pc.cast(texts.column("times").combine_chunks().flatten(), pa.int64())})
    links = links.join(pairs.select(["pair", "total", "best"]), ["pair"], join_type="inner", use_threads=False)
    links = links.append_column("sum", pc.multiply(links.column("times"), links.column("total")))
    links = links.append_column("at_best", pc.if_else(links.column("best"), links.column("times"), 0))
    by_text = links.group_by(["text"], use_threads=False).aggregate([("sum", "sum"), ("at_best", "sum")])
    sums, best = np.zeros(texts.num_rows, np.int64), np.zeros(texts.num_rows, np.int64)
    at = by_text.column("text").to_numpy()
    sums[at], best[at] = by_text.column("sum_sum").to_numpy(), by_text.column("at_best_sum").to_numpy()
    return texts.select(["doc_id", *COUNTS]).append_column("n_best", pa.array(best)).append_column("count_sum", pa.array(sums)) \
        .append_column("groups_sha256", texts.column("groups_sha256"))


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text",
                     block_bytes: int = 1 << 20) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every text.

    Groups lie between byte offsets where tokens of A and B both end. Links are pairs of an A and a B
    token whose bytes overlap; the count of an id pair is how many links of all texts have it.
    n_best: links whose count is the highest of their B id, ties included; count_sum: the links'
    counts added up. ``a_path`` and ``b_path``: files that every executor has.
    """
    found = common.store(parts(common.documents(docs, doc_id, text), a_path, b_path, block_bytes))
    pairs = found.where("of_block").select("block", F.posexplode(F.arrays_zip("a", "b", "n"))) \
        .select("block", F.col("pos").alias("pair"), "col.a", "col.b", "col.n")
    of_b = Window.partitionBy("b")  # no larger than A's vocabulary
    totals = pairs.groupBy("a", "b").agg(F.sum("n").alias("total")) \
        .withColumn("best", F.col("total") == F.max("total").over(of_b))
    known = pairs.drop("n").join(totals, ["a", "b"]).select("block", "pair", "total", "best")
    texts = found.where("NOT of_block").select("block", "doc_id", *COUNTS, "groups_sha256", "pair", "times")
    known = known.withColumnRenamed("block", "of")
    return texts.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(summed, RESULT)
