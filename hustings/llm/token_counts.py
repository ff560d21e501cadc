"""Token counts by whole-token shortcut.

Before any text is read, every string of the vocabulary is encoded alone, and those that come out as
one token are kept: the whole tokens. A text is cut into the pieces that merges never cross. A piece
that is a whole token counts one without any merging; only the rest are merged, each once for as long
as a worker remembers it.

Null and empty texts have no tokens. A text with characters outside the quick way's reach, or with
what may be a special token, is counted by the tokenizer library as a whole, so results are always
the library's own. Texts are never cut. Rows stay rows: repeated ids are counted each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hustings.llm import common
from hustings.llm.pretokens import OTHER, WORD_PIECES, byte_letters

END = "</w>"
SCHEMA = "doc_id long, n_bytes long, n_tokens long"


def whole_tokens(path: str) -> frozenset[str]:
    """The strings of a vocabulary with word ends that encode alone as exactly their own token."""
    tokenizer, letters = Tokenizer.from_file(path), byte_letters()
    strings = {}
    for token, number in tokenizer.get_vocab(with_added_tokens=False).items():
        if token.endswith(END):
            raw = bytes(letters[c] for c in token.removesuffix(END))
            try:
                strings[raw.decode()] = number
            except UnicodeDecodeError:
                continue  # part of a character never stands alone
    found = tokenizer.encode_batch(list(strings), add_special_tokens=False)
    return frozenset(s for (s, number), e in zip(strings.items(), found) if e.ids == [number])


class PieceCounts(common.Remembered):
    """Tokens of a piece: one for whole tokens, merged otherwise."""

    def __init__(self, path: str, whole: frozenset[str], limit: int = 300_000):
        super().__init__(limit)
        self.tokenizer, self.whole = Tokenizer.from_file(path), whole
        self.shown = {b: c for c, b in byte_letters().items()}

    def make(self, piece: str) -> int:
        if piece in self.whole:
            return 1
        return len(self.tokenizer.model.tokenize("".join(self.shown[b] for b in piece.encode())))

    def of(self, text: str) -> int:
        if OTHER.search(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return sum(map(self.__getitem__, WORD_PIECES.findall(text.lower())))


@cache
def piece_counts(path: str, whole: frozenset[str]) -> PieceCounts:
    """One table for each Python worker."""
    return PieceCounts(path, whole)


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                 limit: int | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens), and with ``limit`` over_limit: n_tokens > limit.

    ``path``: a vocabulary file that every executor has. The set of whole tokens is sent along; it is
    no larger than the vocabulary, whatever the data.
    """
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = piece_counts(path, whole.value)
        for batch in batches:
            data = batch.column("data").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(len, data), pa.int64()),
                 pa.array((counts.of(x.decode("utf-8", "replace")) for x in data), pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    out = common.documents(docs, doc_id, text).mapInArrow(count, SCHEMA)
    return out if limit is None else out.withColumn("over_limit", F.col("n_tokens") > limit)
