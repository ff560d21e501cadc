"""Near duplicates by MinHash: many universal hash minima, banding, verification, components.

A text's set is its distinct word shingles. Texts with the same set are one class from the start and
only its least id goes on, so copies cost nothing more. Each class has a signature: the least value
of its shingles under each of many universal hash functions. Classes that agree on a whole band of
the signature share a bucket.

Within a bucket not all pairs are listed. Its least member is compared with the others (a star, as
many pairs as members): by the signatures first, where an estimate far below the threshold ends it,
and then on the full shingle sets, which alone decide. Links so found are put together into
components. A bucket whose members lie in one component is settled, since more links would change
nothing. In the others, the members outside the component of the first one are compared with all
members of other components, in blocks: a task gets two packs of a few hundred full sets and counts
all their intersections by one product of incidence matrices. It returns a link for each two
components that have one. So nothing is capped, and the rows that move grow with the packs, not with
the pairs.

Full sets are made only for classes that share a bucket: the ids are sent as a bit table of bounded
size, which lets a few others through but loses none, and what it lets through is joined exactly.

Case A-Z does not matter; words are runs without ASCII white space; with fewer words than the width
the whole sequence is the one shingle; texts without words have an empty set and no links. Classes
have numbers of their own, so rows that share an id but not the text are judged by their own text each. Rows with a null id are kept and have
no links.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.llm import common
from hustings.llm.components import components

BANDS, ROWS = 28, 4
SKETCHES = "doc_id long, n_shingles long, set_key binary, signature binary"
PACK = 256


def shingle_set(data: bytes, width: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    words = data.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(common.window_hashes(common.word_hashes().of(words), min(width, len(words))))


def universal(count: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and shifts of the hash functions."""
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 1 << 32, (count, 1), np.uint32, False) | np.uint32(1),
            rng.integers(0, 1 << 32, (count, 1), np.uint32, False))


def minima(shingles: np.ndarray, functions: tuple[np.ndarray, np.ndarray], block: int = 512) -> np.ndarray:
    """The least value of (a x + b) mod 2^32 over all shingles, for each function."""
    a, b = functions
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), block):
        values = a * x[k:k + block]
        values += b
        np.minimum(out, values.min(axis=1), out=out)
    return out


def sketches(docs: DataFrame, doc_id: str, text: str, width: int, bands: int, rows: int, more: Sequence[str] = ()) -> DataFrame:
    """(*more, doc_id, n_shingles, set_key, signature); key and signature are null for an empty set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions = universal(bands * rows)
        for batch in batches:
            sizes, keys, signatures = [], [], []
            for data in batch.column("data").to_pylist():
                shingles = shingle_set(data, width)
                sizes.append(len(shingles))
                keys.append(set_key(shingles))
                signatures.append(minima(shingles, functions).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in more), batch.column("doc_id"), pa.array(sizes, pa.int64()),
                 pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())],
                [*more, "doc_id", "n_shingles", "set_key", "signature"])

    return common.documents(docs, doc_id, text, *more).mapInArrow(run, common.schema_of(docs, more) + SKETCHES)


def set_key(shingles: np.ndarray) -> bytes | None:
    """Tells sets apart; null for an empty one."""
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def shingle_sets(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, width: int, most_bytes: int = 1 << 24) -> DataFrame:
    """(id, shingles) of the classes in ``wanted`` (id, doc, set_key); shingles are sorted 64-bit
    hashes. ``doc`` finds the texts, and of the texts that share it the key finds the class's own."""
    docs_wanted = wanted.select(F.col("doc").alias("id"))
    table, bits = common.id_table(docs_wanted, wanted.count(), most_bytes)
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(common.in_table(batch, sent.value)))
            sets = [shingle_set(x, width) for x in batch.column("data").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(map(set_key, sets), pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary())],
                ["doc", "set_key", "shingles"])

    rows = common.documents(docs, doc_id, text).where("doc_id IS NOT NULL").withColumnRenamed("doc_id", "doc")
    made = common.with_cells(rows, "doc", bits).mapInArrow(run, "doc long, set_key binary, shingles binary")
    return made.join(wanted, ["doc", "set_key"]).select("id", "shingles")


def bands_of(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """(id, n_shingles, bucket): each class once for each band of its signature."""
    size = F.lit(4 * rows)
    cut = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)),
                      lambda k: F.xxhash64(k, F.substring("signature", k * size + 1, size)))
    return classes.select("id", "n_shingles", F.explode(cut).alias("bucket"))


def sizes_allow(a: Column, b: Column, percent: int) -> Column:
    """False only where the sizes alone rule the similarity out."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, width)


def signatures_agree(pairs: DataFrame, classes: DataFrame, width: int, least: float) -> DataFrame:
    """Pairs (left, right) whose signatures agree in ``least`` of their places or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = _matrix(batch.column("of_left"), width) == _matrix(batch.column("of_right"), width)
            yield batch.select(["left", "right"]).filter(pa.array(same.mean(axis=1) >= least))

    one = classes.select(F.col("id").alias("left"), F.col("signature").alias("of_left"), F.col("n_shingles").alias("n_left"))
    two = classes.select(F.col("id").alias("right"), F.col("signature").alias("of_right"), F.col("n_shingles").alias("n_right"))
    return pairs.join(one, "left").join(two, "right").select("left", "right", "of_left", "of_right") \
        .mapInArrow(run, "left long, right long")


def sets_agree(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (left, right) whose full sets reach the similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for a, b in zip(batch.column("of_left").to_pylist(), batch.column("of_right").to_pylist()):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = np.concatenate((a, b))
                both.sort()
                common_ones = int(np.count_nonzero(both[1:] == both[:-1]))
                good.append(100 * common_ones >= percent * (len(a) + len(b) - common_ones))
            yield batch.select(["left", "right"]).filter(pa.array(good, pa.bool_()))

    one = sets.select(F.col("id").alias("left"), F.col("shingles").alias("of_left"))
    two = sets.select(F.col("id").alias("right"), F.col("shingles").alias("of_right"))
    return pairs.join(one, "left").join(two, "right").select("left", "right", "of_left", "of_right") \
        .mapInArrow(run, "left long, right long")


def intersections(one: list[np.ndarray], two: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """The sizes of the intersections of all sets of one list with all of the other."""
    values = np.concatenate([*one, *two])
    _, place, times = np.unique(values, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(one) + len(two)), [len(x) for x in (*one, *two)])
    shared = np.flatnonzero(times[place] > 1)
    number = np.cumsum(times > 1) - 1
    place, owner = number[place[shared]], owner[shared]
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    out = np.zeros((len(one), len(two)), np.float32)
    for k in range(0, int(number[-1]) + 1 if len(number) else 0, columns):
        b, e = np.searchsorted(place, (k, k + columns))
        table = np.zeros((len(one) + len(two), columns), np.float32)
        table[owner[b:e], place[b:e] - k] = 1
        out += table[:len(one)] @ table[len(one):].T
    return out.astype(np.int64)


def packs(rows: DataFrame, name: str) -> DataFrame:
    """(bucket, name): the rows of a bucket in packs of about ``PACK``, of (component, id, shingles)."""
    n = rows.groupBy("bucket").agg(F.count("*").alias("rows"))
    slices = F.pmod(F.xxhash64("id"), F.ceil(F.col("rows") / PACK))
    return rows.join(n, "bucket").groupBy("bucket", slices.alias("slice")).agg(
        F.collect_list(F.struct("component", "id", "shingles")).alias(name)).select("bucket", name)


def links_between(grid: DataFrame, percent: int) -> DataFrame:
    """(left, right): a link for each two components that have one, from pairs of packs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {}
            for one, two in zip(batch.column("one").to_pylist(), batch.column("two").to_pylist()):
                sets = [[np.frombuffer(r["shingles"], np.uint64) for r in x] for x in (one, two)]
                both = intersections(*sets)
                sizes = np.array([len(x) for x in sets[0]])[:, None] + np.array([len(x) for x in sets[1]])[None, :]
                of = [np.array([r["component"] for r in x]) for x in (one, two)]
                good = (100 * both >= percent * (sizes - both)) & (of[0][:, None] != of[1][None, :])
                for i, j in zip(*np.nonzero(good)):
                    found.setdefault((one[i]["component"], two[j]["component"]), (one[i]["id"], two[j]["id"]))
            left, right = zip(*found.values()) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["left", "right"])

    return grid.mapInArrow(run, "left long, right long")


def class_components(docs: DataFrame, classes: DataFrame, doc_id: str, text: str, width: int, percent: int,
                     bands: int, rows: int, margin: float) -> DataFrame:
    """(node, component) of the classes that are linked with another."""
    members = bands_of(classes, bands, rows)
    firsts = members.groupBy("bucket").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    members = common.store(members.join(firsts, "bucket"))  # only of buckets that two or more share
    ids = members.select("id").distinct()
    shared = common.store(classes.join(ids, "id", "left_semi"))
    sizes = shared.select(F.col("id").alias("left"), F.col("n_shingles").alias("n_left"))
    stars = members.where("id > first").select(F.col("first").alias("left"), F.col("id").alias("right"),
                                               "n_shingles").distinct().join(sizes, "left") \
        .where(sizes_allow(F.col("n_shingles"), F.col("n_left"), percent)).select("left", "right")
    sets = common.store(shingle_sets(docs, shared.select("id", "doc", "set_key"), doc_id, text, width).dropDuplicates(["id"]))
    likely = signatures_agree(stars, shared, bands * rows, percent / 100 - margin)
    links = common.store(sets_agree(likely, sets, percent))
    labels = components(links, "left", "right")

    placed = members.where("n > 2").join(labels.withColumnRenamed("node", "id"), "id", "left") \
        .select("bucket", "id", F.coalesce("component", "id").alias("component"), "first")
    of_first = placed.where("id = first").select("bucket", F.col("component").alias("of_first"))
    outside = common.store(placed.where("id <> first").join(of_first, "bucket").where("component <> of_first")
                           .select("bucket", "id", "component"))
    if outside.isEmpty():
        return labels
    rest = placed.where("id <> first").join(outside.select("bucket").distinct(), "bucket", "left_semi").drop("first")
    grid = packs(outside.join(sets, "id"), "one").join(packs(rest.join(sets, "id"), "two"), "bucket")
    more = links_between(grid, percent)
    return components(labels.select(F.col("node").alias("left"), F.col("component").alias("right")).union(more), "left", "right")


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80,
               bands: int = BANDS, rows: int = ROWS, margin: float = 0.2,
               more: Sequence[str] = ()) -> DataFrame:
    """A row for each row: (*more, doc_id, n_shingles, component_id, kept); ``more``: columns of
    ``docs`` to go along.

    ``component_id`` is the least id that verified links reach, ``kept`` the rows that have it. A
    pair of exactly the threshold, 0.8, shares no bucket with a probability of (1 - 0.8^rows)^bands,
    4e-7 by default; an estimate ``margin`` below the threshold is rarer still.
    """
    known = common.store(sketches(docs, doc_id, text, width, bands, rows, more))
    classes = known.where("doc_id IS NOT NULL AND set_key IS NOT NULL").groupBy("set_key").agg(
        F.min("doc_id").alias("doc"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    classes = common.store(classes.withColumn("id", F.monotonically_increasing_id()))  # doc_ids need not be unique
    labels = class_components(docs, classes, doc_id, text, width, percent, bands, rows, margin)
    of_class = classes.select("set_key", "doc", "id").join(labels.withColumnRenamed("node", "id"), "id", "left") \
        .select("set_key", "doc", F.coalesce("component", "id").alias("component"))
    least = of_class.groupBy("component").agg(F.min("doc").alias("least"))
    of_key = of_class.join(least, "component").select("set_key", "least")
    found = known.drop("signature")
    with_set = found.where("set_key IS NOT NULL").join(of_key, "set_key", "left")
    out = with_set.unionByName(found.where("set_key IS NULL").withColumn("least", F.lit(None).cast("long"))).select(
        *more, "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
