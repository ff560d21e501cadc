"""Language identification by Bayesian evidence fusion.

Four kinds of evidence meet in one posterior over the languages of the training labels:

* the text: hashed byte-trigram likelihoods, smoothed, with long texts counted as ``weight`` trigrams
  at most, since neighbouring trigrams are far from independent;
* the declared language (markup's lang attribute, or a column), by how often texts of each language
  declare it;
* the last label of the address, by how often texts of each language have it;
* the host, as prior: the languages of the other texts of the host, smoothed by those of its domain,
  which are smoothed by those of all.

The tables behind the last three are sums of the text posteriors, grouped; each row's own posterior
is taken out of its host's and domain's sums before they judge it. Evidence that a row lacks, or a
value no other row has, says nothing.

A row is accepted if it has letters and its best posterior reaches ``least``. Null, empty and
letterless texts are judged by the other evidence but never accepted. Without training labels there
is no language to tell, and every text with letters is accepted. Ties go to the first language in
alphabetical order. Repeated rows count as often as they occur; ids may be null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.llm import common

FEATURES = 1 << 16
SPACES = bytes(c if chr(c).isalpha() or c > 127 else 32 for c in range(256))
MARKUP = re.compile(rb"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w{1,31};")
DECLARED = re.compile(rb"""(?is)<html\b[^>]*?\blang\s*=\s*["']?\s*([a-z]{2,3})\b""")
HOST = re.compile(r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:\[\]]+)")


@dataclass
class Profiles:
    """Languages and the logarithm of each trigram feature's share in them (features, languages)."""
    languages: list[str]
    logs: np.ndarray


def features(data: bytes) -> np.ndarray:
    """The hashed byte trigrams of a text in lower case, without those of spaces alone."""
    raw = np.frombuffer(b" " + data.decode("utf-8", "replace").lower().encode().translate(SPACES) + b" ", np.uint8)
    raw = raw[np.concatenate((np.ones(1, bool), (raw[1:] != 32) | (raw[:-1] != 32)))].astype(np.uint32)
    if len(raw) < 3:
        return np.empty(0, np.int64)
    code = raw[:-2] | raw[1:-1] << np.uint32(8) | raw[2:] << np.uint32(16)
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)


def visible(markup: bytes) -> bytes:
    return MARKUP.sub(b" ", markup)


def train_profiles(labelled: DataFrame, language: str, text: str, per_language: int = 5000, most: int = 64,
                   smoothing: float = 0.5) -> Profiles:
    """Profiles from a bounded sample: ``per_language`` texts of each language as expected by hash of
    the text, and the ``most`` frequent languages at most."""
    rows = labelled.select(F.lower(F.trim(F.col(language))).alias("language"), F.col(text).cast("string").alias("words")) \
        .where("language <> '' AND words <> ''")
    sizes = {r.language: r.n for r in rows.groupBy("language").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "language").limit(most).collect()}
    names = sorted(sizes)
    share = F.create_map(*[F.lit(x) for n in names for x in (n, min(1.0, per_language / sizes[n]))]) if names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), FEATURES), np.int64)
        for batch in batches:
            for name, data in zip(batch.column("language").to_pylist(), batch.column("data").to_pylist()):
                total[names.index(name)] += np.bincount(features(data), minlength=FEATURES)
        k, f = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(f, pa.int32()), pa.array(total[k, f])], ["k", "f", "n"])

    counts = np.full((len(names), FEATURES), smoothing)
    if names:
        turn = F.pmod(F.xxhash64("words"), F.lit(1_000_000)) / 1_000_000
        sample = rows.where(turn < F.element_at(share, F.col("language"))).select("language", F.col("words").cast("binary").alias("data"))
        for r in sample.mapInArrow(run, "k int, f int, n long").groupBy("k", "f").agg(F.sum("n").alias("n")).collect():
            counts[r.k, r.f] += r.n  # languages x features at most
    return Profiles(names, np.log(counts / counts.sum(axis=1)[:, None]).T.astype(np.float32).copy())


def address_parts(address: str | None) -> tuple[str | None, str | None, str | None]:
    """(host, domain, suffix) of an address; nulls if it has no host name."""
    found = HOST.match(address.strip()) if address else None
    if not found:
        return None, None, None
    labels = found[1].lower().strip(".").split(".")
    return ".".join(labels), ".".join(labels[-2:]) if len(labels) > 1 else None, labels[-1] if len(labels) > 1 else None


def evidence(rows: DataFrame, profiles, row_id: str, text: str, declared: str | None, address: str | None,
             host: str | None, markup: bool, weight: int) -> DataFrame:
    """What each row says by itself: (id, n_features, declared, host, domain, suffix, likelihoods)."""
    none = F.lit(None).cast("string")
    source = common.documents(rows, row_id, text, (F.lower(F.trim(declared)) if declared else none).alias("declared"),
                              (F.col(address).cast("string") if address else none).alias("address"),
                              (F.col(host).cast("string") if host else none).alias("host"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = profiles.value.logs
        for batch in batches:
            out = []
            for i, data, said, where, own_host in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "data", "declared", "address", "host"))):
                if markup:
                    if said is None and (found := DECLARED.search(data)):
                        said = found[1].decode().lower()
                    data = visible(data)
                named, domain, suffix = address_parts(where)
                used = features(data)
                sums = np.zeros(logs.shape[1])
                for k in range(0, len(used), 4096):
                    sums += logs[used[k:k + 4096]].sum(axis=0, dtype=np.float64)
                sums *= min(1.0, weight / max(1, len(used)))
                out.append((i, len(used), said or None, own_host or named, domain, suffix, sums - sums.max(initial=-np.inf)))
            columns = list(zip(*out)) or [()] * 7
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             ["doc_id", "n_features", "declared", "host", "domain", "suffix", "likelihoods"])

    return source.mapInArrow(run, "doc_id long, n_features long, declared string, host string, domain string, suffix string, "
                                  "likelihoods array<double>")


def softmax(logs: Column) -> Column:
    shares = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(shares, lambda x: x / F.aggregate(shares, F.lit(0.0), lambda a, b: a + b))


def sums(said: DataFrame, key: str, k: int) -> DataFrame:
    """The text posteriors of all rows with a value, added up: (key, sums)."""
    return said.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.array(*[F.sum(F.col("own")[i]) for i in range(k)]).alias(f"of_{key}"))


def identify(rows: DataFrame, profiles: Profiles, row_id: str = "doc_id", text: str = "text", declared: str | None = None,
             address: str | None = None, host: str | None = None, markup: bool = False, least: float = 0.5,
             weight: int = 200, strength: float = 5.0) -> DataFrame:
    """A row for each row: (doc_id, language, posterior, accepted, text_language, declared, host, n_features).

    ``strength``: how many rows' worth the wider level has in a host's or domain's prior.
    """
    k, spark = len(profiles.languages), rows.sparkSession
    sent = spark.sparkContext.broadcast(profiles)
    said = evidence(rows, sent, row_id, text, declared, address, host, markup, weight)
    if k == 0:
        none = F.lit(None).cast("string")
        return said.select("doc_id", none.alias("language"), F.lit(None).cast("double").alias("posterior"),
                           (F.col("n_features") > 0).alias("accepted"),
                           none.alias("text_language"), "declared", "host", "n_features")
    said = common.store(said.withColumn("own", softmax(F.col("likelihoods"))))
    total = said.agg(*[F.coalesce(F.sum(F.col("own")[i]), F.lit(0.0)) for i in range(k)]).first()
    everywhere = F.array(*[F.lit((total[i] + 1) / (sum(total) + k)) for i in range(k)])
    for key in ("declared", "suffix", "host", "domain"):
        said = said.join(sums(said, key, k), key, "left")

    def others(key: str) -> Column:
        """The sums of the other rows that share a value; zeros where there are none."""
        return F.when(F.col(f"of_{key}").isNull(), F.array_repeat(F.lit(0.0), k)) \
            .otherwise(F.zip_with(f"of_{key}", "own", lambda a, b: F.greatest(a - b, F.lit(0.0))))

    def smoothed(counts: Column, wider: Column) -> Column:
        size = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
        return F.zip_with(counts, wider, lambda c, w: (c + F.lit(strength) * w) / (size + strength))

    def likelihood(key: str) -> Column:
        """log P(value | language) up to a constant, by the shares of the languages' rows that have it."""
        share = F.zip_with(others(key), F.array(*[F.lit(float(total[i])) for i in range(k)]), lambda c, t: F.log((c + 0.5) / (t + 0.5 * k)))
        return F.when(F.col(key).isNull() | (F.aggregate(others(key), F.lit(0.0), lambda a, b: a + b) < 0.5),
                      F.array_repeat(F.lit(0.0), k)).otherwise(share)

    plus = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    said = said.withColumn("by_domain", smoothed(others("domain"), everywhere)).withColumn("prior", smoothed(others("host"), F.col("by_domain"))) \
        .withColumn("by_declared", likelihood("declared")).withColumn("by_suffix", likelihood("suffix"))
    logs = plus(plus(F.col("likelihoods"), F.transform("prior", lambda x: F.log(x))), plus(F.col("by_declared"), F.col("by_suffix")))
    said = said.withColumn("logs", logs).withColumn("posteriors", softmax(F.col("logs")))
    names = F.array(*[F.lit(n) for n in profiles.languages])
    best = lambda c: names[(F.array_position(c, F.array_max(c)) - 1).cast("int")]
    return said.select("doc_id", best(F.col("posteriors")).alias("language"), F.array_max("posteriors").alias("posterior"),
                       ((F.col("n_features") > 0) & (F.array_max("posteriors") >= least)).alias("accepted"),
                       F.when(F.col("n_features") > 0, best(F.col("own"))).alias("text_language"), "declared", "host", "n_features")
