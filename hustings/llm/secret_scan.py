"""Secret scan with a random forest that takes false positives out, in DataFrame functions only.

Candidates are long runs of the characters that keys and tokens are made of, in whole texts, and
whatever is assigned to the name of a credential, at any length and with all its characters. Rules
that are sure of themselves label some of them: a value that is assigned to the name of a credential
is a secret; a run without a digit, and a run of digits that nothing is assigned to, is none. The
forest learns from a bounded sample of labelled findings and judges all candidates. What it sees:

* the length of the candidate, its share of digits and of different characters;
* its character transitions: the mean log probability of its letter pairs in the corpus's own words,
  and how often it changes between letters, capitals, digits and the rest;
* its dictionary coverage: the share of its characters in letter runs that are words of the corpus;
* its path and its neighbouring words: the share of secrets among labelled findings with the same
  path, word before or word after (within 64 characters), smoothed, a finding's own label left out.

What the rules go by, assignment and quotes, the forest does not see, and for half of the sample the
neighbouring words are taken for unknown ones, so that it learns to tell a finding by itself, too.
Labels of one's own replace the rules. Without labelled findings of both kinds there is nothing to
learn, and all candidates stay. Null and empty texts have no candidates; a null path is a path of its
own. Repeated rows give repeated findings.
"""

from __future__ import annotations

from math import log

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.llm import common

ALPHABET = "abcdefghijklmnopqrstuvwxyz"
CLASSES = len(ALPHABET) + 2  # letters, a digit, anything else
CREDENTIAL = r"(?i)(token|secret|passw(or)?d|passwd|api[_-]?key|access[_-]?key|credential)s?$"
KEYS = ("path", "before", "after")
FEATURES = ["n_chars", "digit_share", "different_share", "transition", "switches", "coverage", *(f"{k}_rate" for k in KEYS)]
NEIGHBOURS = ("before", "after")
#: A credential's name and an assignment, and the first character of what is assigned.
NAMED = r"""(?i:token|secret|password|passwd|pass|api[_-]?key|access[_-]?key|credential)s?["']?\s{0,3}[=:]\s{0,3}["']?"""
VALUE = r"""[^\s"'=:]"""


def candidates(docs: DataFrame, doc_id: str, text: str, path: str | None, least: int) -> DataFrame:
    """(doc_id, start, candidate, path, before, after, assigned, quoted); ``start`` counts characters from 0."""
    pattern = f"(?:{NAMED}{VALUE}[^\\s\"']*|[A-Za-z0-9+/_=-]{{{least},}})"
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("words"),
                       (F.col(path).cast("string") if path else F.lit(None).cast("string")).alias("path"))
    cut = rows.select("doc_id", "path", F.regexp_extract_all("words", F.lit(f"({pattern})"), F.lit(1)).alias("found"),
                      F.split("words", pattern, -1).alias("between")).where(F.size("found") > 0)
    lengths = F.transform("found", lambda c, k: F.struct(F.length(F.get("between", k)).alias("b"), F.length(c).alias("c")))
    starts = F.aggregate(lengths, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
                         lambda s, x: F.struct((s["at"] + x["b"] + x["c"]).alias("at"),
                                               F.concat(s["starts"], F.array(s["at"] + x["b"])).alias("starts")),
                         lambda s: s["starts"])
    cut = cut.withColumn("starts", starts)
    def one(match, k):
        name = F.length(F.regexp_extract(match, f"^{NAMED}(?={VALUE})", 0))  # is no part of the candidate
        return F.struct((F.get("starts", k) + name).alias("start"), F.substr(match, name + 1).alias("candidate"),
                        F.right(F.concat(F.get("between", k), F.left(match, name)), F.lit(64)).alias("left"),
                        F.left(F.get("between", k + 1), F.lit(64)).alias("right"))
    each = F.transform("found", one)
    out = cut.select("doc_id", "path", F.explode(each).alias("x")).select("doc_id", "path", "x.*")
    name = r"""([^\s"'=:]+)\s*[=:]*\s*["']?$"""
    return out.select("doc_id", "start", "candidate", F.coalesce("path", F.lit("")).alias("path"),
                      F.lower(F.regexp_extract("left", name, 1)).alias("before"),
                      F.lower(F.regexp_extract("right", r"""^["']?\s*(\S+)""", 1)).alias("after"),
                      F.col("left").rlike(r"""[=:]\s*["']?$""").cast("int").alias("assigned"),
                      F.col("left").rlike(r"""["']$""").cast("int").alias("quoted"))


def rule_labels() -> Column:
    """1 for a secret, 0 for none, null where the rules cannot tell."""
    digits = F.col("candidate").rlike("[0-9]")
    named = F.col("before").rlike(CREDENTIAL) & (F.col("assigned") == 1)
    return F.when(named & digits, 1).when(~digits, 0).when(F.col("candidate").rlike("^[0-9]+$") & (F.col("assigned") == 0), 0)


def dictionary(docs: DataFrame, text: str, least_docs: int) -> DataFrame:
    """(word, n): letter runs in lower case that ``least_docs`` texts or more have."""
    runs = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text).cast("string")), F.lit("([a-z]{3,})"), F.lit(1)))
    return docs.select(F.explode(runs).alias("word")).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_docs)


def kinds(word: Column) -> Column:
    """The class of each character: letters from 0, then digits, then the rest."""
    return F.transform(F.split(F.lower(word), ""), lambda c: F.when(F.instr(F.lit(ALPHABET), c) > 0, F.instr(F.lit(ALPHABET), c) - 1)
                       .when(c.between("0", "9"), len(ALPHABET)).otherwise(len(ALPHABET) + 1))


def character_pairs(word: Column) -> Column:
    """The number of each pair of neighbouring characters."""
    k = kinds(word)
    return F.zip_with(F.slice(k, 1, F.greatest(F.lit(0), F.length(word) - 1)), F.slice(k, 2, F.greatest(F.lit(0), F.length(word) - 1)),
                      lambda a, b: a * CLASSES + b)


def transition_logs(words: DataFrame) -> list[float]:
    """Log probability of each pair given its first character, from words weighted by texts; a bounded table."""
    found = words.select("n", F.explode(character_pairs(F.col("word"))).alias("pair")).groupBy("pair").agg(F.sum("n").alias("n"))
    counts = [0.5] * CLASSES ** 2
    for r in found.collect():  # at most one row for each pair of classes
        counts[r.pair] += r.n
    totals = [sum(counts[a * CLASSES:(a + 1) * CLASSES]) for a in range(CLASSES)]
    return [log(c / totals[p // CLASSES]) for p, c in enumerate(counts)]


def coverage(found: DataFrame, words: DataFrame) -> DataFrame:
    """(candidate, covered): characters of each different candidate that are in dictionary words."""
    runs = found.select("candidate").distinct().select(
        "candidate", F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit("([a-z]{3,})"), F.lit(1))).alias("word"))
    return runs.join(words.select("word"), "word").groupBy("candidate").agg(F.sum(F.length("word")).alias("covered"))


def own_features(logs: list[float]) -> dict[str, Column]:
    """What a candidate tells by itself."""
    c = F.col("candidate")
    n = F.length(c)
    table = F.lit(logs)
    switch = F.length(F.regexp_replace(c, "(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])", "~")) - n
    transition = F.aggregate(character_pairs(c), F.lit(0.0), lambda s, p: s + F.get(table, p))
    return {"n_chars": n.cast("double"), "digit_share": F.length(F.regexp_replace(c, "[^0-9]", "")) / n,
            "different_share": F.size(F.array_distinct(F.split(c, ""))) / n, "transition": transition / F.greatest(n - 1, F.lit(1)),
            "switches": switch / n}


def with_rates(rows: DataFrame, sample: DataFrame, weight: float = 10.0) -> DataFrame:
    """Adds the smoothed share of secrets among labelled findings that share a path or neighbour."""
    share = sample.agg(F.coalesce(F.avg("label"), F.lit(0.5))).first()[0]
    own, one = F.when(F.col("in_sample"), F.col("label")).otherwise(0), F.col("in_sample").cast("int")
    for key in KEYS:
        table = common.store(sample.groupBy(key).agg(F.sum("label").alias("hits"), F.count("*").alias("all")))
        rate = (F.coalesce("hits", F.lit(0)) - own + weight * share) / (F.coalesce("all", F.lit(0)) - one + weight)
        if key in NEIGHBOURS:
            rate = F.when(F.col("in_sample") & (F.col("turn") % 2 == 0), F.lit(float(share))).otherwise(rate)
        rows = rows.join(table, key, "left").withColumn(f"{key}_rate", rate).drop("hits", "all")
    return rows


def secret_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = "source", label: Column | None = None,
                least: int = 16, least_docs: int = 3, per_kind: int = 5000, trees: int = 20, depth: int = 6,
                threshold: float = 0.5) -> DataFrame:
    """A row for each candidate: (doc_id, start, n_chars, finding, label, probability, secret).

    ``label``: 1, 0 or null from the columns of ``candidates``, the rules if left out. The forest is
    fitted on about ``per_kind`` labelled findings of each kind, chosen by hash; everything else
    covers all documents.
    """
    found = common.store(candidates(docs, doc_id, text, path, least).withColumn("label", (rule_labels() if label is None else label).cast("int"))
                         .withColumn("turn", F.pmod(F.xxhash64("doc_id", "start", "candidate"), F.lit(1_000_000))))
    sizes = {r.label: r.n for r in found.where("label IS NOT NULL").groupBy("label").agg(F.count("*").alias("n")).collect()}
    result = ["doc_id", "start", F.length("candidate").alias("n_chars"), F.col("candidate").alias("finding"), "label"]
    if not sizes.get(0) or not sizes.get(1):
        return found.select(*result, F.lit(None).cast("double").alias("probability"), F.lit(True).alias("secret"))
    part = F.when(F.col("label") == 1, per_kind / sizes[1]).otherwise(per_kind / sizes[0])
    found = found.withColumn("in_sample", F.col("label").isNotNull() & (F.col("turn") < part * 1_000_000))
    words = common.store(dictionary(docs, text, least_docs))
    covered = coverage(found, words)
    rows = found.join(covered, "candidate", "left").withColumn("coverage", F.coalesce("covered", F.lit(0)) / F.length("candidate"))
    rows = with_rates(rows, common.store(found.where("in_sample")))
    rows = common.store(rows.select(*found.columns, *[c.alias(n) for n, c in own_features(transition_logs(words)).items()],
                                    "coverage", *[f"{k}_rate" for k in KEYS]))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep").transform(rows)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=1, labelCol="label", featuresCol="features")
    judged = forest.fit(vectors.where("in_sample")).transform(vectors)
    chance = vector_to_array(F.col("probability"))[1]
    return judged.select(*result, chance.alias("probability"), (chance >= threshold).alias("secret"))
