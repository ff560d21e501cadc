"""Quality rules: a decision list learned from labelled statistics, applied as Spark conditions.

Every whole text becomes a row of statistics. Rules are learned from the rows with a label by
sequential covering: on two thirds of the rows a conjunction of thresholds grows by the condition of
greatest information gain until it holds no good row; on the last third it is pruned to the prefix
that tells bad from good rows best; a rule that is precise enough there is kept, the rows it covers
are taken out, and the next one is sought. The rules in order, each a few conditions such as
``symbols > 0.19 AND words <= 240``, become one conditional expression of Spark; a text that no rule holds
for is kept. What is learned is bounded (``sample`` rows of each label, by hash of the id); the
statistics and the verdicts cover all rows.

Words are runs of other bytes than space, tab, line ends, vertical tab and form feed. Null and empty
texts have zeros everywhere and fail the base rules. Labels that are null, or differ for one id, are
not learned from; with no labels of one kind there are no rules, and the base rules decide alone.
Repeated ids are judged each by their own text, and only those ids that one text alone has are
learned from. Texts are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.llm import common

SPACES, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
CAPITALS, DIGITS = bytes(range(ord("A"), ord("Z") + 1)), bytes(range(ord("0"), ord("9") + 1))
MARKS = b"!?.,;:"
#: Counts of a text; all of them are exact.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_capitals",
          "n_digits", "n_marks", "n_longest"]
#: What rules are made of, as SQL over the counts.
FEATURES = {
    "words": "double(n_words)",
    "word_length": "coalesce(try_divide(word_chars, n_words), 0D)",
    "symbols": "coalesce(try_divide(n_symbols, n_words), 0D)",
    "dup_lines": "coalesce(try_divide(n_dup_lines, n_lines), 0D)",
    "repeats": "coalesce(try_divide(n_repeat_words, n_words), 0D)",
    "distinct": "coalesce(try_divide(n_distinct, n_words), 0D)",
    "capitals": "coalesce(try_divide(n_capitals, word_chars), 0D)",
    "digits": "coalesce(try_divide(n_digits, word_chars), 0D)",
    "marks": "coalesce(try_divide(n_marks, n_words), 0D)",
    "line_words": "coalesce(try_divide(n_words, n_lines), 0D)",
    "longest": "coalesce(try_divide(n_longest, n_words), 0D)",
}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def sql(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold!r}D"

    def holds(self, rows: np.ndarray) -> np.ndarray:
        values = rows[:, list(FEATURES).index(self.feature)]
        return values > self.threshold if self.above else values <= self.threshold


@dataclass(frozen=True)
class Rule:
    """Texts for which all conditions hold are not kept."""
    conditions: tuple[Condition, ...]

    def sql(self) -> str:
        return " AND ".join(c.sql() for c in self.conditions)

    def holds(self, rows: np.ndarray) -> np.ndarray:
        return reduce(np.logical_and, (c.holds(rows) for c in self.conditions), np.ones(len(rows), bool))


def repeated_words(numbers: np.ndarray, distinct: int, width: int = 3) -> int:
    """Words in windows of ``width`` that are found twice or more."""
    n = len(numbers) - width + 1
    if n < 2:
        return 0
    keys, base = numbers[:n], max(distinct, 1)
    for k in range(1, width):
        if base > (1 << 62) // max(distinct, 1):
            keys = np.unique(keys, return_inverse=True)[1].astype(np.int64)
            base = n
        keys = keys * max(distinct, 1) + numbers[k:k + n]
        base *= max(distinct, 1)
    _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[which] > 1)
    covered = np.zeros(len(numbers), bool)
    for k in range(width):
        covered[starts + k] = True
    return int(covered.sum())


def longest_run(numbers: np.ndarray) -> int:
    """The most equal words in a row."""
    if not len(numbers):
        return 0
    cuts = np.flatnonzero(np.diff(numbers)) + 1
    return int(np.diff(np.concatenate([[0], cuts, [len(numbers)]])).max())


def counts_of(data: bytes) -> tuple[int, ...]:
    """The ``COUNTS`` of a text."""
    words, numbers = data.split(), {}  # bytes are split at the six spaces of ASCII
    at = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    lines = [x for x in data.split(b"\n") if x.strip()]
    without = lambda some: len(data) - len(data.translate(None, some))
    return (len(words), len(data.decode("utf-8", "replace")) - without(SPACES), without(SYMBOLS), len(lines) - len(set(lines)),
            repeated_words(at, len(numbers)), len(lines), len(numbers), without(CAPITALS), without(DIGITS), without(MARKS), longest_run(at))


def text_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ``COUNTS``), a row for each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.rows_of(batches, "doc_id", "data"):
            columns = list(zip(*((doc, *counts_of(data)) for doc, data in rows)))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", *COUNTS])

    return common.documents(docs, doc_id, text).mapInArrow(run, ", ".join(f"{c} long" for c in ["doc_id", *COUNTS]))


def gain(bad: np.ndarray, good: np.ndarray, p: int, n: int) -> np.ndarray:
    """How much more is known of the bad rows that a condition keeps."""
    with np.errstate(divide="ignore", invalid="ignore"):
        more = bad * (np.log2(bad / (bad + good)) - np.log2(p / (p + n)))
    return np.where(bad > 0, more, -np.inf)


def best_condition(rows: np.ndarray, bad: np.ndarray) -> Condition | None:
    """The threshold of greatest gain; of equals, the first feature's lowest. None if none gains."""
    p, n, best, most = int(bad.sum()), int((~bad).sum()), None, 1e-9
    for k, feature in enumerate(FEATURES):
        order = np.argsort(rows[:, k], kind="stable")
        values, sums = rows[order, k], np.cumsum(bad[order])
        last = np.flatnonzero(values[1:] > values[:-1])  # cuts lie between different values
        if not len(last):
            continue
        below = sums[last]
        for above, kept, others in ((False, below, last + 1 - below), (True, p - below, n - (last + 1 - below))):
            found = gain(kept, others, p, n)
            at = int(np.argmax(found))
            if found[at] > most:
                most = float(found[at])
                cut = values[last[at]] / 2 + values[last[at] + 1] / 2
                best = Condition(feature, above, float(cut if cut < values[last[at] + 1] else values[last[at]]))
    return best


def grown(rows: np.ndarray, bad: np.ndarray, most: int) -> list[Condition]:
    """Conditions that leave no good row, ``most`` at most."""
    out, held = [], np.ones(len(rows), bool)
    while len(out) < most and (held & ~bad).any() and (held & bad).any():
        one = best_condition(rows[held], bad[held])
        if one is None:
            break
        out.append(one)
        held &= one.holds(rows)
    return out


def pruned(conditions: list[Condition], rows: np.ndarray, bad: np.ndarray) -> tuple[Rule | None, float]:
    """The first few conditions that tell bad from good rows best, and how precise they are."""
    best, most, precision = None, -2.0, 0.0
    for k in range(1, len(conditions) + 1):
        rule = Rule(tuple(conditions[:k]))
        held = rule.holds(rows)
        p, n = int((held & bad).sum()), int((held & ~bad).sum())
        if p + n and (p - n) / (p + n) > most:
            best, most, precision = rule, (p - n) / (p + n), p / (p + n)
    return best, precision


def learned(rows: np.ndarray, bad: np.ndarray, turn: np.ndarray, precision: float, most_rules: int = 32,
            most_conditions: int = 6) -> list[Rule]:
    """Rules in order. ``turn``: a number of each row that deals it to growing or pruning."""
    rules, left = [], np.ones(len(rows), bool)
    while len(rules) < most_rules and (left & bad).any():
        prune = left & ((turn + len(rules)) % 3 == 0)
        grow = left & ~prune
        if not (grow & bad).any() or not (prune & bad).any():
            break
        rule, sure = pruned(grown(rows[grow], bad[grow], most_conditions), rows[prune], bad[prune])
        if rule is None or sure < precision:
            break
        rules.append(rule)
        left &= ~rule.holds(rows)
    return rules


def features(statistics: DataFrame) -> DataFrame:
    return statistics.withColumns({name: F.expr(sql) for name, sql in FEATURES.items()})


def learn_rules(statistics: DataFrame, labels: DataFrame, label: str, label_id: str = "doc_id", sample: int = 20_000,
                precision: float = 0.9) -> list[Rule]:
    """Rules for rows whose ``label`` is 0, from ``sample`` rows of each label at most."""
    one = labels.where(F.col(label).isNotNull() & F.col(label_id).isNotNull()).groupBy(F.col(label_id).cast("long").alias("of")) \
        .agg(F.min(label).alias("low"), F.max(label).alias("high")).where("low = high").select("of", (F.col("low") == 0).alias("bad"))
    known = statistics.join(one, F.col("doc_id") == F.col("of"))
    turn = F.shiftrightunsigned(F.xxhash64(F.lit("rules"), F.col("doc_id")), 33)
    single = known.groupBy("of").agg(F.count("*").alias("rows"), *[F.first(c).alias(c) for c in ["bad", "doc_id", *COUNTS]]).where("rows = 1")
    names = ["bad", "turn", *FEATURES]
    rows = features(single).withColumn("turn", turn).select("doc_id", *names)
    some = [rows.where(F.col("bad") == b).orderBy("turn", "doc_id").limit(sample).toArrow() for b in (True, False)]
    both = {c: np.concatenate([t.column(c).to_numpy() for t in some]) for c in names}
    values = np.column_stack([both[f] for f in FEATURES]).astype(float)
    return learned(values, both["bad"].astype(bool), both["turn"].astype(np.int64), precision)


def kept_by(rules: list[Rule]) -> Column:
    """The rules in order as one conditional expression over the ``FEATURES``."""
    out = F
    for rule in rules:
        out = out.when(F.expr(rule.sql()), F.lit(False))
    return out.otherwise(F.lit(True)) if rules else F.lit(True)


def quality_rules(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
                  least_words: int = 50, most_repeats: int = 50, sample: int = 20_000, precision: float = 0.9) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rule).

    base_failed: fewer than ``least_words`` words, or more than ``most_repeats`` percent of them in
    repeated windows. kept: neither that nor covered by a rule; rule is the text of the first rule that holds.
    ``precision``: what a rule must reach on rows it was not grown from.
    """
    statistics = common.store(text_statistics(docs, doc_id, text))
    rules = learn_rules(statistics, labels, label, sample=sample, precision=precision)
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeats * F.col("n_words"))
    first = F.coalesce(*[F.when(F.expr(r.sql()), F.lit(r.sql())) for r in rules], F.lit(None).cast("string"))
    return features(statistics).withColumn("base_failed", failed) \
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                (~F.col("base_failed") & kept_by(rules)).alias("kept"), first.alias("rule"))
