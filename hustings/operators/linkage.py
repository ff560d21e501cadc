"""Record linkage by unambiguous keys, in stages, with a label for each filled value."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.functions.text import none_if_blank
from hustings.session import growing


def unambiguous_index(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys with exactly one distinct non-null value. Rows with a null key drop out."""
    return rows.dropna(subset=[*keys, value]).groupBy(*keys) \
        .agg(F.min(value).alias(value), F.max(value).alias("__max")) \
        .filter(F.col(value) == F.col("__max")).drop("__max")


def majority_dictionary(rows: DataFrame, key: str, value: str, min_count: int,
                        min_share: float) -> DataFrame:
    """Keys whose most frequent value has enough support, with that value."""
    counts = rows.dropna(subset=[key, value]).groupBy(key, value).agg(
        F.count(F.lit(1)).alias("n"))
    tops = counts.groupBy(key).agg(
        F.sum("n").alias("support"), F.max("n").alias("top"),
        F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(value))
    return tops.filter((F.col("support") >= min_count)
                       & (F.col("top") >= F.lit(min_share) * F.col("support"))) \
        .select(key, value, "support", (F.col("top") / F.col("support")).alias("share"))


@dataclass(frozen=True)
class Stage:
    """One attempt: look the row's ``on`` columns up in ``index`` (same order as its keys). An index
    that ``grows`` with the people is never sent out whole."""

    index: DataFrame
    keys: Sequence[str]
    on: Sequence[str]
    value: str
    label: str
    when: Column | None = None
    grows: bool = False


def staged_lookup(df: DataFrame, stages: Sequence[Stage], out: str, label_out: str) -> DataFrame:
    """First hit over the stages and the label of the stage it came from; null without a hit.

    Every stage is one left join to an index with one row for each key, so rows never multiply.
    """
    hits = []
    for i, stage in enumerate(stages):
        keys = [f"__s{i}_k{j}" for j in range(len(stage.keys))]
        index = stage.index.select(
            *[F.col(k).alias(n) for k, n in zip(stage.keys, keys)],
            F.col(stage.value).alias(f"__s{i}_v"))
        cond = stage.when if stage.when is not None else F.lit(True)
        for name, source in zip(keys, stage.on):
            cond = cond & (F.col(source) == F.col(name))
        df = df.join(growing(index) if stage.grows else index, cond, "left").drop(*keys)
        hits.append((f"__s{i}_v", stage.label))
    value = F.coalesce(*[F.col(h) for h, _ in hits])
    label = F.coalesce(*[F.when(F.col(h).isNotNull(), F.lit(text)) for h, text in hits])
    return df.withColumns({out: value, label_out: label}).drop(*[h for h, _ in hits])


def fill_blanks(df: DataFrame, target: str, hit: str, label: str, source: str,
                blank: Column | None = None, eligible: Column | None = None) -> DataFrame:
    """Put a hit into blank cells only, and its label into the source column of those cells."""
    blank = none_if_blank(target).isNull() if blank is None else blank
    fill = blank & F.col(hit).isNotNull()
    if eligible is not None:
        fill = fill & eligible
    return df.withColumn("__fill", F.coalesce(fill, F.lit(False))).withColumns({
        target: F.when(F.col("__fill"), F.col(hit)).otherwise(F.col(target)),
        source: F.when(F.col("__fill"), F.col(label)).otherwise(F.col(source)),
    }).drop("__fill")


def apply_corrections(df: DataFrame, corrections: DataFrame, match: dict[str, str],
                      replace: dict[str, str]) -> DataFrame:
    """Overwrite cells of rows that meet a verified correction; a null replacement overwrites too.

    ``match`` maps a column of ``df`` to the key column of ``corrections``; ``replace`` maps a
    column of ``df`` to the column that replaces it.
    """
    fixes = corrections.select(*[F.col(c).alias(f"__m_{c}") for c in match.values()],
                               *[F.col(c).alias(f"__r_{c}") for c in replace.values()],
                               F.lit(True).alias("__hit"))
    cond = [F.col(a) == F.col(f"__m_{b}") for a, b in match.items()]
    joined = df.join(fixes, cond, "left")
    hit = F.col("__hit").isNotNull()
    return joined.select(*[
        F.when(hit, F.col(f"__r_{replace[c]}")).otherwise(F.col(c)).alias(c)
        if c in replace else F.col(c) for c in df.columns])


def count_difference(left: DataFrame, right: DataFrame, keys: Sequence[str], over: int = 1,
                     names: tuple[str, str] = ("left_count", "right_count")) -> DataFrame:
    """Rows for each key on both sides, kept where the counts differ by more than ``over``."""
    a = left.groupBy(*keys).agg(F.count(F.lit(1)).alias(names[0]))
    b = right.groupBy(*keys).agg(F.count(F.lit(1)).alias(names[1]))
    n, m = (F.coalesce(F.col(c), F.lit(0)) for c in names)
    return a.join(b, list(keys), "full_outer").select(
        *keys, n.alias(names[0]), m.alias(names[1]), (m - n).alias("difference")) \
        .filter(F.abs("difference") > over)


def missing_keys(expected: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys that are expected and not present."""
    return expected.select(*keys).distinct().join(present.select(*keys), list(keys), "left_anti")


def known_keys(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is known; rows with a null key are not. Rows never multiply."""
    return rows.join(known.select(*keys), list(keys), "left_semi").select(*rows.columns)


def common_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys that both sides have, null parts included. Both are narrowed to distinct keys
    before they meet, so a key that many rows share costs one row on either side."""
    a, b = (df.select(*keys).distinct() for df in (left, right))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return a.alias("a").join(b.alias("b"), same, "left_semi")
