"""Data audits. Findings are rows of (dataset, severity, issue, scope, detail)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.functions.text import fold_letters
from hustings.operators.groups import attach
from hustings.operators.reshape import count_matrix, sample_values

ISSUE_COLUMNS = ["dataset", "severity", "issue", "scope", "detail"]


def issues(df: DataFrame, dataset: str, severity: Column | str, issue: Column | str,
           scope: Column, detail: Column) -> DataFrame:
    """Findings in the common schema, one for each row of ``df``."""
    def text(c):
        return F.lit(c) if isinstance(c, str) else c
    return df.select(F.lit(dataset).alias("dataset"), text(severity).alias("severity"),
                     text(issue).alias("issue"), scope.cast("string").alias("scope"),
                     detail.alias("detail"))


def coverage_matrix(df: DataFrame, keys: Sequence[str], level: str,
                    levels: Sequence[str]) -> DataFrame:
    """Rows for each key and level, zero where there are none; rows with a null key drop out."""
    return count_matrix(df, keys, level, levels)


def null_profile(df: DataFrame, period: str, columns: Sequence[str]) -> DataFrame:
    """(period, column, nulls, total, severity) of columns that have nulls in a period.

    ``high`` when the column is entirely null there, ``medium`` above one half, else null. One
    pass over the table counts all columns.
    """
    counted = df.filter(F.col(period).isNotNull()).groupBy(period).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    long = counted.select(period, "total", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls"))
        for i, c in enumerate(columns)])).alias("e"))
    severity = F.when(F.col("e.nulls") == F.col("total"), "high") \
        .when(F.col("e.nulls") > 0.5 * F.col("total"), "medium")
    return long.filter(F.col("e.nulls") > 0).select(
        period, "e.column", "e.nulls", "total", severity.alias("severity"))


def level_collapse(df: DataFrame, period: str, level: str, factor: float = 0.5) -> DataFrame:
    """(period, level, n, median): counts below ``factor`` of the level's median over all periods.
    A period without rows of a level counts as zero."""
    known = df.dropna(subset=[period, level])
    counts = known.groupBy(period, level).agg(F.count(F.lit(1)).alias("n"))
    # Every level in every period: the periods are listed with each level, as many as there are.
    periods = counts.agg(F.collect_set(period).alias("periods"))
    levels = counts.select(level).distinct().withColumn("__p", periods.scalar())
    grid = levels.select(level, F.explode("__p").alias(period))
    full = grid.join(counts, [period, level], "left").na.fill(0, ["n"])
    medians = full.groupBy(level).agg(F.median("n").alias("median"))
    return full.join(medians, level).filter(
        (F.col("median") > 0) & (F.col("n") < F.lit(factor) * F.col("median"))) \
        .select(period, level, "n", "median")


def count_drift(df: DataFrame, truth: DataFrame, key: str, period: str,
                tolerance: float = 0.05) -> DataFrame:
    """(key, period, n, expected, drift, direction) where counts miss the truth by more than the
    tolerance. ``truth``: key, ``expected``. Combinations without any row are not reported."""
    counts = df.dropna(subset=[period]).join(truth.select(key), key, "left_semi") \
        .groupBy(key, period).agg(F.count(F.lit(1)).alias("n"))
    drift = (F.col("n") - F.col("expected")) / F.col("expected")
    return counts.join(truth, key).withColumn("drift", drift.cast("double")) \
        .filter(F.abs("drift") > tolerance) \
        .withColumn("direction", F.when(F.col("drift") > 0, "more").otherwise("fewer")) \
        .select(key, period, "n", "expected", "drift", "direction")


def exact_duplicates(df: DataFrame, period: str) -> DataFrame:
    """Rows of each period that repeat another row entirely, beyond the first."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return groups.filter(F.col("__n") > 1).groupBy(period).agg(
        F.sum(F.col("__n") - 1).alias("duplicates"))


def shared_keys(df: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """Rows of each period whose key is not theirs alone; all of them count."""
    groups = df.groupBy(*dict.fromkeys([*keys, period])).agg(F.count(F.lit(1)).alias("__n"))
    if period in keys:
        per_key = groups.filter(F.col("__n") > 1)
    else:
        sums = groups.groupBy(*keys).agg(F.sum("__n").alias("__t")).filter(F.col("__t") > 1)
        per_key = attach(groups, sums, keys, "inner")
    return per_key.groupBy(period).agg(F.sum("__n").alias("rows"))


def spelling_variants(df: DataFrame, raw: str, norm: Column, period: str) -> DataFrame:
    """(norm, raw, periods, spellings): normalised keys with several raw spellings, one row for
    each spelling with the sorted periods it occurs in."""
    spelled = df.filter(F.col(raw).isNotNull()).select(
        norm.alias("norm"), F.col(raw).alias("raw"), F.col(period).alias("p"))
    each = spelled.groupBy("norm", "raw").agg(F.sort_array(F.collect_set("p")).alias("periods"))
    several = each.groupBy("norm").agg(F.count(F.lit(1)).alias("spellings")) \
        .filter(F.col("spellings") > 1)
    return each.join(several, "norm").select("norm", "raw", "periods", "spellings")


def file_coverage(rows: DataFrame, keys: Sequence[str], position: str, votes: str) -> DataFrame:
    """Rows, distinct positions and votes of each landed file."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(position).alias("positions"),
        F.coalesce(F.sum(votes), F.lit(0)).alias("total_votes"))


def locality_counts(df: DataFrame, period: str, locality: str, area: str) -> DataFrame:
    """Distinct localities and areas of each period, and its rows."""
    return df.groupBy(period).agg(
        F.count_distinct(locality).alias("localities"), F.count_distinct(area).alias("areas"),
        F.count(F.lit(1)).alias("rows"))


def locality_gaps(df: DataFrame, period: str, locality: str) -> DataFrame:
    """(locality, missing_from, periods, first_in, last_in): a row for each locality and period that
    it has no row in, with how many periods it has and the first and last of them."""
    seen = df.select(period, locality).dropna().distinct()
    periods = seen.agg(F.collect_set(period).alias("periods"))  # periods are few
    known = seen.groupBy(locality).agg(F.collect_set(period).alias("__in"))
    missing = known.withColumn("__all", periods.scalar()).select(
        locality, F.explode(F.array_except("__all", "__in")).alias("missing_from"), "__in")
    return missing.select(locality, "missing_from", F.size("__in").alias("periods"),
                          F.array_min("__in").alias("first_in"), F.array_max("__in").alias("last_in"))


def locality_gap_pairs(df: DataFrame, period: str, locality: str) -> DataFrame:
    """(present_in, missing_from, locality) for every ordered pair of periods."""
    gaps = locality_gaps(df, period, locality).select(locality, "missing_from")
    seen = df.select(F.col(period).alias("present_in"), locality).dropna().distinct()
    return seen.join(gaps, locality).select("present_in", "missing_from", locality)


def gap_report(gaps: DataFrame, locality: str, n: int = 8) -> DataFrame:
    """Localities missing for each ordered pair, with the first few names."""
    keys = ["present_in", "missing_from"]
    counts = gaps.groupBy(*keys).agg(F.count(F.lit(1)).alias("localities"))
    return counts.join(sample_values(gaps, keys, locality, n, "sample"), keys)


def required_everywhere(df: DataFrame, period: str, periods: Sequence[int], locality: str,
                        needle: str) -> DataFrame:
    """Listed periods in which no locality contains the required text."""
    found = df.filter(F.contains(F.col(locality), F.lit(needle))).select(period).distinct()
    spark = df.sparkSession
    wanted = spark.createDataFrame([(int(p),) for p in periods], f"{period} int")
    return wanted.join(found.select(F.col(period).cast("int").alias(period)), period, "left_anti")


def person_fields_on_organisations(df: DataFrame, is_organisation: Column,
                                   field: str) -> DataFrame:
    """One row: organisation rows, and how many wrongly carry a person field."""
    return df.filter(is_organisation).agg(
        F.count(F.lit(1)).alias("rows"), F.count(field).alias("with_field"))


def missing_rate(df: DataFrame, column: str) -> DataFrame:
    """One row: rows, missing, and their share."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_if(F.col(column).isNull()).alias("missing")) \
        .withColumn("share", F.col("missing") / F.nullif(F.col("rows"), F.lit(0)))


def category_summary(df: DataFrame, category: str, office: str, votes: str) -> DataFrame:
    """Rows and votes of each category and the sorted list of its offices."""
    per_office = df.groupBy(category, office).agg(
        F.count(F.lit(1)).alias("n"), F.sum(votes).alias("v"))
    return per_office.groupBy(category).agg(
        F.sum("n").alias("rows"), F.sum("v").alias("votes"),
        F.array_join(F.sort_array(F.collect_set(office)), ", ").alias("offices"))


def agreement(winners: DataFrame, ballots: DataFrame, period: str, area: str, surname: str,
              ballot_surname: Column | None = None) -> DataFrame:
    """Per period: distinct folded (area, surname) keys among winners, how many of them appear on
    no ballot of the area, and their percentage. Only periods with rows on both sides count."""
    won = winners.select(F.col(period).alias("period"),
                         fold_letters(F.coalesce(area, F.lit("nan"))).alias("a"),
                         fold_letters(F.coalesce(surname, F.lit(""))).alias("s")).distinct()
    name = F.col(surname) if ballot_surname is None else ballot_surname
    cast = ballots.select(F.col(period).alias("period"),
                          fold_letters(F.coalesce(area, F.lit("nan"))).alias("a"),
                          fold_letters(F.coalesce(name, F.lit(""))).alias("s")).distinct()
    marked = won.join(cast.select("period").distinct(), "period", "left_semi") \
        .join(cast.withColumn("__on", F.lit(True)), ["period", "a", "s"], "left")
    return marked.groupBy("period").agg(
        F.count(F.lit(1)).alias("elected"),
        F.count_if(F.col("__on").isNull()).alias("orphans")) \
        .withColumn("pct", F.lit(100.0) * F.col("orphans") / F.col("elected")) \
        .withColumnRenamed("period", period)


def short_races(df: DataFrame, locality: Sequence[str], race: str) -> DataFrame:
    """(locality, race, n, full): localities that list fewer options in a race than the fullest
    locality does. For races that are the same ballot everywhere."""
    counts = df.groupBy(*locality, race).agg(F.count(F.lit(1)).alias("n"))
    full = counts.groupBy(race).agg(F.max("n").alias("full"))
    return counts.join(full, race).filter(F.col("n") < F.col("full")) \
        .select(*locality, race, "n", "full")


def lacking_race(df: DataFrame, locality: Sequence[str], has_race: Column) -> DataFrame:
    """Localities without any row of a race that each of them must hold."""
    return df.groupBy(*locality).agg(F.max(F.coalesce(has_race, F.lit(False))).alias("__has")) \
        .filter(~F.col("__has")).drop("__has")


def incomplete_localities(df: DataFrame, locality: Sequence[str], race: str,
                          same_everywhere: Column, has_race: Column,
                          lacking: str) -> DataFrame:
    """(locality, reason): truncated same-everywhere races, and localities lacking a race."""
    short = short_races(df.filter(same_everywhere), locality, race).select(
        *locality, F.concat(F.col(race), F.lit(": "), F.col("n"), F.lit(" of "), F.col("full"))
        .alias("reason"))
    none = lacking_race(df, locality, has_race).withColumn("reason", F.lit(lacking))
    return short.unionByName(none)


def row_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def low_count_spots(df: DataFrame, office: str, votes: str, below: int = 100) -> DataFrame:
    """Rows of each office with fewer votes than the limit."""
    return df.groupBy(office).agg(F.count(F.lit(1)).alias("n"),
                                  F.count_if(F.col(votes) < below).alias("low"))


def expect_rows(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Known answers that the output does not hold, compared on the given columns."""
    return known.join(df.select(*keys).distinct(), list(keys), "left_anti")
