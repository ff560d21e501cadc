"""The audit of winners, of vote counts and of their agreement, as one table of findings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.functions import offices
from hustings.functions.places import TALLY_CATEGORIES
from hustings.functions.text import fold_spelling
from hustings.operators import audit

# Fixed values ---------------------------------------------------------------------------------
EXPECTED_COUNTS = {"GOVERNOR": 82, "VICE GOVERNOR": 82, "MAYOR": 1634, "VICE MAYOR": 1634}
OPTIONAL_COLUMNS = ["title", "middle_name"]
CAPITAL = "MANILA"
# ----------------------------------------------------------------------------------------------


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _n(c: str):
    return F.format_number(F.col(c), 0)


def audit_winners(winners: DataFrame, truth: dict[str, int] | None = None) -> DataFrame:
    """Unknown offices, missing values, collapsed levels, implausible counts, duplicates and
    provinces spelled in several ways."""
    spark = winners.sparkSession
    truth = EXPECTED_COUNTS if truth is None else truth
    rows = winners.withColumn("level", offices.office_level("position"))
    unknown = rows.filter(F.col("level").isNull() & F.col("position").isNotNull()) \
        .select("position").distinct()
    columns = [c for c in winners.columns if c not in OPTIONAL_COLUMNS]
    nulls = audit.null_profile(winners, "year", columns).filter(F.col("severity").isNotNull())
    entirely = F.col("severity") == "high"
    low = audit.level_collapse(rows, "year", "level")
    known = spark.createDataFrame(list(truth.items()), "position string, expected int")
    drift = audit.count_drift(winners, known, "position", "year")
    exact = audit.exact_duplicates(winners, "year")
    shared = audit.shared_keys(winners, ["year", "province", "position", "full_name"], "year")
    spelled = audit.spelling_variants(winners, "province", fold_spelling("province"), "year")
    name = "winners"
    return _union([
        audit.issues(unknown, name, "high", "unrecognised position", F.col("position"),
                     F.lit("position is not one of the 7 expected offices")),
        audit.issues(nulls, name, F.col("severity"),
                     F.concat(F.col("column"), F.when(entirely, " entirely missing")
                              .otherwise(" mostly missing")), F.col("year"),
                     F.concat(_n("nulls"), F.lit(" of "), _n("total"), F.lit(" rows have no "),
                              F.col("column"))),
        audit.issues(low, name, "high", F.concat("level", F.lit(" offices largely missing")),
                     F.col("year"), F.concat(F.col("n"), F.lit(" rows vs a median of "),
                                             F.format_number("median", 0))),
        audit.issues(drift, name, "high",
                     F.concat(F.lit("implausible "), "position", F.lit(" count")), F.col("year"),
                     F.concat(_n("n"), F.lit(" rows, "),
                              F.format_number(F.abs("drift") * 100, 0), F.lit("% "),
                              F.col("direction"), F.lit(" than ~"), _n("expected"))),
        audit.issues(exact, name, "high", "duplicate rows", F.col("year"),
                     F.concat(_n("duplicates"), F.lit(" rows are exact duplicates"))),
        audit.issues(shared, name, "medium", "same person listed twice for one seat",
                     F.col("year"), F.concat(_n("rows"), F.lit(" rows share province, position "
                                                               "and name with another row"))),
        audit.issues(spelled, name, "high", "province spelled differently across cycles",
                     F.col("norm"), F.concat(
                         F.lit("'"), F.col("raw"), F.lit("' in "),
                         F.array_join(F.col("periods").cast("array<string>"), ", "))),
    ])


def file_coverage(raw: DataFrame, region_of, province_of, file_of) -> DataFrame:
    """(year, region, province, municipality, file, rows, positions, total_votes) of the landed
    files, nationwide tally categories left out. The locality is the name inside the file."""
    placed = raw.withColumns({"__region": region_of, "__province": province_of, "__file": file_of})
    keys = ["year", "__region", "__province", "__file"]
    per_file = audit.file_coverage(
        placed.withColumn("__votes", F.col("votes").try_cast("bigint")), keys, "position", "__votes")
    city = placed.groupBy(*keys).agg(F.min(F.upper(F.trim("city"))).alias("municipality"))
    return per_file.join(city, keys).withColumnsRenamed(
        {"__region": "region", "__province": "province", "__file": "file"}) \
        .select("year", "region", "province", "municipality", "file", "rows", "positions",
                "total_votes")


def audit_files(coverage: DataFrame, empty: DataFrame | None = None, unreadable: DataFrame | None = None,
                years: Sequence[int] = ()) -> DataFrame:
    """Files that name no place, files without rows, files that cannot be read, cycles without files.

    ``empty``: file. ``unreadable``: file, reason. ``years``: the cycles that must have landed.
    """
    same = (F.col("region") == F.col("province")) & (F.col("province") == F.col("municipality"))
    junk = coverage.filter(same & ~F.col("municipality").isin(TALLY_CATEGORIES))
    found = audit.issues(junk, "votecounts", "high", "junk locality scraped",
                         F.concat_ws("/", F.col("year").cast("string"), "municipality"),
                         F.concat(F.lit("region, province and city are all the same in "),
                                  F.col("file")))
    frames = [found]
    if empty is not None:
        frames.append(audit.issues(empty, "votecounts", "medium", "empty file", F.col("file"),
                                   F.lit("file contains no rows")))
    if unreadable is not None:
        frames.append(audit.issues(unreadable, "votecounts", "high", "unreadable file", F.col("file"), F.col("reason")))
    if years:
        wanted = coverage.sparkSession.createDataFrame([(int(y),) for y in years], "year int")
        landed = coverage.select(F.col("year").cast("int").alias("year")).distinct()
        frames.append(audit.issues(wanted.join(landed, "year", "left_anti"), "votecounts", "high", "no raw files",
                                   F.col("year"), F.lit("no file has landed for this cycle")))
    return _union(frames)


def audit_vote_counts(counts: DataFrame, coverage: DataFrame | None = None,
                      years: Sequence[int] = ()) -> DataFrame:
    """Organisations parsed as people, missing parties, nationwide tallies, localities that a
    cycle lacks, and the capital where it is absent."""
    organisation = ~offices.is_person_office("position")
    parsed = audit.person_fields_on_organisations(counts, organisation, "last_name") \
        .filter(F.col("with_field") > 0)
    party = audit.missing_rate(counts.filter(~organisation), "party").filter(F.col("missing") > 0)
    special = audit.category_summary(counts.filter(~F.col("is_geographic")), "province",
                                     "position", "votes")
    name = "votecounts"
    frames = [
        audit.issues(parsed, name, "high", "party-list groups parsed as people",
                     F.lit("PARTY LIST"), F.concat(_n("with_field"), F.lit(
                         " organisation rows have person-name fields set"))),
        audit.issues(party, name, "low", "party missing", F.lit("all cycles"),
                     F.concat(_n("missing"), F.lit(" of "), _n("rows"),
                              F.lit(" person rows have no party"))),
        audit.issues(special, name, "info", "non-geographic tally category", F.col("province"),
                     F.concat(_n("rows"), F.lit(" rows ("), _n("votes"), F.lit(" votes); offices: "),
                              F.col("offices"))),
    ]
    if coverage is not None:
        places = coverage.filter(~F.col("municipality").isin(TALLY_CATEGORIES))
        gaps = audit.gap_report(audit.locality_gap_pairs(places, "year", "municipality"),
                                "municipality")
        frames.append(audit.issues(
            gaps, name, "medium", "locality missing from a cycle", F.col("missing_from"),
            F.concat(F.col("localities"), F.lit(" localities of "), F.col("present_in"),
                     F.lit(" are absent: "), F.array_join("sample", ", "))))
        absent = audit.required_everywhere(places, "year", years, "municipality", CAPITAL)
        frames.append(audit.issues(absent, name, "high", "capital absent", F.col("year"),
                                   F.lit("no file for the capital")))
    return _union(frames)


def audit_alignment(winners: DataFrame, counts: DataFrame, years: Sequence[int],
                    all_years: Sequence[int], limit: float = 1.0) -> DataFrame:
    """Winners whose surname is on no ballot of their province, cycles without ballots and cycles
    that the ballots cover in part."""
    spark = winners.sparkSession
    surname = F.split("candidate_name", ",")[0]
    agreed = audit.agreement(winners.filter(F.col("year").isin(list(years))), counts, "year",
                             "province", "last_name", surname).filter(F.col("pct") > limit)
    have = counts.select(F.col("year").cast("int").alias("year")).dropna().distinct()
    wanted = spark.createDataFrame([(int(y),) for y in all_years], "year int")
    name = "alignment"
    return _union([
        audit.issues(agreed, name, "high", "winners disagree with the ballots", F.col("year"),
                     F.concat(_n("orphans"), F.lit(" of "), _n("elected"), F.lit(" ("),
                              F.format_number("pct", 1),
                              F.lit("%) surnames are on no ballot of their province"))),
        audit.issues(wanted.join(have, "year", "left_anti"), name, "info",
                     "no vote counts for this cycle", F.col("year"),
                     F.lit("this cycle cannot be verified against ballots")),
        audit.issues(have.filter(~F.col("year").isin(list(years))), name, "info",
                     "partial vote counts for this cycle", F.col("year"),
                     F.lit("a complete check of winners against ballots is not expected")),
    ])


def roster_gaps(found: DataFrame, roster: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Places of a roster that are not there, or that are filed under another parent.

    ``roster`` and ``found``: region, province. ``filed_under`` names the other parent, if any.
    """
    region, province = keys
    missing = audit.expect_rows(found, roster, keys)
    elsewhere = found.groupBy(province).agg(F.min(region).alias("filed_under"))
    return missing.join(elsewhere, province, "left").select(region, province, "filed_under")
