"""Kinship by shared name tokens: another person of the unit, in the same or another year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.operators.groups import top_n
from hustings.session import growing, stored

MATCHES = ["last", "middle", "all"]


def _token_years(rows: DataFrame, unit: Sequence[str], surname: str, middle: str, person: str,
                 year: str) -> DataFrame:
    """For each token of a unit: per year the least and greatest person who carries it as surname
    (slo, shi) and as middle name (mlo, mhi). Two bounds are enough to tell whether somebody other
    than a given person is there."""
    tokens = F.explode(F.array(F.struct(F.lit("s").alias("kind"), F.col(surname).alias("token")),
                               F.struct(F.lit("m").alias("kind"), F.col(middle).alias("token"))))
    each = rows.select(*unit, F.col(person).alias("person"), F.col(year).alias("y"), tokens.alias("t")) \
        .filter(F.col("t.token").isNotNull() & (F.col("t.token") != ""))

    def of(kind: str) -> Column:
        return F.when(F.col("t.kind") == kind, F.col("person"))
    bounds = each.groupBy(*unit, F.col("t.token").alias("token"), "y").agg(
        F.min(of("s")).alias("slo"), F.max(of("s")).alias("shi"), F.min(of("m")).alias("mlo"), F.max(of("m")).alias("mhi"))
    return bounds.groupBy(*unit, "token").agg(
        F.collect_list(F.struct("y", "slo", "shi", "mlo", "mhi")).alias("years"))


def kin_flags(rows: DataFrame, unit: Sequence[str], person: str, year: str, surname: str,
              middle: str) -> DataFrame:
    """Adds ``<match>_fat`` and ``<match>_thin`` for last, middle and all: is there another person
    in the unit with a matching token in the same year, or in another year.

    last: their surname is mine. middle: their middle is my surname, or their surname or middle is
    my middle. all: either. Rows are joined to token tables, never to each other, so the work
    grows with the rows even where one surname fills a unit. Persons and years must be non-null.
    """
    unit = list(unit)
    table = stored(_token_years(rows, unit, surname, middle, person, year))  # met by both names
    out = rows
    for name, key in (("mine", surname), ("middle", middle)):
        side = table.select(*[F.col(u).alias(f"__u_{u}") for u in unit],
                            F.col("token").alias("__token"), F.col("years").alias(f"__{name}"))
        meet = (F.col(key) == F.col("__token"))
        for u in unit:
            meet = meet & (F.col(u) == F.col(f"__u_{u}"))
        out = out.join(growing(side), meet, "left").drop("__token", *[f"__u_{u}" for u in unit])

    def other(mine: str, theirs: str, same_year: bool) -> Column:
        def hit(e):
            when = (e["y"] == F.col(year)) if same_year else (e["y"] != F.col(year))
            return when & ((e[f"{theirs}lo"] != F.col(person)) | (e[f"{theirs}hi"] != F.col(person)))
        return F.coalesce(F.exists(F.col(f"__{mine}"), lambda e: F.coalesce(hit(e), F.lit(False))), F.lit(False))

    flags = {}
    for kind, same in (("fat", True), ("thin", False)):
        last = other("mine", "s", same)
        mid = other("mine", "m", same) | other("middle", "s", same) | other("middle", "m", same)
        flags |= {f"last_{kind}": last, f"middle_{kind}": mid, f"all_{kind}": last | mid}
    return out.withColumns(flags).drop("__mine", "__middle")


def kin_rates(flagged: DataFrame, unit: Sequence[str], year: str) -> DataFrame:
    """Per unit and year: rows, and for each match how many are related at all, in the same year,
    in another year."""
    counts = [F.count(F.lit(1)).alias("total")]
    for m in MATCHES:
        fat, thin = F.col(f"{m}_fat"), F.col(f"{m}_thin")
        counts += [F.count_if(fat | thin).alias(f"{m}_both"), F.count_if(fat).alias(f"{m}_fat"),
                   F.count_if(thin).alias(f"{m}_thin")]
    return flagged.groupBy(*unit, year).agg(*counts)


def leveled(rows: DataFrame, levels: dict[str, str]) -> DataFrame:
    """Each row once for each level it has a unit at: columns ``level`` and ``unit``."""
    entries = F.array(*[F.struct(F.lit(name).alias("level"), F.col(c).cast("string").alias("unit"))
                        for name, c in levels.items()])
    return rows.withColumn("__l", F.explode(entries)) \
        .select("*", "__l.level", "__l.unit").drop("__l").filter(F.col("unit").isNotNull())


def clan_members(rows: DataFrame, unit: Sequence[str], surname: str, person: str, full_name: str,
                 year: str, office: str, top_members: int = 12) -> tuple[DataFrame, DataFrame]:
    """(clans, members) of families with two or more persons.

    clans: people, seats, fat, thin. members: the first ``top_members`` of each clan by number of
    distinct seats, then name, each with its fullest name and its seats; ``more`` in clans counts
    the rest. The cap is a report limit, the counts cover everyone.
    """
    keys = [*unit, surname]
    seats = rows.groupBy(*keys, person, year, office).agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(full_name, F.struct(-F.length(full_name), F.col(full_name))).alias("name"))
    people = seats.groupBy(*keys, person).agg(
        F.sum("n").alias("rows"),
        F.sort_array(F.collect_set(F.struct(year, office)), asc=False).alias("seats"),
        F.min_by("name", F.struct(-F.length("name"), F.col("name"))).alias("name"))
    per_year = seats.groupBy(*keys, year).agg(F.min(person).alias("lo"), F.max(person).alias("hi"))
    spans = per_year.groupBy(*keys).agg(
        F.bool_or(F.col("lo") != F.col("hi")).alias("fat"), F.count(F.lit(1)).alias("years"))
    sizes = people.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("people"), F.sum("rows").alias("seats"))
    clans = sizes.filter(F.col("people") >= 2).join(growing(spans), keys).select(
        *keys, "people", "seats", "fat", (F.col("years") > 1).alias("thin"),
        F.greatest(F.lit(0), F.col("people") - top_members).alias("more"))
    kept = top_n(people.join(growing(clans.select(*keys)), keys, "left_semi"), keys,
                 [F.size("seats").desc(), F.col("name"), F.col(person)], top_members)
    return clans, kept.select(*keys, person, "name", "seats", "place")


def clan_detail(rows: DataFrame, unit: Sequence[str], surname: str, person: str, full_name: str,
                year: str, office: str, top_clans: int = 12, top_members: int = 12) -> DataFrame:
    """One row for each leading clan of a unit, with its leading members nested; ``more`` counts the
    members that are not shown, ``more_clans`` the clans of the unit."""
    clans, members = clan_members(rows, unit, surname, person, full_name, year, office, top_members)
    keys = [*unit, surname]
    rest = clans.groupBy(*unit).agg(F.greatest(F.lit(0), F.count(F.lit(1)) - top_clans).alias("more_clans"))
    leading = top_n(clans, unit, [F.col("seats").desc(), F.col("people").desc(), F.col(surname)],
                    top_clans, out="clan_place")
    nested = members.groupBy(*keys).agg(F.transform(
        F.sort_array(F.collect_list(F.struct("place", "name", "seats"))),
        lambda m: F.struct(m["name"].alias("name"), m["seats"].alias("seats"))).alias("members"))
    return leading.join(growing(nested), keys).join(rest, list(unit))
