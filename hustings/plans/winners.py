"""Winners: elected from ballots, merged with inherited cycles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.functions import names, offices, parties
from hustings.functions.places import normalize_places
from hustings.functions.text import fold, none_if_blank
from hustings.operators import linkage
from hustings.operators.groups import drop_duplicate_rows, fill_from_mode, top_n
from hustings.operators.reshape import align_union
from hustings.operators.tally import elect, jurisdiction_tally, pooled_tally, seat_estimate

CARRIED = ["region", "last_name", "first_name", "middle_name", "title"]
ELECTED_COLUMNS = ["year", "region", "province", "city", "district", "position", "candidate_name",
                   "last_name", "first_name", "middle_name", "title", "party", "votes"]
WINNER_COLUMNS = ["last_name", "first_name", "middle_name", "title", "full_name", "position",
                  "party", "year", "province", "city", "region", "sex"]
ARTEFACTS = ["Community", "Position Weight"]

# Fixed values ---------------------------------------------------------------------------------
COUNCILOR_SEATS = 8
BOARD_DEFAULT = 4
BOARD_OFFICE = "PROVINCIAL BOARD MEMBER"
# (last, province, first as scraped, first, middle)
NAME_CORRECTIONS = [
    ("AGLIPAY", "CAGAYAN", "1", "EDGAR", None),
    ("LANETE", "MASBATE", "S", "SCOTT", "DAVIES"),
    ("UY", "BOHOL", "A.", "ALVIN", "JAYAG"),
    ("TERUEL", "ILOILO", "V", "VIRGILIO", "TORRES"),
    ("TERUEL", "ILOILO", "NENE", "VIRGILIO", "TORRES"),
    ("RUANTO", "QUEZON", "L.A.", "LORD", "ARNEL FUENTE"),
    ("RUANTO", "QUEZON", "L.", "LORD", "ARNEL FUENTE"),
    ("JAVIER", "ANTIQUE", "J.TOBIAS", "TOBIAS", None),
    ("JAVIER", "ANTIQUE", "J.", "TOBIAS", None),
    ("CLAVER", "KALINGA", "G.", "GKACHAY", None),
]
# ----------------------------------------------------------------------------------------------


def board_seats(ballots: DataFrame, inherited: DataFrame, base_year: int = 2019,
                scope: str = "cycle") -> DataFrame:
    """Board seats for each district of a province, from the people who held them in a base cycle.

    ``scope`` "cycle" counts the districts of the cycle being built; "all" pools the districts of
    every cycle. Both sides must carry canonical province names.
    """
    holders = inherited.filter((F.col("year") == base_year) & (F.col("position") == BOARD_OFFICE))
    contests = ballots.filter(F.col("position") == BOARD_OFFICE)
    by = ["year"] if scope == "cycle" else []
    return seat_estimate(holders, contests, "province", "district", by=by)


def local_winners(ballots: DataFrame, seats: DataFrame,
                  councilors: int = COUNCILOR_SEATS) -> DataFrame:
    """Winners of all local offices and cycles in one pass."""
    cast = ballots.filter(F.col("is_geographic") & F.col("position").isin(offices.LOCAL_OFFICES))
    order = [F.col("region"), F.col("province"), F.col("city"), -F.col("votes")]
    tally = jurisdiction_tally(cast, "position", offices.JURISDICTION, ["candidate_name", "party"],
                               "votes", CARRIED, order, by=["year"])
    keys = [k for k in ("year", "province") if k in seats.columns]
    known = tally.join(seats.select(*keys, F.col("seats").alias("__board")), keys, "left")
    n = F.when(F.col("position").isin(offices.SINGLE_SEAT_OFFICES), 1) \
        .when(F.col("position") == "COUNCILOR", councilors) \
        .otherwise(F.coalesce("__board", F.lit(BOARD_DEFAULT)))
    race = ["year", "position", "province", "city", "district"]
    won = elect(known.withColumn("seats", n), race, "votes", "seats", ["candidate_name", "party"])
    return won.select(*ELECTED_COLUMNS, "seats", "tie_at_cutoff")


def national_winners(ballots: DataFrame, seats: dict[str, int] | None = None,
                     keep_null: bool = True) -> DataFrame:
    """Winners of nationwide offices: every row counts, places or not. Without ``keep_null``
    candidates that lack a party are left out."""
    seats = offices.NATIONAL_SEATS if seats is None else seats
    cast = ballots.filter(F.col("position").isin(list(seats)))
    tally = pooled_tally(cast, ["year", "position"], ["candidate_name", "party"], "votes",
                         CARRIED[1:], keep_null)
    n = F.coalesce(*[F.when(F.col("position") == o, F.lit(k)) for o, k in seats.items()])
    won = elect(tally.withColumn("seats", n), ["year", "position"], "votes", "seats",
                ["candidate_name", "party"])
    nowhere = {c: F.lit(None).cast("string") for c in ("region", "province", "city", "district")}
    return won.withColumns(nowhere).select(*ELECTED_COLUMNS, "seats", "tie_at_cutoff")


def winners_from_ballots(ballots: DataFrame, seats: DataFrame) -> DataFrame:
    return local_winners(ballots, seats).unionByName(national_winners(ballots))


def to_winners_schema(elected: DataFrame) -> DataFrame:
    """Elected rows in the published schema; the name parts are carried, not parsed again."""
    return elected.withColumn(
        "full_name", names.canonical_full_name("last_name", "first_name", "middle_name")) \
        .withColumn("sex", F.lit("")).select(*WINNER_COLUMNS)


def canonicalise_inherited(df: DataFrame) -> DataFrame:
    """Inherited rows (``FIRST MIDDLE SURNAME``) in the published schema; no city, no sex."""
    parsed = df.drop(*ARTEFACTS).withColumn("__n", names.standardize_name("full_name", "party"))
    return parsed.withColumns({
        "last_name": F.col("__n.last"), "first_name": F.col("__n.first"),
        "middle_name": F.col("__n.middle"), "title": F.col("__n.title"),
        "full_name": names.canonical_full_name("__n.last", "__n.first", "__n.middle"),
        "city": F.lit(None).cast("string"), "sex": F.lit(""),
    }).select(*WINNER_COLUMNS)


def apply_name_corrections(df: DataFrame, rules: Sequence[tuple] = tuple(NAME_CORRECTIONS)
                           ) -> DataFrame:
    """Verified corrections of initials; a missing middle overwrites too."""
    table = df.sparkSession.createDataFrame(
        list(rules), "last string, province string, scraped string, first string, middle string") \
        .withColumn("full", F.concat_ws(", ", "last", F.concat_ws(" ", "first", "middle")))
    keyed = df.withColumns({"__l": F.upper("last_name"), "__p": F.upper("province")})
    return linkage.apply_corrections(
        keyed, table,
        {"__l": "last", "__p": "province", "first_name": "scraped"},
        {"first_name": "first", "middle_name": "middle", "full_name": "full"}).drop("__l", "__p")


def fill_listed_sex(df: DataFrame, by_key: DataFrame, by_given: DataFrame, first_year: int = 2004,
                    last_year: int = 2022) -> DataFrame:
    """Blank sex of the covered cycles: exact (year, position, last, given), then the given name.

    ``by_key``: year, position, last, given, sex. ``by_given``: given, sex.
    """
    keyed = df.withColumns({
        "__last": F.coalesce(fold("last_name"), F.lit("")),
        "__given": F.coalesce(names.given_token("first_name"), F.lit(""))})
    stages = [
        linkage.Stage(by_key, ["year", "position", "last", "given"],
                      ["year", "position", "__last", "__given"], "sex", "list"),
        linkage.Stage(by_given, ["given"], ["__given"], "sex", "given-name"),
    ]
    looked = linkage.staged_lookup(keyed, stages, "__hit", "__label")
    fill = none_if_blank("sex").isNull() & F.col("year").between(first_year, last_year) \
        & F.col("__hit").isNotNull()
    return looked.withColumn("sex", F.when(fill, F.col("__hit")).otherwise(F.col("sex"))) \
        .drop("__last", "__given", "__hit", "__label")


def sex_dictionaries(listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(by_key, by_given) learned from list records (year, position, last, given, sex): keys with
    one sex, and given names of at least five people of whom 99 percent share one."""
    keys = ["year", "position", "last", "given"]
    return (linkage.unambiguous_index(listed, keys, "sex"),
            linkage.majority_dictionary(listed, "given", "sex", 5, 0.99).select("given", "sex"))


def merge_winners(inherited: DataFrame, fresh: Sequence[DataFrame], fresh_years: Sequence[int],
                  by_key: DataFrame | None = None, by_given: DataFrame | None = None,
                  listed: DataFrame | None = None) -> DataFrame:
    """Inherited cycles that were not built anew, listed cycles and fresh winners in one table,
    with corrected names, known sexes, canonical places, regions and parties."""
    kept = inherited.filter(~F.col("year").isin(list(fresh_years)) | F.col("year").isNull())
    frames = [canonicalise_inherited(kept)]
    if listed is not None:
        frames.append(listed.select(*WINNER_COLUMNS))
    frames += [to_winners_schema(f) for f in fresh]
    merged = apply_name_corrections(align_union(frames, WINNER_COLUMNS))
    if by_key is not None and by_given is not None:
        merged = fill_listed_sex(merged, by_key, by_given)
    merged = normalize_places(merged, city="city")
    merged = fill_from_mode(merged, "province", "region")
    merged = merged.withColumn("party", parties.canonical_party("party"))
    return drop_duplicate_rows(merged)


def leading_rows(df: DataFrame, keys: Sequence[str], votes: str, n: int,
                 tie_break: Sequence[str]) -> DataFrame:
    """The first ``n`` of each group by votes."""
    order = [F.col(votes).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break]]
    return top_n(df, keys, order, n)
