"""Results by stable place code: cells for localities and for provinces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.functions.places import TALLY_CATEGORIES, city_key
from hustings.functions.text import fold, none_if_blank, number_value
from hustings.operators import cells, crosswalk
from hustings.operators.reshape import exclude_keys
from hustings.plans.kin import CITY_SPELLINGS, aliases
from hustings.session import checkpointed

# Fixed values ---------------------------------------------------------------------------------
DRAWN_RACES = ["PRESIDENT", "VICE PRESIDENT", "SENATOR", "PARTY LIST", "GOVERNOR", "MAYOR"]
PROVINCE_RACES = ["PRESIDENT", "VICE PRESIDENT", "SENATOR", "PARTY LIST", "GOVERNOR"]
# Province name -> units it may mean, in the order they are searched.
PROVINCE_SCOPES = {
    "NCR FIRST DISTRICT": ["1303900000"], "NCR SECOND DISTRICT": ["1307400000"],
    "NCR THIRD DISTRICT": ["1307500000"], "NCR FOURTH DISTRICT": ["1307600000"],
    "COTABATO": ["1204700000"], "MAGUINDANAO": ["1908700000", "1908800000"],
    "BASILAN": ["1900700000", "0990100000"], "DAVAO DEL SUR": ["1102400000", "1108600000"],
}
DRAWN_SPELLINGS = [*CITY_SPELLINGS, ("DAVAO DEL NORTE", "SAMAL", "Island Garden City of Samal")]
# ----------------------------------------------------------------------------------------------


def province_scopes(names: DataFrame, name: str, provinces: DataFrame,
                    listed: dict[str, list[str]] | None = None) -> DataFrame:
    """(scope_name, scope, scope_pos) of each distinct province name, keyed by its folded form: the
    listed units, else the one unit whose own name has the same key."""
    listed = PROVINCE_SCOPES if listed is None else listed
    spark = names.sparkSession
    table = spark.createDataFrame(
        [(k, s, i) for k, v in listed.items() for i, s in enumerate(v)],
        "scope_name string, scope string, scope_pos int")
    distinct = names.select(fold(name).alias("scope_name"), city_key(name).alias("__key")) \
        .distinct().filter(F.col("scope_name").isNotNull())
    by_key = provinces.groupBy(city_key("name").alias("__key")).agg(F.max("code").alias("scope"))
    known = distinct.select("scope_name").distinct()
    own = table.join(known, "scope_name", "left_semi")
    rest = distinct.join(table.select("scope_name").distinct(), "scope_name", "left_anti") \
        .join(by_key, "__key").groupBy("scope_name").agg(F.max("scope").alias("scope")) \
        .withColumn("scope_pos", F.lit(0))
    return own.unionByName(rest)


def drawn_rows(counts: DataFrame, withheld: DataFrame | None = None,
               races: Sequence[str] = DRAWN_RACES) -> DataFrame:
    """Rows of the drawn races outside nationwide tally categories; blank party instead of null,
    so organisations keep their rows; votes that are no number count 0."""
    rows = counts.filter(~F.coalesce(F.col("region").isin(TALLY_CATEGORIES), F.lit(False))
                         & F.col("position").isin(list(races)))
    if withheld is not None:
        rows = exclude_keys(rows, withheld)
    return rows.select(
        "year", "region", "province", "city", "position", "candidate_name",
        F.coalesce("party", F.lit("")).alias("party"),
        F.coalesce(number_value("votes"), F.lit(0).cast("bigint")).alias("votes"))


def place_crosswalk(rows: DataFrame, provinces: DataFrame, places: DataFrame,
                    listed: dict[str, list[str]] | None = None, spellings=None,
                    cutoff: float | None = crosswalk.CUTOFF) -> tuple[DataFrame, DataFrame]:
    """(crosswalk, scopes). Every distinct pair of province and non-blank city is resolved once:
    ``code``, ``how``, ``near``, ``ratio``. ``places``: scope, name, code."""
    pairs = rows.filter(none_if_blank("city").isNotNull()).select("province", "city").distinct() \
        .withColumns({"scope_name": fold("province"), "key": city_key("city")})
    scopes = province_scopes(rows.select("province").distinct(), "province", provinces, listed)
    names = places.select("scope", city_key("name").alias("key"), "code") \
        .filter(F.col("key").isNotNull())
    rules = DRAWN_SPELLINGS if spellings is None else spellings
    table = aliases(rows.sparkSession, rules) if rules else None
    solved = crosswalk.crosswalk(pairs, scopes, names, ["province", "city"], "scope_name", "key",
                                 table, cutoff)
    return solved, scopes


def place_results(counts: DataFrame, provinces: DataFrame, places: DataFrame,
                  withheld: DataFrame | None = None,
                  **options) -> dict[str, DataFrame]:
    """Cells of localities and provinces, the crosswalk behind them and its metrics.

    Province cells are summed from all rows of their localities; a total reported for a whole
    province stands only where there are none.
    """
    rows = drawn_rows(counts, withheld)
    solved, scopes = place_crosswalk(rows, provinces, places, **options)
    solved = checkpointed(solved)
    located = rows.join(solved.select("province", "city", "code"), ["province", "city"], "left")
    placed = located.filter(F.col("code").isNotNull()).join(
        places.select("code", F.col("scope").alias("prov")).distinct(), "code")
    candidate = ["candidate_name", "party"]
    local = cells.result_cells(placed, ["year", "position", "code"], candidate, "votes")
    rolled = cells.result_cells(placed.filter(F.col("position").isin(PROVINCE_RACES)),
                                ["year", "position", "prov"], candidate, "votes")
    first = scopes.filter(F.col("scope_pos") == 0).select("scope_name", F.col("scope").alias("prov"))
    totals = rows.filter(none_if_blank("city").isNull()
                         & F.col("position").isin(PROVINCE_RACES)) \
        .withColumn("scope_name", fold("province")).join(first, "scope_name")
    in_city = located.filter(none_if_blank("city").isNotNull())
    return {
        "cells": local,
        "province_cells": cells.with_province_totals(
            rolled, totals, ["year", "position", "prov"], candidate, "votes"),
        "crosswalk": solved,
        "unresolved": cells.unresolved_votes(in_city, "code", "votes", ["province", "city"]),
        "metrics": cells.placement_metrics(in_city, "code", "votes", ["province", "city"]),
        "per_race": local.groupBy("year", "position").agg(F.count(F.lit(1)).alias("localities")),
        "no_result": places.select("code", "name").distinct()
        .join(local.select("code").distinct(), "code", "left_anti"),
    }
