"""Family ties among office-holders: rates for each unit and year, and the clans behind them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.functions.names import extract_given
from hustings.functions.places import city_key
from hustings.functions.text import fold
from hustings.operators import crosswalk, identity, kinship
from hustings.session import stored

# Fixed values ---------------------------------------------------------------------------------
LEVELS = {"region": "region_code", "province": "prov_code", "municipality": "city_code"}
NATIONWIDE = ["PRESIDENT", "VICE PRESIDENT", "SENATOR"]
# Province name -> unit that holds it; the first of two where a province was split later.
PROVINCE_UNITS = {
    "NCR FIRST DISTRICT": "1303900000", "NCR SECOND DISTRICT": "1307400000",
    "NCR THIRD DISTRICT": "1307500000", "NCR FOURTH DISTRICT": "1307600000",
    "COTABATO": "1204700000", "MAGUINDANAO": "1908700000",
}
# (province or None, spelling, official name)
CITY_SPELLINGS = [
    (None, "CORDOBA", "Cordova"), (None, "JETAFE", "Getafe"),
    (None, "PINAMUNGAHAN", "Pinamungajan"), (None, "OZAMIS", "Ozamiz"),
    (None, "BALIUAG", "Baliwag"), (None, "MATAAS NA KAHOY", "Mataasnakahoy"),
    (None, "BACUNGAN", "Leon T. Postigo"), (None, "PIO V CORPUZ", "Pio V. Corpus"),
    ("LANAO DEL SUR", "TAGOLOAN", "Tagoloan II"),
]
# (region code, surname, given name, other given name of the same person)
SAME_PERSON = [
    ("0100000000", "MARCOS", "MARIA", "IMEE"),
    ("0600000000", "VILLARUZ", "ROBERT", "BOY"),
    ("0600000000", "VILLARUZ", "ROBERT", "BOK"),
    ("0600000000", "ESPINOSA", "LOIDA", "NENE"),
    ("0100000000", "VALDEZ", "MELANIE", "MEL"),
]
# ----------------------------------------------------------------------------------------------


def aliases(spark, rules) -> DataFrame:
    """Alias table for the crosswalk from (province, spelling, official name) rules."""
    raw = spark.createDataFrame(list(rules), "scope_name string, form string, official string")
    return raw.select("scope_name", "form", city_key("official").alias("alias"))


def province_codes(provinces: DataFrame, names: DataFrame, name: str,
                   units: dict[str, str]) -> DataFrame:
    """(province, code) of each distinct province name: a listed unit, else the unit whose own
    name has the same key. ``provinces``: code, name."""
    listed = F.coalesce(F.lit(None).cast("string"), *[
        F.when(F.col("__fold") == k, F.lit(v)) for k, v in units.items()])
    by_key = provinces.groupBy(city_key("name").alias("__key")).agg(F.max("code").alias("__code"))
    return names.select(F.col(name).alias("province")).distinct() \
        .withColumns({"__fold": fold("province"), "__key": city_key("province")}) \
        .join(by_key, "__key", "left") \
        .select("province", F.coalesce(listed, "__code").alias("code"))


def city_codes(pairs: DataFrame, places: DataFrame, alias_table: DataFrame | None) -> DataFrame:
    """(province, city, prov_code, code): one scope, the alias before the name itself, no prefixes
    and no near spellings. ``places``: scope, name, code."""
    keyed = pairs.withColumns({"scope_name": fold("province"), "key": city_key("city"),
                               "__form": fold("city")})
    if alias_table is not None:
        # An alias is written as the folded name, before honorifics are taken off.
        own = alias_table.filter(F.col("scope_name").isNotNull()).select(
            "scope_name", F.col("form").alias("__form"), F.col("alias").alias("__own"))
        general = alias_table.filter(F.col("scope_name").isNull()).select(
            F.col("form").alias("__form"), F.col("alias").alias("__general"))
        keyed = keyed.join(own, ["scope_name", "__form"], "left") \
            .join(general, "__form", "left").withColumn("__alias", F.coalesce("__own", "__general"))
    else:
        keyed = keyed.withColumn("__alias", F.lit(None).cast("string"))
    table = places.groupBy(F.col("scope").alias("prov_code"), city_key("name").alias("__name")) \
        .agg(F.max("code").alias("__c"))
    by_alias = table.withColumnsRenamed({"__name": "__alias", "__c": "__a"})
    by_name = table.withColumnsRenamed({"__name": "key", "__c": "__b"})
    return keyed.join(by_alias, ["prov_code", "__alias"], "left") \
        .join(by_name, ["prov_code", "key"], "left") \
        .select("province", "city", "prov_code", F.coalesce("__a", "__b").alias("code"))


def located_winners(winners: DataFrame, provinces: DataFrame, places: DataFrame,
                    units: dict[str, str] | None = None, spellings=None) -> DataFrame:
    """Winners with surname, given name, middle name and the codes of their units; rows without a
    name or a known province drop out. ``provinces``: code, name, region."""
    spark = winners.sparkSession
    units = PROVINCE_UNITS if units is None else units
    rules = CITY_SPELLINGS if spellings is None else spellings
    w = winners.filter(F.col("last_name").isNotNull() & F.col("first_name").isNotNull()
                       & ~F.coalesce(F.col("position").isin(NATIONWIDE), F.lit(False))) \
        .withColumns({"surname": fold("last_name"),
                      "given": extract_given("first_name", "middle_name"),
                      "middle": F.coalesce(fold("middle_name"), F.lit(""))}) \
        .filter(F.col("surname").isNotNull() & F.col("given").isNotNull())
    # the names come from all rows, so that they are not folded again for them; what is known of
    # provinces and cities is stored, so that the plan of the rows does not hold theirs
    codes = stored(province_codes(provinces, winners, "province", units).filter(F.col("code").isNotNull()) \
        .join(provinces.select("code", F.col("region").alias("region_code")), "code") \
        .withColumnRenamed("code", "prov_code"))
    pairs = winners.filter(F.col("city").isNotNull()).select("province", "city").distinct() \
        .join(codes.select("province", "prov_code"), "province")
    w = w.join(codes, "province")
    table = aliases(spark, rules) if rules else None
    cities = stored(city_codes(pairs, places, table).select(
        "province", "city", F.col("code").alias("city_code")))
    return w.join(cities, ["province", "city"], "left")


def kin_table(located: DataFrame, curated_rules=tuple(SAME_PERSON)) -> DataFrame:
    """Located winners with one identity for each person, once for each level they have a unit at,
    and the six kinship flags."""
    spark = located.sparkSession
    curated = spark.createDataFrame(
        list(curated_rules), "region_code string, surname string, a string, b string") \
        if curated_rules else None
    named = identity.resolve_given(located, ["region_code", "surname"], "given", "year", "middle",
                                   curated, "person_given")
    # tokens and flags both start from them, so the plans of the persons end here
    people = stored(named.withColumn("person", F.concat_ws("|", "region_code", "surname", "person_given")))
    return kinship.kin_flags(kinship.leveled(people, LEVELS), ["level", "unit"], "person", "year",
                             "surname", "middle")


def kin_report(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rates, clans): rates for all levels; clans for provinces and municipalities."""
    rates = kinship.kin_rates(flagged, ["level", "unit"], "year")
    clans = kinship.clan_detail(flagged.filter(F.col("level") != "region"), ["level", "unit"],
                                "surname", "person", "full_name", "year", "position")
    return rates, clans


def simple_crosswalk(pairs: DataFrame, scopes: DataFrame, names: DataFrame, id_cols: list[str],
                     scope_name: str, key: str, alias_table: DataFrame | None) -> DataFrame:
    """The cascade without prefixes and without near spellings."""
    return crosswalk.resolve_codes(pairs, scopes, names, id_cols, scope_name, key, alias_table,
                                   prefixes=False)
