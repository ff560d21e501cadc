"""Missing middle names and sexes filled by staged linkage, with the source of every value."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.functions import names, offices
from hustings.functions.places import canonical_city, canonical_province
from hustings.functions.text import fold, none_if_blank
from hustings.operators import linkage
from hustings.operators.groups import attach, flag_top_row
from hustings.operators.linkage import Stage, staged_lookup, unambiguous_index
from hustings.session import checkpointed, growing, stored
from hustings.sources.lists import middle_sources, sex_sources

# Cycles that are filled, and the labels of the sources.
FILL_YEARS = (2016, 2019, 2022, 2025)
SELF_YEAR = 2025
LIST, INHERITED, SELF, GIVEN = "comelec_lec", "v8.5", "self-prior", "given-name"
WINNER_MATCH, PERSON_INDEX, PERSON_MATCH = "winner-match", "person-index", "person-match"
GIVEN_DERIVED, ORIGINAL, PRIOR = "given-name-derived", "original", "prior"

AUDIT_COLUMNS = ["dataset", "year", "province", "city", "position", "last_name", "first_name",
                 "field", "value_filled", "source"]


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def with_link_keys(df: DataFrame) -> DataFrame:
    """Folded key parts beside the row; a missing part is an empty text.

    Rows without any name, such as organisations, are nobody's namesake: their name keys start with
    a hyphen, which no folded name does, and differ from row to row, so that they match nothing and
    do not meet in one task.
    """
    nobody = F.concat(F.lit("-"), F.xxhash64(*[F.col(c) for c in df.columns]).cast("string"))
    last, given = _text(fold("last_name")), _text(names.given_token("first_name"))
    keyed = df.withColumns({
        "k_province": _text(fold(canonical_province("province"))),
        "k_city": _text(fold(canonical_city("city"))), "k_last": last, "k_given": given})
    unnamed = (F.col("k_last") == "") & (F.col("k_given") == "")
    return keyed.withColumn("__unnamed", unnamed).withColumns({
        k: F.when(F.col("__unnamed"), nobody).otherwise(F.col(k)) for k in ("k_last", "k_given")}).drop("__unnamed")


KEYS = ["k_province", "k_city", "k_last", "k_given"]
#: What a look-up needs to know of a winner.
PERSON = ["year", "province", "city", "position", "last_name", "first_name"]


def _is(column: str, values: Sequence[str]) -> Column:
    return F.coalesce(F.col(column).isin(list(values)), F.lit(False))


def stored_index(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The unambiguous values of linkage rows by their keys, written once: the look-up that joins
    several indexes then plans joins of short tables, and the driver keeps no sums of them."""
    return stored(unambiguous_index(rows, keys, "value"))


def indexes(rows: DataFrame, by: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The three unambiguous indexes of linkage rows: city offices by (city, last, given) and by
    (city, last), governors by (province, position, last, given)."""
    city = rows.filter(_is("position", offices.CITY_OFFICES) & (F.col("city") != ""))
    governor = rows.filter(_is("position", offices.GOVERNOR_OFFICES))
    by = list(by)
    return {
        "person": unambiguous_index(city, [*by, "city", "last", "given"], "value"),
        "surname": unambiguous_index(city, [*by, "city", "last"], "value"),
        "governor": unambiguous_index(governor, [*by, "province", "position", "last", "given"],
                                      "value"),
    }


def stages(rows: DataFrame, label: str, surname_only: bool, by: Sequence[str] = (),
           when: Column | None = None) -> list[Stage]:
    """Lookup stages over one source, their indexes stored. The surname alone is trusted only within
    one election."""
    idx, by = indexes(rows, by), list(by)
    city, governor = _is("position", offices.CITY_OFFICES), _is("position", offices.GOVERNOR_OFFICES)
    if when is not None:
        city, governor = city & when, governor & when
    out = [Stage(stored(idx["person"]), [*by, "city", "last", "given"],
                 [*by, "k_city", "k_last", "k_given"], "value", label, city, grows=True)]
    if surname_only:
        out.append(Stage(stored(idx["surname"]), [*by, "city", "last"], [*by, "k_city", "k_last"],
                         "value", label, city, grows=True))
    out.append(Stage(stored(idx["governor"]), [*by, "province", "position", "last", "given"],
                     [*by, "k_province", "position", "k_last", "k_given"], "value", label, governor, grows=True))
    return out


def stored_links(rows: DataFrame) -> DataFrame:
    """Linkage rows, each once, written with their folded keys. Every index over them starts from the
    short rows; their plans would else carry the folding of all key parts, and the driver all plans."""
    return checkpointed(rows.drop("source").distinct())


def winner_middles(winners: DataFrame, source: str = SELF) -> DataFrame:
    c = F.col
    return middle_sources(winners, source, province=c("province"), city=c("city"),
                          position=c("position"), last=c("last_name"), first=c("first_name"),
                          value=c("middle_name"), year=c("year"))


def winner_sexes(winners: DataFrame, source: str = SELF) -> DataFrame:
    c = F.col
    return sex_sources(winners, source, province=c("province"), city=c("city"),
                       position=c("position"), last=c("last_name"), first=c("first_name"),
                       value=c("sex"), year=c("year"))


def _log(filled: DataFrame, dataset: str, field: str, column: str, source: str) -> DataFrame:
    return filled.filter("__filled").select(
        F.lit(dataset).alias("dataset"), "year", "province", "city", "position", "last_name",
        "first_name", F.lit(field).alias("field"), F.col(column).alias("value_filled"),
        F.col(source).alias("source"))


def _fill(df: DataFrame, target: str, source: str, blank: Column, eligible: Column) -> DataFrame:
    fill = F.coalesce(blank & eligible & F.col("__hit").isNotNull(), F.lit(False))
    return df.withColumn("__filled", fill).withColumns({
        target: F.when(F.col("__filled"), F.col("__hit")).otherwise(F.col(target)),
        source: F.when(F.col("__filled"), F.col("__label")).otherwise(F.col(source)),
    }).drop("__hit", "__label")


def with_source_columns(winners: DataFrame) -> DataFrame:
    """Source columns carried from an earlier run, or started from what is there."""
    add = {}
    if "middle_name_source" not in winners.columns:
        add["middle_name_source"] = F.when(names.has_middle("middle_name"), ORIGINAL).otherwise("")
    if "sex_source" not in winners.columns:
        add["sex_source"] = F.when(none_if_blank("sex").isNotNull(), PRIOR).otherwise("")
    return winners.withColumns(add) if add else winners


def blank_people(winners: DataFrame, blank: Column, years: Sequence[int]) -> DataFrame:
    """The people of the given cycles with a blank field, each once, with their folded key parts.
    What is looked up depends on these columns alone, so fills are found by person, not by row."""
    return checkpointed(with_link_keys(
        winners.filter(blank & F.col("year").isin(list(years))).select(*PERSON).distinct()))


def _fills(people: DataFrame, steps: Sequence[Stage]) -> DataFrame:
    """(person, value, label): the people who are found."""
    found = staged_lookup(people, steps, "value", "label").filter(F.col("value").isNotNull())
    return checkpointed(found.select(*PERSON, "value", "label"))


def middle_fills(winners: DataFrame, listed: DataFrame, inherited: DataFrame,
                 years: Sequence[int] = FILL_YEARS, self_year: int = SELF_YEAR) -> DataFrame:
    """(person, value, label). Cycles with a list look into that list, then the inherited file, of
    the same year; these look-ups do not feed each other, so the cycles run as one pass keyed by
    year. The cycle without a list matches itself to all other cycles, fills included."""
    people = blank_people(winners, ~names.has_middle("middle_name"), years)
    listed, inherited = stored_links(listed), stored_links(inherited)
    fills = _fills(people.filter(F.col("year") != self_year),
                   stages(listed, LIST, True, ["year"]) + stages(inherited, INHERITED, True, ["year"]))
    if self_year not in years:
        return fills
    known = winners.select(*PERSON, "middle_name"), fills.select(*PERSON, F.col("value").alias("middle_name"))
    others = listed.unionByName(inherited)
    for rows in known:  # one after the other: each plan folds all key parts
        others = others.unionByName(stored_links(winner_middles(rows.filter(F.col("year") != self_year))))
    return fills.unionByName(_fills(people.filter(F.col("year") == self_year), stages(others, SELF, False)))


@dataclass(frozen=True)
class Spans:
    """An index that grows: for each key and cycle the least and the greatest value. Two such tables
    merge by union, and a key is unambiguous where the two values of all cycles asked are equal."""

    keys: Sequence[str]
    rows: DataFrame

    @classmethod
    def of(cls, sources: DataFrame, keys: Sequence[str], year: Column | str = "year") -> Spans:
        rows = sources.dropna(subset=[*keys, "value"]).withColumn("cycle", F.col(year) if isinstance(year, str) else year)
        return cls(keys, rows.groupBy("cycle", *keys).agg(F.min("value").alias("low"), F.max("value").alias("high")))

    def merged(self, other: Spans) -> Spans:
        return Spans(self.keys, self.rows.unionByName(other.rows))

    def stored(self) -> Spans:
        return Spans(self.keys, checkpointed(self.rows))

    def but(self, cycle: int, wanted: DataFrame) -> DataFrame:
        """The unambiguous values over all cycles but one, for the wanted keys only. Rows without a
        cycle, those of lists, always count."""
        asked = self.rows.filter(F.col("cycle").isNull() | (F.col("cycle") != cycle)) \
            .join(growing(wanted.distinct()), list(self.keys), "left_semi")
        return asked.groupBy(*self.keys).agg(F.min("low").alias("value"), F.max("high").alias("__high")) \
            .filter(F.col("value") == F.col("__high")).drop("__high")


#: Keys of the two indexes over other cycles, and the columns that ask for them.
SPANS = {"person": (["city", "last", "given"], ["k_city", "k_last", "k_given"]),
         "governor": (["province", "position", "last", "given"], ["k_province", "position", "k_last", "k_given"])}


def sex_spans(sexes: DataFrame, year: Column | str = "year") -> dict[str, Spans]:
    governors = sexes.filter(_is("position", offices.GOVERNOR_OFFICES))
    return {"person": Spans.of(_city_rows(sexes), SPANS["person"][0], year),
            "governor": Spans.of(governors, SPANS["governor"][0], year)}


def sex_fills(winners: DataFrame, listed: DataFrame, given_sex: DataFrame,
              years: Sequence[int] = FILL_YEARS, list_years: Sequence[int] | None = None) -> DataFrame:
    """(person, value, label). Each cycle in turn: its own list, then the person in any other cycle,
    then the given name. Fills of one cycle feed the next: the index over all cycles is made once,
    and only what a cycle fills is added to it.

    ``listed``: linkage rows of sexes. ``given_sex``: given, sex.
    """
    people = blank_people(winners, none_if_blank("sex").isNull(), years)
    listed = stored_links(listed)
    always = sex_spans(listed, F.lit(None).cast("int"))
    index = {k: always[k].merged(s).stored() for k, s in sex_spans(stored_links(winner_sexes(winners))).items()}
    out = None
    for year in years:
        mine = people.filter(F.col("year") == year)
        steps = []
        if list_years is None or year in list_years:
            steps += stages(listed.filter(F.col("year") == year), LIST, True)
        for kind, held in (("person", offices.CITY_OFFICES), ("governor", offices.GOVERNOR_OFFICES)):
            keys, on = SPANS[kind]
            wanted = mine.filter(_is("position", held)).select(*[F.col(o).alias(k) for k, o in zip(keys, on)])
            steps.append(Stage(index[kind].but(year, wanted), keys, on, "value", SELF, _is("position", held), grows=True))
        steps.append(Stage(given_sex, ["given"], ["k_given"], "sex", GIVEN))
        fills = _fills(mine, steps)
        fresh = sex_spans(stored_links(winner_sexes(fills.withColumnRenamed("value", "sex"))))
        index = {k: s.merged(fresh[k]) for k, s in index.items()}
        out = fills if out is None else out.unionByName(fills)
    return out


def apply_fills(winners: DataFrame, fills: DataFrame, field: str, blank: Column) -> DataFrame:
    """Blank fields of the people found, with their source; ``__filled_<field>`` marks them."""
    found = attach(winners, growing(fills).withColumnsRenamed({"value": "__hit", "label": "__label"}), PERSON)
    return _fill(found, field, f"{field}_source", blank, F.lit(True)) \
        .withColumnRenamed("__filled", f"__filled_{field}")


def _filled(done: DataFrame, name: str, field: str) -> DataFrame:
    return _log(done.withColumn("__filled", F.col(f"__filled_{field}")), "winners", name, field, f"{field}_source")


def _with_full_names(winners: DataFrame) -> DataFrame:
    touched = F.col("middle_name_source").isin(LIST, INHERITED, SELF)
    full = names.canonical_full_name("last_name", "first_name", "middle_name")
    return winners.withColumn("full_name", F.when(touched, full).otherwise(F.col("full_name")))


def fill_winner_middles(winners: DataFrame, listed: DataFrame, inherited: DataFrame,
                        years: Sequence[int] = FILL_YEARS,
                        self_year: int = SELF_YEAR) -> tuple[DataFrame, DataFrame]:
    """(winners, log) with middle names filled, see ``middle_fills``. ``listed`` and ``inherited``:
    linkage rows of middle names."""
    fills = middle_fills(winners, listed, inherited, years, self_year)
    done = checkpointed(apply_fills(winners, fills, "middle_name", ~names.has_middle("middle_name")))
    return _with_full_names(done).drop("__filled_middle_name"), _filled(done, "Middle Name", "middle_name")


def fill_winner_sexes(winners: DataFrame, listed: DataFrame, given_sex: DataFrame,
                      years: Sequence[int] = FILL_YEARS,
                      list_years: Sequence[int] | None = None) -> tuple[DataFrame, DataFrame]:
    """(winners, log) with sexes filled, see ``sex_fills``."""
    fills = sex_fills(winners, listed, given_sex, years, list_years)
    done = checkpointed(apply_fills(winners, fills, "sex", none_if_blank("sex").isNull()))
    return done.drop("__filled_sex"), _filled(done, "Sex", "sex")


def backfill_winners(winners: DataFrame, listed_middles: DataFrame, inherited_middles: DataFrame,
                     listed_sexes: DataFrame, given_sex: DataFrame,
                     years: Sequence[int] = FILL_YEARS,
                     self_year: int = SELF_YEAR) -> tuple[DataFrame, DataFrame]:
    """Winners with middle names, sexes and one spelling for each title, and the log of fills. The
    fills are found first, and the winners are written once."""
    base = with_source_columns(winners)
    middles = middle_fills(base, listed_middles, inherited_middles, years, self_year)
    sexes = sex_fills(base, listed_sexes, given_sex, years)
    done = apply_fills(base, middles, "middle_name", ~names.has_middle("middle_name"))
    done = checkpointed(apply_fills(done, sexes, "sex", none_if_blank("sex").isNull()))
    log = _filled(done, "Middle Name", "middle_name").unionByName(_filled(done, "Sex", "sex"))
    return _with_full_names(done).withColumn("title", names.canonical_title("title")) \
        .drop("__filled_middle_name", "__filled_sex"), log


def coverage_report(before: DataFrame, log: DataFrame, field: str = "Middle Name",
                    column: str = "middle_name") -> DataFrame:
    """Blanks, fills and percentage for each cycle."""
    blanks = before.filter(~names.has_middle(column)).groupBy("year").agg(
        F.count(F.lit(1)).alias("blanks"))
    fills = log.filter(F.col("field") == field).groupBy("year").agg(
        F.count(F.lit(1)).alias("filled"))
    return blanks.join(fills, "year", "left").na.fill(0, ["filled"]).withColumn(
        "pct", F.bround(F.lit(100.0) * F.col("filled") / F.greatest("blanks", F.lit(1)), 0))


def race_winner_rows(counts: DataFrame, row_id: str,
                     elected: DataFrame | None = None) -> DataFrame:
    """``is_winner``: the top row of each race. Only it may use a winner's own record, so that a
    losing namesake never does. With ``elected`` the rows of that table are the winners instead."""
    race = ["year", "region", "province", "city", "district", "position"]
    if elected is None:
        return flag_top_row(counts, race, "votes", row_id, "is_winner")
    keys = ["year", "province", "position", "candidate_name"]
    won = elected.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct() \
        .withColumn("__won", F.lit(True))
    meet = [counts[k].eqNullSafe(F.col(f"__{k}")) for k in keys]
    return counts.join(won, meet, "left").withColumn(
        "is_winner", F.col("__won").isNotNull()).drop("__won", *[f"__{k}" for k in keys])


def _city_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(_is("position", offices.CITY_OFFICES) & (F.col("city") != ""))


def fill_vote_counts(counts: DataFrame, winners: DataFrame, listed_middles: DataFrame,
                     listed_sexes: DataFrame, given_sex: DataFrame,
                     years: Sequence[int] = FILL_YEARS) -> tuple[DataFrame, DataFrame]:
    """Vote counts with middle names and sexes carried over, and the log of fills.

    ``counts`` carries ``row_id``, unique and stable, and ``is_winner``.
    """
    # election, which middle names and sexes start from, is planned and run once
    winners = stored(winners.select(*PERSON, "middle_name", "sex"))
    middles, listed_middles = stored_links(winner_middles(winners)), stored_links(listed_middles)
    own = stored_index(_city_rows(middles), ["year", "city", "position", "last", "given"])
    index = stored_index(_city_rows(middles.unionByName(listed_middles)), ["city", "last", "given"])
    keyed = with_link_keys(counts)
    looked = staged_lookup(keyed, [
        Stage(own, ["year", "city", "position", "last", "given"],
              ["year", "k_city", "position", "k_last", "k_given"], "value", WINNER_MATCH,
              F.col("is_winner"), grows=True),
        Stage(index, ["city", "last", "given"], ["k_city", "k_last", "k_given"], "value",
              PERSON_INDEX, grows=True),
    ], "__hit", "__label").withColumn("__source", F.lit(None).cast("string"))
    target = F.col("year").isin(list(years)) & _is("position", offices.CITY_OFFICES)
    done = _fill(looked, "middle_name", "__source", ~names.has_middle("middle_name"), target)
    log = _log(done, "vote_counts", "middle_name", "middle_name", "__source")
    full = names.canonical_full_name("last_name", "first_name", "middle_name")
    done = done.withColumn("candidate_name", F.when(F.col("__filled"), full)
                           .otherwise(F.col("candidate_name"))).drop("__filled", "__source", *KEYS)
    return add_sexes(stored(done), winners, listed_sexes, given_sex), log


def add_sexes(counts: DataFrame, winners: DataFrame, listed: DataFrame,
              given_sex: DataFrame) -> DataFrame:
    """``sex`` and ``sex_source`` from the first of five tiers: the winner's own record, the
    person in the city, the person in the province, a given name learned from the winners, a given
    name of the static list."""
    sexes = stored_links(winner_sexes(winners))
    everyone = sexes.unionByName(stored_links(listed))
    own = stored_index(sexes.filter(F.col("city") != ""), ["year", "city", "position", "last", "given"])
    person = stored_index(everyone.filter(F.col("city") != ""), ["city", "last", "given"])
    province = stored_index(everyone, ["province", "last", "given"])
    learned = stored(learned_given_sexes(winners))
    keyed = with_link_keys(counts).withColumn(
        "k_extracted", names.extract_given("first_name", "middle_name"))
    return staged_lookup(keyed, [
        Stage(own, ["year", "city", "position", "last", "given"],
              ["year", "k_city", "position", "k_last", "k_given"], "value", WINNER_MATCH,
              F.col("is_winner"), grows=True),
        Stage(person, ["city", "last", "given"], ["k_city", "k_last", "k_given"], "value",
              PERSON_MATCH, F.col("k_city") != "", grows=True),
        Stage(province, ["province", "last", "given"], ["k_province", "k_last", "k_given"],
              "value", PERSON_MATCH, grows=True),
        Stage(learned, ["given"], ["k_extracted"], "sex", GIVEN_DERIVED, grows=True),
        Stage(given_sex, ["given"], ["k_given"], "sex", GIVEN),
    ], "sex", "sex_source").drop("k_extracted", *KEYS)


def learned_given_sexes(winners: DataFrame, min_count: int = 2,
                        min_share: float = 0.8) -> DataFrame:
    """given, sex: given names of several winners most of whom share one sex."""
    rows = winners.filter(none_if_blank("sex").isNotNull()).select(
        names.extract_given("first_name", "middle_name").alias("given"),
        F.trim("sex").alias("sex"))
    return linkage.majority_dictionary(rows, "given", "sex", min_count, min_share) \
        .select("given", "sex")
