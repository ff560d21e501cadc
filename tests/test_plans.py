"""The pipeline on hand-written rows: every rule meets a null, a tie, a duplicate or an ambiguity."""

import pytest
from pyspark.sql import functions as F

from hustings.operators.reshape import drop_and_count, require_known
from hustings.plans import audits, backfill, explore, kin, place_results, vote_counts, winners
from hustings.session import checkpointed
from hustings.sources.ballots import BALLOT_COLUMNS

RAW = ", ".join(f"{c} string" for c in BALLOT_COLUMNS) + ", year int"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def ballots(spark):
    base = [
        # two localities of one province: a governor is elected by their sum
        ("Region IV-A", "Compostela Valley", "City of Nabunturan", "PROVINCIAL GOVERNOR COMPOSTELA VALLEY", "1", "CRUZ, ATTY.JUAN (LP)", "Liberal Party", "60", "60 %"),
        ("Region IV-A", "DAVAO DE ORO", "Monkayo", "GOVERNOR of DAVAO DE ORO", "2", "CRUZ, ATTY. JUAN", "LP", "10", "10 %"),
        ("Region IV-A", "DAVAO DE ORO", "Monkayo", "GOVERNOR of DAVAO DE ORO", "1", "REY, ANA", "NP", "65", "-"),
        # a tie for the only seat
        ("CAR", "ABRA", "BANGUED", "MAYOR of ABRA - BANGUED", "2", "LIM, BO", "IND", "5", "50 %"),
        ("CAR", "ABRA", "BANGUED", "MAYOR of ABRA - BANGUED", "1", "TAN, CY(PFP", None, "5", "50 %"),
        # an exact duplicate row
        ("CAR", "ABRA", "BANGUED", "VICE-MAYOR ABRA - BANGUED", "1", "GO, DY", "NP", "7", "70 %"),
        ("CAR", "ABRA", "BANGUED", "VICE-MAYOR ABRA - BANGUED", "1", "GO, DY", "NP", "7", "70 %"),
        # board members by district
        *[("CAR", "ABRA", "BANGUED", f"PROVINCIAL BOARD MEMBER of ABRA - {d} PROVDIST", "1", f"B{d}{i}, X", "NP", str(i), "1 %")
          for d in ("FIRST", "SECOND") for i in range(1, 5)],
        # nationwide: absentee rows count, places or not
        ("CAR", "ABRA", "BANGUED", "SENATOR of PHILIPPINES", "1", "SY, E", "LP", "3", "1 %"),
        ("LAV", "LAV", "LAV", "SENATOR of PHILIPPINES", "1", "SY, E", "LP", "4", "1 %"),
        ("OAV", "EUROPE", "ITALY", "SENATOR of PHILIPPINES", "1", "UY, F", None, "5", "1 %"),
        ("LAV", "LAV", "LAV", "PARTY LIST of PHILIPPINES", "100 H.E.L.P", "81 BAYAN MUNA", "GROUP", "2", "1 %"),
    ]
    return spark.createDataFrame([(*r, 2022) for r in base], RAW)


def test_vote_counts(spark):
    out = vote_counts.build_vote_counts([ballots(spark)])
    assert out.columns == vote_counts.VOTE_COUNT_COLUMNS
    assert out.count() == ballots(spark).count() - 1
    r = out.filter("raw_position like 'PROVINCIAL GOV%'").first()
    assert (r.province, r.city, r.position, r.candidate_name, r.title, r.party, r.votes, r.percentage, r["rank"]) == (
        "DAVAO DE ORO", "NABUNTURAN", "GOVERNOR", "CRUZ, JUAN", "ATTY.", "LP", 60, 60.0, 1)
    assert out.filter("last_name = 'TAN'").first().party == "PFP"
    org = out.filter("position = 'PARTY LIST'").first()
    assert (org.candidate_name, org.last_name, org.party, org.reported_party, org["rank"]) == ("BAYAN MUNA", None, None, "GROUP", None)
    assert {r.province for r in out.filter("not is_geographic").collect()} == {"LAV", "EUROPE"}
    bad = spark.createDataFrame([("R", "P", "C", "DOGCATCHER", None, "A", "B", "1", None, 2022)], RAW)
    with pytest.raises(ValueError, match="DOGCATCHER"):
        vote_counts.build_vote_counts([ballots(spark), bad])
    assert require_known(out, "position", "raw_position").count() == out.count()


def test_unknown_values_are_named_in_one_pass(spark):
    """Nine rows of ten share one unknown value; more values are unknown than are named."""
    rows = spark.createDataFrame([(None, "x") for _ in range(900)] + [(None, f"u{k}") for k in range(40)] + [(1, "known")] * 60 + [(None, None)],
                                 "known int, raw string")
    with pytest.raises(ValueError, match=r"unrecognised raw: \['x', .* and about \d+ more") as error:
        require_known(rows, "known", "raw")
    assert str(error.value).count("'") == 2 * 20 and "known'" not in str(error.value)
    with pytest.raises(ValueError, match=r"unrecognised raw: \['\(null\)'\]$"):
        require_known(rows.filter("raw is null or raw = 'known'"), "known", "raw")
    kept, removed = drop_and_count(rows)
    assert (kept.count(), removed) == (43, 958)


def test_winners(spark):
    counts = checkpointed(vote_counts.build_vote_counts([ballots(spark)]))
    held = spark.createDataFrame([(2019, "ABRA", "PROVINCIAL BOARD MEMBER")] * 5, "year int, province string, position string")
    seats = winners.board_seats(counts, held)
    assert rows_of(seats.select("province", "seats")) == [("ABRA", 2)]
    won = winners.winners_from_ballots(counts, seats)
    got = {(r.position, r.province, r.district, r.candidate_name, r.votes, r.tie_at_cutoff) for r in won.collect()}
    assert ("GOVERNOR", "DAVAO DE ORO", None, "CRUZ, JUAN", 70, False) in got
    assert ("MAYOR", "ABRA", None, "LIM, BO", 5, True) in got and ("SENATOR", None, None, "SY, E", 7, False) in got
    assert {c for p, _, d, c, *_ in got if d == "FIRST"} == {"BFIRST4, X", "BFIRST3, X"}
    assert {r.candidate_name for r in winners.national_winners(counts, keep_null=False).collect()} == {"SY, E"}
    assert "PARTY LIST" not in {g[0] for g in got}


def test_merge(spark):
    counts = checkpointed(vote_counts.build_vote_counts([ballots(spark)]))
    fresh = winners.local_winners(counts, spark.createDataFrame([], "year int, province string, seats int"))
    old = spark.createDataFrame([
        (2004, "DATU ALI M LIM", "MAYOR", "LAKAS CMD", "ABRA", "CAR", 1.0), (2004, "DATU ALI M LIM", "MAYOR", "LAKAS CMD", "ABRA", "CAR", 1.0),
        (2004, "A. UY", "MAYOR", "NP", "BOHOL", None, 1.0), (2022, "OLD ONE", "MAYOR", "NP", "ABRA", "CAR", 1.0), (2001, "EVA DY", "MAYOR", "NP", "ABRA", None, 2.0),
    ], "year int, full_name string, position string, party string, province string, region string, Community double")
    by_key = spark.createDataFrame([(2004, "MAYOR", "LIM", "ALI", "M")], "year int, position string, last string, given string, sex string")
    by_given = spark.createDataFrame([("EVA", "F"), ("ALVIN", "M")], "given string, sex string")
    out = winners.merge_winners(old, [fresh], [2022], by_key, by_given)
    got = {(r.year, r.full_name): r for r in out.collect()}
    assert (2022, "ONE, OLD") not in got and out.filter("year = 2004 and last_name = 'LIM'").count() == 1
    lim = got[(2004, "LIM, ALI M")]
    assert (lim.title, lim.party, lim.sex, lim.region) == ("DATU", "LAKAS-CMD", "M", "CORDILLERA ADMINISTRATIVE REGION")
    uy = got[(2004, "UY, ALVIN JAYAG")]
    assert (uy.first_name, uy.middle_name, uy.sex, uy.region) == ("ALVIN", "JAYAG", "M", None)
    eva = got[(2001, "DY, EVA")]
    assert (eva.sex or "", eva.region) == ("", "CORDILLERA ADMINISTRATIVE REGION")


WIN = "year int, province string, city string, position string, last_name string, first_name string, middle_name string, title string, full_name string, sex string"


def people(spark):
    def p(year, city, position, last, first, middle="", sex=""):
        return (year, "ABRA", city, position, last, first, middle, "atty", f"{last}, {first}", sex)
    return spark.createDataFrame([
        p(2016, "X", "MAYOR", "CRUZ", "JUAN"), p(2016, "X", "COUNCILOR", "REY", "NICK"), p(2016, "Y", "COUNCILOR", "LIM", "BO"),
        p(2016, None, "GOVERNOR", "TAN", "CY"), p(2016, "X", "COUNCILOR", "SY", "EVA", "KEPT", "F"),
        p(2019, "X", "MAYOR", "CRUZ", "JUAN"), p(2025, "X", "MAYOR", "CRUZ", "JUAN"), p(2025, "X", "COUNCILOR", "REY", "MARIA"),
    ], WIN)


LINK = "year int, province string, city string, position string, last string, given string, value string, source string"


def test_backfill(spark):
    listed = spark.createDataFrame([
        (2016, "ABRA", "X", "MAYOR", "CRUZ", "JUAN", "DIAZ", "l"), (2016, "ABRA", "X", "COUNCILOR", "REY", "NICOLAS", "GO", "l"),
        (2016, "ABRA", "Y", "COUNCILOR", "LIM", "BO", "A1", "l"), (2016, "ABRA", "Y", "COUNCILOR", "LIM", "BO", "A2", "l"),
        (2016, "ABRA", "X", "COUNCILOR", "SY", "EVA", "OTHER", "l")], LINK)
    inherited = spark.createDataFrame([(2016, "ABRA", "", "GOVERNOR", "TAN", "CY", "UY", "v")], LINK)
    sexes = spark.createDataFrame([(2016, "ABRA", "X", "MAYOR", "CRUZ", "JUAN", "M", "l")], LINK)
    givens = spark.createDataFrame([("MARIA", "F")], "given string, sex string")
    out, log = backfill.backfill_winners(people(spark), listed, inherited, sexes, givens)
    got = {(r.year, r.last_name, r.first_name): (r.middle_name, r.middle_name_source, r.sex, r.sex_source) for r in out.collect()}
    assert got == {
        (2016, "CRUZ", "JUAN"): ("DIAZ", "comelec_lec", "M", "comelec_lec"), (2016, "REY", "NICK"): ("GO", "comelec_lec", "", ""),
        (2016, "LIM", "BO"): ("", "", "", ""), (2016, "TAN", "CY"): ("UY", "v8.5", "", ""),
        (2016, "SY", "EVA"): ("KEPT", "original", "F", "prior"), (2019, "CRUZ", "JUAN"): ("", "", "M", "self-prior"),
        (2025, "CRUZ", "JUAN"): ("DIAZ", "self-prior", "M", "self-prior"), (2025, "REY", "MARIA"): ("", "", "F", "given-name")}
    assert {r.title for r in out.collect()} == {"ATTY."}
    assert out.filter("full_name = 'CRUZ, JUAN DIAZ'").count() == 2
    assert log.count() == 4 + 4 and log.columns == backfill.AUDIT_COLUMNS
    again, more = backfill.backfill_winners(out, listed, inherited, sexes, givens)
    assert more.count() == 0 and rows_of(again.select(out.columns)) == rows_of(out)
    report = {r.year: (r.blanks, r.filled) for r in backfill.coverage_report(people(spark), log).collect()}
    assert report == {2016: (4, 3), 2019: (1, 0), 2025: (2, 1)}


def test_vote_count_backfill(spark):
    won = people(spark).withColumn("middle_name", F.when((F.col("last_name") == "CRUZ") & (F.col("year") == 2016), "DIAZ").otherwise("")) \
        .withColumn("sex", F.when(F.col("last_name") == "CRUZ", "M").otherwise(""))
    schema = "row_id int, year int, region string, province string, city string, district string, position string, candidate_name string, last_name string, first_name string, middle_name string, votes bigint"
    counts = spark.createDataFrame([
        (1, 2016, "CAR", "ABRA", "X", None, "MAYOR", "CRUZ, JUAN", "CRUZ", "JUAN", None, 9), (2, 2016, "CAR", "ABRA", "X", None, "MAYOR", "CRUZ, J", "CRUZ", "J", None, 9),
        (3, 2016, "CAR", "ABRA", "X", None, "MAYOR", "DY, ZED", "DY", "ZED", None, None), (4, 2019, "CAR", "ABRA", "X", None, "MAYOR", "CRUZ, JUAN", "CRUZ", "JUAN", "KEPT", 1),
        (5, 2013, "CAR", "ABRA", "X", None, "MAYOR", "CRUZ, JUAN", "CRUZ", "JUAN", None, 1)], schema)
    empty = spark.createDataFrame([], LINK)
    givens = spark.createDataFrame([("ZED", "M")], "given string, sex string")
    out, log = backfill.fill_vote_counts(backfill.race_winner_rows(counts, "row_id"), won, empty, empty, givens)
    got = {r.row_id: (r.is_winner, r.candidate_name, r.middle_name, r.sex, r.sex_source) for r in out.collect()}
    assert got == {1: (True, "CRUZ, JUAN DIAZ", "DIAZ", "M", "winner-match"), 2: (False, "CRUZ, J", None, None, None),
                   3: (False, "DY, ZED", None, "M", "given-name"), 4: (True, "CRUZ, JUAN", "KEPT", "M", "winner-match"),
                   5: (True, "CRUZ, JUAN", None, "M", "person-match")}
    assert rows_of(log.select("value_filled", "source")) == [("DIAZ", "winner-match")]


def test_places_and_kin(spark):
    counts = checkpointed(vote_counts.build_vote_counts([ballots(spark)]))
    total = spark.createDataFrame([("R", "ABRA", "", "GOVERNOR of ABRA", None, "OO, P", "NP", "40", None, 2013)], RAW)
    counts = checkpointed(counts.unionByName(vote_counts.build_vote_counts([total])))
    provinces = spark.createDataFrame([("p1", "Abra", "r1"), ("p2", "Davao de Oro", "r2")], "code string, name string, region string")
    towns = spark.createDataFrame([("p1", "Bangued", "t1"), ("p2", "Nabunturan", "t2"), ("p2", "Monkayoo", "t3"), ("p1", "Empty", "t4")], "scope string, name string, code string")
    out = place_results.place_results(counts, provinces, towns, listed={}, spellings=(), cutoff=0.85)
    solved = {(r.province, r.city): (r.code, r.how) for r in out["crosswalk"].collect()}
    assert solved[("DAVAO DE ORO", "MONKAYO")] == ("t3", "near") and solved[("ABRA", "BANGUED")] == ("t1", "exact")
    cells = {(r.year, r.position, r.code): r.total for r in out["cells"].collect()}
    assert cells[(2022, "GOVERNOR", "t3")] == 75 and cells[(2022, "MAYOR", "t1")] == 10
    prov = {(r.year, r.position, r.prov): r.total for r in out["province_cells"].collect()}
    assert prov[(2022, "GOVERNOR", "p2")] == 135 and prov[(2013, "GOVERNOR", "p1")] == 40 and (2022, "MAYOR", "p1") not in prov
    assert [r.code for r in out["no_result"].collect()] == ["t4"]

    people_rows = [(2016, "ABRA", "Bangued", "MAYOR", "CRUZ", "GWEN", ""), (2019, "ABRA", "Bangued", "MAYOR", "CRUZ", "GWENDOLYN", ""),
                   (2019, "ABRA", "Bangued", "COUNCILOR", "CRUZ", "BO", ""), (2019, "ABRA", "Bangued", "COUNCILOR", "LIM", "CY", "CRUZ"),
                   (2019, "ABRA", None, "GOVERNOR", "TAN", "DY", ""), (2019, None, None, "SENATOR", "CRUZ", "EL", "")]
    df = spark.createDataFrame(people_rows, "year int, province string, city string, position string, last_name string, first_name string, middle_name string") \
        .withColumn("full_name", F.concat_ws(", ", "last_name", "first_name"))
    flagged = checkpointed(kin.kin_table(checkpointed(kin.located_winners(df, provinces, towns)), ()))
    rates, clans = kin.kin_report(flagged)
    r = rates.filter("level = 'municipality' and year = 2019").first()
    assert (r.total, r.last_both, r.last_fat, r.last_thin, r.middle_both, r.middle_fat, r.all_both) == (3, 2, 2, 1, 3, 3, 3)
    c = clans.filter("level = 'province'").first()
    assert (c.surname, c.people, c.seats, c.fat, c.thin, [m.name for m in c.members]) == ("CRUZ", 2, 3, True, True, ["CRUZ, GWENDOLYN", "CRUZ, BO"])


def test_explore_and_audits(spark):
    counts = checkpointed(vote_counts.build_vote_counts([ballots(spark)]))
    seats = spark.createDataFrame([], "year int, province string, seats int")
    won = checkpointed(winners.winners_from_ballots(counts, seats))
    table = checkpointed(winners.to_winners_schema(won))
    rows = checkpointed(explore.explore_rows(table, won, counts))
    got = {(r.position, r.full_name): (r.province, r.votes) for r in rows.collect()}
    assert got[("Senator", "SY, E")] == ("Nationwide", 7) and got[("Governor", "CRUZ, JUAN")] == ("DAVAO DE ORO", 70)
    assert ("Senator", "UY, F") not in got
    coded, dictionary = explore.explore_table(rows)
    assert coded.count() == rows.count() and dictionary.filter("column = 'position' and value = 'Governor'").first().code == 0
    found = audits.audit_winners(table.unionByName(table.filter("position = 'MAYOR'")), {"GOVERNOR": 1, "MAYOR": 5})
    kinds = {r.issue for r in found.collect()}
    assert {"unrecognised position", "duplicate rows", "implausible MAYOR count", "same person listed twice for one seat"} <= kinds
    assert "implausible GOVERNOR count" not in kinds
    cover = audits.file_coverage(ballots(spark), F.col("region"), F.col("province"), F.col("city"))
    kinds = {(r.issue, r.scope) for r in audits.audit_vote_counts(counts, cover, [2022]).collect()}
    assert ("capital absent", "2022") in kinds and ("non-geographic tally category", "LAV") in kinds
    assert {r.scope for r in audits.audit_files(cover).collect()} == set()
    other = table.withColumn("last_name", F.when(F.col("position") == "MAYOR", "NOBODY").otherwise(F.col("last_name")))
    kinds = {(r.issue, r.scope) for r in audits.audit_alignment(other, counts, [2022], [2019, 2022]).collect()}
    assert kinds == {("winners disagree with the ballots", "2022"), ("no vote counts for this cycle", "2019")}


def test_files_that_cannot_be_read_are_findings(spark):
    from hustings.plans import audits
    cover = spark.createDataFrame([(2016, "CAR", "ABRA", "X", "f", 3, 1, 9)], "year int, region string, province string, municipality string, "
                                  "file string, rows long, positions long, total_votes long")
    bad = spark.createDataFrame([("g", "not JSON")], "file string, reason string")
    got = {(r.issue, r.scope) for r in audits.audit_files(cover, unreadable=bad, years=[2016, 2019]).collect()}
    assert got == {("unreadable file", "g"), ("no raw files", "2019")}


def test_rows_without_a_name_match_nobody(spark):
    from hustings.plans import backfill
    schema = "year int, province string, city string, position string, last_name string, first_name string, middle_name string, sex string, is_winner boolean"
    winners = spark.createDataFrame([(2016, "ABRA", "X", "MAYOR", None, None, None, "M", True)], schema)
    counts = spark.createDataFrame([(2016, "ABRA", "X", "PARTY LIST", None, None, None, None, False)], schema).drop("sex")
    none = backfill.winner_sexes(winners).filter("false")
    givens = spark.createDataFrame([], "given string, sex string")
    assert [r.sex for r in backfill.add_sexes(counts, winners, none, givens).collect()] == [None]


def test_fills_are_found_once_for_each_person(spark):
    """Nine rows of ten are one person; the cycles after the first find what it filled."""
    schema = ("year int, province string, city string, position string, last_name string, first_name string, middle_name string, "
              "sex string, title string, full_name string")
    hot = [(2016, "ABRA", "BANGUED", "MAYOR", "CRUZ", "ANA", "", "", "", "CRUZ, ANA")] * 900
    later = [(y, "ABRA", "BANGUED", "MAYOR", "CRUZ", "ANA", "", "", "", "CRUZ, ANA") for y in (2019, 2022)] * 20
    odd = [(2019, "ABRA", "BANGUED", "MAYOR", f"LIM{k}", "BO", "", "", "", f"LIM{k}, BO") for k in range(50)]
    people = spark.createDataFrame(hot + later + odd, schema)
    listed = backfill.winner_sexes(spark.createDataFrame([(2016, "ABRA", "BANGUED", "MAYOR", "CRUZ", "ANA", "", "F", "", "")], schema), "list")
    given = spark.createDataFrame([("BO", "M")], "given string, sex string")
    fills = backfill.sex_fills(backfill.with_source_columns(people), listed, given)
    assert fills.count() == 53
    out, log = backfill.fill_winner_sexes(backfill.with_source_columns(people), listed, given)
    got = {(r.year, r.last_name[:3], r.sex, r.sex_source): r["count"] for r in out.groupBy(
        "year", F.substring("last_name", 1, 3).alias("last_name"), "sex", "sex_source").count().collect()}
    assert got == {(2016, "CRU", "F", "comelec_lec"): 900, (2019, "CRU", "F", "self-prior"): 20, (2022, "CRU", "F", "self-prior"): 20,
                   (2019, "LIM", "M", "given-name"): 50}
    assert log.count() == 990
