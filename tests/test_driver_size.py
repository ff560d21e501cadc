"""Plans stay short: the driver keeps the text of every plan, with all tables that an expression carries."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from hustings.functions import names, text
from hustings.operators import identity
from hustings.plans import backfill, kin


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def people(spark):
    rows = [(2016 + 3 * (k % 3), "Cebu", "City of Cebu", "MAYOR", f"Año {k}", f"Éva-{k}", "Reyes" if k % 2 else "",
             "F" if k % 3 else "") for k in range(12)]
    return spark.createDataFrame(rows, "year int, province string, city string, position string, last_name string, "
                                       "first_name string, middle_name string, sex string")


def test_folding_brings_small_tables(spark):
    texts = ["ﬁ Ａé가 ①㎏", "나ß-ı", "각 x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert len(plan(df.select(text.fold("t").alias("f")))) < 12_000
    assert len(plan(df.select(names.extract_given("t", "t").alias("g")))) < 40_000
    assert [r[0] for r in df.select(text.fold("t")).collect()] == ["FI AE 1KG", "SS I", "X"]
    bare = ["".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)) for t in texts]
    assert [r[0] for r in df.select(text.strip_accents("t")).collect()] == bare


def test_indexes_start_from_stored_links(people, spark):
    given = spark.createDataFrame([("EVA", "F")], "given string, sex string")
    listed = backfill.winner_sexes(people, "list")
    sexed = backfill.add_sexes(people.drop("sex").withColumn("is_winner", F.lit(True)), people, listed, given)
    middles = backfill.winner_middles(people, "list")
    fills = backfill.middle_fills(people, middles, middles, (2016, 2019), 2022)
    for df, most in ((sexed, 400_000), (fills, 60_000)):
        assert len(plan(df)) < most
    assert backfill.stored_links(listed.unionByName(listed)).count() == listed.drop("source").distinct().count()


def test_what_grows_is_not_sent_out(people, spark):
    """Edges of rings, linked people and tokens of families meet by sorting and merging."""
    from hustings.operators import geometry, kinship
    edges = spark.createDataFrame([(1, k, k, 0, (k + 1) % 4, 0) for k in range(4)], "unit int, edge int, sx int, sy int, ex int, ey int")
    rings = geometry.stitch_rings(edges, ["unit"], "edge")
    assert sorted(r.pos for r in rings.collect()) == [0, 1, 2, 3]
    flagged = kinship.kin_flags(people, ["province"], "first_name", "year", "last_name", "middle_name")
    given = spark.createDataFrame([("EVA", "F")], "given string, sex string")
    sexed = backfill.add_sexes(people.drop("sex").withColumn("is_winner", F.lit(True)), people, backfill.winner_sexes(people, "x"), given)
    for df, joins in ((rings, 2), (flagged, 2), (sexed, 4)):
        physical = df._jdf.queryExecution().optimizedPlan().toString()
        assert physical.count("strategy=merge") >= joins


def largest(monkeypatch, *modules):
    """A list that gets the length of every plan that the modules store."""
    seen = []
    for m in modules:
        for name in ("stored", "checkpointed"):
            if hasattr(m, name):
                monkeypatch.setattr(m, name, lambda df, f=getattr(m, name): (seen.append(len(plan(df))), f(df))[1])
    return seen


def test_kin_plans_do_not_hold_each_other(spark, monkeypatch):
    seen = largest(monkeypatch, identity, kin)
    rows = [("MAYOR", "Dela Cruz", g, "REYES", f"{g} x", 2016 + 3 * k, "Cebu", "Cebu City") for k, g in enumerate(["Ana", "Anabel"])]
    winners = spark.createDataFrame(rows, "position string, last_name string, first_name string, middle_name string, "
                                          "full_name string, year int, province string, city string")
    units = spark.createDataFrame([("0702200000", "Cebu", "0700000000")], "code string, name string, region string")
    towns = spark.createDataFrame([("0702200000", "Cebu City", "0702217000")], "scope string, name string, code string")
    located = kin.located_winners(winners, units, towns)
    assert len(plan(located)) < 110_000
    flagged = kin.kin_table(located)
    # the two spellings are one person, so nobody is another one's kin
    assert {(r.level, r.person, r.all_fat, r.all_thin) for r in flagged.collect()} == {
        (level, "0700000000|DELA CRUZ|ANABEL", False, False) for level in kin.LEVELS}
    assert len(plan(flagged)) < 12_000 and max(seen) < 110_000


def test_void_columns_are_stored(spark):
    from hustings.session import stored
    df = spark.createDataFrame([(1,)], "a int").select(F.lit(None).alias("n"), "a")
    assert stored(df).columns == ["n", "a"] and [tuple(r) for r in stored(df).collect()] == [(None, 1)]


def test_middles_of_winners_and_fills_are_planned_apart(people, monkeypatch):
    seen = largest(monkeypatch, backfill)
    middles = backfill.winner_middles(people, "list")
    backfill.middle_fills(people, middles, middles, (2016, 2019, 2022), 2022)
    alone = len(plan(middles.drop("source").distinct()))
    assert max(seen) < 1.5 * alone


def test_counts_are_filled_from_stored_rows(people, spark, monkeypatch):
    given = spark.createDataFrame([("EVA", "F")], "given string, sex string")
    counts = people.drop("sex").withColumns({"row_id": F.monotonically_increasing_id(), "is_winner": F.lit(True),
                                             "candidate_name": F.col("last_name")})
    lists = backfill.winner_middles(people, "list"), backfill.winner_sexes(people, "list")
    filled, log = backfill.fill_vote_counts(counts, people, *lists, given, (2016, 2019, 2022))
    assert filled.count() == 12 and log.count() == len([r for r in filled.collect() if r.middle_name]) - 6
    assert len(plan(filled)) < 1.1 * len(plan(backfill.add_sexes(counts, people, lists[1], given)))
