"""Steps that once carried more than they need: rings, polygons and tallies, on rows of their own."""

from pyspark.sql import functions as F

from hustings.operators import geometry, tally


def test_ring_positions_come_with_the_ring(spark, monkeypatch):
    """One loop finds the ring and the place in it; its rows carry numbers, not units."""
    kept = []

    def noting(df, store=geometry.stored):
        kept.append(df.columns)
        return store(df)
    monkeypatch.setattr(geometry, "stored", noting)
    order = [5, 3, 8, 1, 9, 2, 7]  # a ring of seven, a chain of two that does not close, a loop
    rows = [("u", e, k, 0, (k + 1) % 7, 0) for k, e in enumerate(order)]
    rows += [("u", 20, 50, 0, 51, 0), ("u", 21, 51, 0, 52, 0), ("w", 1, 4, 4, 4, 4)]
    edges = spark.createDataFrame(rows, "unit string, edge long, sx int, sy int, ex int, ey int")
    got = {(r.unit, r.edge): (r.ring, r.pos, r.size) for r in geometry.stitch_rings(edges, ["unit"], "edge").collect()}
    want = {("u", e): (1, (k - 3) % 7, 7) for k, e in enumerate(order)}
    assert got == want | {("u", 20): (None, None, None), ("u", 21): (None, None, None), ("w", 1): (1, 0, 1)}
    rounds = [c for c in kept if "done" in c]
    assert 3 <= len(rounds) <= 5 and all("unit" not in c for c in rounds)


def test_polygons_are_put_together_from_stored_points(spark):
    corners = [(0, 0), (8, 0), (8, 8), (0, 8)]
    rows = [("u", ring, 0, k, float(x * f + d), float(y * f + d))
            for ring, f, d in ((1, 1, 0), (2, 0.5, 1), (3, 0.125, 2)) for k, (x, y) in enumerate(corners)]
    points = spark.createDataFrame(rows, "unit string, ring long, block long, line int, x double, y double")
    found = geometry.assemble_polygons(points, ["unit"], 2.0)
    assert {(r.ring, r.depth, r.is_hole, r.outer) for r in found.collect()} == {(1, 0, False, 1), (2, 1, True, 1), (3, 2, False, 3)}
    assert "lag(" not in found._jdf.queryExecution().optimizedPlan().toString()  # points before are looked for once


def test_tally_sorts_sums_not_rows(spark):
    rows = [("MAYOR", "P", "C", "a", None, 1, "R2"), ("MAYOR", "P", "C", "a", None, 2, "R1"), ("MAYOR", "P", "C", "a", None, None, None),
            ("GOVERNOR", "P", "C", "a", "x", 4, None), ("GOVERNOR", "P", "D", "a", "x", 8, None)]
    df = spark.createDataFrame(rows, "office string, province string, city string, name string, party string, votes int, region string")
    places = {"MAYOR": ["province", "city"], "GOVERNOR": ["province"]}
    got = tally.jurisdiction_tally(df, "office", places, ["name", "party"], "votes", ["region"])
    assert {(r.office, r.province, r.city, r.party, r.votes, r.region) for r in got.collect()} == {
        ("MAYOR", "P", "C", None, 3, "R1"), ("GOVERNOR", "P", None, "x", 12, None)}
    assert dict(got.dtypes)["votes"] == "bigint"
    first = got._jdf.queryExecution().sparkPlan().toString().splitlines()
    assert "HashAggregate" in [line for line in first if "Aggregate" in line][-1]
    wide = tally.jurisdiction_tally(df.withColumn("votes", F.col("votes").cast("decimal(9,2)")), "office", places, ["name", "party"], "votes", ["region"])
    assert dict(wide.dtypes)["votes"] == "decimal(19,2)"
