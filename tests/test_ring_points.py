"""Points of rings travel once for the points before them, and polygons store no second copy of their sides."""

from hustings.operators import geometry
from tests.test_outlines import ring_rows, square


def test_points_before_are_found_without_a_join(spark):
    rows = [("u", 1, i // 4, i % 4, i * 10, i if i % 3 else None) for i in range(11)] \
        + [("u", 2, 0, 0, 5, 5), (None, 3, 7, 0, 1, 2), (None, 3, 9, 0, 3, 4)]
    points = spark.createDataFrame(rows, "unit string, ring int, block int, line int, x int, y int")
    for close in (False, True):
        want = []
        for ring in (1, 2, 3):
            own = [r for r in rows if r[1] == ring]
            for k, r in enumerate(own):
                before = [own[k - 1][c] if k else None for c in (4, 5, 2, 3)]
                want.append((*r, *[own[-1][c] if close and b is None else b for b, c in zip(before, (4, 5, 2, 3))]))
        got = geometry.with_previous_point(points, ["unit", "ring"], close=close, place=True)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
        assert got.columns == [*points.columns, "px", "py", "pblock", "pline"]
        assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_polygons_store_points_once(spark, monkeypatch):
    kept = []

    def noting(df, store=geometry.stored):
        kept.append(df.columns)
        return store(df)
    monkeypatch.setattr(geometry, "stored", noting)
    rings = [square(0, 0, 100), square(10, 10, 50, True), square(20, 20, 30), [(5, 5), (6, 6), (7, 7)]]  # the last has no area
    rows = [r for k, ring in enumerate(rings) for r in ring_rows("A", k, ring)] + ring_rows(None, 9, square(0, 0, 5))
    points = spark.createDataFrame(rows, "unit string, ring int, block int, line int, x double, y double")
    got = {(r.unit, r.ring): (r.depth, r.is_hole, r.outer) for r in geometry.assemble_polygons(points, ["unit"], 16.0).collect()}
    assert got == {("A", 0): (0, False, 0), ("A", 1): (1, True, 0), ("A", 2): (2, False, 2), (None, 9): (0, False, 9)}
    assert sum("px" in c or "x0" in c for c in kept) == 1
