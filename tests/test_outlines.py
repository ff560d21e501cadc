"""Point in ring by cells, polygons put together, against brute force; one unit holds most rows."""

import math
import random

from pyspark.sql import functions as F

from hustings.operators import geometry


def star(rng, cx, cy, size, n, whole):
    """A ring around a centre, its corners on the grid or anywhere."""
    turns = sorted(rng.random() * 2 * math.pi for _ in range(n))
    out = [(cx + size * rng.uniform(0.3, 1) * math.cos(t), cy + size * rng.uniform(0.3, 1) * math.sin(t)) for t in turns]
    return [(float(round(x)), float(round(y))) for x, y in out] if whole else out


def inside(point, ring):
    x, y = point
    odd = False
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1]):
        if (y0 > y) != (y1 > y) and x < (x1 - x0) * (y - y0) / (y1 - y0) + x0:
            odd = not odd
    return odd


def edges_of(spark, rings):
    rows = [(u, r, *p, *q) for u, r, ring in rings for p, q in zip(ring, ring[1:] + ring[:1])]
    return spark.createDataFrame(rows, "unit int, ring int, x0 double, y0 double, x1 double, y1 double")


def test_points_in_rings(spark):
    rng = random.Random(4)
    rings = [(0 if rng.random() < 0.9 else 1, k, star(rng, rng.uniform(-40, 40), rng.uniform(-40, 40), rng.choice([2, 8, 30]),
                                                      rng.randint(3, 12), k % 2 == 0)) for k in range(120)]
    points = [(0 if rng.random() < 0.9 else 1, k, rng.uniform(-60, 60), rng.uniform(-60, 60)) for k in range(300)]
    # on grid lines and cell corners, but on no edge: the rings' corners are whole numbers
    points += [(0, 1000 + k, float(5 * rng.randint(-10, 10)) + rng.choice([0, 1e-4]), 5 * rng.randint(-10, 10) + 0.5) for k in range(100)]
    holes = spark.createDataFrame(points, "unit int, hole int, x double, y double")
    want = {(u, h, r) for u, h, x, y in points for v, r, ring in rings if u == v and inside((x, y), ring)}
    edges = edges_of(spark, rings)
    for cell in (5.0, 1.7, 200.0):
        got = {(r.unit, r.hole, r.ring) for r in geometry.rings_around(holes, edges, ["unit"], cell).collect()}
        assert got == want, cell
    least = {(r.unit, r.hole): r.ring for r in geometry.containing_rings(holes, edges, ["unit"], 5.0).collect()}
    assert least == {(u, h): min(r for v, i, r in want if (v, i) == (u, h)) for u, h, _ in want}


def test_a_point_meets_the_edges_of_its_cell_only(spark):
    """A ring of 4,000 edges in one row of the plane, and points along that row."""
    n = 2000
    low = [(float(k), 0.0) for k in range(n)]
    high = [(float(k) + 0.5, 9.0 - (k % 2)) for k in reversed(range(n))]
    edges = edges_of(spark, [(0, 1, low + high)])
    holes = spark.createDataFrame([(0, k, 20 * k + 0.25, 4.0) for k in range(100)], "unit int, hole int, x double, y double")
    met = geometry.rings_around(holes, edges, ["unit"], 10.0, met=True).groupBy("hole").count().agg(F.max("count")).first()[0]
    assert met <= 30
    assert geometry.rings_around(holes, edges, ["unit"], 10.0).count() == 100


def ring_rows(unit, ring, corners):
    return [(unit, ring, 0, k, float(x), float(y)) for k, (x, y) in enumerate(corners)]


def square(x, y, size, turned=False):
    out = [(x, y), (x + size, y), (x + size, y + size), (x, y + size)]
    return out[::-1] if turned else out


def test_polygons_with_holes_within_islands_within_holes(spark):
    shapes = {1: square(0, 0, 100), 2: square(10, 10, 50, True), 3: square(20, 20, 30), 4: square(25, 25, 10), 5: square(70, 70, 20),
              6: square(60, 10, 20, True),  # touches ring 2 at its side
              7: [(100, 100), (120, 100), (120, 120), (100, 120)],  # touches ring 1 at a corner
              8: [(200, 0), (260, 0), (260, 60), (200, 60), (200, 50), (250, 50), (250, 10), (200, 10)],  # a bracket
              9: square(210, 20, 20),  # between its arms, not inside
              10: [(252, 20), (258, 20), (255, 30)], 11: [(5, 5), (6, 6), (7, 7)]}  # 11 has no area
    rows = [r for k, ring in shapes.items() for r in ring_rows("A", k, ring)] + ring_rows("B", 1, square(30, 30, 5))
    points = spark.createDataFrame(rows, "unit string, ring int, block int, line int, x double, y double")
    for cell in (7.0, 64.0):
        got = {(r.unit, r.ring): (r.depth, r.is_hole, r.outer) for r in geometry.assemble_polygons(points, ["unit"], cell).collect()}
        assert got == {("A", 1): (0, False, 1), ("A", 2): (1, True, 1), ("A", 3): (2, False, 3), ("A", 4): (3, True, 3), ("A", 5): (1, True, 1),
                       ("A", 6): (1, True, 1), ("A", 7): (0, False, 7), ("A", 8): (0, False, 8), ("A", 9): (0, False, 9),
                       ("A", 10): (1, True, 8), ("B", 1): (0, False, 1)}, cell


def test_inner_points_are_inside(spark):
    rng = random.Random(9)
    rings = [star(rng, 0, 0, 10, rng.randint(3, 20), False) for _ in range(150)]
    rows = [r for k, ring in enumerate(rings) for r in ring_rows("A", k, ring)]
    points = spark.createDataFrame(rows, "unit string, ring int, block int, line int, x double, y double")
    got = {r.ring: (r.x, r.y) for r in geometry.inner_points(points, ["unit", "ring"]).collect()}
    assert len(got) == 150 and all(inside(got[k], ring) for k, ring in enumerate(rings))
    assert geometry.assemble_polygons(points.limit(0), ["unit"], 5.0).count() == 0
