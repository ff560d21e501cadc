"""Outlines over whole tables: orders of a customer as a ring, parts as cells of a grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from hustings.catalog.registry import query
from hustings.operators import geometry

RING = """
  SELECT c_nationkey AS unit, o_custkey AS ring, CAST(floor(o_orderkey / 1000) AS bigint) AS block, o_orderkey AS line,
    CAST(datediff(o_orderdate, TIMESTAMP '1995-01-01') AS bigint) AS x, CAST(floor(o_totalprice / 50000) AS bigint) AS y
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""
RING_SQL = """
  p AS (SELECT c_nationkey AS unit, o_custkey AS ring, CAST(floor(o_orderkey / 1000) AS bigint) AS block, o_orderkey AS line,
    CAST(date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) AS bigint) AS x, CAST(floor(o_totalprice / 50000) AS bigint) AS y
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
KEYS = ["unit", "ring"]


def ring_points(t):
    return t.sql(RING, "orders", "customer")


AREAS_SQL = f"""{RING_SQL},
  q AS (SELECT *, coalesce(lag(x) OVER w, last_value(x) OVER f) AS px, coalesce(lag(y) OVER w, last_value(y) OVER f) AS py FROM p
    WINDOW w AS (PARTITION BY ring ORDER BY line), f AS (PARTITION BY ring ORDER BY line
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
  a AS (SELECT unit, ring, sum(px * y - x * py) / 2 AS area FROM q GROUP BY 1, 2)"""


@query("ring_areas", f"WITH {AREAS_SQL} SELECT * FROM a")
def ring_areas(t):
    return geometry.ring_areas(ring_points(t), KEYS)


@query("outer_rings", f"""WITH {AREAS_SQL}
  SELECT unit, ring, area, CASE WHEN max(area) OVER (PARTITION BY unit) > 0 THEN area > 0 ELSE true END AS is_outer FROM a""")
def outer_rings(t):
    return geometry.outer_and_holes(geometry.ring_areas(ring_points(t), KEYS), ["unit"])


@query("quantised_points", f"""WITH {RING_SQL}
  SELECT ring, line, CAST(round_even((x - min(x) OVER ()) / ((max(x) OVER () - min(x) OVER ()) / 99.0), 0) AS bigint) AS x,
    CAST(round_even((y - min(y) OVER ()) / ((max(y) OVER () - min(y) OVER ()) / 99.0), 0) AS bigint) AS y FROM p""")
def quantised(t):
    return geometry.quantise(ring_points(t), 100).select("ring", "line", "x", "y")


@query("quantised_by_unit", f"""WITH {RING_SQL}
  SELECT ring, line, CAST(round_even((x - min(x) OVER w) / ((max(x) OVER w - min(x) OVER w) / 99.0), 0) AS bigint) AS x,
    CAST(round_even((y - min(y) OVER w) / ((max(y) OVER w - min(y) OVER w) / 99.0), 0) AS bigint) AS y FROM p
  WINDOW w AS (PARTITION BY unit)""")
def quantised_by_unit(t):
    return geometry.quantise(ring_points(t), 100, ["unit"]).select("ring", "line", "x", "y")


@query("delta_points", f"""WITH {RING_SQL},
  q AS (SELECT ring, line, line // 3 % 5 AS x, y // 9 AS y FROM p),
  r AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM q WINDOW w AS (PARTITION BY ring ORDER BY line)),
  k AS (SELECT * FROM r WHERE py IS NULL OR y <> py OR x <> px)
  SELECT ring, line, y, CAST(x - coalesce(lag(x) OVER w, 0) AS bigint) AS dx, y - coalesce(lag(y) OVER w, 0) AS dy FROM k
  WINDOW w AS (PARTITION BY ring ORDER BY line)""")
def delta_points(t):
    flat = ring_points(t).withColumns({"x": (F.floor(F.col("line") / 3) % 5).cast("bigint"), "y": F.floor(F.col("y") / 9)})
    return geometry.delta_encode(geometry.drop_repeats(flat, KEYS), KEYS).select(
        "ring", "line", "y", "dx", "dy")


@query("shape_quality", f"""WITH {RING_SQL}, n AS (SELECT unit, ring, count(DISTINCT (x // 400, y // 4)) AS k FROM p GROUP BY 1, 2)
  SELECT unit, count(*) AS rings, count(*) FILTER (k >= 3) AS solid, count(*) FILTER (k >= 3) = 0 AS degenerate FROM n GROUP BY 1""")
def shape_quality(t):
    coarse = ring_points(t).withColumns({"x": F.floor(F.col("x") / 400), "y": F.floor(F.col("y") / 4)})
    return geometry.shape_quality(coarse, ["unit"], ["ring"])


@query("recovered_shapes", f"""WITH {RING_SQL}
  SELECT ring, line, CASE WHEN unit < 8 THEN x ELSE 0 END AS x FROM p""")
def recovered_shapes(t):
    points = ring_points(t)
    quality = points.select("unit").distinct().withColumn("degenerate", F.col("unit") < 8)
    coarse = points.withColumn("x", F.lit(0).cast("bigint"))
    return geometry.recover_shapes(coarse, points, quality, ["unit"]).select("ring", "line", "x")


@query("edge_use", """
  SELECT l_suppkey, l_partkey, count(*) AS uses FROM lineitem GROUP BY 1, 2""")
def edge_use(t):
    return geometry.edge_use(t.lineitem, ["l_suppkey"], "l_partkey")


@query("boundary_edges", """
  SELECT l_suppkey, l_partkey, min(l_orderkey) AS l_orderkey FROM lineitem GROUP BY 1, 2 HAVING count(*) = 1""")
def boundary_edges(t):
    return geometry.boundary_edges(t.lineitem, ["l_suppkey"], "l_partkey").select(
        "l_suppkey", "l_partkey", "l_orderkey")


NUMBERED = """
  SELECT o_orderpriority AS unit, l_orderkey, l_quantity, l_extendedprice,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i,
    count(*) OVER (PARTITION BY l_orderkey) AS n
  FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"""
NUMBERED_SQL = NUMBERED.replace("{", "").replace("}", "")


@query("stitched_rings", f"""
  SELECT unit, l_orderkey * 1000 + i AS edge, l_orderkey * 1000 + 1 AS ring, i - 1 AS pos, n AS size FROM ({NUMBERED_SQL})""")
def stitched_rings(t):
    # The line items of an order are the edges of a ring; the last one leads back to the first.
    edges = t.sql(NUMBERED, "lineitem", "orders").select(
        "unit", (F.col("l_orderkey") * 1000 + F.col("i")).alias("edge"),
        F.col("l_orderkey").alias("sx"), F.col("i").alias("sy"), F.col("l_orderkey").alias("ex"),
        F.when(F.col("i") == F.col("n"), 1).otherwise(F.col("i") + 1).alias("ey"))
    return geometry.stitch_rings(edges, ["unit"], "edge")


CELLS = """
  SELECT p_brand AS unit, p_partkey % 50 AS i, CAST(floor(p_partkey / 50) AS bigint) AS j FROM {part}"""


@query("dissolved_area", "SELECT p_brand AS unit, CAST(count(*) AS double) AS area FROM part GROUP BY 1")
def dissolved_area(t):
    # A part is a unit cell; its brand is dissolved out of its cells. Arc ids: the lower edge of
    # cell (i, j) is 2 * (j * 51 + i), the left edge one more.
    cells = t.sql(CELLS, "part")

    def arc(i, j, left):
        return (F.lit(2) * (j * 51 + i) + (1 if left else 0)).cast("bigint")
    i, j = F.col("i"), F.col("j")
    sides = F.array(*[F.struct(a.alias("arc"), F.lit(b).alias("backward")) for a, b in (
        (arc(i, j, False), False), (arc(i + 1, j, True), False),
        (arc(i, j + 1, False), True), (arc(i, j, True), True))])
    refs = cells.select("unit", F.lit("f").alias("file"), F.explode(sides).alias("s")) \
        .select("unit", "file", "s.arc", "s.backward")
    used = refs.select("file", "arc").distinct()
    at = F.floor(F.col("arc") / 2).cast("bigint")
    x, y = at % 51, F.floor(at / 51).cast("bigint")
    points = used.select("file", "arc", F.explode(F.array(F.lit(0), F.lit(1))).alias("line")).select(
        "file", "arc", "line",
        (x + F.when(F.col("arc") % 2 == 0, F.col("line")).otherwise(0)).alias("x"),
        (y + F.when(F.col("arc") % 2 == 1, F.col("line")).otherwise(0)).alias("y"))
    out = geometry.dissolve(refs, points, ["unit"])
    return out["rings"].groupBy("unit").agg(F.sum("area").cast("double").alias("area"))


@query("containing_rings", """
  SELECT c_nationkey AS unit, c_custkey AS hole, min(s_suppkey) AS ring FROM customer JOIN supplier ON c_nationkey = s_nationkey
    AND c_acctbal >= s_acctbal AND c_acctbal < s_acctbal + 1500 AND c_custkey >= s_suppkey * 10 AND c_custkey < s_suppkey * 10 + 400
  GROUP BY 1, 2""")
def containing_rings(t):
    holes = t.customer.select(F.col("c_nationkey").alias("unit"), F.col("c_custkey").alias("hole"),
                              F.col("c_acctbal").alias("x"), F.col("c_custkey").cast("double").alias("y"))
    box = t.supplier.select(
        F.col("s_nationkey").alias("unit"), F.col("s_suppkey").alias("ring"),
        F.col("s_acctbal").alias("a"), (F.col("s_acctbal") + 1500).alias("b"),
        (F.col("s_suppkey") * 10.0).alias("c"), (F.col("s_suppkey") * 10.0 + 400).alias("d"))
    corners = [("a", "c"), ("b", "c"), ("b", "d"), ("a", "d")]
    edges = box.select("unit", "ring", F.explode(F.array(*[
        F.struct(F.col(p[0]).alias("x0"), F.col(p[1]).alias("y0"), F.col(q[0]).alias("x1"),
                 F.col(q[1]).alias("y1")) for p, q in zip(corners, corners[1:] + corners[:1])]))
        .alias("e")).select("unit", "ring", "e.*")
    return geometry.containing_rings(holes, edges, ["unit"], 100.0)


NESTED = """
  SELECT unit, o_orderkey AS ring, CAST(floor((rn - 1) / 2) AS bigint) AS level, (rn - 1) % 2 AS side,
    5000 * (c_custkey % 50) AS cx, 5000 * CAST(floor(c_custkey / 50) AS bigint) AS cy FROM (
    SELECT c_nationkey AS unit, c_custkey, o_orderkey, row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey) AS rn
    FROM {orders} JOIN {customer} ON o_custkey = c_custkey)"""
NESTED_SQL = NESTED.replace("{", "").replace("}", "")


def nested_squares(t):
    """Customers as islands: of two orders, the first one's square holds what comes after, and the
    second one's square lies beside that. Every third square is wound the other way."""
    level, first = F.col("level"), F.col("side") == 0
    box = t.sql(NESTED, "orders", "customer").withColumns({
        "a": F.col("cx") + F.when(first, 10 * level).otherwise(4000 - 30 * (level + 1) + 5),
        "b": F.col("cx") + F.when(first, 4000 - 30 * level).otherwise(4000 - 30 * (level + 1) + 25),
        "c": F.col("cy") + F.when(first, 10 * level).otherwise(F.lit(2000)),
        "d": F.col("cy") + F.when(first, 4000 - 10 * level).otherwise(F.lit(2010))})
    corners = F.array(*[F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
                        for x, y in (("a", "c"), ("b", "c"), ("b", "d"), ("a", "d"))])
    points = box.select("unit", "ring", F.posexplode(corners).alias("line", "p"))
    return points.select("unit", "ring", F.lit(0).cast("bigint").alias("block"),
                         F.when(F.col("ring") % 3 == 0, -F.col("line")).otherwise(F.col("line")).alias("line"), "p.x", "p.y")


@query("assembled_polygons", f"""WITH n AS ({NESTED_SQL}),
  d AS (SELECT *, level + CASE WHEN side = 1 THEN 1 ELSE 0 END AS depth FROM n)
  SELECT d.unit, d.ring, d.depth, d.depth % 2 = 1 AS is_hole, CASE WHEN d.depth % 2 = 1 THEN h.ring ELSE d.ring END AS outer
  FROM d LEFT JOIN n h ON h.cx = d.cx AND h.cy = d.cy AND h.side = 0 AND h.level = d.depth - 1""")
def assembled_polygons(t):
    return geometry.assemble_polygons(nested_squares(t), ["unit"], 1000.0)


TOPOLOGY = f"""
  a AS (SELECT l_orderkey, CAST(i - 1 AS integer) AS line, n, CAST(floor(l_extendedprice) AS bigint) % 1000 AS dx,
    CAST(l_quantity AS bigint) - 25 AS dy FROM ({NUMBERED_SQL}))"""


def topologies(t):
    """One boundary file for each order: a single ring whose steps are its line items."""
    step = F.struct("i", F.array(F.floor("l_extendedprice") % 1000,
                                 F.col("l_quantity").cast("bigint") - 25).alias("d"))
    arcs = t.sql(NUMBERED, "lineitem", "orders").groupBy("l_orderkey").agg(F.transform(
        F.sort_array(F.collect_list(step)), lambda s: s["d"]).alias("steps"))
    shape = F.struct(
        F.lit("Polygon").alias("type"),
        F.array(F.array(F.when(F.col("l_orderkey") < 7000, 0).otherwise(-1))).alias("arcs"),
        F.struct(F.col("l_orderkey").alias("adm3_psgc")).alias("properties"))
    return arcs.select("l_orderkey", F.to_json(F.struct(
        F.array("steps").alias("arcs"),
        F.create_map(F.lit("m"), F.struct(F.array(shape).alias("geometries"))).alias("objects")))
        .alias("body"))


@query("decoded_arcs", f"""WITH {TOPOLOGY}
  SELECT l_orderkey AS file, line, CAST(sum(dx) OVER w AS bigint) AS x, CAST(sum(dy) OVER w AS bigint) AS y FROM a
  WINDOW w AS (PARTITION BY l_orderkey ORDER BY line)""")
def decoded_arcs(t):
    return geometry.arc_points(topologies(t), "l_orderkey", "body").select("file", "line", "x", "y")


def halved_topologies(t):
    """The same rings out of two arcs, the second stored from its end. Orders from 7000 on are walked
    the other way round."""
    step = F.struct("i", F.array(F.floor("l_extendedprice") % 1000,
                                 F.col("l_quantity").cast("bigint") - 25).alias("d"))
    rings = t.sql(NUMBERED, "lineitem", "orders").groupBy("l_orderkey").agg(F.transform(
        F.sort_array(F.collect_list(step)), lambda s: s["d"]).alias("d"))
    half = F.ceil(F.size("d") / 2).cast("int")

    def total(i):
        return F.aggregate("d", F.lit(0).cast("bigint"), lambda s, d: s + d[i])
    back = F.transform(F.reverse(F.slice("d", half + 1, F.size("d"))), lambda d: F.array(-d[0], -d[1]))
    arcs = F.array(F.slice("d", F.lit(1), half), F.concat(F.array(F.array(total(0), total(1))), back))
    forward = F.col("l_orderkey") < 7000
    refs = F.when(F.size("d") == 1, F.when(forward, F.array(F.lit(0))).otherwise(F.array(F.lit(-1)))) \
        .when(forward, F.array(F.lit(0), F.lit(-2))).otherwise(F.array(F.lit(1), F.lit(-1)))
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(refs).alias("arcs"),
                     F.struct(F.col("l_orderkey").alias("adm3_psgc")).alias("properties"))
    return rings.select("l_orderkey", F.to_json(F.struct(
        arcs.alias("arcs"), F.create_map(F.lit("m"), F.struct(F.array(shape).alias("geometries"))).alias("objects"))).alias("body"))


@query("chained_rings", f"""WITH {TOPOLOGY},
  p AS (SELECT l_orderkey, line + 1 AS i, n, (n + 1) // 2 AS k, sum(dx) OVER w AS x, sum(dy) OVER w AS y FROM a
    WINDOW w AS (PARTITION BY l_orderkey ORDER BY line))
  SELECT lpad('' || l_orderkey, 10, '0') AS unit,
    CASE WHEN l_orderkey < 7000 THEN CASE WHEN i <= k THEN 0 ELSE 1 END ELSE CASE WHEN i >= k THEN 0 ELSE 1 END END AS block,
    CASE WHEN l_orderkey < 7000 THEN CASE WHEN i <= k THEN i - 1 ELSE i - k END ELSE CASE WHEN i >= k THEN n - i ELSE k - i END END AS line,
    x * 0.5 + 10 AS x, y * 0.25 - 3 AS y FROM p""")
def chained_rings(t):
    files = halved_topologies(t)
    points = geometry.arc_points(files, "l_orderkey", "body")
    refs = geometry.ring_arcs(files, "l_orderkey", "body", "adm3_psgc")
    chained = geometry.chain_points(refs, points, ["unit", "poly", "ring"])
    return geometry.scale_points(chained, (0.5, 0.25), (10.0, -3.0)).select("unit", "block", "line", "x", "y")


@query("shared_arcs", f"""WITH {RING_SQL}
  SELECT DISTINCT ring, side, ring AS arc, side = 'b' AND EXISTS (SELECT 1 FROM p b JOIN p c ON b.ring = c.ring AND b.ring = p.ring
      WHERE b.line <> c.line AND (b.x, b.y) <> (c.x, c.y)) AS turned FROM p, (VALUES ('a'), ('b')) s(side)""")
def shared_arcs(t):
    # Every ring and the same ring walked backward share an arc.
    points = ring_points(t).select("ring", "block", "line", "x", "y")
    there = points.withColumn("side", F.lit("a"))
    back = points.withColumns({"side": F.lit("b"), "block": -F.col("block"), "line": -F.col("line")})
    out = geometry.shared_arcs(there.unionByName(back), ["ring", "side"])
    return out.select("ring", "side", F.col("arc.ring").alias("arc"), F.col("backward").alias("turned"))
