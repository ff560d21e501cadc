"""Outlines made of shared arcs: decode, chain, dissolve, quantise and encode.

Points are rows. Along a ring they are ordered by ``(block, line)``, the arc's place in the ring and
the point's place in the arc, so rings of any size are worked on arc by arc.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hustings.functions.places import place_code
from hustings.operators.groups import attach
from hustings.operators.ordered import BLOCK, previous, running
from hustings.session import growing, stored
from hustings.sources.feeds import BOUNDARY_FEED

POINT = ["x", "y"]


def arc_points(files: DataFrame, file: str, body: str) -> DataFrame:
    """(file, arc, block, line, x, y): arcs are stored as steps; points are their running sums."""
    doc = files.select(F.col(file).alias("file"), F.from_json(body, BOUNDARY_FEED)["arcs"].alias("a"))
    steps = doc.select("file", F.posexplode("a").alias("arc", "p")) \
        .select("file", "arc", F.posexplode("p").alias("line", "d")) \
        .withColumn("block", F.floor(F.col("line") / BLOCK).cast("bigint"))
    return running(steps, ["file", "arc"], "block", "line",
                   total={"x": F.col("d")[0], "y": F.col("d")[1]}).drop("d")


def ring_arcs(files: DataFrame, file: str, body: str, code: str) -> DataFrame:
    """(file, unit, poly, ring, pos, arc, backward): the signed arcs of every ring. A reference
    below zero is the complement of an arc that is walked backward."""
    doc = files.select(F.col(file).alias("file"),
                       F.explode(F.from_json(body, BOUNDARY_FEED)["objects"]).alias("layer", "o"))
    shapes = doc.select("file", F.posexplode("o.geometries").alias("shape", "g")).filter(
        F.col("g.type").isNotNull() & F.col("g.arcs").isNotNull())
    many = F.from_json("g.arcs", "array<array<array<bigint>>>")
    one = F.array(F.from_json("g.arcs", "array<array<bigint>>"))
    polys = shapes.select("file", "shape", place_code(F.col(f"g.properties.{code}")).alias("unit"),
                          F.posexplode(F.when(F.col("g.type") == "Polygon", one).otherwise(many))
                          .alias("poly", "rings"))
    refs = polys.select("file", "shape", "unit", "poly", F.posexplode("rings").alias("ring", "arcs")) \
        .select("file", "shape", "unit", "poly", "ring", F.posexplode("arcs").alias("pos", "ref"))
    return refs.select("file", "shape", "unit", "poly", "ring", "pos",
                       F.when(F.col("ref") >= 0, F.col("ref")).otherwise(F.bitwise_not("ref"))
                       .cast("int").alias("arc"), (F.col("ref") < 0).alias("backward"))


def chain_points(refs: DataFrame, points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, block, line, x, y): points of rings in walking order. The first point of every arc
    but the first repeats the last point before it and is dropped."""
    ends = points.groupBy("file", "arc").agg(F.max("line").alias("__last"))
    placed = refs.join(growing(ends), ["file", "arc"]).join(
        growing(points.select("file", "arc", F.col("line").alias("__at"), "x", "y")), ["file", "arc"])
    line = F.when(F.col("backward"), F.col("__last") - F.col("__at")).otherwise(F.col("__at"))
    return placed.select(*keys, F.col("pos").alias("block"), line.alias("line"), "x", "y") \
        .filter((F.col("line") > 0) | (F.col("block") == 0))


def scale_points(points: DataFrame, scale: tuple[float, float],
                 translate: tuple[float, float]) -> DataFrame:
    """Grid points to coordinates."""
    return points.withColumns({"x": F.col("x") * scale[0] + translate[0],
                               "y": F.col("y") * scale[1] + translate[1]})


def edge_use(refs: DataFrame, unit: Sequence[str], edge: str) -> DataFrame:
    """How often each edge is used within a unit, whichever way it is walked."""
    return refs.groupBy(*unit, edge).agg(F.count(F.lit(1)).alias("uses"))


def boundary_edges(refs: DataFrame, unit: Sequence[str], edge: str) -> DataFrame:
    """References to edges used once: the outside of the unit. An edge between two parts is used
    twice and drops out."""
    once = edge_use(refs, unit, edge).filter(F.col("uses") == 1).drop("uses")
    return refs.join(growing(once), [*unit, edge], "left_semi")


def stitch_rings(edges: DataFrame, unit: Sequence[str], edge: str) -> DataFrame:
    """(unit, edge, ring, pos, size): closed rings out of directed edges (sx, sy) -> (ex, ey).

    ``ring`` is the least edge of the ring, ``pos`` counts from it. Each edge is linked to the one
    that starts where it ends; where several do, the i-th arriving edge goes on to the i-th
    leaving one. Rings are then found by doubling: every round an edge looks twice as far ahead for
    the least edge number and how far away it is, so a ring of n edges takes log2(n) rounds of one
    join. Rows with a null ring belong to a chain that does not close. Edges are unique in a unit.
    """
    keys = list(unit)
    # stored once, so that the numbers stay; rows of the rounds carry those, not units and edges
    edges = stored(edges.select(*keys, edge, "sx", "sy", "ex", "ey").withColumn("__id", F.monotonically_increasing_id()))
    opened = (F.col("sx") != F.col("ex")) | (F.col("sy") != F.col("ey"))
    open_edges = edges.filter(opened)
    known = F.lit(True)
    for k in [*keys, edge]:
        known = known & F.col(k).isNotNull()
    closed = edges.filter(~F.coalesce(opened, F.lit(False)) | ~known) \
        .join(growing(open_edges.select(*keys, edge)), [*keys, edge], "left_anti").select(
            *keys, edge, F.col(edge).alias("ring"), F.lit(0).cast("bigint").alias("pos"),
            F.lit(1).cast("bigint").alias("size"))
    vertex = [*keys, "vx", "vy"]
    ends = F.explode(F.array(F.struct(F.col("ex").alias("vx"), F.col("ey").alias("vy"), F.lit(0).alias("leaves")),
                             F.struct(F.col("sx").alias("vx"), F.col("sy").alias("vy"), F.lit(1).alias("leaves"))))
    met = open_edges.select(*keys, edge, "__id", ends.alias("e")).select(*keys, edge, "__id", "e.*").repartition(*vertex)
    turn = F.row_number().over(Window.partitionBy(*vertex, "leaves").orderBy(edge))
    paired = Window.partitionBy(*vertex).orderBy("turn", "leaves")
    goes_on = F.lead("leaves").over(paired) == 1
    for c in vertex:
        goes_on = goes_on & F.col(c).isNotNull()
    goes_on = goes_on & (F.lead("turn").over(paired) == F.col("turn")) & F.lead(edge).over(paired).isNotNull()
    nxt = F.when(goes_on & F.col(edge).isNotNull(), F.lead("__id").over(paired))
    linked = met.withColumn("turn", turn).withColumn("nxt", nxt).filter("leaves = 0").select("__id", "nxt")
    # low: the least number ahead, null where the chain ends; away: how many edges ahead it is. Numbers
    # are kept as distances from the row's own, which are short where rows of a ring lie together.
    me = F.col("__id")
    state = stored(linked.select(
        "__id", (F.col("nxt") - me).alias("dn"), F.when(F.col("nxt").isNotNull(), F.least(me, "nxt") - me).alias("dl"),
        F.when(F.col("nxt") < me, 1).otherwise(0).cast("bigint").alias("away")))
    # A row that meets the same least number twice has seen its whole ring and is done; the others may
    # still ask for it in the next round, when the rest of its ring is done, too.
    active, reach, rounds = state, 1, []
    while True:
        later = state.select(me.alias("nxt"), F.col("dn").alias("dn2"), F.col("dl").alias("dl2"), F.col("away").alias("a2"))
        n2, l2, low = F.col("nxt") + F.col("dn2"), F.col("nxt") + F.col("dl2"), me + F.col("dl")
        ends = F.col("a2").isNotNull() & F.col("dl2").isNull()
        lower = F.coalesce(low.isNotNull() & (ends | (l2 < low)), F.lit(False))
        twice = F.coalesce((l2 == low) & (F.lit(reach) + F.col("a2") > F.col("away")), F.lit(False))
        state = stored(active.select(me, (me + F.col("dn")).alias("nxt"), "dl", "away").join(growing(later), "nxt", "left").select(
            "__id", (n2 - me).alias("dn"), F.when(lower, l2 - me).otherwise(F.col("dl")).alias("dl"),
            F.when(lower, F.lit(reach) + F.col("a2")).otherwise(F.col("away")).alias("away"), twice.alias("done")))
        active, reach = state.filter("NOT done"), reach * 2
        rounds.append(state.filter("done"))
        if active.filter(F.col("dl").isNotNull()).isEmpty():
            break
    seen = reduce(DataFrame.unionByName, [*rounds, active]).select("__id", "dl", "away")
    named = stored(edges.filter(opened).select("__id", *keys, edge).join(growing(seen), "__id").select(
        *keys, edge, F.coalesce(me + F.col("dl"), F.lit(-1)).alias("low"), "away"))
    rings = named.filter("low >= 0").groupBy("low").agg(
        F.count(F.lit(1)).alias("size"), F.min(edge).alias("ring"), F.min_by("away", edge).alias("first"))
    pos = F.pmod(F.col("first") - F.col("away"), F.col("size"))
    placed = named.filter("low >= 0").join(growing(rings), "low").select(*keys, edge, "ring", pos.alias("pos"), "size")
    unclosed = named.filter("low < 0").select(
        *keys, edge, F.lit(None).cast(edges.schema[edge].dataType).alias("ring"),
        F.lit(None).cast("bigint").alias("pos"), F.lit(None).cast("bigint").alias("size"))
    return placed.unionByName(closed).unionByName(unclosed)


def with_previous_point(points: DataFrame, ring: Sequence[str], close: bool = False,
                        place: bool = False) -> DataFrame:
    """Adds (px, py), the point before; for the first point null, or the last point with
    ``close``. With ``place`` (pblock, pline) say where that point is."""
    of = {"x": "px", "y": "py"} | ({"block": "pblock", "line": "pline"} if place else {})
    return previous(points, list(ring), "block", "line", of, around=close)


def _signed_area() -> Column:
    return F.sum(F.col("px") * F.col("y") - F.col("x") * F.col("py")) / 2


def ring_areas(points: DataFrame, ring: Sequence[str]) -> DataFrame:
    """Signed area of each ring; the sign tells outline from hole."""
    return with_previous_point(points, ring, close=True).groupBy(*ring).agg(_signed_area().alias("area"))


def outer_and_holes(areas: DataFrame, unit: Sequence[str]) -> DataFrame:
    """``is_outer`` by the sign of the area; a unit wound entirely the other way is turned."""
    has = areas.groupBy(*unit).agg(F.bool_or(F.col("area") > 0).alias("__has"))
    return attach(areas, has, list(unit)).withColumn(
        "is_outer", F.when(F.col("__has"), F.col("area") > 0).otherwise(F.lit(True))).drop("__has")


def left_of(x: Column, y: Column) -> Column:
    """Whether the edge meets the line at ``y`` at or left of ``x``. Only the end with the greater
    y belongs to the edge, so a corner of a ring counts once."""
    rises = F.col("y1") > F.col("y0")
    side = (F.col("x1") - F.col("x0")) * (y - F.col("y0")) - (F.col("y1") - F.col("y0")) * (x - F.col("x0"))
    return ((F.col("y0") > y) != (F.col("y1") > y)) & F.when(rises, side <= 0).otherwise(side >= 0)


def above_of(x: Column, y: Column) -> Column:
    """Whether the edge meets the upright line just right of ``x`` above ``y``."""
    runs = F.col("x1") > F.col("x0")
    side = (F.col("x1") - F.col("x0")) * (y - F.col("y0")) - (F.col("y1") - F.col("y0")) * (x - F.col("x0"))
    climbs = (F.col("y1") > F.col("y0")) == runs
    return ((F.col("x0") > x) != (F.col("x1") > x)) & (
        F.when(runs, side < 0).otherwise(side > 0) | ((side == 0) & climbs & (F.col("y0") != F.col("y1"))))


def edge_cells(edges: DataFrame, cell: float) -> DataFrame:
    """Edges with the (row, col) of every cell they touch."""
    size, slack = F.lit(float(cell)), 1e-9
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    rows = edges.withColumn("row", F.explode(F.sequence(F.floor(low / size).cast("bigint"),
                                                        F.floor(high / size).cast("bigint"))))

    def x_at(y: Column) -> Column:
        inside = F.least(F.greatest(y, low), high)
        share = F.when(F.col("y1") == F.col("y0"), F.lit(0.0)).otherwise(
            (inside - F.col("y0")) / F.nullif(F.col("y1") - F.col("y0"), F.lit(0)))
        return F.col("x0") + share * (F.col("x1") - F.col("x0"))
    flat = F.col("y0") == F.col("y1")
    ends = [F.when(flat, F.col("x0")).otherwise(x_at(F.col("row") * size)),
            F.when(flat, F.col("x1")).otherwise(x_at((F.col("row") + 1) * size))]
    return rows.withColumn("col", F.explode(F.sequence(
        F.floor(F.least(*ends) / size - slack).cast("bigint"), F.floor(F.greatest(*ends) / size + slack).cast("bigint"))))


def inner_corners(edges: DataFrame, keys: Sequence[str], cell: float) -> DataFrame:
    """(keys, row, col): cells whose lower left corner lies within the ring.

    Edges flip the parity where they meet the lower line of a row; the flips of a ring and row are
    added up from left to right, and between an odd sum and the next flip all corners are inside.
    """
    size = F.lit(float(cell))
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    rows = edges.filter(F.col("y0") != F.col("y1")).withColumn("row", F.explode(F.sequence(
        F.floor(low / size).cast("bigint"), F.floor(high / size).cast("bigint"))))
    y = F.col("row") * size
    met = rows.filter((F.col("y0") > y) != (F.col("y1") > y))
    x = F.col("x0") + (y - F.col("y0")) / (F.col("y1") - F.col("y0")) * (F.col("x1") - F.col("x0"))
    near = F.floor(x / size).cast("bigint")
    first = F.when(left_of((near - 1) * size, y), near - 1).when(left_of(near * size, y), near) \
        .when(left_of((near + 1) * size, y), near + 1).otherwise(near + 2)
    # dealt once, for the flips and for the walk along them
    flips = met.select(*keys, "row", first.alias("col")).repartition(*keys, "row").groupBy(*keys, "row", "col").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") % 2 == 1)
    along = Window.partitionBy(*keys, "row").orderBy("col")  # a ring's flips in one row
    spans = flips.withColumns({"turn": F.row_number().over(along), "next": F.lead("col").over(along)}) \
        .filter((F.col("turn") % 2 == 1) & F.col("next").isNotNull())
    return spans.select(*keys, "row", F.explode(F.sequence("col", F.col("next") - 1)).alias("col"))


def rings_around(holes: DataFrame, edges: DataFrame, unit: Sequence[str], cell: float,
                 met: bool = False) -> DataFrame:
    """(unit, hole, ring): all rings of the unit whose outline contains the hole's point.

    ``holes``: unit, hole, x, y. ``edges``: unit, ring, x0, y0, x1, y1 of closed rings. The plane
    is cut into square cells. For each ring the cells are known whose lower left corner it holds,
    carried from cell to cell along a row; a point has the corner's parity, turned by every edge
    between the corner and the point. Those edges touch the point's own cell, so a point meets the
    edges of one cell only, whatever the size of the rings. With ``met`` the crossings are returned
    as they are met, one row for each (point, edge of the cell).
    """
    keys = list(unit)
    size = F.lit(float(cell))
    at = holes.select(*keys, "hole", "x", "y", F.floor(F.col("y") / size).cast("bigint").alias("row"),
                      F.floor(F.col("x") / size).cast("bigint").alias("col"))
    x, y, left, low = F.col("x"), F.col("y"), F.col("col") * size, F.col("row") * size
    turns = (left_of(x, y) != left_of(left, y)).cast("bigint") + (above_of(left, y) != above_of(left, low)).cast("bigint")
    local = at.join(edge_cells(edges, cell), [*keys, "row", "col"]).select(*keys, "hole", "ring", turns.alias("n"))
    if met:
        return local
    corner = at.join(inner_corners(edges, [*keys, "ring"], cell), [*keys, "row", "col"]) \
        .select(*keys, "hole", "ring", F.lit(1).cast("bigint").alias("n"))
    return local.filter("n > 0").unionByName(corner).groupBy(*keys, "hole", "ring").agg(F.sum("n").alias("n")) \
        .filter(F.col("n") % 2 == 1).drop("n")


def containing_rings(holes: DataFrame, edges: DataFrame, unit: Sequence[str],
                     cell: float) -> DataFrame:
    """(unit, hole, ring): the least ring of the unit whose outline contains the hole's point."""
    return rings_around(holes, edges, unit, cell).groupBy(*unit, "hole").agg(F.min("ring").alias("ring"))


def inner_points(points: DataFrame, ring: Sequence[str]) -> DataFrame:
    """(ring, x, y): a point strictly inside each ring.

    The least corner v by (x, y) is convex. If no other point of the ring lies in the triangle of v
    and its neighbours, the triangle's middle is inside; otherwise the middle between v and the
    point in the triangle that is farthest from the line of the neighbours.
    """
    keys = list(ring)
    pairs = with_previous_point(points, ring, close=True, place=True)
    corner = pairs.groupBy(*keys).agg(*_least_corner()).select(*keys, F.struct("v.*", "b.*").alias("v"))
    return _inner_points(attach(pairs.select(*keys, "x", "y"), growing(corner), keys), keys)


def _least_corner() -> list[Column]:
    """The least corner with the one before, and the one after, whose point before is the least."""
    return [F.min_by(F.struct("x", "y", F.col("px").alias("ax"), F.col("py").alias("ay")), F.struct("x", "y", "block", "line")).alias("v"),
            F.min_by(F.struct(F.col("x").alias("bx"), F.col("y").alias("by")), F.struct("px", "py", "pblock", "pline")).alias("b")]


def _inner_points(near: DataFrame, keys: Sequence[str], *more: str) -> DataFrame:
    """``inner_points`` of points that have their ring's least corner and its neighbours, ``v``, and
    ``more`` that is the same for all points of a ring."""
    def side(p, q, x, y):
        (px, py), (qx, qy) = p, q
        return (qx - px) * (y - py) - (qy - py) * (x - px)
    v, a, b = [(F.col(f"v.{n[0]}"), F.col(f"v.{n[1]}")) for n in (("x", "y"), ("ax", "ay"), ("bx", "by"))]
    x, y = F.col("x"), F.col("y")
    sides = [side(p, q, x, y) for p, q in ((v, a), (a, b), (b, v))]
    within = (F.greatest(*sides) <= 0) | (F.least(*sides) >= 0)
    other = ~(((x == v[0]) & (y == v[1])) | ((x == a[0]) & (y == a[1])) | ((x == b[0]) & (y == b[1])))
    far = F.when(within & other, F.struct(F.abs(sides[1]).alias("far"), x.alias("qx"), y.alias("qy")))
    found = near.groupBy(*keys).agg(F.max(far).alias("q"), F.first("v").alias("v"), *[F.first(c).alias(c) for c in more])
    middle = {c: F.when(F.col("q").isNotNull(), (F.col(f"v.{c}") + F.col(f"q.q{c}")) / 2).otherwise(
        (F.col(f"v.{c}") + F.col(f"v.a{c}") + F.col(f"v.b{c}")) / 3).cast("double") for c in POINT}
    return found.select(*keys, *more, middle["x"].alias("x"), middle["y"].alias("y"))


def assemble_polygons(points: DataFrame, unit: Sequence[str], cell: float) -> DataFrame:
    """(unit, ring, depth, is_hole, outer): rings sorted into polygons by how deep they are nested.

    ``points``: unit, ring, block, line, x, y of closed rings that do not cross. ``depth`` is the
    number of larger rings around a ring. Rings of even depth are outlines, islands included; a
    ring of odd depth is a hole and belongs to the smallest ring around it, ``outer``. The winding
    does not matter. Rings without area are left out.
    """
    keys = list(unit)
    of = [*keys, "ring"]
    pairs = stored(with_previous_point(stored(points.select(*of, "block", "line", *POINT)), of, close=True, place=True))
    # area and least corner are found at once, and join the points once; sides of rings without area
    # are met as well, and go with the areas they do not have
    rings = stored(pairs.groupBy(*of).agg(F.abs(_signed_area()).alias("area"), *_least_corner()).filter("area > 0").select(
        *of, "area", F.struct("v.*", "b.*").alias("v")))
    areas = rings.select(*of, "area")
    inner = stored(_inner_points(pairs.select(*of, "x", "y").join(growing(rings), of), of, "area").select(
        *keys, F.struct("ring", "area").alias("hole"), "x", "y"))
    sides = pairs.select(*of, F.col("px").alias("x0"), F.col("py").alias("y0"), F.col("x").alias("x1"), F.col("y").alias("y1"))
    met = rings_around(inner, sides, keys, cell).select(*keys, "hole", "ring")
    around = attach(met, growing(areas), of).filter(F.col("area") > F.col("hole.area"))
    nested = around.groupBy(*keys, F.col("hole.ring").alias("ring")).agg(
        F.count(F.lit(1)).alias("depth"), F.min_by("ring", F.struct("area", "ring")).alias("__smallest"))
    depth = F.coalesce("depth", F.lit(0))
    return attach(areas.drop("area"), nested, of).select(
        *of, depth.alias("depth"), (depth % 2 == 1).alias("is_hole"),
        F.when(depth % 2 == 1, F.col("__smallest")).otherwise(F.col("ring")).alias("outer"))


def quantise(points: DataFrame, grid: int, within: Sequence[str] = ()) -> DataFrame:
    """Points on a grid of ``grid`` steps over the bounding box of the table, or of each group;
    halves go to the even step. A box without extent maps to 0."""
    box = [F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"),
           F.max("y").alias("y1")]
    if within:
        boxed = attach(points.drop("x0", "x1", "y0", "y1"), points.groupBy(*within).agg(*box),
                       list(within))
    else:
        bounds = points.agg(F.struct(*box).alias("b"))
        boxed = points.withColumn("__b", bounds.scalar()).select("*", "__b.*").drop("__b")

    def step(c, lo, hi):
        size = (F.col(hi) - F.col(lo)) / F.lit(grid - 1)
        on = F.bround((F.col(c) - F.col(lo)) / F.nullif(size.cast("double"), F.lit(0.0)))
        return F.coalesce(on, F.lit(0.0)).cast("bigint")
    return boxed.withColumns({"x": step("x", "x0", "x1"), "y": step("y", "y0", "y1")}) \
        .drop("x0", "x1", "y0", "y1")


def drop_repeats(points: DataFrame, ring: Sequence[str]) -> DataFrame:
    """Points that differ from the one before."""
    pairs = with_previous_point(points, ring)
    same = (F.col("x") == F.col("px")) & (F.col("y") == F.col("py"))
    return pairs.filter(~F.coalesce(same, F.lit(False))).drop("px", "py")


def delta_encode(points: DataFrame, ring: Sequence[str]) -> DataFrame:
    """(dx, dy) from the point before; the first point counts from the origin."""
    pairs = with_previous_point(points, ring)
    return pairs.withColumns({
        "dx": F.col("x") - F.coalesce("px", F.lit(0)),
        "dy": F.col("y") - F.coalesce("py", F.lit(0))}).drop("px", "py")


def shape_quality(points: DataFrame, unit: Sequence[str], ring: Sequence[str]) -> DataFrame:
    """Rings of each unit, how many keep an interior (three distinct points), and ``degenerate``
    where none does."""
    distinct = points.select(*unit, *ring, *POINT).distinct().groupBy(*unit, *ring).agg(
        F.count(F.lit(1)).alias("points"))
    return distinct.groupBy(*unit).agg(
        F.count(F.lit(1)).alias("rings"), F.count_if(F.col("points") >= 3).alias("solid")) \
        .withColumn("degenerate", F.col("solid") == 0)


def recover_shapes(points: DataFrame, finer: DataFrame, quality: DataFrame,
                   unit: Sequence[str]) -> DataFrame:
    """Degenerate units taken from a finer source where it has them."""
    bad = quality.filter("degenerate").select(*unit)
    better = finer.join(bad, list(unit), "left_semi")
    replaced = better.select(*unit).distinct()
    return points.join(replaced, list(unit), "left_anti").unionByName(better)


def shared_arcs(points: DataFrame, ring: Sequence[str]) -> DataFrame:
    """(ring, arc, backward): rings with the same points in the same or opposite order get one arc
    id, the least ring of the group; ``backward`` where the order is opposite to that ring's.

    Sequences are compared by two independent 64-bit sums over (place, x, y), taken both ways.
    """
    keys = list(ring)
    numbered = running(points, keys, "block", "line", total={"__i": F.lit(1)})
    sizes = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    both = attach(numbered, sizes, keys)

    def mark(i: Column) -> list[Column]:
        return [F.sum(F.xxhash64(i, "x", "y").cast("decimal(38,0)")),
                F.sum(F.xxhash64("y", i, "x").cast("decimal(38,0)"))]
    i, n = F.col("__i").cast("bigint"), F.col("__n")
    there, back = mark(i), mark((n + 1 - i).cast("bigint"))
    signed = both.groupBy(*keys).agg(
        F.max("__n").alias("n"), F.struct(*there).alias("there"), F.struct(*back).alias("back"))
    key = F.struct("n", F.least("there", "back").alias("k"))
    keyed = signed.select(*keys, key.alias("key"), "there", F.struct(*keys).alias("__ring"))
    firsts = keyed.groupBy("key").agg(
        F.min_by(F.struct("__ring", "there"), "__ring").alias("__first"))
    return keyed.join(firsts, "key").select(
        *keys, F.col("__first.__ring").alias("arc"),
        (F.col("there") != F.col("__first.there")).alias("backward"))


def dissolve(refs: DataFrame, points: DataFrame, unit: Sequence[str]) -> dict[str, DataFrame]:
    """Units out of their parts: the boundary arcs chained to rings, split into outlines and holes.

    Returns ``points`` (unit, ring, block, line, x, y; closing points dropped), ``rings`` (unit,
    ring, area, is_outer) and ``unclosed`` edges. ``assemble_polygons`` files the rings of the
    points under their outlines.
    """
    keys = list(unit)
    edges = boundary_edges(refs, keys, "arc")
    ends = points.groupBy("file", "arc").agg(
        F.min_by(F.struct(*POINT), "line").alias("a"), F.max_by(F.struct(*POINT), "line").alias("z"))
    directed = edges.join(growing(ends), ["file", "arc"])

    def end(c, forward, backward):
        return F.when(F.col("backward"), F.col(f"{backward}.{c}")).otherwise(F.col(f"{forward}.{c}"))
    directed = directed.withColumns({"sx": end("x", "a", "z"), "sy": end("y", "a", "z"),
                                     "ex": end("x", "z", "a"), "ey": end("y", "z", "a")})
    stitched = stitch_rings(directed.select(*keys, "arc", "sx", "sy", "ex", "ey"), keys, "arc")
    closed = stitched.filter(F.col("ring").isNotNull())
    walk = closed.join(growing(edges.select(*keys, "file", "arc", "backward")), [*keys, "arc"])
    chained = chain_points(walk, points, [*keys, "ring", "size"])
    sizes = chained.groupBy(*keys, "ring").agg(
        F.count(F.lit(1)).alias("__n"), F.max(F.struct("block", "line")).alias("__end"))
    # Fewer than four points, the closing one included, hold no interior.
    kept = chained.join(growing(sizes.filter(F.col("__n") > 3)), [*keys, "ring"]) \
        .filter(F.struct("block", "line") != F.col("__end")).drop("__n", "__end", "size")
    areas = ring_areas(kept, [*keys, "ring"])
    return {"points": kept, "rings": outer_and_holes(areas, keys),
            "unclosed": stitched.filter(F.col("ring").isNull())}
