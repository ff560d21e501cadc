"""Tallies, seats, winners, shares, standings and cells over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hustings.catalog.registry import query
from hustings.operators import cells, groups, tally
from hustings.plans.winners import leading_rows

VOTES = """
  SELECT n_name AS race, r_name AS area, p_brand AS candidate, p_type AS party,
         CAST(sum(l_quantity) AS bigint) AS votes
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2, 3, 4"""

# Seats of a region: suppliers in it divided by its nations, as if each had held a seat.
SEATS = """
  held AS (SELECT r_name AS area, count(*) AS held
             FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1),
  d AS (SELECT r_name AS area, count(DISTINCT n_name) AS districts FROM nation JOIN region
          ON n_regionkey = r_regionkey GROUP BY 1),
  seats AS (SELECT d.area, districts, CAST(coalesce(held, 8) AS bigint) AS total,
      CAST(greatest(1, CASE WHEN (coalesce(held, 8) * 2) % districts = 0
             AND ((coalesce(held, 8) * 2) // districts) % 2 = 1
          THEN 2 * round(coalesce(held, 8) / districts / 2) ELSE round(coalesce(held, 8) / districts) END)
        AS integer) AS seats, held IS NULL AS default_used
    FROM d LEFT JOIN held ON d.area = held.area)"""


def votes(t):
    """One row for each line item with its race, area, candidate and party."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")) \
        .select("n_nationkey", F.col("n_name").alias("race"), F.col("r_name").alias("area"))
    buyers = t.customer.select("c_custkey", "c_nationkey").join(
        places, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = t.orders.select("o_orderkey", "o_custkey").join(
        buyers, F.col("o_custkey") == F.col("c_custkey"))
    parts = t.part.select("p_partkey", F.col("p_brand").alias("candidate"),
                          F.col("p_type").alias("party"))
    return t.lineitem.select("l_orderkey", "l_partkey", "l_quantity") \
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey")) \
        .join(parts, F.col("l_partkey") == F.col("p_partkey")) \
        .select("race", "area", "candidate", "party",
                F.col("l_quantity").cast("bigint").alias("votes"))


def seats(t):
    areas = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")) \
        .select("n_nationkey", F.col("n_name").alias("race"), F.col("r_name").alias("area"))
    holders = t.supplier.join(areas, F.col("s_nationkey") == F.col("n_nationkey"))
    return tally.seat_estimate(holders, areas, "area", "race")


@query("seat_estimate", f"WITH {SEATS} SELECT * FROM seats")
def seat_estimate(t):
    return seats(t)


@query("elect_topn", f"""
  WITH v AS ({VOTES}), {SEATS},
  r AS (SELECT v.*, seats, row_number() OVER w AS place,
          lead(votes) OVER w AS next_votes
        FROM v JOIN seats USING (area)
        WINDOW w AS (PARTITION BY race ORDER BY votes DESC, candidate, party)),
  t AS (SELECT race, bool_or(place = seats AND votes = coalesce(next_votes, -1)) AS tie FROM r GROUP BY 1)
  SELECT race, candidate, party, votes, CAST(seats AS integer) AS seats, CAST(place AS integer) AS place,
    tie AS tie_at_cutoff
  FROM r JOIN t USING (race) WHERE place <= seats""")
def elect_topn(t):
    totals = tally.pooled_tally(votes(t), ["race", "area"], ["candidate", "party"], "votes")
    known = totals.join(seats(t).select("area", "seats"), "area")
    return tally.elect(known, ["race"], "votes", "seats", ["candidate", "party"]).select(
        "race", "candidate", "party", "votes", "seats", "place", "tie_at_cutoff")


@query("race_share", f"""
  WITH v AS ({VOTES})
  SELECT race, candidate, party, votes, CAST(sum(votes) OVER (PARTITION BY race) AS bigint) AS total,
    round(100.0 * votes / sum(votes) OVER (PARTITION BY race), 2) AS percentage,
    CAST(rank() OVER (PARTITION BY race ORDER BY votes DESC) AS integer) AS rank
  FROM v""")
def race_share(t):
    totals = tally.pooled_tally(votes(t), ["race"], ["candidate", "party"], "votes")
    summed = groups.group_total(totals, ["race"], "votes", "total")
    return groups.standing(groups.share_of_total(summed, ["race"], "votes", total="total"), ["race"], "votes")


@query("line_standing", """
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag,
    CAST(rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS bigint) AS rank
  FROM lineitem""")
def line_standing(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             "l_returnflag", "l_quantity")
    return groups.standing(rows, ["l_returnflag"], "l_quantity").drop("l_quantity")


@query("jurisdiction_tally", """
  SELECT CASE WHEN o_orderstatus = 'O' THEN 'GOVERNOR' WHEN o_orderstatus = 'F' THEN 'MAYOR'
      ELSE 'COUNCILOR' END AS office, n_name AS province,
    CASE WHEN o_orderstatus <> 'O' THEN c_mktsegment END AS city,
    CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS district,
    p_brand AS candidate, nullif(p_type, 'PROMO') AS party,
    CAST(sum(l_quantity) AS bigint) AS votes, min(r_name) AS region
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3, 4, 5, 6""")
def jurisdiction_tally(t):
    rows = t.sql("""
      SELECT CASE WHEN o_orderstatus = 'O' THEN 'GOVERNOR' WHEN o_orderstatus = 'F' THEN 'MAYOR'
          ELSE 'COUNCILOR' END AS office, n_name AS province, c_mktsegment AS city,
        o_orderpriority AS district, p_brand AS candidate, nullif(p_type, 'PROMO') AS party,
        cast(l_quantity as bigint) AS votes, r_name AS region
      FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
        JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
        JOIN {part} ON l_partkey = p_partkey""",
                 "lineitem", "orders", "customer", "nation", "region", "part")
    from hustings.functions.offices import JURISDICTION
    wanted = {o: JURISDICTION[o] for o in ("GOVERNOR", "MAYOR", "COUNCILOR")}
    return tally.jurisdiction_tally(rows, "office", wanted, ["candidate", "party"], "votes",
                                    ["region"])


NULLED = """
  SELECT year(o_orderdate) AS year, p_type AS position, p_brand AS candidate,
    CASE WHEN p_size < 25 THEN NULL ELSE 'P' || CAST(p_size AS varchar) END AS party,
    CAST(sum(l_quantity) AS bigint) AS votes
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2, 3, 4"""


def nulled(t):
    return t.sql("""
      SELECT year(o_orderdate) AS year, p_type AS position, p_brand AS candidate,
        CASE WHEN p_size < 25 THEN NULL ELSE concat('P', cast(p_size as string)) END AS party,
        cast(l_quantity as bigint) AS votes
      FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey""",
                 "lineitem", "orders", "part")


@query("national_tally", NULLED)
def national_tally(t):
    return tally.pooled_tally(nulled(t), ["year", "position"], ["candidate", "party"], "votes")


@query("national_tally_no_null", f"WITH v AS ({NULLED}) SELECT * FROM v WHERE party IS NOT NULL")
def national_tally_no_null(t):
    return tally.pooled_tally(nulled(t), ["year", "position"], ["candidate", "party"], "votes",
                              keep_null=False)


@query("national_topn", f"""
  WITH v AS ({NULLED}),
  r AS (SELECT *, CASE position WHEN 'SMALL' THEN 12 ELSE 1 END AS seats,
      row_number() OVER (PARTITION BY year, position ORDER BY votes DESC, candidate, party NULLS LAST)
        AS place FROM v)
  SELECT year, position, candidate, party, votes, CAST(place AS integer) AS place FROM r
  WHERE place <= seats""")
def national_topn(t):
    totals = tally.pooled_tally(nulled(t), ["year", "position"], ["candidate", "party"], "votes") \
        .withColumn("seats", F.when(F.col("position") == "SMALL", 12).otherwise(1))
    return tally.elect(totals, ["year", "position"], "votes", "seats", ["candidate", "party"],
                       tie_flag=False).drop("seats")


@query("leading_rows", """
  SELECT o_custkey, o_orderkey, o_totalprice, CAST(place AS integer) AS place FROM (
    SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (
      PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders)
  WHERE place <= 3""")
def leading(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return leading_rows(rows, ["o_custkey"], "o_totalprice", 3, ["o_orderkey"])


@query("top_row_flag", """
  SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey
    ORDER BY coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END, -1) DESC, o_orderkey) = 1 AS is_top
  FROM orders""")
def top_row_flag(t):
    rows = t.orders.select("o_orderkey", "o_custkey", F.when(
        F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"))
    return groups.flag_top_row(rows, ["o_custkey"], "price", "o_orderkey").select(
        "o_orderkey", "is_top")


@query("keep_first", """
  SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (
    PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def keep_first(t):
    rows = t.events.select("user_id", "event_type", "event_id", "value", "ts")
    return groups.keep_first(rows, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("collapse_max", """
  SELECT o_custkey, o_orderpriority, max(o_totalprice) AS o_totalprice FROM orders GROUP BY 1, 2""")
def collapse_max(t):
    return groups.collapse_max(t.orders, ["o_custkey", "o_orderpriority"], "o_totalprice")


CELLS = """
  WITH v AS (SELECT year(o_orderdate) AS year, n_name AS code, r_name AS prov, p_brand AS candidate,
      CAST(sum(l_quantity) AS bigint) AS votes
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
      JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3, 4)"""


def cell_rows(t):
    return t.sql("""
      SELECT year(o_orderdate) AS year, n_name AS code, r_name AS prov, p_brand AS candidate,
        cast(l_quantity as bigint) AS votes
      FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
        JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
        JOIN {part} ON l_partkey = p_partkey""",
                 "lineitem", "orders", "customer", "nation", "region", "part")


@query("result_cells", f"""{CELLS}, r AS (SELECT *, row_number() OVER w AS place,
      CAST(sum(votes) OVER (PARTITION BY year, code) AS bigint) AS total FROM v
    WINDOW w AS (PARTITION BY year, code ORDER BY votes DESC, candidate))
  SELECT year, code, candidate, votes, CAST(place AS integer) AS place, total FROM r
  WHERE place <= 6 AND total > 0""")
def result_cells(t):
    out = cells.result_cells(cell_rows(t), ["year", "code"], ["candidate"], "votes")
    return out.select("year", "code", "total", F.posexplode("top").alias("pos", "e")).select(
        "year", "code", "e.candidate", "e.votes", (F.col("pos") + 1).alias("place"), "total")


@query("rollup_cells", f"""{CELLS},
  a AS (SELECT year, CASE year WHEN 1999 THEN '-' ELSE prov END AS prov, candidate, sum(votes) AS votes FROM v GROUP BY 1, 2, 3
    UNION ALL SELECT year, prov, candidate, 10 * sum(votes) FROM v WHERE year = 1999 GROUP BY 1, 2, 3),
  r AS (SELECT *, row_number() OVER (PARTITION BY year, prov ORDER BY votes DESC, candidate) AS place,
      sum(votes) OVER (PARTITION BY year, prov) AS total FROM a)
  SELECT year, prov, candidate, CAST(votes AS bigint) AS votes, CAST(place AS integer) AS place,
    CAST(total AS bigint) AS total FROM r WHERE place <= 6""")
def rollup_cells(t):
    # The localities of cycle 1999 are in no province; a total reported for the provinces stands in.
    rows = cell_rows(t)
    keys = ["year", "prov"]
    known = rows.withColumn("prov", F.when(F.col("year") == 1999, "-").otherwise(F.col("prov")))
    rolled = cells.result_cells(known, keys, ["candidate"], "votes")
    reported = rows.withColumn("votes", F.col("votes") * 10)
    out = cells.with_province_totals(rolled, reported, keys, ["candidate"], "votes")
    return out.select("year", "prov", "total", F.posexplode("top").alias("pos", "e")).select(
        "year", "prov", "e.candidate", "e.votes", (F.col("pos") + 1).alias("place"), "total")


@query("placement_metrics", """
  WITH v AS (SELECT n_name AS a, c_mktsegment AS b, CASE WHEN r_name <> 'ASIA' THEN n_nationkey END AS code,
      sum(l_quantity) AS votes
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3)
  SELECT count(*) AS pairs, count(code) AS resolved, CAST(sum(votes) AS bigint) AS votes,
    CAST(sum(votes) FILTER (code IS NULL) AS bigint) AS unplaced,
    round(100.0 * sum(votes) FILTER (code IS NULL) / sum(votes), 3) AS unplaced_pct FROM v""")
def placement_metrics(t):
    return cells.placement_metrics(placed_rows(t), "code", "votes", ["a", "b"])


@query("unresolved_votes", """
  SELECT n_name AS a, c_mktsegment AS b, CAST(sum(l_quantity) AS bigint) AS votes
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE r_name = 'ASIA' GROUP BY 1, 2""")
def unresolved_votes(t):
    return cells.unresolved_votes(placed_rows(t), "code", "votes", ["a", "b"])


def placed_rows(t):
    return t.sql("""
      SELECT n_name AS a, c_mktsegment AS b, CASE WHEN r_name <> 'ASIA' THEN n_nationkey END AS code,
        cast(l_quantity as bigint) AS votes
      FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
        JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
                 "lineitem", "orders", "customer", "nation", "region")
