"""Audits over whole tables."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from hustings.catalog.registry import query
from hustings.functions.text import fold_spelling
from hustings.operators import audit
from hustings.plans.audits import roster_gaps
from hustings.streaming.landing import latest_files, refetch_worklist, refetched

GAPS = """
  SELECT o_orderkey, year(o_orderdate) AS year, CASE WHEN year(o_orderdate) <> 1996 THEN o_orderstatus END AS status,
    CASE WHEN year(o_orderdate) <> 1997 OR o_totalprice < 100000 THEN o_orderpriority END AS priority,
    CASE WHEN o_totalprice > 30000 THEN o_totalprice END AS price FROM {orders}"""
GAPS_SQL = GAPS.replace("{", "").replace("}", "")


@query("null_profile", f"""
  WITH g AS ({GAPS_SQL}), c AS (SELECT year, count(*) AS total, count(*) - count(status) AS s,
    count(*) - count(priority) AS p, count(*) - count(price) AS r FROM g GROUP BY 1)
  SELECT year, "column", nulls, total, CASE WHEN nulls = total THEN 'high' WHEN nulls > 0.5 * total THEN 'medium' END AS severity
  FROM (SELECT year, total, 'status' AS "column", s AS nulls FROM c UNION ALL SELECT year, total, 'priority', p FROM c
        UNION ALL SELECT year, total, 'price', r FROM c) WHERE nulls > 0""")
def null_profile(t):
    return audit.null_profile(t.sql(GAPS, "orders"), "year", ["status", "priority", "price"])


@query("level_collapse", """
  WITH o AS (SELECT year(o_orderdate) AS year, CASE WHEN o_orderpriority = '5-LOW' AND year(o_orderdate) = 1998 THEN '4-NOT SPECIFIED'
        WHEN o_orderpriority = '2-HIGH' AND year(o_orderdate) = 1999 AND o_totalprice < 400000 THEN '3-MEDIUM' ELSE o_orderpriority END AS level
      FROM orders),
  c AS (SELECT year, level, count(*) AS n FROM o GROUP BY 1, 2),
  g AS (SELECT y.year, l.level, coalesce(n, 0) AS n FROM (SELECT DISTINCT year FROM c) y CROSS JOIN
          (SELECT DISTINCT level FROM c) l LEFT JOIN c ON c.year = y.year AND c.level = l.level),
  m AS (SELECT level, median(n) AS median FROM g GROUP BY 1)
  SELECT year, level, n, median FROM g JOIN m USING (level) WHERE median > 0 AND n < 0.5 * median""")
def level_collapse(t):
    rows = t.sql("""SELECT year(o_orderdate) AS year, CASE WHEN o_orderpriority = '5-LOW' AND year(o_orderdate) = 1998 THEN '4-NOT SPECIFIED'
        WHEN o_orderpriority = '2-HIGH' AND year(o_orderdate) = 1999 AND o_totalprice < 400000 THEN '3-MEDIUM' ELSE o_orderpriority END AS level
      FROM {orders}""", "orders")
    return audit.level_collapse(rows, "year", "level")


@query("count_drift", """
  WITH truth AS (SELECT c_mktsegment AS segment, count(*) AS expected FROM customer GROUP BY 1),
  c AS (SELECT c_mktsegment AS segment, year(o_orderdate) AS year, count(*) AS n FROM orders JOIN customer
        ON o_custkey = c_custkey GROUP BY 1, 2)
  SELECT segment, year, n, expected, round((n - expected) / expected, 6) AS drift,
    CASE WHEN n > expected THEN 'more' ELSE 'fewer' END AS direction
  FROM c JOIN truth USING (segment) WHERE abs(n - expected) / expected > 0.05""")
def count_drift(t):
    truth = t.customer.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("expected"))
    rows = t.sql("""SELECT c_mktsegment AS segment, year(o_orderdate) AS year FROM {orders}
      JOIN {customer} ON o_custkey = c_custkey""", "orders", "customer")
    return audit.count_drift(rows, truth, "segment", "year").withColumn("drift", F.round("drift", 6))


DUPS = "SELECT user_id, event_type, CAST(floor(value / 5) AS bigint) AS v, day(ts) AS d FROM {events}"


@query("exact_duplicates", """
  SELECT d, sum(n - 1)::bigint AS duplicates FROM (SELECT user_id, event_type, floor(value / 5) AS v, day(ts) AS d, count(*) AS n
    FROM events GROUP BY ALL) WHERE n > 1 GROUP BY 1""")
def exact_duplicates(t):
    return audit.exact_duplicates(t.sql(DUPS, "events"), "d")


@query("shared_keys", """
  SELECT d, count(*) AS rows FROM (SELECT day(ts) AS d, count(*) OVER (PARTITION BY user_id, event_type, day(ts)) AS n
    FROM events) WHERE n > 1 GROUP BY 1""")
def shared_keys(t):
    return audit.shared_keys(t.sql(DUPS, "events"), ["user_id", "event_type", "d"], "d")


@query("spelling_variants", """
  WITH v AS (SELECT DISTINCT year(o_orderdate) AS year, n_name, CASE WHEN year(o_orderdate) < 1997 THEN replace(n_name, '_', '-')
      WHEN year(o_orderdate) < 1999 THEN replace(n_name, '_', ', ') ELSE n_name END AS raw
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
  SELECT replace(n_name, '_', ' ') AS norm, raw, string_agg(year, ',' ORDER BY year) AS periods, 2 AS spellings
  FROM v WHERE raw <> n_name GROUP BY n_name, raw""")
def spelling_variants(t):
    rows = t.sql("""SELECT year(o_orderdate) AS year, CASE WHEN year(o_orderdate) < 1997 THEN replace(n_name, '_', '-')
        WHEN year(o_orderdate) < 1999 THEN replace(n_name, '_', ', ') ELSE n_name END AS raw
      FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey""",
                 "orders", "customer", "nation")
    return audit.spelling_variants(rows, "raw", fold_spelling("raw"), "year").withColumn(
        "periods", F.array_join(F.col("periods").cast("array<string>"), ","))


@query("file_coverage", """
  SELECT o_custkey, year(o_orderdate) AS year, count(*) AS rows, count(DISTINCT o_orderpriority) AS positions,
    CAST(sum(floor(o_totalprice)) AS bigint) AS total_votes FROM orders GROUP BY 1, 2""")
def file_coverage(t):
    rows = t.orders.select("o_custkey", F.year("o_orderdate").alias("year"), "o_orderpriority",
                           F.floor("o_totalprice").alias("votes"))
    return audit.file_coverage(rows, ["o_custkey", "year"], "o_orderpriority", "votes")


@query("locality_counts", """
  SELECT year(o_orderdate) AS year, count(DISTINCT o_custkey) AS localities, count(DISTINCT c_nationkey) AS areas,
    count(*) AS rows FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def locality_counts(t):
    return audit.locality_counts(placed(t), "year", "o_custkey", "c_nationkey")


def placed(t):
    return t.sql("""SELECT year(o_orderdate) AS year, o_custkey, c_nationkey FROM {orders}
      JOIN {customer} ON o_custkey = c_custkey""", "orders", "customer")


GAPS_BY_YEAR = """
  l AS (SELECT DISTINCT year(o_orderdate) AS year, o_custkey FROM orders),
  g AS (SELECT a.year AS present_in, y.year AS missing_from, a.o_custkey FROM l a JOIN (SELECT DISTINCT year FROM l) y
        ON a.year <> y.year WHERE NOT EXISTS (SELECT 1 FROM l b WHERE b.year = y.year AND b.o_custkey = a.o_custkey))"""


@query("locality_gaps", f"WITH {GAPS_BY_YEAR} SELECT * FROM g")
def locality_gaps(t):
    return audit.locality_gap_pairs(placed(t), "year", "o_custkey")


@query("locality_gap_pairs", f"WITH {GAPS_BY_YEAR} SELECT * FROM g")
def locality_gap_pairs(t):
    return audit.locality_gap_pairs(placed(t), "year", "o_custkey")


@query("gap_report", f"""WITH {GAPS_BY_YEAR}
  SELECT present_in, missing_from, localities, sample FROM (
    SELECT present_in, missing_from, count(*) AS localities FROM g GROUP BY 1, 2) JOIN (
    SELECT present_in, missing_from, string_agg(o_custkey, ',' ORDER BY o_custkey) AS sample FROM (
      SELECT *, row_number() OVER (PARTITION BY present_in, missing_from ORDER BY o_custkey) AS rn FROM g)
    WHERE rn <= 8 GROUP BY 1, 2) USING (present_in, missing_from)""")
def gap_report(t):
    gaps = audit.locality_gap_pairs(placed(t), "year", "o_custkey")
    return audit.gap_report(gaps, "o_custkey").withColumn(
        "sample", F.array_join(F.col("sample").cast("array<string>"), ","))


@query("organisation_fields", """
  SELECT count(*) AS rows, count(*) FILTER (o_totalprice > 450000) AS with_field FROM orders WHERE o_orderstatus = 'P'""")
def organisation_fields(t):
    rows = t.orders.withColumn("last", F.when(F.col("o_totalprice") > 450000, "x"))
    return audit.person_fields_on_organisations(rows, F.col("o_orderstatus") == "P", "last")


@query("missing_rate", """
  SELECT count(*) AS rows, count(*) FILTER (value <= 5) AS missing, round(count(*) FILTER (value <= 5) / count(*), 6) AS share
  FROM events""")
def missing_rate(t):
    rows = t.events.withColumn("v", F.when(F.col("value") > 5, F.col("value")))
    return audit.missing_rate(rows, "v").withColumn("share", F.round("share", 6))


@query("category_summary", """
  SELECT c_mktsegment, count(*) AS rows, CAST(sum(floor(o_totalprice)) AS bigint) AS votes,
    (SELECT string_agg(p, ', ' ORDER BY p) FROM (SELECT DISTINCT o_orderpriority AS p FROM orders)) AS offices
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def category_summary(t):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).withColumn(
        "v", F.floor("o_totalprice"))
    return audit.category_summary(rows, "c_mktsegment", "o_orderpriority", "v")


RAN = """
  SELECT year(o_orderdate) AS year, n_name AS area, concat(c_mktsegment, ' ', chr(65 + o_custkey % 26), chr(65 + o_custkey % 17), chr(65 + o_custkey % 11)) AS surname
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey"""
RAN_SQL = re.sub(r"chr\((.*?)\)", r"chr(CAST(\1 AS integer))", RAN).replace("{", "").replace("}", "")


@query("agreement", f"""
  WITH r AS ({RAN_SQL}),
  f AS (SELECT DISTINCT year, regexp_replace(area, '[^A-Z ]', '', 'g') AS a, surname AS s FROM r),
  g AS (SELECT DISTINCT year + 1 AS year, a, s FROM f)
  SELECT f.year, count(*) AS elected, count(*) FILTER (g.s IS NULL) AS orphans,
    round(100.0 * count(*) FILTER (g.s IS NULL) / count(*), 6) AS pct
  FROM f LEFT JOIN g ON f.year = g.year AND f.a = g.a AND f.s = g.s WHERE f.year IN (SELECT year FROM g) GROUP BY 1""")
def agreement(t):
    # customers of a year against those of the year before
    won = t.sql(RAN, "orders", "customer", "nation")
    cast = won.select((F.col("year") + 1).alias("year"), "area", F.concat("surname", F.lit(", X")).alias("name"))
    return audit.agreement(won, cast, "year", "area", "surname", F.split("name", ",")[0]) \
        .withColumn("pct", F.round("pct", 6))


SHORT_SQL = """
  c AS (SELECT user_id, event_type, count(DISTINCT hour(ts)) AS n FROM events GROUP BY 1, 2),
  m AS (SELECT event_type, max(n) AS "full" FROM c GROUP BY 1)"""


def options(t):
    return t.sql("SELECT DISTINCT user_id, event_type, hour(ts) AS option FROM {events}", "events")


@query("short_races", f"""WITH {SHORT_SQL} SELECT user_id, event_type, n, "full" FROM c JOIN m USING (event_type)
  WHERE n < "full" """)
def short_races(t):
    return audit.short_races(options(t), ["user_id"], "event_type")


@query("incomplete_localities", f"""WITH {SHORT_SQL}
  SELECT user_id, event_type || ': ' || n || ' of ' || "full" AS reason FROM c JOIN m USING (event_type)
  WHERE n < "full" AND event_type IN ('view', 'click')
  UNION ALL SELECT user_id, 'no purchase' FROM events GROUP BY 1 HAVING NOT bool_or(event_type = 'purchase' AND hour(ts) = 3)""")
def incomplete_localities(t):
    return audit.incomplete_localities(
        options(t), ["user_id"], "event_type", F.col("event_type").isin("view", "click"),
        (F.col("event_type") == "purchase") & (F.col("option") == 3), "no purchase")


@query("required_everywhere", """
  SELECT CAST(y AS integer) AS year FROM (VALUES (1995), (1996), (2010)) v(y) WHERE y NOT IN (SELECT year(o_orderdate) FROM orders
    JOIN customer ON o_custkey = c_custkey WHERE c_name LIKE '%00042%')""")
def required_everywhere(t):
    rows = t.sql("SELECT year(o_orderdate) AS year, c_name FROM {orders} JOIN {customer} ON o_custkey = c_custkey",
                 "orders", "customer")
    return audit.required_everywhere(rows, "year", [1995, 1996, 2010], "c_name", "00042")


@query("roster_gaps", """
  WITH f AS (SELECT DISTINCT CASE WHEN n_nationkey % 3 = 0 THEN 'ELSEWHERE' ELSE r_name END AS region, n_name AS province
      FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
  SELECT r_name AS region, n_name AS province, (SELECT min(f.region) FROM f WHERE f.province = n_name) AS filed_under
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE (r_name, n_name) NOT IN (SELECT region, province FROM f)""")
def gaps_of_roster(t):
    found = t.sql("""SELECT CASE WHEN n_nationkey % 3 = 0 THEN 'ELSEWHERE' ELSE r_name END AS region, n_name AS province
      FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""", "supplier", "nation", "region")
    roster = t.sql("SELECT r_name AS region, n_name AS province FROM {nation} JOIN {region} ON n_regionkey = r_regionkey",
                   "nation", "region")
    return roster_gaps(found, roster, ["region", "province"])


@query("row_counts", """
  SELECT year(o_orderdate) AS year, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2""")
def row_counts(t):
    return audit.row_counts(t.orders.withColumn("year", F.year("o_orderdate")), ["year", "o_orderpriority"])


@query("low_count_spots", """
  SELECT l_returnflag, count(*) AS n, count(*) FILTER (l_quantity < 10) AS low FROM lineitem GROUP BY 1""")
def low_count_spots(t):
    return audit.low_count_spots(t.lineitem, "l_returnflag", "l_quantity", 10)


@query("latest_files", """
  SELECT user_id, event_type, event_id FROM (SELECT *, dense_rank() OVER (PARTITION BY user_id ORDER BY ts DESC) AS r FROM events)
  WHERE r = 1""")
def latest(t):
    rows = t.events.select("user_id", "event_type", "event_id", "ts",
                           F.col("ts").cast("string").alias("file"))
    return latest_files(rows, ["user_id"], "file", "ts").select("user_id", "event_type", "event_id")


@query("refetch_worklist", """
  WITH c AS (SELECT user_id, event_type, count(DISTINCT hour(ts)) AS n FROM events GROUP BY 1, 2),
  m AS (SELECT event_type, max(n) AS "full" FROM c GROUP BY 1)
  SELECT 'P' AS province, user_id AS city, event_type || ': ' || n || ' of ' || "full" AS reason FROM c JOIN m USING (event_type)
    WHERE n < "full" AND event_type = 'view'
  UNION ALL SELECT 'P', user_id, 'no MAYOR race' FROM events GROUP BY 2 HAVING NOT bool_or(event_type = 'purchase' AND hour(ts) = 5)
  UNION ALL SELECT 'P', c_custkey, 'not landed' FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)""")
def worklist(t):
    landed = t.sql("SELECT DISTINCT 'P' AS province, user_id AS city, event_type AS position, hour(ts) AS h FROM {events}",
                   "events")
    roster = t.customer.select(F.lit("P").alias("province"), F.col("c_custkey").alias("city"))
    return refetch_worklist(landed, roster, F.col("position") == "view",
                            (F.col("position") == "purchase") & (F.col("h") == 5))


@query("refetched", """
  SELECT event_id, user_id, event_type, 'old' AS batch FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE value > 55)
  UNION ALL SELECT event_id, user_id, event_type, 'new' FROM events WHERE value > 55""")
def replaced(t):
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    fresh = rows.filter(F.col("value") > 55).drop("value").withColumn("batch", F.lit("new"))
    return refetched(rows.drop("value").withColumn("batch", F.lit("old")), fresh, ["user_id"])
