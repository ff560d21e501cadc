"""Linkage, fills, anti-joins and set operations over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hustings.catalog.registry import query
from hustings.operators import groups, linkage, reshape
from hustings.plans.backfill import learned_given_sexes
from hustings.sources.ballots import merge_secondary


@query("unambiguous_index", """
  SELECT c_nationkey, c_mktsegment, min(b) AS band FROM (
    SELECT c_nationkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN 'low' WHEN c_acctbal < 9500 THEN 'mid' END AS b
    FROM customer) WHERE b IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT b) = 1""")
def unambiguous_index(t):
    rows = t.sql("""SELECT c_nationkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN 'low'
      WHEN c_acctbal < 9500 THEN 'mid' END AS band FROM {customer}""", "customer")
    return linkage.unambiguous_index(rows, ["c_nationkey", "c_mktsegment"], "band")


INDEXES = """
  o AS (SELECT o_orderkey, o_custkey, o_orderpriority, c_nationkey, c_mktsegment, year(o_orderdate) AS y
        FROM orders JOIN customer ON o_custkey = c_custkey),
  i1 AS (SELECT o_custkey, min(o_orderstatus) AS v FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) = 1),
  s AS (SELECT c_nationkey, c_mktsegment, year(o_orderdate) AS y, o_orderpriority,
          CASE WHEN o_totalprice > 300000 THEN o_orderstatus END AS known FROM orders JOIN customer ON o_custkey = c_custkey),
  i2 AS (SELECT c_nationkey, c_mktsegment, y, o_orderpriority, min(known) AS v FROM s GROUP BY 1, 2, 3, 4
         HAVING count(DISTINCT known) = 1),
  i3 AS (SELECT c_nationkey, c_mktsegment, y, min(known) AS v FROM s GROUP BY 1, 2, 3 HAVING count(DISTINCT known) = 1)"""


def link_tables(t):
    rows = t.sql("""SELECT o_orderkey, o_custkey, o_orderpriority, c_nationkey, c_mktsegment, o_orderstatus,
      year(o_orderdate) AS y, o_totalprice FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
                 "orders", "customer")
    # cheap orders do not tell their status; the index leaves unknown values out
    known = F.when(F.col("o_totalprice") > 300000, F.col("o_orderstatus"))
    dear = rows.withColumn("o_orderstatus", known)
    keys = ["c_nationkey", "c_mktsegment", "y"]
    return (rows, linkage.unambiguous_index(rows, ["o_custkey"], "o_orderstatus"),
            linkage.unambiguous_index(dear, [*keys, "o_orderpriority"], "o_orderstatus"),
            linkage.unambiguous_index(dear, keys, "o_orderstatus"))


@query("staged_linkage", f"""
  WITH {INDEXES}
  SELECT o_orderkey, coalesce(i1.v, i2.v, CASE WHEN o.o_orderpriority <> '5-LOW' THEN i3.v END) AS status,
    CASE WHEN i1.v IS NOT NULL THEN 'person' WHEN i2.v IS NOT NULL THEN 'exact'
      WHEN i3.v IS NOT NULL AND o.o_orderpriority <> '5-LOW' THEN 'loose' END AS source
  FROM o LEFT JOIN i1 USING (o_custkey) LEFT JOIN i2 USING (c_nationkey, c_mktsegment, y, o_orderpriority)
    LEFT JOIN i3 USING (c_nationkey, c_mktsegment, y)""")
def staged_linkage(t):
    rows, person, exact, loose = link_tables(t)
    keys = ["c_nationkey", "c_mktsegment", "y"]
    return linkage.staged_lookup(rows.drop("o_orderstatus"), [
        linkage.Stage(person, ["o_custkey"], ["o_custkey"], "o_orderstatus", "person"),
        linkage.Stage(exact, [*keys, "o_orderpriority"], [*keys, "o_orderpriority"],
                      "o_orderstatus", "exact"),
        linkage.Stage(loose, keys, keys, "o_orderstatus", "loose",
                      F.col("o_orderpriority") != "5-LOW"),
    ], "status", "source").select("o_orderkey", "status", "source")


@query("fill_blanks", f"""
  WITH {INDEXES}
  SELECT orders.o_orderkey, CASE WHEN o_totalprice < 100000 AND o.y BETWEEN 1996 AND 1999 AND coalesce(i2.v, i3.v) IS NOT NULL
      THEN coalesce(i2.v, i3.v) WHEN o_totalprice < 100000 THEN ' ' ELSE o_orderstatus END AS status,
    CASE WHEN o_totalprice >= 100000 THEN 'original' WHEN o.y NOT BETWEEN 1996 AND 1999 THEN ''
      WHEN i2.v IS NOT NULL THEN 'exact' WHEN i3.v IS NOT NULL THEN 'loose' ELSE '' END AS source
  FROM orders JOIN o ON orders.o_orderkey = o.o_orderkey LEFT JOIN i2 ON o.c_nationkey = i2.c_nationkey
    AND o.c_mktsegment = i2.c_mktsegment AND o.y = i2.y AND o.o_orderpriority = i2.o_orderpriority
    LEFT JOIN i3 ON o.c_nationkey = i3.c_nationkey AND o.c_mktsegment = i3.c_mktsegment AND o.y = i3.y""")
def fill_blanks(t):
    rows, _, exact, loose = link_tables(t)
    keys = ["c_nationkey", "c_mktsegment", "y"]
    blank = F.col("o_totalprice") < 100000
    target = rows.withColumn("status", F.when(blank, F.lit(" ")).otherwise(F.col("o_orderstatus"))) \
        .withColumn("source", F.when(blank, F.lit("")).otherwise("original"))
    looked = linkage.staged_lookup(target, [
        linkage.Stage(exact, [*keys, "o_orderpriority"], [*keys, "o_orderpriority"],
                      "o_orderstatus", "exact"),
        linkage.Stage(loose, keys, keys, "o_orderstatus", "loose"),
    ], "hit", "label")
    return linkage.fill_blanks(looked, "status", "hit", "label", "source",
                               eligible=F.col("y").between(1996, 1999)) \
        .select("o_orderkey", "status", "source")


@query("majority_dictionary", """
  WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2),
  m AS (SELECT user_id, sum(n) AS support, max(n) AS top FROM c GROUP BY 1)
  SELECT user_id, min(event_type) AS event_type, CAST(support AS bigint) AS support,
    round(top / support, 6) AS share
  FROM m JOIN c USING (user_id) WHERE n = top AND support >= 5 AND top >= 0.26 * support
  GROUP BY user_id, support, top""")
def majority_dictionary(t):
    return linkage.majority_dictionary(t.events, "user_id", "event_type", 5, 0.26) \
        .withColumn("share", F.round("share", 6))


@query("learned_dictionary", """
  WITH p AS (SELECT upper(split_part(p_name, ' ', 1)) AS given, CASE WHEN p_size > 12 THEN 'M' ELSE 'F' END AS sex
             FROM part),
  c AS (SELECT given, sex, count(*) AS n FROM p GROUP BY 1, 2),
  m AS (SELECT given, sum(n) AS support, max(n) AS top FROM c GROUP BY 1)
  SELECT given, min(sex) AS sex FROM m JOIN c USING (given) WHERE n = top AND support >= 2 AND top >= 0.8 * support
  GROUP BY given""")
def learned_dictionary(t):
    rows = t.sql("""SELECT p_name AS first_name, '' AS middle_name,
      CASE WHEN p_size > 12 THEN 'M' ELSE 'F' END AS sex FROM {part}""", "part")
    return learned_given_sexes(rows)


@query("mode_backfill", """
  WITH c AS (SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS seg FROM customer),
  n AS (SELECT c_nationkey, seg, count(*) AS n FROM c WHERE seg IS NOT NULL GROUP BY 1, 2),
  m AS (SELECT c_nationkey, seg AS mode FROM n
        QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, seg) = 1)
  SELECT c_custkey, coalesce(seg, mode) AS seg FROM c LEFT JOIN m USING (c_nationkey)""")
def mode_backfill(t):
    rows = t.sql("""SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS seg
      FROM {customer}""", "customer")
    return groups.fill_from_mode(rows, "c_nationkey", "seg").select("c_custkey", "seg")


@query("corrections", """
  SELECT c_custkey, CASE WHEN n_nationkey < 4 THEN r_name ELSE c_name END AS c_name,
    CASE WHEN n_nationkey < 4 THEN NULL ELSE c_mktsegment END AS c_mktsegment
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def corrections(t):
    # a rule for every nation; those from 4 on have no key yet, so they meet nobody
    placed = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left") \
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(*t.customer.columns)
    fixes = t.sql("""SELECT CASE WHEN n_nationkey < 4 THEN n_nationkey END AS k, r_name AS name,
      cast(null as string) AS seg FROM {nation} LEFT JOIN {region} ON n_regionkey = r_regionkey""", "nation", "region").distinct()
    return linkage.apply_corrections(placed, fixes, {"c_nationkey": "k"},
                                     {"c_name": "name", "c_mktsegment": "seg"}) \
        .select("c_custkey", "c_name", "c_mktsegment")


@query("votes_for_winners", """
  SELECT c_custkey, o_orderpriority AS priority, max(o_totalprice) AS votes
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey
  GROUP BY 1, 2""")
def votes_for_winners(t):
    votes = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("votes"))
    best = groups.collapse_max(votes, ["c_custkey", "priority"], "votes")
    return t.customer.select("c_custkey").join(best, "c_custkey", "left")


@query("secondary_merge", """
  SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderpriority FROM orders s WHERE o_orderstatus <> 'F' AND NOT EXISTS (
    SELECT 1 FROM orders p WHERE p.o_orderstatus = 'F' AND p.o_custkey = s.o_custkey
      AND p.o_orderpriority = s.o_orderpriority)""")
def secondary_merge(t):
    rows = t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"),
                           "o_orderpriority", "o_orderstatus")
    primary = rows.filter(F.col("o_orderstatus") == "F").drop("o_orderstatus")
    mirror = rows.filter(F.col("o_orderstatus") != "F").drop("o_orderstatus")
    merged = merge_secondary(primary, mirror, ["o_custkey", "o_orderpriority"])
    return merged.withColumn("o_custkey", F.col("o_custkey").cast("bigint"))


@query("missing_keys", """
  SELECT DISTINCT o_custkey, year(o_orderdate) + 1 AS year FROM orders
  EXCEPT SELECT o_custkey, year(o_orderdate) FROM orders""")
def missing_keys(t):
    # whoever ordered in a year is expected in the next
    present = t.orders.select("o_custkey", F.year("o_orderdate").cast("bigint").alias("year"))
    return linkage.missing_keys(present.withColumn("year", F.col("year") + 1), present, ["o_custkey", "year"])


@query("known_keys", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT user_id FROM events)")
def known_keys(t):
    users = t.events.select(F.col("user_id").alias("o_custkey"))
    return linkage.known_keys(t.orders, users, ["o_custkey"]).select("o_orderkey")


@query("count_difference", """
  WITH a AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1),
  b AS (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1)
  SELECT k, coalesce(a.n, 0) AS customers, coalesce(b.n, 0) AS suppliers,
    coalesce(b.n, 0) - coalesce(a.n, 0) AS difference FROM a FULL JOIN b USING (k)
  WHERE abs(difference) > 1""")
def count_difference(t):
    return linkage.count_difference(
        t.customer.withColumnRenamed("c_nationkey", "k"),
        t.supplier.withColumnRenamed("s_nationkey", "k"), ["k"],
        names=("customers", "suppliers"))


@query("withheld_keys", """
  SELECT o_orderkey FROM orders WHERE (year(o_orderdate), o_orderpriority) NOT IN
    (SELECT year(o_orderdate), o_orderpriority FROM orders GROUP BY ALL HAVING sum(o_totalprice) > 1.2 * (
       SELECT avg(s) FROM (SELECT sum(o_totalprice) AS s FROM orders GROUP BY year(o_orderdate), o_orderpriority)))""")
def withheld_keys(t):
    rows = t.sql("""SELECT o_orderkey, year(o_orderdate) AS year, o_orderpriority AS position, o_totalprice
      FROM {orders}""", "orders")
    sums = rows.groupBy("year", "position").agg(F.sum("o_totalprice").alias("s"))
    mean = sums.agg((F.avg("s") * 1.2).alias("m"))
    withheld = sums.filter(F.col("s") > mean.scalar()).select("year", "position")
    return reshape.exclude_keys(rows, withheld).select("o_orderkey")


@query("superseded_cycles", """
  SELECT o_orderkey, year(o_orderdate) AS year, o_totalprice AS price FROM orders WHERE year(o_orderdate) NOT IN (1998, 2000)
  UNION ALL SELECT o_orderkey, year(o_orderdate), NULL FROM orders WHERE o_orderstatus = 'F' AND year(o_orderdate) IN (1998, 2000)""")
def superseded_cycles(t):
    rows = t.sql("SELECT o_orderkey, year(o_orderdate) AS year, o_totalprice AS price, o_orderstatus "
                 "FROM {orders}", "orders")
    inherited = rows.drop("o_orderstatus")
    fresh = rows.filter((F.col("o_orderstatus") == "F") & F.col("year").isin(1998, 2000)) \
        .select("o_orderkey", "year")
    return reshape.replace_periods(inherited, fresh, "year", [1998, 2000])


@query("duplicate_rows", """
  SELECT DISTINCT user_id, event_type, CASE WHEN value > 5 THEN CAST(floor(value) AS bigint) END AS v FROM events""")
def duplicate_rows(t):
    rows = t.sql("""SELECT user_id, event_type, CASE WHEN value > 5 THEN cast(floor(value) as bigint) END AS v
      FROM {events}""", "events")
    return groups.drop_duplicate_rows(rows)


@query("duplicate_count", """
  SELECT (SELECT count(*) FROM events) - (SELECT count(*) FROM (
    SELECT DISTINCT user_id, event_type, CASE WHEN value > 5 THEN floor(value) END FROM events)) AS removed""")
def duplicate_count(t):
    rows = t.sql("""SELECT user_id, event_type, CASE WHEN value > 5 THEN cast(floor(value) as bigint) END AS v
      FROM {events}""", "events")
    return groups.duplicate_count(rows)


@query("key_intersection", """
  SELECT o_custkey AS k FROM orders INTERSECT SELECT user_id FROM events""")
def key_intersection(t):
    return linkage.common_keys(t.orders.withColumnRenamed("o_custkey", "k"), t.events.withColumnRenamed("user_id", "k"), ["k"])


@query("known_answers", "SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def known_answers(t):
    from hustings.operators.audit import expect_rows
    seen = t.events.select(F.col("user_id").alias("c_custkey"))
    return expect_rows(seen, t.customer.select("c_custkey", "c_nationkey"), ["c_custkey"])
