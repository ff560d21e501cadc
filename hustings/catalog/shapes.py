"""Reshaping and dictionary codes over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hustings.catalog.registry import query
from hustings.operators import reshape
from hustings.sources.ballots import restrict, wide_to_long
from hustings.sources.sinks import nested_rows


@query("melt_columns", """
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, name, value FROM (
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
  UNPIVOT (value FOR name IN (l_quantity, l_extendedprice, l_discount, l_tax))""")
def melt_columns(t):
    return reshape.melt(t.lineitem, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
                        ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "name", "value")


WIDE_SQL = """
  SELECT CASE WHEN o_orderpriority = '5-LOW' THEN ' ' ELSE o_orderpriority END AS place, o_orderkey AS id,
    CASE WHEN o_orderstatus = 'F' THEN format('{:,}', CAST(floor(o_totalprice) AS bigint)) ELSE '-' END AS a,
    CASE WHEN o_orderstatus = 'O' THEN CAST(CAST(floor(o_totalprice) AS bigint) AS varchar) ELSE ' ' END AS b,
    CAST(year(o_orderdate) AS varchar) || ' ' AS c FROM orders"""


@query("wide_to_long", f"""
  WITH w AS ({WIDE_SQL})
  SELECT place, id, position, candidate_name, CAST(replace(trim(v), ',', '') AS bigint) AS votes FROM (
    SELECT place, id, 'PRESIDENT' AS position, 'ANA DIAZ' AS candidate_name, a AS v FROM w
    UNION ALL SELECT place, id, 'VICE PRESIDENT', 'BO: CY', b FROM w UNION ALL SELECT place, id, 'SENATOR', 'D', c FROM w)
  WHERE trim(place) <> '' AND regexp_full_match(replace(trim(v), ',', ''), '[0-9]+')""")
def wide(t):
    rows = t.orders.select(
        F.when(F.col("o_orderpriority") == "5-LOW", " ").otherwise(F.col("o_orderpriority"))
        .alias("Municipality/City"), F.col("o_orderkey").alias("psgc.1"),
        F.when(F.col("o_orderstatus") == "F", F.format_number(F.floor("o_totalprice"), 0))
        .otherwise("-").alias("P: ANA DIAZ"),
        F.when(F.col("o_orderstatus") == "O", F.floor("o_totalprice").cast("string")).otherwise(" ")
        .alias("VP: BO: CY"),
        F.concat(F.year("o_orderdate").cast("string"), F.lit(" ")).alias("S: D"))
    return wide_to_long(rows, {"Municipality/City": "place", "psgc.1": "id"}, "`Municipality/City`")


@query("count_matrix", """
  SELECT c_nationkey, year(o_orderdate) AS year, count(*) FILTER (o_orderstatus = 'F') AS F,
    count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'X') AS X
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
def count_matrix(t):
    rows = t.sql("""SELECT c_nationkey, year(o_orderdate) AS year, o_orderstatus
      FROM {orders} JOIN {customer} ON o_custkey = c_custkey""", "orders", "customer")
    return reshape.count_matrix(rows, ["c_nationkey", "year"], "o_orderstatus", ["F", "O", "X"])


CODED = """
  SELECT o_orderkey, o_orderpriority AS priority, CASE WHEN o_orderstatus <> 'P' THEN n_name END AS place,
    c_name AS person
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey"""
CODED_TABLES = ["orders", "customer", "nation"]
CODED_SQL = CODED.replace("{", "").replace("}", "")


@query("encode_columns", f"""
  WITH b AS ({CODED_SQL}),
  p AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT priority AS v FROM b)),
  n AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT place AS v FROM b WHERE place IS NOT NULL)),
  c AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT person AS v FROM b))
  SELECT o_orderkey, p.code AS priority, coalesce(n.code, -1) AS place, c.code AS person
  FROM b JOIN p ON priority = p.v LEFT JOIN n ON place = n.v JOIN c ON person = c.v""")
def encode_columns(t):
    return reshape.encode_columns(t.sql(CODED, *CODED_TABLES), ["priority", "place", "person"])[0]


@query("code_dictionary", f"""
  WITH b AS ({CODED_SQL}), v AS (SELECT DISTINCT 'priority' AS "column", priority AS value FROM b
    UNION SELECT 'place', place FROM b WHERE place IS NOT NULL UNION SELECT 'person', person FROM b)
  SELECT "column", value, row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS code FROM v""")
def code_dictionary(t):
    return reshape.encode_columns(t.sql(CODED, *CODED_TABLES), ["priority", "place", "person"])[1]


@query("surrogate_ids", """
  WITH b AS (SELECT event_id, event_type, CASE WHEN value > 1 THEN user_id END AS user_id FROM events),
  k AS (SELECT event_type, user_id, row_number() OVER (ORDER BY event_type, user_id NULLS FIRST) - 1 AS id
        FROM (SELECT DISTINCT event_type, user_id FROM b))
  SELECT event_id, b.event_type, b.user_id, id FROM b JOIN k ON b.event_type = k.event_type
    AND b.user_id IS NOT DISTINCT FROM k.user_id""")
def surrogate_ids(t):
    rows = t.events.select("event_id", "event_type",
                           F.when(F.col("value") > 1, F.col("user_id")).alias("user_id"))
    return reshape.surrogate_ids(rows, ["event_type", "user_id"], "id")


@query("aligned_union", """
  SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS double) AS balance FROM customer
  UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""")
def aligned_union(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                          F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                          F.col("s_acctbal").alias("balance"))
    return reshape.align_union([a, b], ["id", "name", "segment", "balance"])


@query("nested_rows", """
  SELECT n_nationkey AS n, '[' || n_nationkey || ', ' || n_name || ', ' || n_regionkey || ']' AS r FROM nation""")
def rows_as_arrays(t):
    rows = nested_rows(t.nation, ["n_nationkey"], ["n_nationkey", "n_name", "n_regionkey"])
    return rows.select(F.col("n_nationkey").alias("n"),
                       F.concat(F.lit("["), F.array_join("row", ", "), F.lit("]")).alias("r"))


@query("sample_values", """
  SELECT c_mktsegment, string_agg(c_name, ', ' ORDER BY c_name) AS names FROM (
    SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_name) AS rn FROM (
      SELECT DISTINCT c_mktsegment, c_name FROM customer)) WHERE rn <= 8 GROUP BY 1""")
def sample_values(t):
    return reshape.sample_values(t.customer, ["c_mktsegment"], "c_name", 8, "names") \
        .withColumn("names", F.array_join("names", ", "))


@query("sorted_nulls_last", """
  SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS p, o_totalprice FROM orders""")
def sorted_nulls_last(t):
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
                           .alias("p"), "o_totalprice")
    return reshape.sort_nulls_last(rows, [("p", False), ("o_totalprice", True)])


@query("restricted_cycles", """
  SELECT o_orderkey, year(o_orderdate) AS year FROM orders WHERE year(o_orderdate) IN (1997, 1999)
    AND o_orderpriority IN ('2-HIGH')""")
def restricted_cycles(t):
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"), "o_orderpriority")
    return restrict(rows, year=[1997, 1999], o_orderpriority=["2-HIGH"]).drop("o_orderpriority")
