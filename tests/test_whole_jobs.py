"""Queries that once did less than their job, on rows of their own."""

from pyspark.sql import functions as F

from hustings.catalog import load


def test_corrections_look_nations_and_regions_up(spark, tmp_path):
    spark.createDataFrame([(1, "a", 2, "X"), (2, "b", 7, "Y"), (3, "c", None, "Z")],
                          "c_custkey long, c_name string, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(2, 5), (7, 7)], "n_nationkey int, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(5, "FIVE"), (7, "SEVEN")], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    got = {tuple(r) for r in load()[0]["corrections"](spark, str(tmp_path)).collect()}
    assert got == {(1, "FIVE", None), (2, "b", "Y"), (3, "c", "Z")}


def test_locality_gaps_have_a_row_for_each_pair(spark, tmp_path):
    spark.sql("""SELECT * FROM VALUES (1L, 1L, TIMESTAMP '1995-05-01', 'F', 1.0D), (2L, 1L, TIMESTAMP '1996-05-01', 'F', 1.0D),
      (3L, 2L, TIMESTAMP '1997-05-01', 'F', 1.0D) AS t(o_orderkey, o_custkey, o_orderdate, o_orderstatus, o_totalprice)""") \
        .withColumn("o_orderpriority", F.lit("1-URGENT")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT id + 1 AS c_custkey, 0 AS c_nationkey FROM range(2)").write.parquet(f"{tmp_path}/customer.parquet")
    got = {tuple(r) for r in load()[0]["locality_gaps"](spark, str(tmp_path)).select("present_in", "missing_from", "o_custkey").collect()}
    assert got == {(1995, 1997, 1), (1996, 1997, 1), (1997, 1995, 2), (1997, 1996, 2)}
