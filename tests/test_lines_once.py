"""Passes over document lines: the lines travel once for each pass, and what comes before is not worked out again."""

import pytest
from pyspark.sql import functions as F

from hustings.operators.ordered import previous, running
from hustings.sources import lists, pages


@pytest.fixture(scope="module")
def numbered(spark):
    data = [("d" if i % 2 else None, i // 7, i % 7, i if i % 5 == 0 else None) for i in range(60)]
    return spark.createDataFrame(data, "doc string, page int, line int, v int")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_not_joined(numbered):
    seen = running(numbered, ["doc"], "page", "line", last={"seen": F.col("v")}, total={"n": F.lit(1)})
    before = previous(numbered, ["doc"], "page", "line", {"line": "p"})
    for df in (seen, before):
        assert "Join" not in plan(df)
    got = {(r.doc, r.n): r.seen for r in seen.collect()}
    for doc in (None, "d"):
        last = None
        for n, i in enumerate(range(0 if doc is None else 1, 60, 2), 1):
            last = i if i % 5 == 0 else last
            assert got[doc, n] == last


def test_parsers_start_from_stored_lines(spark):
    text = ["CAR", "ABRA", "MAYOR", "CRUZ,  ANA", "LP", "M", "Page 1", "7"]
    lines = spark.createDataFrame([("a", i // 3, i % 3, t) for i, t in enumerate(text)], "doc string, page int, line int, text string")
    rendered = lines.withColumn("seq", F.col("page") * 3 + F.col("line"))
    for df in (lists.parse_listing(lines, "citymun"), lists.parse_records(lines, "citymun"), lists.parse_sexes(lines),
               pages.text_results(rendered, ["doc"], "page", "line", "text", "seq")):
        assert "LogicalRDD" not in plan(df) and "Relation" in plan(df)
        assert plan(df).count("Relation") <= 8
    assert [r.name for r in lists.parse_listing(lines, "citymun").collect()] == ["CRUZ, ANA"]
