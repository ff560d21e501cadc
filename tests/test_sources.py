"""Landed files, documents, sinks and incremental landing on small fixtures."""

import json
import os

import pytest
from pyspark.sql import functions as F

from hustings.sources import ballots, feeds, lists, pages, sinks
from hustings.streaming import landing

HEADER = "region,province,city,position,rank,candidate_name,party,votes,percentage\n"


def put(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding=encoding)
    return path


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_read_ballots(spark, tmp_path):
    root = tmp_path / "2016"
    put(root, "CAR/ABRA/CAR_ABRA_X.csv", HEADER + 'CAR,ABRA,X,"MAYOR, of X",1,"CRUZ, ""JUN""",,"12",44 %\nCAR,ABRA,X,MAYOR,-,NA,LP,3,\n')
    put(root, "CAR/ABRA/CAR_ABRA_Y.csv", HEADER)
    rows = ballots.read_ballots(spark, str(root))
    got = rows.select("year", "city", "position", "rank", "candidate_name", "party", "votes", "percentage").collect()
    assert {tuple(r) for r in got} == {(2016, "X", "MAYOR, of X", "1", 'CRUZ, "JUN"', None, "12", "44 %"),
                                       (2016, "X", "MAYOR", "-", "NA", "LP", "3", None)}
    place = ballots.place_from_path("source_file", "2016")
    assert {tuple(r) for r in rows.select(place["region"], place["province"], place["stem"]).collect()} == {("CAR", "ABRA", "CAR_ABRA_X")}
    listing = ballots.list_files(spark, str(root))
    empty = ballots.empty_files(listing, rows)
    assert [r.file.endswith("CAR_ABRA_Y.csv") for r in empty.collect()] == [True]
    assert ballots.read_optional(spark, str(tmp_path / "none.csv")) is None


def test_wide_and_archive(spark, tmp_path):
    path = put(tmp_path, "wide.csv", 'Region,Province,Municipality/City,P: ANA,"S: DIAZ, BO"\nR,Ñ,X,"1,234",-\nR,Ñ,,5,6\n', "latin-1")
    got = ballots.read_wide(spark, str(path), {"Region": "region", "Province": "province", "Municipality/City": "city"}, "Municipality/City", 2010)
    assert rows_of(got) == [("R", "Ñ", "X", "PRESIDENT", "ANA", 1234, 2010)]
    schema = "region string, province string, city string, position string, area string, candidate_name string, party string, votes string"
    main = spark.createDataFrame([("region-4a", "north-cotabato", "x-town", "MAYOR", "X", "A", "LP", "3"),
                                  ("region-4a", "north-cotabato", "x-town", "MAYOR", "X", "B", "LP", "1")], schema)
    mirror = spark.createDataFrame([("region-1", "north-cotabato", "x-town", "MAYOR", "X", "C", "LP", "9"),
                                    ("region-1", "abra", None, "GOVERNOR", None, "D", "LP", "x")], schema)
    got = ballots.shape_archive(main, 2013, mirror).select("region", "province", "city", "position", "candidate_name", "votes", "percentage", "rank")
    assert rows_of(got) == sorted([("REGION IV A", "COTABATO", "X TOWN", "MAYOR of X", "A", 3, 75.0, 1), ("REGION IV A", "COTABATO", "X TOWN", "MAYOR of X", "B", 1, 25.0, 2),
                                   ("REGION I", "ABRA", "", "GOVERNOR", "D", 0, None, 1)], key=str)


def lines(spark, text, per_page=4):
    return spark.createDataFrame([("a", i // per_page, i % per_page, t) for i, t in enumerate(text.strip().split("\n"))],
                                 "doc string, page int, line int, text string")


def test_listings(spark):
    text = """Republic of the Philippines
ABRA
CAR
BANGUED
MAYOR
1.
CRUZ, JUAN
PEDRO SANTOS
LP
M
COUNCILOR
FIRST DISTRICT
LIM, BO
2.
IND
M
BOLINEY
MAYOR
UY, D E
NP
F
NCR - FOURTH DISTRICT
MAKATI
MAYOR
OO, P Q
KBL
F"""
    got = lists.parse_listing(lines(spark, text), "citymun").select("region", "province", "city", "position", "district", "name", "party", "sex")
    assert {tuple(r) for r in got.collect()} == {
        ("CAR", "ABRA", "BANGUED", "MAYOR", "", "CRUZ, JUAN PEDRO SANTOS", "LP", "M"),
        ("CAR", "ABRA", "BANGUED", "COUNCILOR", "FIRST DISTRICT", "LIM, BO", "IND", "M"),
        ("CAR", "ABRA", "BOLINEY", "MAYOR", "", "UY, D E", "NP", "F"),
        ("NCR", "NCR - FOURTH DISTRICT", "MAKATI", "MAYOR", "", "OO, P Q", "KBL", "F")}
    late = """REGION : CAR
PROVINCE : ABRA
BANGUED
MAYOR
CRUZ, JUAN P SANTOS
1
LP
MALE
VICE-MAYOR
REYES, ANA DIAZ
F
NP
BENGUET
BAGUIO
MAYOR
OO, P Q
KBL
F
PROVINCE/CITY/MUN. : ITOGON, IFUGAO
MEMBER, SANGGUNIANG BAYAN
KK, L M
M
Party in mixed case
UNA"""
    got = lists.parse_records(lines(spark, late), "citymun").drop("doc")
    assert {tuple(r) for r in got.collect()} == {
        ("ABRA", "BANGUED", "MAYOR", "CRUZ", "JUAN P", "SANTOS", "M"), ("ABRA", "BANGUED", "VICE MAYOR", "REYES", "ANA", "DIAZ", "F"),
        ("BENGUET", "BAGUIO", "MAYOR", "OO", "P", "Q", "F"), ("IFUGAO", "ITOGON", "COUNCILOR", "KK", "L", "M", "M")}


def test_block_size_does_not_change_results(spark):
    text = "\n".join(f"TOWN {i}\nMAYOR\nCRUZ{i}, A B\nLP\nM\nCOUNCILOR\nLIM{i}, C D\nNP\nF" for i in range(12))
    results = [rows_of(lists.parse_listing(lines(spark, text, n), "citymun")) for n in (1, 5, 1000)]
    assert results[0] == results[1] == results[2] and len(results[0]) == 24
    results = [rows_of(lists.parse_records(lines(spark, text, n), "citymun")) for n in (1, 5, 1000)]
    assert results[0] == results[1] == results[2] and len(results[0]) == 24


def test_pages(spark):
    html = ('<p>As of May</p><p><b>MAYOR of X</b></p><p>As of</p><div class="phvote-tbl"><table><tr><td>A, B (LP)</td><td>LP</td>'
            '<td>1,200</td></tr><tr><td>C</td><td></td><td>-</td></tr></table></div><p>VICE-MAYOR of Y</p><table><tr><td>z</td><td>q</td><td>1</td></tr></table>')
    docs = spark.createDataFrame([("http://h.com/%202013/r/p/c/", html), ("http://h.com/2013/r/p", html)], "url string, html string")
    got = pages.archived_races(docs, "url", "html", "2013", 2013)
    assert rows_of(got) == [(2013, "r", "p", "c", "MAYOR", "X", "A, B", "LP", 1200)]


def test_feeds(spark):
    body = json.dumps({"result": [{"contest": "MAYOR", "candidates": [
        {"name": "A", "party": "LONG|LP", "vote_count": 5}, {"name": "B", "party": None, "vote_count": "7"}, {"name": "C", "vote_count": 5}]}]})
    docs = spark.createDataFrame([("X", body)], "city string, body string")
    got = [tuple(r) for r in feeds.pooled_feed_rows(docs, "body", ["city"]).orderBy("rank").collect()]
    assert got == [("X", "MAYOR", 1, "B", "", 7, "41.18 %"), ("X", "MAYOR", 2, "A", "LP", 5, "29.41 %"), ("X", "MAYOR", 3, "C", "", 5, "29.41 %")]


def test_sinks(spark, tmp_path):
    log = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    one = sinks.append_audit(spark, log, str(tmp_path / "log"), 1)
    two = sinks.append_audit(spark, log.union(spark.createDataFrame([("c", 3)], "k string, v int")), str(tmp_path / "log"), 2)
    assert one.count() == 2 and two.count() == 3
    table = spark.createDataFrame([(2016, "b", 1), (2019, "a", 2), (2016, None, 3)], "year int, name string, votes int")
    sinks.write_table(table, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).filter("year = 2016").count() == 2
    sinks.export_csv(table, str(tmp_path / "csv"), ["year", "name"], [("year", True), ("name", True)])
    assert [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "csv")).collect()][:2] == [("2016", "b"), ("2016", None)]
    places = spark.createDataFrame([("R", "P", "C", "x"), ("R", "P", "D", "y")], "region string, province string, city string, candidate string")
    sinks.write_localities(places, str(tmp_path / "loc"), ["candidate"])
    sinks.write_localities(places.filter("city = 'C'").withColumn("candidate", F.lit("z")), str(tmp_path / "loc"), ["candidate"])
    assert rows_of(spark.read.option("header", True).csv(str(tmp_path / "loc")).select("city", "candidate")) == [("C", "z"), ("D", "y")]
    sinks.write_payload(places, str(tmp_path / "json"), "city")
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    found = spark.createDataFrame([("d", "low", "i", "s", "t"), ("d", "high", "i", "s", "t")], "dataset string, severity string, issue string, scope string, detail string")
    sinks.write_report(found, str(tmp_path / "rep"))
    assert [r.severity for r in spark.read.option("header", True).csv(str(tmp_path / "rep")).collect()] == ["high", "low"]
    years = [ballots.read_by_year_glob(spark, str(tmp_path / "w_*.csv"))]
    put(tmp_path, "w_2016.csv", "a,b\n1,2\n")
    years.append(ballots.read_by_year_glob(spark, str(tmp_path / "w_*.csv")))
    assert years[0] is None and [tuple(r) for r in years[1].collect()] == [("1", "2", 2016)]


def test_a_run_touches_the_buckets_of_its_rows_only(spark, tmp_path):
    """Nine rows of ten are equal in one column; a re-run writes no data, a small run few buckets."""
    folder = tmp_path / "log"
    rows = spark.range(2000).select(F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                    F.when(F.col("id") % 7 > 0, F.col("id")).alias("v"))

    def written(version):
        return len(list((folder / "data" / f"version={version}").glob("bucket=*")))
    first = sinks.append_audit(spark, rows, str(folder), 1, buckets=16)
    want = sorted(((r.k, r.v) for r in rows.distinct().collect()), key=str)
    assert rows_of(first) == want and written(1) == 16
    again = sinks.append_audit(spark, rows, str(folder), 2, buckets=16)
    assert rows_of(again) == want and written(2) == 0
    few = spark.createDataFrame([("new", 1), ("hot", 1), (None, None)], "k string, v long")
    third = sinks.append_audit(spark, few, str(folder), 3, buckets=16)
    more = rows_of(third)
    assert more == sorted([*want, ("new", 1), (None, None)], key=str) and 1 <= written(3) <= 2
    assert rows_of(sinks.append_audit(spark, few, str(folder), 3, buckets=16)) == more  # the same run once more
    assert rows_of(first) == want  # an earlier version stays as it was


def test_landing_is_resumable(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    row = "CAR,ABRA,{},MAYOR,1,{},LP,{},\n"
    put(tmp_path / "in", "a.csv", HEADER + row.format("X", "A", 1) + row.format("X", "B", 2))
    put(tmp_path / "in", "b.csv", HEADER + row.format("Y", "C", 3))
    landing.land_stream(spark, source, target, mark).awaitTermination()
    assert rows_of(spark.read.parquet(target).select("city", "candidate_name")) == [("X", "A"), ("X", "B"), ("Y", "C")]
    put(tmp_path / "in", "c.csv", HEADER + row.format("X", "D", 9))
    landing.land_stream(spark, source, target, mark).awaitTermination()
    got = rows_of(spark.read.parquet(target).select("city", "candidate_name"))
    assert got == [("X", "D"), ("Y", "C")]
    landing.land_stream(spark, source, target, mark).awaitTermination()
    assert rows_of(spark.read.parquet(target).select("city", "candidate_name")) == got


def test_newest_file_stands_whatever_the_order(spark, tmp_path):
    """One file a batch, in any order, with restarts; one place holds nine rows of ten."""
    def text(name, big):
        rows = [("X", f"{name}{k}") for k in range(90 if big else 3)] + [("Y" if big else "Z", f"{name}y")]
        return HEADER + "".join(f"CAR,ABRA,{city},MAYOR,1,{c},LP,1,\n" for city, c in rows)
    times = {"a": 1_700_000_000, "b": 1_700_000_500, "c": 1_600_000_000, "d": 1_700_000_500, "e": 1_700_000_900}
    tables = []
    for turn, order in enumerate(("abcde", "edcba", "bdace")):
        source, target, mark = (str(tmp_path / str(turn) / n) for n in ("in", "out", "mark"))
        for k, name in enumerate(order):
            path = put(tmp_path / str(turn) / "in", f"{name}.csv", text(name, name != "e"))
            os.utime(path, (times[name], times[name]))
            if k != 2:  # the third one waits for the fourth, and both come with one call
                landing.land_stream(spark, source, target, mark, max_files=1).awaitTermination()
        tables.append(rows_of(spark.read.parquet(target).select("city", "candidate_name")))
    assert tables[0] == tables[1] == tables[2]
    assert tables[0] == sorted([("X", f"e{k}") for k in range(3)] + [("Y", "dy"), ("Z", "ey")], key=str)


def test_malformed_lines(spark, tmp_path):
    root = tmp_path / "2019"
    put(root, "CAR/ABRA/A.csv", HEADER + "CAR,ABRA,X,MAYOR,1,A,LP,3,4 %\nCAR,ABRA\nCAR,ABRA,X,MAYOR,1,A,LP,3,4 %,more\n")
    found = ballots.malformed_lines(spark, str(root))
    assert rows_of(found.select("line")) == [("CAR,ABRA",), ("CAR,ABRA,X,MAYOR,1,A,LP,3,4 %,more",)]
    assert ballots.read_ballots(spark, str(root)).count() == 3


def test_unreadable_documents(spark):
    whole = json.dumps({"result": [{"contest": "MAYOR", "candidates": [{"name": "A", "party": "B", "vote_count": "1"}]}]})
    docs = [("read", whole), ("torn", whole[:-4]), ("blank", "  "), ("null", None), ("list", "[1]"), ("other", '{"x": 1}')]
    df = spark.createDataFrame(docs, "place string, body string")
    got = dict(rows_of(feeds.unreadable_documents(df, "body", ["place"], "pooled")))
    assert got == {"torn": "not JSON", "blank": "empty", "null": "empty", "list": "nothing to read", "other": "nothing to read"}
    assert {r.place for r in feeds.pooled_feed_rows(df, "body", ["place"]).collect()} == {"read"}
    for kind, body in (("result", '{"result": []}'), ("contests", '{"MAYOR": {"contestCodeAndLocationCode": []}}'), ("board", '{"rs": []}'),
                       ("ballot", '{"cn": "x", "bos": []}'), ("canvass", '{"national": []}'), ("boundary", '{"objects": {}}')):
        one = spark.createDataFrame([("a", body), ("b", "{")], "place string, body string")
        assert dict(rows_of(feeds.unreadable_documents(one, "body", ["place"], kind))) == {"b": "not JSON"}


def test_units_of_trees_of_any_depth(spark):
    """A region, chains of different length, and nine nodes of ten below one province."""
    nodes = {"r1": (None, "Region", "R1", False), "r2": ("nowhere", "Region", "R2", False), "p1": ("r1", "Province", "P1", True),
             "p2": ("r1", "Province", "P2", True), "p3": ("x1", "Province", "P3", None), "x1": ("r2", "Island", "X1", True),
             "p4": (None, "Province", "P4", True), "lost": ("gone", "City/Municipality", "LOST", True),
             "c1": ("r2", "City/Municipality", "C1", True), "c4": ("p4", "City/Municipality", "C4", False)}
    for k in range(40):  # a long chain below p2, with a board at its end
        nodes[f"d{k}"] = (f"d{k - 1}" if k else "p2", "District", f"D{k}", k == 39)
        nodes[f"e{k}"] = (f"d{k}", "City/Municipality", f"E{k}", False)
    for k in range(900):
        nodes[f"h{k}"] = ("p1", "City/Municipality", f"H{k}", False)
    nodes["q"] = ("h7", "City/Municipality", "Q", False)
    nodes["i"] = ("p3", "City/Municipality", "I", None)
    df = spark.createDataFrame([(n, *v) for n, v in nodes.items()], "node string, parent string, level string, name string, has_board boolean").repartition(4)

    def up(n):
        while n in nodes:
            yield n
            n = nodes[n][0]
    boards = {a for n, v in nodes.items() if v[3] for a in list(up(n))[1:]}
    tallied = {n for n, v in nodes.items() if v[1] == "Province" and v[3] and n not in boards}
    first = lambda n, level: next((a for a in up(n) if nodes[a][1] == level), None)
    name = lambda n: n and nodes[n][2]
    want = [(name(first(n, "Region")), name(n), {"P1": "CITY P1"}.get(name(n), name(n)), n) for n in tallied]
    for n, v in nodes.items():
        region, province = first(n, "Region"), first(n, "Province")
        if v[1] == "City/Municipality" and province not in tallied and (region or province):
            want.append((name(region), name(province), v[2], n))
    assert tallied == {"p1", "p4"}
    assert rows_of(feeds.canvass_units(df, {"P1": "CITY P1"})) == sorted(want, key=str)
    ring = spark.createDataFrame([("a", "b", "Region", "A", False), ("b", "a", "Region", "B", False)], df.schema)
    with pytest.raises(ValueError, match="below themselves"):
        feeds.canvass_units(ring)


def test_a_record_behind_very_many_lines(spark):
    """Half a million lines of garbage in one document, nine of ten lines of all, before a name."""
    n = 500_000
    garbage = spark.range(n).select(F.lit("big").alias("doc"), F.floor(F.col("id") / 4096).alias("page"), F.col("id").alias("line"),
                                    F.concat(F.lit("GARBAGE "), F.col("id") % 97).alias("text"))
    tail = ["COUNCILOR", "CRUZ,", "ANA B", "7.", "LP", "F"]
    end = spark.createDataFrame([("big", n // 4096 + 1, n + k, x) for k, x in enumerate(["LIM, BO C", "NP", "M", *tail[1:]])] +
                                [("small", 0, k, x) for k, x in enumerate(tail)], "doc string, page long, line long, text string")
    got = lists.parse_listing(garbage.unionByName(end), "citymun").select("doc", "name", "party", "sex")
    assert rows_of(got) == [("big", "CRUZ, ANA B", "LP", "F"), ("big", "LIM, BO C", "NP", "M"), ("small", "CRUZ, ANA B", "LP", "F")]
