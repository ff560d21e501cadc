"""Group, linkage, crosswalk, identity and kinship operators against brute force."""

import random
from difflib import get_close_matches

import pytest
from pyspark.sql import functions as F

from hustings.operators import audit, crosswalk, groups, identity, kinship, linkage, tally
from hustings.operators.ordered import previous, running


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_no_range_of_a_large_group_is_twice_the_mean(spark):
    """One group holds nine rows of ten, its values far from those of the others and uneven."""
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 70).cast("string"))).alias("g"),
        F.when(F.col("id") % 10 > 0, F.pow(F.rand(3), 5) * 1e-3).otherwise(F.rand(4) * 1e6).alias("v"))
    sizes = [r["count"] for r in groups.value_ranges(rows, ["g"], "v", 20).groupBy("__range").count().collect()]
    assert len(sizes) >= 19 and max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_tasks_send_their_best_rows_only(spark):
    rows = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 10 > 0, "hot").otherwise(F.when(F.col("id") % 20 == 0, F.concat(F.lit("g"), F.col("id") % 300))).alias("g"),
        (F.hash("id") % 1000).alias("v"), "id", F.when(F.col("id") % 10 > 0, 3).when(F.col("id") % 300 != 60, 1).alias("n"))
    order = [F.col("v").desc(), F.col("id")]
    best = groups.best_in_task(rows.withColumn("n", F.coalesce("n", F.lit(0))), ["g"], order, "n")
    sent = {r.g: r["count"] for r in best.groupBy("g").count().collect()}
    assert sent["hot"] == 6 * 3 and max(n for g, n in sent.items() if g != "hot") <= 6 and "g60" not in sent
    got = {(r.g, r.place): r.id for r in groups.top_n(rows, ["g"], order, F.col("n")).collect()}
    data = sorted((r for r in rows.collect() if r.n), key=lambda r: (-r.v, r.id))
    want = {}
    for r in data:
        place = sum(1 for g, _ in want if g == r.g) + 1 if len(want) < 500 else r.n + 1
        if place <= r.n:
            want[r.g, place] = r.id
    assert got == want and (None, 1) in got


def test_standing_and_top_n_with_a_hot_group(spark):
    random.seed(1)
    data = [("hot" if random.random() < 0.5 else random.choice("abc"), random.choice([None, 0, 0, *range(40)]), i)
            for i in range(1500)]
    df = spark.createDataFrame(data, "g string, v int, i int")
    for r in groups.standing(df, ["g"], "v", ranges=8).collect():
        want = None if r.v is None else 1 + sum(1 for g, v, _ in data if g == r.g and v is not None and v > r.v)
        assert r["rank"] == want
    seats = {"hot": 7, "a": 2, "b": 1, "c": 3}
    n = F.create_map(*[F.lit(x) for kv in seats.items() for x in kv])[F.col("g")]
    got = groups.top_n(df, ["g"], [F.col("v").desc_nulls_last(), F.col("i")], n, tie_on="v")
    for g, k in seats.items():
        order = sorted((r for r in data if r[0] == g), key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        mine = sorted((r for r in got.collect() if r.g == g), key=lambda r: r.place)
        assert [r.i for r in mine] == [r[2] for r in order[:k]]
        assert mine[0].tie_at_cutoff == (order[k - 1][1] == order[k][1])


def test_tally_and_elect_against_a_model(spark):
    random.seed(7)
    data = [(random.choice("PQ"), random.choice(["x", "y", None]), random.choice("abcde"),
             random.choice(["L", None]), random.randint(0, 5)) for _ in range(300)]
    df = spark.createDataFrame(data, "province string, city string, candidate string, party string, votes int") \
        .withColumn("office", F.lit("MAYOR"))
    total = {}
    for p, c, cand, party, v in data:
        total[(p, c, cand, party)] = total.get((p, c, cand, party), 0) + v
    counted = tally.jurisdiction_tally(df, "office", {"MAYOR": ["province", "city"]}, ["candidate", "party"], "votes")
    assert {(r.province, r.city, r.candidate, r.party): r.votes for r in counted.collect()} == total
    won = tally.elect(counted.withColumn("seats", F.lit(3)), ["province", "city"], "votes", "seats", ["candidate", "party"])
    for key in {(k[0], k[1]) for k in total}:
        order = sorted(((-v, k[2], k[3] is None, k[3] or "") for k, v in total.items() if k[:2] == key))
        mine = sorted((r for r in won.collect() if (r.province, r.city) == key), key=lambda r: r.place)
        assert [(r.votes, r.candidate, r.party) for r in mine] == [(-o[0], o[1], o[3] or None) for o in order[:3]]


def test_seats(spark):
    held = spark.createDataFrame([("A",)] * 5 + [("B",)] * 9, "area string")
    contests = spark.createDataFrame([("A", "1"), ("A", "2"), ("B", None), ("C", "1"), ("C", "2"), ("C", "3")],
                                     "area string, district string")
    got = {r.area: (r.seats, r.default_used) for r in tally.seat_estimate(held, contests, "area", "district").collect()}
    assert got == {"A": (2, False), "B": (9, False), "C": (3, True)}


def test_index_and_stages(spark):
    rows = spark.createDataFrame([("k1", "v"), ("k1", "v"), ("k2", "a"), ("k2", "b"), (None, "z"), ("k3", None)], "k string, v string")
    index = linkage.unambiguous_index(rows, ["k"], "v")
    assert rows_of(index) == [("k1", "v")]
    second = spark.createDataFrame([("k2", "w"), ("k1", "other")], "k string, v string")
    df = spark.createDataFrame([("k1", ""), ("k2", " "), ("k2", "kept"), ("k9", None)], "k string, t string").withColumn("s", F.lit("old"))
    stages = [linkage.Stage(index, ["k"], ["k"], "v", "one"), linkage.Stage(second, ["k"], ["k"], "v", "two")]
    looked = linkage.staged_lookup(df, stages, "hit", "label")
    filled = linkage.fill_blanks(looked, "t", "hit", "label", "s").select("k", "t", "s")
    assert rows_of(filled) == sorted([("k1", "v", "one"), ("k2", "w", "two"), ("k2", "kept", "old"), ("k9", None, "old")], key=str)
    again = linkage.fill_blanks(linkage.staged_lookup(filled, stages, "hit", "label"), "t", "hit", "label", "s")
    assert rows_of(again.select("k", "t", "s")) == rows_of(filled)


def test_majority(spark):
    data = [("four", "M")] * 4 + [("big", "M")] * 99 + [("big", "F")] + [("mix", "M")] * 4 + [("mix", "F")] + [("one", "F")]
    df = spark.createDataFrame(data, "g string, s string")
    strict = {r.g for r in linkage.majority_dictionary(df, "g", "s", 5, 0.99).collect()}
    loose = {r.g for r in linkage.majority_dictionary(df, "g", "s", 2, 0.8).collect()}
    assert strict == {"big"} and loose == {"big", "four", "mix"}


@pytest.mark.parametrize("cutoff", [0.6, 0.9])
def test_near_spellings_equal_brute_force(spark, cutoff):
    random.seed(5)
    letters = "ABCDE "
    names = sorted({"".join(random.choices(letters, k=random.randint(6, 22))).strip() or "A" for _ in range(120)})

    def bend(s):
        s = list(s)
        for _ in range(random.randint(0, 2)):
            i = random.randrange(len(s))
            s[i:i + 1] = random.choice([[], [random.choice(letters)], [s[i], random.choice(letters)]])
        return "".join(s).strip() or "A"
    words = sorted({bend(random.choice(names)) for _ in range(250)})
    near = crosswalk.near_spellings(
        spark.createDataFrame([("s", w) for w in words], "sn string, key string"),
        spark.createDataFrame([("s", "t", 0)], "scope_name string, scope string, scope_pos int"),
        spark.createDataFrame([("t", n, n) for n in names], "scope string, key string, code string"),
        ["sn", "key"], "sn", "key", cutoff)
    got = {r.key: r.near for r in near.collect()}
    want = {w: m[0] for w in words if (m := get_close_matches(w, names, n=1, cutoff=cutoff))}
    assert got == want and len(want) > 50


def test_a_piece_that_most_names_share_makes_no_quadratic_join(spark):
    """Nine names of ten begin with the same word; few of them meet under one pair of letters."""
    random.seed(8)
    name = lambda: "".join(random.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ", k=9))
    names = [("s", ("MUNICIPALITY " if k % 10 else "") + name()) for k in range(1500)]
    df = spark.createDataFrame(names, "scope string, text string")
    pieces = crosswalk.rarest_first(df.select("text"), df, "text", 2)
    index = crosswalk.rare_pairs(df.join(pieces, "text"), "text", 0.9).groupBy("__pair").count()
    pairs, keys = index.agg(F.expr("sum(count * count)"), F.count("*")).first()
    assert keys > 1000 and pairs < 0.05 * len(names) ** 2
    words = spark.createDataFrame([("s", n[1:]) for _, n in names[:200]], "scope string, text string")
    found = crosswalk.near_candidates(words, df, "scope", "text", 0.9)
    assert 200 <= found.count() <= 400 and found.filter("near = concat(substr(near, 1, 1), text)").count() == 200


def test_crosswalk_cascade(spark):
    pairs = spark.createDataFrame([("P", "OFFICIAL OLDNAME"), ("P", "SAMAL"), ("Q", "SAMAL"), ("Q", "BALIUAGG TOWN"), ("P", "ZZZ")],
                                  "p string, key string")
    scopes = spark.createDataFrame([("P", "1", 0), ("P", "2", 1), ("Q", "2", 0)], "scope_name string, scope string, scope_pos int")
    names = spark.createDataFrame([("1", "OFFICIAL", "a"), ("2", "OFFICIAL OLDNAME", "b"), ("1", "ISLAND", "c"), ("2", "SAMAL", "d"),
                                   ("2", "BALIUAG TOWN", "e")], "scope string, key string, code string")
    aliases = spark.createDataFrame([("P", "SAMAL", "ISLAND")], "scope_name string, form string, alias string")
    got = {(r.p, r.key): (r.code, r.how) for r in crosswalk.crosswalk(pairs, scopes, names, ["p", "key"], "p", "key", aliases).collect()}
    assert got == {("P", "OFFICIAL OLDNAME"): ("a", "exact"), ("P", "SAMAL"): ("c", "exact"), ("Q", "SAMAL"): ("d", "exact"),
                   ("Q", "BALIUAGG TOWN"): ("e", "near"), ("P", "ZZZ"): (None, None)}


def test_same_person(spark):
    rows = [("CRUZ", "GWEN", 1, ""), ("CRUZ", "GWENDOLYN", 2, ""), ("CRUZ", "JUN", 1, ""), ("CRUZ", "JUNJUN", 2, ""),
            ("REY", "MEL", 1, ""), ("REY", "MELANIE", 2, ""), ("REY", "MELCHOR", 3, ""), ("LIM", "JOSE", 1, ""), ("LIM", "JOSEJR", 2, ""),
            ("TAN", "ANA", 1, ""), ("TAN", "ANABEL", 1, ""), ("SY", "ROSE", 1, "DIAZ"), ("SY", "ROSEANN", 2, "LOPEZ"),
            ("GO", "ROB", 1, ""), ("GO", "ROBERT", 2, ""), ("GO", "ROBERTO", 3, ""), ("VI", "ROBERT", 1, ""), ("VI", "BOK", 2, "")]
    df = spark.createDataFrame(rows, "sn string, g string, y int, m string")
    curated = spark.createDataFrame([("VI", "ROBERT", "BOK"), ("VI", "ROBERT", "NOBODY")], "sn string, a string, b string")
    got = {(r.sn, r.g): r.person_given for r in identity.same_person_names(df, ["sn"], "g", "y", "m", curated).collect()}
    assert got == {("CRUZ", "GWEN"): "GWENDOLYN", ("CRUZ", "GWENDOLYN"): "GWENDOLYN", ("GO", "ROB"): "ROBERTO", ("GO", "ROBERT"): "ROBERTO",
                   ("GO", "ROBERTO"): "ROBERTO", ("VI", "ROBERT"): "ROBERT", ("VI", "BOK"): "ROBERT"}


def test_kin_flags_against_pairs(spark):
    random.seed(2)
    data = [(i, random.choice("UV"), f"p{random.randint(0, 30)}", random.randint(1, 4), random.choice("ABCDEF"), random.choice(["", "A", "G", "H", "B"]))
            for i in range(200)]
    df = spark.createDataFrame(data, "i int, u string, p string, y int, s string, m string")
    for r in kinship.kin_flags(df, ["u"], "p", "y", "s", "m").collect():
        def rel(test, same):
            return any(x[1] == r.u and x[2] != r.p and (x[3] == r.y) == same and test(x) for x in data)
        for same, kind in ((True, "fat"), (False, "thin")):
            last = rel(lambda x: x[4] == r.s, same)
            mid = rel(lambda x: x[5] == r.s or (r.m and (x[4] == r.m or x[5] == r.m)), same)
            assert (r[f"last_{kind}"], r[f"middle_{kind}"], r[f"all_{kind}"]) == (last, mid, last or mid)


def test_running_state_crosses_blocks(spark):
    data = [("d", i // 7, i % 7, i if i % 5 == 0 else None) for i in range(60)]
    df = spark.createDataFrame(data, "doc string, page int, line int, v int")
    out = running(df, ["doc"], "page", "line", last={"seen": F.col("v")}, total={"n": F.lit(1)}).orderBy("page", "line").collect()
    assert [(r.seen, r.n) for r in out] == [(i // 5 * 5, i + 1) for i in range(60)]
    prev = previous(df.drop("v").withColumn("k", F.col("page") * 7 + F.col("line")), ["doc"], "page", "line", {"k": "p"}).orderBy("k").collect()
    assert [r.p for r in prev] == [None, *range(59)]


def test_audits_edges(spark):
    df = spark.createDataFrame([(1, None, "x")] * 3 + [(2, "a", None)] * 2 + [(2, None, "x")] * 3, "y int, a string, b string")
    got = {(r.y, r.column): r.severity for r in audit.null_profile(df, "y", ["a", "b"]).collect()}
    assert got == {(1, "a"): "high", (2, "a"): "medium", (2, "b"): None}
    truth = spark.createDataFrame([("M", 20)], "k string, expected int")
    counts = spark.createDataFrame([("M", 1)] * 21 + [("M", 2)] * 18 + [("Z", 1)], "k string, y int")
    assert [(r.y, r.n, r.direction) for r in audit.count_drift(counts, truth, "k", "y").collect()] == [(2, 18, "fewer")]
    dup = spark.createDataFrame([(1, "a", 1), (1, "a", 1), (1, "a", 2), (1, "b", 1)], "y int, k string, v int")
    assert rows_of(audit.exact_duplicates(dup, "y")) == [(1, 1)]
    assert rows_of(audit.shared_keys(dup, ["y", "k"], "y")) == [(1, 3)]


def test_known_and_common_keys(spark):
    from hustings.operators import linkage
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (4, "z")], "k int, v string")
    assert sorted(r.k for r in linkage.known_keys(a, b, ["k", "v"]).collect()) == [1, 1]
    assert sorted(r.k for r in linkage.common_keys(a, b, ["k", "v"]).collect()) == [1, 2]
