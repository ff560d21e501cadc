"""Landed JSON feeds to ballot rows. Ranks are worked out inside each contest's own list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.functions.text import none_if_blank, squash
from hustings.session import checkpointed

# Fixed values ---------------------------------------------------------------------------------
PARTY_SUFFIX = r"\(([^)]{1,20})\)\s*$"
NUMBERED_OPTION = r"^\s*\d+\.\s*(.*?)\s*(?:\(([^)]*)\))?\s*$"
# Contest key -> (path slug, level the office resolves at).
CONTEST_LEVELS = {
    "SENATOR": ("senator", "municipality"),
    "PARTY_LIST": ("party-list", "municipality"),
    "GOVERNOR": ("governor", "municipality"),
    "VICE_GOVERNOR": ("vice-governor", "municipality"),
    "CONGRESSMAN": ("congressman", "municipality"),
    "PROVINCIAL_BOARD_MEMBER": ("provincial-board-member", "municipality"),
    "MAYOR": ("mayor", "municipality"),
    "VICE_MAYOR": ("vice-mayor", "municipality"),
    "COUNCILOR": ("councilor", "municipal-district"),
}
# ----------------------------------------------------------------------------------------------

POOLED_FEED = ("struct<result:array<struct<contest:string,"
               "candidates:array<struct<name:string,party:string,vote_count:string>>>>>")
RESULT_FEED = ("struct<contestDetail:string,positionName:string,result:array<struct<rank:string,"
               "candidateName:string,partyNameShort:string,partyName:string,voteCount:string>>>")
CONTEST_FEED = ("map<string,struct<contestCodeAndLocationCode:array<"
                "struct<contestCode:string,locationCode:string>>>>")
BOARD_FEED = "struct<rs:array<struct<cc:string,bo:string,v:string,per:string>>>"
BALLOT_FEED = "struct<cn:string,bos:array<struct<boc:string,bon:string,pn:string>>>"
CANVASS_OPTION = "struct<name:string,votes:string,percentage:string>"
CANVASS_CONTEST = (f"array<struct<contestName:string,candidates:struct<candidates:"
                   f"array<{CANVASS_OPTION}>>>>")
CANVASS_FEED = f"struct<local:{CANVASS_CONTEST},national:{CANVASS_CONTEST}>"
BOUNDARY_FEED = ("struct<transform:struct<scale:array<double>,translate:array<double>>,"
                 "arcs:array<array<array<bigint>>>,"
                 "objects:map<string,struct<geometries:array<struct<type:string,arcs:string,"
                 "properties:struct<adm1_psgc:string,adm2_psgc:string,adm2_en:string,"
                 "adm3_psgc:string,adm3_en:string>>>>>>")


#: Each kind of document with the fields of which it must have one.
KINDS = {"pooled": (POOLED_FEED, ["result"]), "result": (RESULT_FEED, ["result"]), "contests": (CONTEST_FEED, []),
         "board": (BOARD_FEED, ["rs"]), "ballot": (BALLOT_FEED, ["bos"]), "canvass": (CANVASS_FEED, ["local", "national"]),
         "boundary": (BOUNDARY_FEED, ["objects"])}


def unreadable_documents(feeds: DataFrame, body: str, keys: list[str], kind: str) -> DataFrame:
    """(*keys, reason) of the documents that the row functions can give nothing for: ``empty``, ``not
    JSON``, or ``nothing to read`` where the parts that a document of its kind must have are missing
    or of another type. Every landed document is either here or read."""
    schema, parts = KINDS[kind]
    read = F.from_json(body, schema)
    found = F.coalesce(*[read[p] for p in parts]) if len(parts) > 1 else read[parts[0]] if parts else read
    reason = F.when(none_if_blank(body).isNull(), "empty").when(F.try_parse_json(body).isNull(), "not JSON") \
        .when(found.isNull(), "nothing to read")
    return feeds.select(*keys, reason.alias("reason")).filter(F.col("reason").isNotNull())


def whole(c: Column) -> Column:
    """A count that may come as number or text; anything else is 0."""
    return F.coalesce(c.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def share_text(votes: Column, total: Column) -> Column:
    """``"44.06 %"``, empty where the total is 0."""
    share = F.bround(F.lit(100.0) * votes / F.nullif(total, F.lit(0)), 2)
    return F.coalesce(F.format_string("%.2f %%", share), F.lit(""))


def with_share(value: Column, total: Column) -> Column:
    return F.when(total > 0, share_text(value, total)).otherwise(F.lit(""))


def ranked(options: Column) -> Column:
    """An option list (name, party, votes, pct) by votes, most first; equal votes keep the order
    of the source. The position in the result is the rank."""
    keyed = F.transform(options, lambda o, i: F.struct(
        (-o["votes"]).alias("down"), i.alias("i"), o.alias("option")))
    return F.transform(F.array_sort(keyed), lambda k: k["option"])


def _ballot_rows(df: DataFrame, keys: list[str], position: str, options: str) -> DataFrame:
    return df.select(*keys, F.col(position).alias("position"),
                     F.posexplode(ranked(F.col(options))).alias("__pos", "o")).select(
        *keys, "position", (F.col("__pos") + 1).alias("rank"),
        F.col("o.name").alias("candidate_name"), F.col("o.party").alias("party"),
        F.col("o.votes").alias("votes"), F.col("o.pct").alias("percentage"))


def pooled_feed_rows(feeds: DataFrame, body: str, keys: list[str]) -> DataFrame:
    """Contests with candidates in one document for each locality; the party is the text after
    the last bar; share is of the contest's total."""
    contests = feeds.select(*keys, F.explode(F.from_json(body, POOLED_FEED)["result"]).alias("c"))
    votes = F.transform("c.candidates", lambda x: whole(x["vote_count"]))
    total = F.aggregate(votes, F.lit(0).cast("bigint"), lambda a, v: a + v)
    with_total = contests.withColumn("__total", total)
    options = F.transform("c.candidates", lambda x: F.struct(
        F.coalesce(x["name"], F.lit("")).alias("name"),
        F.trim(F.element_at(F.split(F.coalesce(x["party"], F.lit("")), r"\|"), -1)).alias("party"),
        whole(x["vote_count"]).alias("votes"),
        with_share(whole(x["vote_count"]), F.col("__total")).alias("pct")))
    shaped = with_total.withColumn("__position", F.coalesce("c.contest", F.lit(""))) \
        .withColumn("__options", options)
    return _ballot_rows(shaped, keys, "__position", "__options")


def locality_regions(roster: DataFrame, provinces: DataFrame, capital_names: list[str],
                     capital_cities: DataFrame, missing: dict[str, str]) -> DataFrame:
    """Distinct (province, city) of a roster with the province name of another reference
    (``bucket``) and its region; both null where the place cannot be mapped.

    ``provinces``: name, region. ``capital_cities``: city_key, bucket, for provinces that name the
    capital area as a whole; ``roster`` carries ``city_key`` for them. ``missing``: provinces the
    reference omits, with their region.
    """
    places = roster.select(F.upper(F.trim("province")).alias("province"),
                           F.upper(F.trim("city")).alias("city"), "city_key").distinct()
    named = provinces.select(F.upper("name").alias("name"), F.upper("region").alias("region"))
    exact = named.select(F.col("name").alias("province"), F.col("name").alias("__exact"))
    folded = named.groupBy(squash("name").alias("__fold")).agg(F.max("name").alias("__folded"))
    capital = capital_cities.select("city_key", F.col("bucket").alias("__capital"))
    found = places.join(exact, "province", "left") \
        .withColumn("__fold", squash("province")).join(folded, "__fold", "left") \
        .join(capital, "city_key", "left")
    extra = F.when(F.col("province").isin(list(missing)), F.col("province"))
    bucket = F.when(F.col("province").isin(capital_names), F.col("__capital")) \
        .otherwise(F.coalesce("__exact", "__folded", extra))
    supplied = F.coalesce(*[F.when(F.col("province") == p, F.lit(r)) for p, r in missing.items()],
                          F.lit(None).cast("string"))
    mapped = found.withColumn("bucket", bucket).join(
        named.select(F.col("name").alias("bucket"), "region"), "bucket", "left")
    region = F.when(F.col("bucket").isNotNull(), F.coalesce("region", supplied))
    return mapped.select(region.alias("region"),
                         F.when(region.isNotNull(), F.col("bucket")).alias("bucket"),
                         "city", "province")


def locality_table(locations: DataFrame, capital: tuple[str, str]) -> DataFrame:
    """(code, city, province, region): municipalities whose parent, the text after the last comma,
    is a known province; posts abroad drop out. A province's region follows its own comma.
    ``capital`` is a (name, region) pair that the source does not list as a province."""
    last = F.trim(F.element_at(F.split("fullLocationName", ","), -1))
    has_comma = F.contains(F.col("fullLocationName"), F.lit(","))
    provinces = locations.filter(F.col("locationType") == "province").groupBy(
        F.col("locationName").alias("province")).agg(
        F.max(F.when(has_comma, last).otherwise(F.lit(""))).alias("region"))
    name, region = capital
    known = provinces.filter(F.col("province") != name).unionByName(
        locations.sparkSession.createDataFrame([(name, region)], "province string, region string"))
    return locations.filter(F.col("locationType") == "municipality").select(
        F.col("locationCode").alias("code"), F.col("locationName").alias("city"),
        last.alias("province")).join(known, "province")


def contest_paths(contests: DataFrame, code: str, body: str) -> DataFrame:
    """(code, path) of every result document a municipality's contest list points to."""
    levels = F.create_map(*[x for k, (slug, level) in CONTEST_LEVELS.items()
                            for x in (F.lit(k), F.struct(F.lit(slug).alias("slug"),
                                                         F.lit(level).alias("level")))])
    entries = contests.select(F.col(code).alias("code"),
                              F.explode(F.from_json(body, CONTEST_FEED)).alias("key", "entry"))
    pairs = entries.withColumn("lv", levels[F.col("key")]).filter(F.col("lv").isNotNull()) \
        .select("code", "lv", F.explode("entry.contestCodeAndLocationCode").alias("p"))
    return pairs.select("code", F.concat_ws(
        "-", F.col("lv.slug"), F.col("p.contestCode"), F.col("lv.level"), F.lit("location"),
        F.col("p.locationCode")).alias("path"))


def result_feed_rows(results: DataFrame, body: str, keys: list[str]) -> DataFrame:
    """One result document for each contest; source rank kept, share worked out."""
    docs = results.select(*keys, F.from_json(body, RESULT_FEED).alias("d"))
    votes = F.transform("d.result", lambda x: whole(x["voteCount"]))
    total = F.aggregate(votes, F.lit(0).cast("bigint"), lambda a, v: a + v)
    rows = docs.withColumn("__total", total).select(
        *keys, F.coalesce(none_if_blank("d.contestDetail"), "d.positionName", F.lit(""))
        .alias("position"), "__total", F.explode("d.result").alias("c"))
    n = whole(F.col("c.voteCount"))
    return rows.select(
        *keys, "position", F.coalesce("c.rank", F.lit("")).alias("rank"),
        F.coalesce("c.candidateName", F.lit("")).alias("candidate_name"),
        F.coalesce(F.nullif("c.partyNameShort", F.lit("")), "c.partyName", F.lit("")).alias("party"),
        n.alias("votes"), with_share(n, F.col("__total")).alias("percentage"))


def municipal_feed_rows(locations: DataFrame, contests: DataFrame, results: DataFrame,
                        capital: tuple[str, str]) -> DataFrame:
    """Locations, contest lists (code, body) and result documents (path, body) to ballot rows."""
    places = locality_table(locations, capital)
    paths = contest_paths(contests, "code", "body").join(places, "code")
    docs = paths.join(results, "path")
    return result_feed_rows(docs, "body", ["region", "province", "city"])


def tree_context(nodes: DataFrame, levels: dict[str, str]) -> DataFrame:
    """``nodes`` with, for each column of ``levels``, the nearest node of that level on the way up,
    the node itself included, as ``struct(node, name)``; and ``below``: whether any node below has a
    board. Trees may have any depth, different in every branch.

    Every round a node points twice as far up, takes over what the node there knows of the way
    above, and hands what it knows of the nodes below to the node it pointed at. A tree of depth d
    takes log2(d) rounds of one join and one aggregate. Parents that are no nodes are roots' parents.
    """
    own = F.struct("node", "name")
    state = nodes.select(
        "node", F.col("parent").alias("jump"), F.coalesce("has_board", F.lit(False)).alias("has"), F.lit(False).alias("below"),
        *[F.when(F.col("level") == level, own).alias(c) for c, level in levels.items()])
    known = nodes.select(F.col("node").alias("jump"))
    state = checkpointed(state.join(known.withColumn("__in", F.lit(True)), "jump", "left").withColumn(
        "jump", F.when(F.col("__in"), F.col("jump"))).drop("__in"))
    rounds, most = 0, state.count().bit_length() + 1
    while state.filter(F.col("jump").isNotNull()).limit(1).count():
        if rounds > most:
            raise ValueError("units that are below themselves")
        rounds += 1
        above = state.select(F.col("node").alias("jump"), F.col("jump").alias("__jump"), *[F.col(c).alias(f"__{c}") for c in levels])
        lower = state.filter(F.col("jump").isNotNull()).groupBy(F.col("jump").alias("node")).agg(
            F.bool_or(F.col("has") | F.col("below")).alias("__below"))
        state = checkpointed(state.join(above, "jump", "left").join(lower, "node", "left").select(
            "node", F.col("__jump").alias("jump"), "has", (F.col("below") | F.coalesce("__below", F.lit(False))).alias("below"),
            *[F.coalesce(c, f"__{c}").alias(c) for c in levels]))
    return nodes.join(state.select("node", "below", *levels), "node")


def canvass_units(nodes: DataFrame, rename: dict[str, str] | None = None) -> DataFrame:
    """(region, province, city, node) of every unit that is tallied.

    ``nodes``: node, parent, level, name, has_board, a tree of any depth. Cities are units. A
    province is itself the unit only when it has a board and nothing below it does; its cities then
    are not. A city belongs to the nearest province and region above it, and to none drops out.
    """
    tree = tree_context(nodes, {"region": "Region", "province": "Province"})
    is_unit = F.coalesce("has_board", F.lit(False)) & ~F.col("below")
    provinces = tree.filter(F.col("level") == "Province").select(
        F.col("node").alias("__province"), is_unit.alias("is_unit"), F.col("region.name").alias("region"), F.col("name").alias("province"))
    shown = F.col("province")
    for name, display in (rename or {}).items():
        shown = F.when(F.col("province") == name, F.lit(display)).otherwise(shown)
    own = provinces.filter("is_unit").select("region", "province", shown.alias("city"), F.col("__province").alias("node"))
    tallied = provinces.filter("is_unit").select("__province")
    cities = tree.filter(F.col("level") == "City/Municipality") \
        .filter(F.col("province").isNotNull() | F.col("region").isNotNull())
    rest = cities.join(tallied, F.col("province.node") == F.col("__province"), "left_anti")
    return own.unionByName(rest.select(
        F.col("region.name").alias("region"), F.col("province.name").alias("province"), F.col("name").alias("city"), "node"))


def board_rows(boards: DataFrame, contests: DataFrame, keys: list[str]) -> DataFrame:
    """Board results (keys, ``board``, ``body``) met with the options of their contest (``code``,
    ``body``); a result without an option drops out. The party is the bracketed end of the name,
    else the option's own."""
    ballots = contests.select(F.col("code").alias("cc"),
                              F.from_json("body", BALLOT_FEED).alias("b"))
    options = ballots.select("cc", F.col("b.cn").alias("cn"),
                             F.posexplode("b.bos").alias("pos", "o")) \
        .groupBy("cc", F.col("o.boc").alias("bo")).agg(
        F.max_by(F.struct("cn", "o.bon", "o.pn"), "pos").alias("o"))
    entries = boards.select(*keys, "board", F.posexplode(
        F.from_json("body", BOARD_FEED)["rs"]).alias("i", "r")) \
        .select(*keys, "board", "i", "r.cc", "r.bo", "r.v", "r.per")
    met = entries.join(options, ["cc", "bo"])
    name = F.trim("o.bon")
    suffix = F.trim(F.nullif(F.regexp_extract(name, PARTY_SUFFIX, 1), F.lit("")))
    per = F.when(F.col("per").isNull() | F.col("per").isin("", "0"), F.lit("")) \
        .otherwise(F.concat(F.col("per"), F.lit(" %")))
    option = F.struct("i", F.struct(
        name.alias("name"), F.coalesce(suffix, "o.pn", F.lit("")).alias("party"),
        whole(F.col("v")).alias("votes"), per.alias("pct")).alias("o"))
    # A contest's entries all come from one document of the board.
    lists = met.groupBy(*keys, "board", "cc").agg(
        F.max("o.cn").alias("__position"),
        F.transform(F.array_sort(F.collect_list(option)), lambda e: e["o"]).alias("__options"))
    return _ballot_rows(lists, keys, "__position", "__options")


def canvass_rows(feeds: DataFrame, body: str, keys: list[str]) -> DataFrame:
    """Local and national contests of one document for each locality; options read
    ``"12. NAME (PARTY)"`` and are ranked by votes, not by their ballot number."""
    doc = F.from_json(body, CANVASS_FEED)
    empty = F.from_json(F.lit("[]"), CANVASS_CONTEST)
    contests = feeds.select(*keys, F.explode(F.concat(
        F.coalesce(doc["local"], empty), F.coalesce(doc["national"], empty))).alias("c"))

    def option(o):
        raw = F.coalesce(o["name"], F.lit(""))
        fits = raw.rlike(NUMBERED_OPTION)
        return F.struct(
            F.trim(F.when(fits, F.regexp_extract(raw, NUMBERED_OPTION, 1)).otherwise(raw))
            .alias("name"),
            F.trim(F.regexp_extract(raw, NUMBERED_OPTION, 2)).alias("party"),
            whole(o["votes"]).alias("votes"),
            F.coalesce(F.concat(o["percentage"], F.lit(" %")), F.lit("")).alias("pct"))
    shaped = contests.select(*keys, F.col("c.contestName").alias("__position"),
                             F.transform("c.candidates.candidates", option).alias("__options"))
    return _ballot_rows(shaped.filter(F.col("__options").isNotNull()), keys,
                        "__position", "__options")


def boundary_properties(files: DataFrame, body: str, code: str, name: str) -> DataFrame:
    """(code, name, province, region, has_shape) of every unit in landed boundary files. Units
    without geometry are listed too. Codes are ten-digit text."""
    from hustings.functions.places import area_label, place_code
    geometry = files.select(F.explode(F.from_json(body, BOUNDARY_FEED)["objects"])
                            .alias("layer", "o")).select(F.explode("o.geometries").alias("g"))
    units = geometry.select(
        place_code(F.col(f"g.properties.{code}")).alias("code"),
        area_label(F.col(f"g.properties.{name}")).alias("name"),
        place_code(F.col("g.properties.adm2_psgc")).alias("province"),
        place_code(F.col("g.properties.adm1_psgc")).alias("region"),
        (F.col("g.type").isNotNull() & F.col("g.arcs").isNotNull()).alias("has_shape"))
    return units.filter(F.col("code").isNotNull()).groupBy("code").agg(
        F.max("name").alias("name"), F.max("province").alias("province"),
        F.max("region").alias("region"), F.bool_or("has_shape").alias("has_shape"))
