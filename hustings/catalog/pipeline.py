"""The whole results pipeline over ballots derived from the standard tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hustings.catalog.derived import COUNTS_SQL, raw_ballots
from hustings.catalog.registry import query
from hustings.plans import audits, backfill, explore, kin, place_results, vote_counts, winners
from hustings.session import checkpointed

COUNT_COLUMNS = ("year, region, province, city, district, position, candidate_name, last_name, first_name, "
                 "middle_name, title, party, votes, CAST(NULL AS double) AS percentage, CAST(NULL AS integer) AS rank, "
                 "is_national_race, is_geographic, raw_position, reported_name, reported_party")


ELECTING = ["year", "region", "province", "city", "district", "position", "candidate_name", "last_name", "first_name",
            "middle_name", "title", "party", "votes", "is_geographic"]


def counts(t, columns=None, races=None):
    """The vote-counts table, stored because the stages after it read it more than once; only the
    columns and races that they ask for, so both are narrowed before the duplicates are removed."""
    rows = vote_counts.build_vote_counts([raw_ballots(t)], check=False)
    rows = rows if races is None else rows.filter(F.col("position").isin(races))
    return checkpointed(rows if columns is None else rows.select(*columns))


@query("vote_counts", f"WITH {COUNTS_SQL} SELECT {COUNT_COLUMNS} FROM counts")
def all_vote_counts(t):
    rows = vote_counts.build_vote_counts([raw_ballots(t)])  # fails on an office that no rule knows
    return vote_counts.published_order(rows)


# Office-holders of the base cycle: customers of one segment with a low balance sit on boards.
HOLDERS = """
  SELECT 2019 AS year, CASE n_nationkey WHEN 0 THEN 'DAVAO DE ORO' WHEN 1 THEN 'NCR SECOND DISTRICT'
      ELSE replace(n_name, '_', ' ') END AS province, CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal < 3000
      THEN 'PROVINCIAL BOARD MEMBER' ELSE 'COUNCILOR' END AS position, c_name AS full_name
  FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""
HOLDERS_SQL = HOLDERS.replace("{", "").replace("}", "")

SEATS_SQL = f"""
  held AS (SELECT province, count(*) AS held FROM ({HOLDERS_SQL}) WHERE position = 'PROVINCIAL BOARD MEMBER' GROUP BY 1),
  board AS (SELECT year, province, CAST(greatest(1, round_even(coalesce(max(held), 8) / count(DISTINCT district), 0)) AS integer) AS seats
    FROM counts LEFT JOIN held USING (province) WHERE position = 'PROVINCIAL BOARD MEMBER' GROUP BY 1, 2)"""
LOCAL_SQL = f"""{COUNTS_SQL}, {SEATS_SQL},
  tally AS (SELECT year, position, province, CASE WHEN position IN ('MAYOR', 'COUNCILOR') THEN city END AS city,
      CASE WHEN position IN ('COUNCILOR', 'PROVINCIAL BOARD MEMBER') THEN district END AS district, candidate_name, party,
      CAST(sum(votes) AS bigint) AS votes, min(region) AS region, min(last_name) AS last_name, min(first_name) AS first_name,
      min(middle_name) AS middle_name, min(title) AS title
    FROM counts WHERE is_geographic AND position IN ('MAYOR', 'GOVERNOR', 'COUNCILOR', 'PROVINCIAL BOARD MEMBER')
    GROUP BY 1, 2, 3, 4, 5, 6, 7),
  seated AS (SELECT tally.*, CASE position WHEN 'COUNCILOR' THEN 8 WHEN 'PROVINCIAL BOARD MEMBER' THEN coalesce(seats, 4) ELSE 1 END AS seats
    FROM tally LEFT JOIN board USING (year, province)),
  placed AS (SELECT *, row_number() OVER w AS place, lead(votes) OVER w AS next FROM seated
    WINDOW w AS (PARTITION BY year, position, province, city, district ORDER BY votes DESC, candidate_name, party NULLS LAST)),
  local AS (SELECT * EXCLUDE (place, next), bool_or(place = seats AND votes = next) OVER (PARTITION BY year, position, province, city, district)
      AS tie FROM placed QUALIFY place <= seats)"""
NATIONAL_SQL = """
  nt AS (SELECT year, position, candidate_name, party, CAST(sum(votes) AS bigint) AS votes, min(last_name) AS last_name,
      min(first_name) AS first_name, min(middle_name) AS middle_name, min(title) AS title FROM counts WHERE position = 'SENATOR' GROUP BY 1, 2, 3, 4),
  np AS (SELECT *, row_number() OVER w AS place, lead(votes) OVER w AS next FROM nt
    WINDOW w AS (PARTITION BY year ORDER BY votes DESC, candidate_name, party NULLS LAST)),
  national AS (SELECT *, bool_or(place = 12 AND votes = next) OVER (PARTITION BY year) AS tie FROM np QUALIFY place <= 12)"""


def board(t, ballots, scope="cycle"):
    return winners.board_seats(ballots, t.sql(HOLDERS, "customer", "nation"), scope=scope)


def elected(t, ballots):
    return winners.winners_from_ballots(ballots, board(t, ballots))


@query("board_seats_pooled", f"""WITH {COUNTS_SQL},
  held AS (SELECT province, count(*) AS held FROM ({HOLDERS_SQL}) WHERE position = 'PROVINCIAL BOARD MEMBER' GROUP BY 1)
  SELECT province, count(DISTINCT district) AS districts, coalesce(max(held), 8) AS total,
    CAST(greatest(1, round_even(coalesce(max(held), 8) / count(DISTINCT district), 0)) AS integer) AS seats, max(held) IS NULL AS default_used
  FROM counts LEFT JOIN held USING (province) WHERE position = 'PROVINCIAL BOARD MEMBER' GROUP BY 1""")
def board_seats_pooled(t):
    return board(t, counts(t, ["year", "province", "district", "position"], [winners.BOARD_OFFICE]), "all")


@query("winners_from_ballots", f"""WITH {LOCAL_SQL}, {NATIONAL_SQL}
  SELECT year, region, province, city, district, position, candidate_name, last_name, first_name, middle_name, title, party, votes,
    CAST(seats AS integer) AS seats, coalesce(tie, false) AS tie_at_cutoff FROM local
  UNION ALL SELECT year, NULL, NULL, NULL, NULL, position, candidate_name, last_name, first_name, middle_name, title, party, votes,
    12, coalesce(tie, false) FROM national""")
def winners_from_ballots(t):
    return elected(t, counts(t, ELECTING))


# Inherited winners write names the other way round and spell places and parties differently.
INHERITED = """
  SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 1998 ELSE 1992 END AS year,
    concat(CASE WHEN c_acctbal > 8000 THEN 'DATU ' ELSE '' END, 'C', c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN ' MID' ELSE '' END,
      ' ', c_mktsegment) AS full_name, 'COUNCILOR' AS position,
    CASE WHEN c_mktsegment = 'FURNITURE' THEN 'Liberal Party' ELSE 'lakas cmd' END AS party, replace(n_name, '_', '-') AS province,
    CASE WHEN c_acctbal >= 0 THEN CASE r_name WHEN 'AFRICA' THEN 'ARMM' ELSE r_name END END AS region, 7 AS Community
  FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"""
SEX_KEYS = """SELECT 1992 AS year, 'COUNCILOR' AS position, c_mktsegment AS last,
  CASE WHEN c_acctbal > 5000 THEN concat('C', c_custkey) ELSE concat('Q', c_custkey) END AS given, 'M' AS sex FROM {customer}"""
SEX_GIVENS = """SELECT CASE WHEN c_acctbal > 2000 THEN concat('C', c_custkey) ELSE concat('Q', c_custkey) END AS given, 'F' AS sex FROM {customer}"""
INHERITED_TABLES = ["customer", "nation", "region"]


def merged(t):
    ballots = counts(t, ELECTING)
    fresh = winners.local_winners(ballots, board(t, ballots))
    return winners.merge_winners(
        t.sql(INHERITED, *INHERITED_TABLES), [fresh], [1998],
        t.sql(SEX_KEYS, "customer"), t.sql(SEX_GIVENS, "customer"))


MERGED_SQL = f"""{LOCAL_SQL},
  inh AS (SELECT c_mktsegment AS last_name, 'C' || c_custkey AS first_name, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'MID' END AS middle_name,
      CASE WHEN c_acctbal > 8000 THEN 'DATU' END AS title,
      c_mktsegment || ', C' || c_custkey || CASE WHEN c_mktsegment = 'MACHINERY' THEN ' MID' ELSE '' END AS full_name,
      'COUNCILOR' AS position, CASE WHEN c_mktsegment = 'FURNITURE' THEN 'LP' ELSE 'LAKAS-CMD' END AS party, 1992 AS year,
      replace(n_name, '_', ' ') AS province, NULL AS city,
      CASE WHEN c_acctbal >= 0 THEN CASE r_name WHEN 'AFRICA' THEN 'BARMM' ELSE r_name END END AS region, '' AS sex
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_mktsegment <> 'BUILDING'),
  u AS (SELECT * FROM inh UNION ALL SELECT last_name, first_name, middle_name, title, candidate_name, position, party, year,
      province, city, region, '' FROM local),
  n AS (SELECT province, region, count(*) AS n FROM u WHERE region IS NOT NULL GROUP BY 1, 2),
  m AS (SELECT province, region AS mode FROM n QUALIFY row_number() OVER (PARTITION BY province ORDER BY n DESC, region) = 1),
  merged AS (SELECT DISTINCT u.* REPLACE (coalesce(u.region, mode) AS region) FROM u LEFT JOIN m USING (province))"""


@query("merged_winners", f"WITH {MERGED_SQL} SELECT * FROM merged")
def merged_winners(t):
    # The lists cover cycles from 2004 on, so no sex is filled here; see listed_sex for that.
    return merged(t)


@query("listed_sex", f"""
  SELECT full_name, 'C' || regexp_extract(full_name, 'C([0-9]+)', 1) AS given, CASE WHEN year = 1998 THEN '' ELSE sex END AS sex FROM (
    SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 1998 ELSE 1992 END AS year,
      (CASE WHEN c_acctbal > 8000 THEN 'DATU ' ELSE '' END) || 'C' || c_custkey || (CASE WHEN c_mktsegment = 'MACHINERY' THEN ' MID' ELSE '' END)
        || ' ' || c_mktsegment AS full_name,
      CASE WHEN c_acctbal > 5000 THEN 'M' WHEN c_acctbal > 2000 THEN 'F' ELSE '' END AS sex FROM customer)""")
def listed_sex(t):
    rows = t.sql(INHERITED, *INHERITED_TABLES).withColumn("raw", F.col("full_name")) \
        .withColumn("__n", F.split("full_name", " "))
    given = F.regexp_extract("raw", "(C[0-9]+)", 1)
    rows = rows.withColumns({"first_name": given, "last_name": F.element_at("__n", -1), "sex": F.lit("")})
    filled = winners.fill_listed_sex(rows, t.sql(SEX_KEYS, "customer"), t.sql(SEX_GIVENS, "customer"), 1990, 1995)
    return filled.select(F.col("raw").alias("full_name"), F.col("first_name").alias("given"), "sex")


@query("sex_dictionaries", """
  WITH l AS (SELECT year(o_orderdate) AS year, o_orderpriority AS position, c_mktsegment AS last, n_name AS given, 
      CASE WHEN o_totalprice > 100000 THEN 'M' ELSE 'F' END AS sex FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
  SELECT year, position, last, given, min(sex) AS sex FROM l GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT sex) = 1""")
def sex_dictionaries(t):
    listed = t.sql("""SELECT year(o_orderdate) AS year, o_orderpriority AS position, c_mktsegment AS last, n_name AS given,
      CASE WHEN o_totalprice > 100000 THEN 'M' ELSE 'F' END AS sex FROM {orders} JOIN {customer} ON o_custkey = c_custkey
      JOIN {nation} ON c_nationkey = n_nationkey""", "orders", "customer", "nation")
    return winners.sex_dictionaries(listed)[0]


# Person fields to fill: winners of all cycles, with middle names and sexes known for some.
PEOPLE = """
  SELECT year(o_orderdate) AS year, n_name AS province, c_mktsegment AS city,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'MAYOR' WHEN '2-HIGH' THEN 'GOVERNOR' ELSE 'COUNCILOR' END AS position,
    concat('S', CAST(floor(c_acctbal / 40) AS int)) AS last_name, concat('G', c_custkey) AS first_name,
    CASE WHEN o_orderstatus = 'F' THEN concat('M', c_custkey, CASE WHEN o_totalprice > 400000 THEN 'X' ELSE '' END) ELSE '' END AS middle_name,
    CASE WHEN o_orderstatus = 'O' AND o_totalprice > 250000 THEN CASE WHEN c_acctbal > 5000 OR o_totalprice > 480000 THEN 'M' ELSE 'F' END ELSE '' END AS sex,
    'Atty' AS title, concat('S', CAST(floor(c_acctbal / 40) AS int), ', G', c_custkey) AS full_name
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey"""
PEOPLE_TABLES = ["orders", "customer", "nation"]
PEOPLE_SQL = PEOPLE.replace("{", "").replace("}", "")
# Given names the lists know the sex of: those of customers above a balance, other names for the rest.
GIVENS = "SELECT concat(CASE WHEN c_acctbal > {least} THEN 'G' ELSE 'Q' END, c_custkey) AS given, 'F' AS sex FROM {{customer}}"
FILL_CYCLES = (1996, 1998, 2000, 2001)


def people(t):
    return t.sql(PEOPLE, *PEOPLE_TABLES)


def listed_rows(t, what):
    """What the lists know: the people of two cycles; of the others they have the names alone."""
    known = F.col("year").isin(1996, 1998)
    rows = people(t).withColumns({c: F.when(known, F.col(c)).otherwise("") for c in ("middle_name", "sex")})
    return backfill.winner_middles(rows, "list") if what == "middle" else backfill.winner_sexes(rows, "list")


def inherited_rows(t):
    """What an inherited file knows: another middle name for some people of two cycles."""
    some = F.col("year").isin(1998, 2000) & F.col("last_name").like("S1%")
    middle = F.when(some, F.concat(F.lit("I"), F.substring("first_name", 2, 9))).otherwise("")
    return backfill.winner_middles(people(t).withColumn("middle_name", middle), "inherited")


def index_sql(name, source, keys, value):
    """A table of the keys that have one value only."""
    return f"{name} AS (SELECT {keys}, min({value}) AS v FROM {source} GROUP BY ALL HAVING count(DISTINCT {value}) = 1)"


def looked_up(alias, keys, rows="p"):
    return f"LEFT JOIN {alias} ON " + " AND ".join(f"{rows}.{k} = {alias}.{k}" for k in keys.split(", "))


PERSON_SQL = "year, kp, city, position, last_name, first_name"
CITY, GOV = "position <> 'GOVERNOR'", "position = 'GOVERNOR'"
TOWNSMAN, KINSMAN, GOVERNOR = "city, last_name, first_name", "city, last_name", "kp, last_name, first_name"
MIDDLE_SQL = f"""
  p AS (SELECT row_number() OVER () AS id, replace(province, '_', ' ') AS kp, * FROM ({PEOPLE_SQL})),
  l AS (SELECT {PERSON_SQL}, middle_name AS m FROM p WHERE middle_name <> '' AND year IN (1996, 1998)),
  h AS (SELECT {PERSON_SQL}, 'I' || substr(first_name, 2) AS m FROM p WHERE year IN (1998, 2000) AND last_name LIKE 'S1%'),
  {", ".join(index_sql(f"{s}{k}", f"(FROM {s} WHERE {w})", f"year, {by}", "m") for s in "lh"
             for k, w, by in (("p", CITY, TOWNSMAN), ("s", CITY, KINSMAN), ("g", GOV, GOVERNOR)))},
  one AS (SELECT p.*, CASE WHEN {CITY} THEN coalesce(lp.v, ls.v) ELSE lg.v END AS of_list,
      CASE WHEN {CITY} THEN coalesce(hp.v, hs.v) ELSE hg.v END AS of_file FROM p
    {" ".join(looked_up(f"{s}{k}", f"year, {by}") for s in "lh" for k, by in (("p", TOWNSMAN), ("s", KINSMAN), ("g", GOVERNOR)))}),
  hits AS (SELECT * EXCLUDE (of_list, of_file), CASE WHEN middle_name = '' AND year IN (1996, 1998, 2000) THEN coalesce(of_list, of_file) END AS hit,
      CASE WHEN of_list IS NULL THEN 'v8.5' ELSE 'comelec_lec' END AS label FROM one),
  others AS (SELECT {PERSON_SQL}, coalesce(nullif(middle_name, ''), hit) AS m FROM hits WHERE year <> 2001 AND coalesce(nullif(middle_name, ''), hit) IS NOT NULL
    UNION ALL SELECT * FROM l UNION ALL SELECT * FROM h),
  {index_sql("op", f"(FROM others WHERE {CITY})", TOWNSMAN, "m")}, {index_sql("og", f"(FROM others WHERE {GOV})", GOVERNOR, "m")},
  two AS (SELECT hits.*, CASE WHEN middle_name = '' AND year = 2001 THEN CASE WHEN {CITY} THEN op.v ELSE og.v END END AS self
    FROM hits {looked_up("op", TOWNSMAN, "hits")} {looked_up("og", GOVERNOR, "hits")})"""
FILLED_MIDDLE = """coalesce(nullif(middle_name, ''), hit, self, '') AS middle_name,
    CASE WHEN middle_name <> '' THEN 'original' WHEN hit IS NOT NULL THEN label WHEN self IS NOT NULL THEN 'self-prior' ELSE '' END
      AS middle_name_source,
    last_name || ', ' || first_name || CASE WHEN middle_name = '' AND coalesce(hit, self) IS NOT NULL THEN ' ' || coalesce(hit, self) ELSE '' END AS full_name"""


def filled_middles(t):
    base = backfill.with_source_columns(people(t))
    return backfill.fill_winner_middles(base, listed_rows(t, "middle"), inherited_rows(t), FILL_CYCLES, 2001)


@query("backfilled_middles", f"""WITH {MIDDLE_SQL}
  SELECT year, province, city, position, last_name, first_name, {FILLED_MIDDLE} FROM two""")
def backfilled_middles(t):
    return filled_middles(t)[0].select("year", "province", "city", "position", "last_name", "first_name",
                                       "middle_name", "middle_name_source", "full_name")


@query("backfill_log", f"""WITH {MIDDLE_SQL}
  SELECT 'winners' AS dataset, year, province, city, position, last_name, first_name, 'Middle Name' AS field, coalesce(hit, self) AS value_filled,
    CASE WHEN hit IS NOT NULL THEN label ELSE 'self-prior' END AS source FROM two WHERE coalesce(hit, self) IS NOT NULL""")
def backfill_log(t):
    return filled_middles(t)[1]


@query("backfill_coverage", f"""WITH {MIDDLE_SQL}
  SELECT year, count(*) AS blanks, count(coalesce(hit, self)) AS filled,
    round_even(100.0 * count(coalesce(hit, self)) / count(*), 0) AS pct FROM two WHERE middle_name = '' GROUP BY 1""")
def backfill_coverage(t):
    return backfill.coverage_report(people(t), filled_middles(t)[1])


def cycle_sql(year, before):
    """Sexes of a cycle: its own list, then the person in any other cycle, fills included, then the given name."""
    c = f"c{year}"
    return f"""
  {index_sql(c + "p", f"(FROM ks WHERE year = {year} AND {CITY})", TOWNSMAN, "s")}, {index_sql(c + "s", f"(FROM ks WHERE year = {year} AND {CITY})", KINSMAN, "s")},
  {index_sql(c + "g", f"(FROM ks WHERE year = {year} AND {GOV})", GOVERNOR, "s")},
  {c}o AS (SELECT * FROM ks UNION ALL SELECT {PERSON_SQL}, s FROM {before} WHERE year <> {year} AND s IS NOT NULL),
  {index_sql(c + "op", f"(FROM {c}o WHERE {CITY})", TOWNSMAN, "s")}, {index_sql(c + "og", f"(FROM {c}o WHERE {GOV})", GOVERNOR, "s")},
  {c}h AS (SELECT p.*, CASE WHEN {CITY} THEN coalesce({c}p.v, {c}s.v) ELSE {c}g.v END AS a, CASE WHEN {CITY} THEN {c}op.v ELSE {c}og.v END AS b, gs.v AS g
    FROM {before} p {looked_up(c + "p", TOWNSMAN)} {looked_up(c + "s", KINSMAN)} {looked_up(c + "g", GOVERNOR)}
      {looked_up(c + "op", TOWNSMAN)} {looked_up(c + "og", GOVERNOR)} {looked_up("gs", "first_name")}),
  {c} AS (SELECT * EXCLUDE (s, sex_source, a, b, g), CASE WHEN s IS NULL AND year = {year} THEN coalesce(a, b, g) ELSE s END AS s,
      CASE WHEN s IS NULL AND year = {year} THEN CASE WHEN a IS NOT NULL THEN 'comelec_lec' WHEN b IS NOT NULL THEN 'self-prior'
        WHEN g IS NOT NULL THEN 'given-name' ELSE '' END ELSE sex_source END AS sex_source FROM {c}h)"""


@query("backfilled_winners", f"""WITH {MIDDLE_SQL},
  c0 AS (SELECT *, nullif(sex, '') AS s, CASE WHEN sex <> '' THEN 'prior' ELSE '' END AS sex_source FROM two),
  ks AS (SELECT {PERSON_SQL}, sex AS s FROM p WHERE sex <> '' AND year IN (1996, 1998)),
  gs AS (SELECT CASE WHEN c_acctbal > 9000 THEN 'G' ELSE 'Q' END || c_custkey AS first_name, 'F' AS v FROM customer),
  {", ".join(cycle_sql(y, f"c{b}") for b, y in zip((0, *FILL_CYCLES), FILL_CYCLES))}
  SELECT year, province, city, position, last_name, first_name, {FILLED_MIDDLE}, coalesce(s, sex) AS sex, sex_source, 'ATTY.' AS title
  FROM c{FILL_CYCLES[-1]}""")
def backfilled_winners(t):
    givens = t.sql(GIVENS.format(least=9000), customer=t.customer)
    return backfill.backfill_winners(people(t), listed_rows(t, "middle"), inherited_rows(t), listed_rows(t, "sex"),
                                     givens, FILL_CYCLES, 2001)[0]


SEXED_SQL = f"""
  p AS (SELECT row_number() OVER () AS id, replace(province, '_', ' ') AS kp, * FROM ({PEOPLE_SQL})),
  k AS (SELECT * FROM p WHERE sex <> ''),
  t1 AS (SELECT year, city, position, last_name, first_name, min(sex) AS v FROM k GROUP BY 1, 2, 3, 4, 5 HAVING count(DISTINCT sex) = 1),
  t2 AS (SELECT city, last_name, first_name, min(sex) AS v FROM k GROUP BY 1, 2, 3 HAVING count(DISTINCT sex) = 1),
  t3 AS (SELECT kp, last_name, first_name, min(sex) AS v FROM k GROUP BY 1, 2, 3 HAVING count(DISTINCT sex) = 1),
  c4 AS (SELECT first_name, sex, count(*) AS n FROM k GROUP BY 1, 2),
  s4 AS (SELECT first_name, sum(n) AS s, max(n) AS top FROM c4 GROUP BY 1 HAVING sum(n) >= 2 AND max(n) >= 0.8 * sum(n)),
  t4 AS (SELECT first_name, min(sex) AS v FROM s4 JOIN c4 USING (first_name) WHERE n = top GROUP BY 1),
  t5 AS (SELECT CASE WHEN c_acctbal > 3000 THEN 'G' ELSE 'Q' END || c_custkey AS first_name, 'F' AS v FROM customer)"""


@query("candidate_sexes", f"""WITH {SEXED_SQL}
  SELECT o_orderkey, coalesce(CASE WHEN win THEN t1.v END, t2.v, t3.v, t4.v, t5.v) AS sex,
    CASE WHEN win AND t1.v IS NOT NULL THEN 'winner-match' WHEN t2.v IS NOT NULL OR t3.v IS NOT NULL THEN 'person-match'
      WHEN t4.v IS NOT NULL THEN 'given-name-derived' WHEN t5.v IS NOT NULL THEN 'given-name' END AS sex_source
  FROM (SELECT o_orderkey, o_totalprice > 200000 AS win, replace(n_name, '_', ' ') AS kp, year(o_orderdate) AS year, c_mktsegment AS city,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'MAYOR' WHEN '2-HIGH' THEN 'GOVERNOR' ELSE 'COUNCILOR' END AS position,
      'S' || CAST(floor(c_acctbal / 40) AS integer) AS last_name, 'G' || c_custkey AS first_name
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) d
  LEFT JOIN t1 USING (year, city, position, last_name, first_name) LEFT JOIN t2 ON d.city = t2.city AND d.last_name = t2.last_name AND d.first_name = t2.first_name
  LEFT JOIN t3 ON d.kp = t3.kp AND d.last_name = t3.last_name AND d.first_name = t3.first_name
  LEFT JOIN t4 ON d.first_name = t4.first_name LEFT JOIN t5 ON d.first_name = t5.first_name""".replace(
    "floor(c_acctbal / 40) AS integer", "floor(c_acctbal / 40) AS int"))
def candidate_sexes(t):
    rows = t.sql("""SELECT o_orderkey, o_totalprice > 200000 AS is_winner, n_name AS province, year(o_orderdate) AS year, c_mktsegment AS city,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'MAYOR' WHEN '2-HIGH' THEN 'GOVERNOR' ELSE 'COUNCILOR' END AS position,
        concat('S', CAST(floor(c_acctbal / 40) AS int)) AS last_name, concat('G', c_custkey) AS first_name, cast(null as string) AS middle_name
      FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey""", *PEOPLE_TABLES)
    none = listed_rows(t, "sex").filter(F.lit(False))
    givens = t.sql(GIVENS.format(least=3000), customer=t.customer)
    return backfill.add_sexes(rows, people(t), none, givens).select("o_orderkey", "sex", "sex_source")


@query("filled_vote_counts")
def filled_vote_counts(t):
    ballots = counts(t)
    rows = ballots.withColumn("row_id", F.xxhash64(*ballots.columns))
    marked = backfill.race_winner_rows(rows, "row_id")
    middles, sexes = listed_rows(t, "middle"), listed_rows(t, "sex")
    givens = t.sql("SELECT DISTINCT upper(split_part(p_name, ' ', 1)) AS given, 'F' AS sex FROM {part}", "part")
    people_now = winners.to_winners_schema(elected(t, ballots))
    return backfill.fill_vote_counts(marked, people_now, middles, sexes, givens, FILL_CYCLES)[0]


# Places with stable codes: nations are units, segments the localities in them.
UNITS = """SELECT lpad(cast(n_nationkey as string), 10, '0') AS code, CASE n_nationkey WHEN 0 THEN 'Davao de Oro' ELSE replace(n_name, '_', ' ') END AS name,
  lpad(cast(n_regionkey as string), 10, '9') AS region FROM {nation}"""
TOWNS = ["Makati City", "Quezon", "City of Pasig", "Manila", "Las Piñas"]


def units(t):
    return t.sql(UNITS, "nation")


def towns(t):
    name = F.explode(F.array(*[F.lit(x) for x in TOWNS]))
    listed = units(t).select(F.col("code").alias("scope"), name.alias("name"))
    other = (F.col("name") == "Manila") & (F.col("scope") == "0000000005")
    return listed.withColumn("name", F.when(other, "Baclaran").otherwise(F.col("name"))) \
        .withColumn("code", F.concat_ws("-", "scope", F.upper("name")))


PLACED_SQL = f"""{COUNTS_SQL},
  d AS (SELECT year, region, province, city, position, candidate_name, coalesce(party, '') AS party, votes,
      CASE WHEN province = 'DAVAO DE ORO' THEN '0000000000' WHEN starts_with(province, 'NATION ')
        THEN lpad(replace(province, 'NATION ', ''), 10, '0') END AS scope,
      CASE city WHEN 'MAKATI' THEN 'MAKATI CITY' WHEN 'PASIG' THEN 'CITY OF PASIG' WHEN 'LAS PINAS' THEN 'LAS PIÑAS' ELSE city END AS town
    FROM counts WHERE region <> 'LAV' AND position IN ('SENATOR', 'PARTY LIST', 'GOVERNOR', 'MAYOR')),
  x AS (SELECT *, CASE WHEN scope IS NOT NULL AND NOT (scope = '0000000005' AND city = 'MANILA') THEN scope || '-' || town END AS code FROM d)"""


def placed_results(t, what):
    drawn = counts(t, ["year", "region", "province", "city", "position", "candidate_name", "party", "votes"],
                   list(place_results.DRAWN_RACES))
    return place_results.place_results(drawn, units(t), towns(t))[what]


def flat(cells, key):
    return cells.select("year", "position", key, "total", F.posexplode("top").alias("pos", "e")).select(
        "year", "position", key, "total", (F.col("pos") + 1).alias("place"), "e.candidate_name", "e.party", "e.votes")


def _cells_sql(key: str, where: str) -> str:
    return f"""WITH {PLACED_SQL},
  v AS (SELECT year, position, {key}, candidate_name, party, sum(votes) AS votes FROM (SELECT *, scope AS prov FROM x) WHERE {where} GROUP BY 1, 2, 3, 4, 5),
  r AS (SELECT *, row_number() OVER (PARTITION BY year, position, {key} ORDER BY votes DESC, candidate_name, party) AS place,
      sum(votes) OVER (PARTITION BY year, position, {key}) AS total FROM v)
  SELECT year, position, {key}, CAST(total AS bigint) AS total, CAST(place AS integer) AS place, candidate_name, party, CAST(votes AS bigint) AS votes
  FROM r WHERE place <= 6"""


@query("place_cells", _cells_sql("code", "code IS NOT NULL"))
def place_cells(t):
    return flat(placed_results(t, "cells"), "code")


@query("province_cells", _cells_sql("prov", "code IS NOT NULL AND position <> 'MAYOR'"))
def province_cells(t):
    return flat(placed_results(t, "province_cells"), "prov")


@query("place_metrics", f"""WITH {PLACED_SQL}
  SELECT count(DISTINCT (province, city)) AS pairs, count(DISTINCT CASE WHEN code IS NOT NULL THEN (province, city) END) AS resolved,
    CAST(sum(votes) AS bigint) AS votes, CAST(sum(votes) FILTER (code IS NULL) AS bigint) AS unplaced,
    round(100.0 * sum(votes) FILTER (code IS NULL) / sum(votes), 3) AS unplaced_pct FROM x""")
def place_metrics(t):
    return placed_results(t, "metrics")


@query("places_without_result", f"""WITH {PLACED_SQL},
  u AS (SELECT lpad('' || n_nationkey, 10, '0') AS scope, unnest(['Makati City', 'Quezon', 'City of Pasig',
      CASE n_nationkey WHEN 5 THEN 'Baclaran' ELSE 'Manila' END, 'Las Piñas']) AS name FROM nation)
  SELECT scope || '-' || upper(name) AS code, name FROM u WHERE scope || '-' || upper(name) NOT IN (SELECT code FROM x WHERE code IS NOT NULL)""")
def places_without_result(t):
    return placed_results(t, "no_result")


@query("unplaced_pairs", f"""WITH {PLACED_SQL}
  SELECT province, city, CAST(sum(votes) AS bigint) AS votes FROM x WHERE code IS NULL GROUP BY 1, 2""")
def unplaced_pairs(t):
    return placed_results(t, "unresolved")


# Office-holders of every cycle for the kinship report.
KIN = """
  SELECT year(o_orderdate) AS year, n_name AS province, c_mktsegment AS city, CASE WHEN o_orderpriority = '5-LOW' THEN 'MAYOR' ELSE 'COUNCILOR' END AS position,
    concat('S', CAST(floor(c_acctbal / 200) AS int)) AS last_name, concat('G', lpad(cast(c_custkey as string), 8, '0')) AS first_name,
    CASE WHEN o_totalprice > 300000 THEN concat('S', CAST(floor(o_totalprice / 10000) AS int)) END AS middle_name, c_name AS full_name
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey"""
KIN_UNITS = """SELECT lpad(cast(n_nationkey as string), 10, '0') AS code, replace(n_name, '_', ' ') AS name,
  lpad(cast(n_regionkey as string), 10, '9') AS region FROM {nation}"""


def kin_rows(t):
    provinces = t.sql(KIN_UNITS, "nation")
    segments = t.sql("SELECT DISTINCT c_mktsegment AS name FROM {customer}", "customer")
    places = provinces.select(F.col("code").alias("scope")).join(
        t.customer.select(F.lpad(F.col("c_nationkey").cast("string"), 10, "0").alias("scope"),
                          F.col("c_mktsegment").alias("name")).distinct(), "scope") \
        .join(segments, "name", "left_semi") \
        .withColumn("code", F.concat_ws("-", "scope", "name"))
    return kin.located_winners(t.sql(KIN, *PEOPLE_TABLES), provinces, places, units={}, spellings=())


def _kin(mine: str, theirs: str, op: str) -> str:
    return (f"EXISTS (SELECT 1 FROM tok x WHERE x.kind = '{theirs}' AND x.level = s.level AND x.unit = s.unit AND x.token = s.{mine} "
            f"AND x.year {op} s.year AND (x.lo <> s.person OR x.hi <> s.person))")


KIN_SQL = f"""
  w AS (SELECT *, lpad('' || n_regionkey, 10, '9') AS rc, lpad('' || c_nationkey, 10, '0') AS pc
    FROM (SELECT year(o_orderdate) AS year, n_regionkey, c_nationkey, c_mktsegment AS city, 'S' || CAST(floor(c_acctbal / 200) AS int) AS surname,
        'G' || lpad('' || c_custkey, 8, '0') AS first_name, CASE WHEN o_totalprice > 300000 THEN 'S' || CAST(floor(o_totalprice / 10000) AS int) ELSE '' END AS middle
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)),
  v AS (SELECT year, surname, middle, rc || surname || first_name AS person, rc, pc, pc || '-' || city AS cc FROM (
      SELECT * REPLACE (CASE WHEN starts_with(surname, 'S-') THEN 'S ' || surname[3:] ELSE surname END AS surname) FROM w)),
  s AS (SELECT 'region' AS level, rc AS unit, * FROM v UNION ALL SELECT 'province', pc, * FROM v UNION ALL SELECT 'municipality', cc, * FROM v),
  tok AS (SELECT 'S' AS kind, level, unit, surname AS token, year, min(person) AS lo, max(person) AS hi FROM s GROUP BY 2, 3, 4, 5
    UNION ALL SELECT 'M', level, unit, middle, year, min(person), max(person) FROM s WHERE middle <> '' GROUP BY 2, 3, 4, 5),
  f AS (SELECT level, unit, year, {_kin('surname', 'S', '=')} AS lf, {_kin('surname', 'S', '<>')} AS lt,
      {_kin('surname', 'M', '=')} OR {_kin('middle', 'S', '=')} OR {_kin('middle', 'M', '=')} AS mf,
      {_kin('surname', 'M', '<>')} OR {_kin('middle', 'S', '<>')} OR {_kin('middle', 'M', '<>')} AS mt FROM s)"""


@query("kin_report", f"""WITH {KIN_SQL}
  SELECT level, unit, year, count(*) AS total, count(*) FILTER (lf OR lt) AS last_both, count(*) FILTER (lf) AS last_fat, count(*) FILTER (lt) AS last_thin,
    count(*) FILTER (mf OR mt) AS middle_both, count(*) FILTER (mf) AS middle_fat, count(*) FILTER (mt) AS middle_thin,
    count(*) FILTER (lf OR lt OR mf OR mt) AS all_both, count(*) FILTER (lf OR mf) AS all_fat, count(*) FILTER (lt OR mt) AS all_thin
  FROM f GROUP BY 1, 2, 3""")
def kin_report(t):
    return kin.kin_report(kin.kin_table(checkpointed(kin_rows(t)), ()))[0]


@query("kin_clans", f"""WITH {KIN_SQL},
  c AS (SELECT level, unit, surname, count(DISTINCT person) AS people, count(*) AS seats FROM s WHERE level <> 'region' GROUP BY 1, 2, 3 HAVING count(DISTINCT person) >= 2)
  SELECT level, unit, surname, people, seats, CAST(place AS integer) AS clan_place FROM (
    SELECT *, row_number() OVER (PARTITION BY level, unit ORDER BY seats DESC, people DESC, surname) AS place FROM c) WHERE place <= 12""")
def kin_clans(t):
    return kin.kin_report(kin.kin_table(checkpointed(kin_rows(t)), ()))[1].select(
        "level", "unit", "surname", "people", "seats", "clan_place")


EXPLORE_SQL = f"""{LOCAL_SQL}, {NATIONAL_SQL},
  loc AS (SELECT year, position, region, province, candidate_name AS full_name, party FROM local),
  vt AS (SELECT year, province, position, candidate_name AS full_name, max(votes) AS votes FROM local GROUP BY 1, 2, 3, 4),
  rows_ AS (SELECT year, position, 'Nationwide' AS region, 'Nationwide' AS province, candidate_name AS full_name, party, votes FROM national
      UNION ALL SELECT loc.year, loc.position, region, loc.province, loc.full_name, party, votes
      FROM loc LEFT JOIN vt USING (year, province, position, full_name))"""
PRETTY = """CASE position WHEN 'MAYOR' THEN 'Mayor' WHEN 'GOVERNOR' THEN 'Governor' WHEN 'COUNCILOR' THEN 'Councilor'
    WHEN 'SENATOR' THEN 'Senator' ELSE 'Provincial Board Member' END"""


def explored(t):
    ballots = counts(t, ELECTING)
    won = checkpointed(elected(t, ballots))
    return explore.explore_rows(winners.to_winners_schema(won), won, ballots, range(1900, 2100))


@query("explore_rows", f"WITH {EXPLORE_SQL} SELECT year, {PRETTY} AS position, region, province, full_name, party, votes FROM rows_")
def explore_rows(t):
    return explored(t)


@query("explore_table", f"""WITH {EXPLORE_SQL}, b AS (SELECT year, {PRETTY} AS position, region, province, full_name, party, votes FROM rows_),
  a AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS c FROM (SELECT DISTINCT position AS v FROM b)),
  r AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS c FROM (SELECT DISTINCT region AS v FROM b)),
  p AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS c FROM (SELECT DISTINCT province AS v FROM b)),
  q AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS c FROM (SELECT DISTINCT party AS v FROM b WHERE party IS NOT NULL))
  SELECT year, a.c AS position, r.c AS region, p.c AS province, full_name, coalesce(q.c, -1) AS party, votes
  FROM b JOIN a ON position = a.v JOIN r ON region = r.v JOIN p ON province = p.v LEFT JOIN q ON party = q.v""")
def explore_table(t):
    return explore.explore_table(checkpointed(explored(t)))[0]


def _missing_sql(column: str) -> str:
    return f"""SELECT '{column}' AS col, year, count(*) FILTER ({column} IS NULL) AS nulls, count(*) AS total FROM merged GROUP BY 2"""


MISSING_SQL = " UNION ALL ".join(_missing_sql(c) for c in (
    "last_name", "first_name", "full_name", "position", "party", "year", "province", "city", "region", "sex"))


@query("winner_audit", f"""WITH {MERGED_SQL},
  gone AS (SELECT * FROM ({MISSING_SQL}) WHERE nulls > 0.5 * total),
  c AS (SELECT year, level, count(*) AS n FROM (SELECT year, CASE WHEN position IN ('MAYOR', 'COUNCILOR') THEN 'municipal' ELSE 'provincial' END AS level
      FROM merged) GROUP BY 1, 2),
  g AS (SELECT y.year, l.level, coalesce(n, 0) AS n FROM (SELECT DISTINCT year FROM c) y CROSS JOIN (SELECT DISTINCT level FROM c) l
      LEFT JOIN c ON c.year = y.year AND c.level = l.level),
  md AS (SELECT level, median(n) AS median FROM g GROUP BY 1),
  dr AS (SELECT year, position, n, expected, (n - expected) / expected AS drift FROM (SELECT year, position, count(*) AS n FROM merged GROUP BY 1, 2)
      JOIN (VALUES ('COUNCILOR', 1000), ('MAYOR', 125)) e(position, expected) USING (position)),
  sh AS (SELECT year, count(*) AS rows FROM (SELECT year, count(*) OVER (PARTITION BY year, province, position, full_name) AS n FROM merged)
      WHERE n > 1 GROUP BY 1)
  SELECT 'winners' AS dataset, CASE WHEN nulls = total THEN 'high' ELSE 'medium' END AS severity,
    col || CASE WHEN nulls = total THEN ' entirely missing' ELSE ' mostly missing' END AS issue, '' || year AS scope,
    format('{{:,}}', nulls) || ' of ' || format('{{:,}}', total) || ' rows have no ' || col AS detail FROM gone
  UNION ALL SELECT 'winners', 'high', level || ' offices largely missing', '' || year,
    n || ' rows vs a median of ' || format('{{:,.0f}}', median) FROM g JOIN md USING (level) WHERE median > 0 AND n < 0.5 * median
  UNION ALL SELECT 'winners', 'high', 'implausible ' || position || ' count', '' || year, format('{{:,}}', n) || ' rows, ' ||
    format('{{:,.0f}}', abs(drift) * 100) || '% ' || CASE WHEN n > expected THEN 'more' ELSE 'fewer' END || ' than ~' || format('{{:,}}', expected)
    FROM dr WHERE abs(drift) > 0.05
  UNION ALL SELECT 'winners', 'medium', 'same person listed twice for one seat', '' || year,
    format('{{:,}}', rows) || ' rows share province, position and name with another row' FROM sh""")
def winner_audit(t):
    return audits.audit_winners(checkpointed(merged(t)), {"COUNCILOR": 1000, "MAYOR": 125})


@query("vote_count_audit", f"""WITH {COUNTS_SQL}
  SELECT 'votecounts' AS dataset, 'info' AS severity, 'non-geographic tally category' AS issue, province AS scope,
    format('{{:,}}', count(*)) || ' rows (' || format('{{:,}}', CAST(sum(votes) AS bigint)) || ' votes); offices: ' ||
    string_agg(DISTINCT position, ', ' ORDER BY position) AS detail FROM counts WHERE NOT is_geographic GROUP BY province
  UNION ALL SELECT 'votecounts', 'high', 'party-list groups parsed as people', 'PARTY LIST',
    format('{{:,}}', count(*)) || ' organisation rows have person-name fields set' FROM counts
    WHERE position = 'PARTY LIST' AND last_name IS NOT NULL HAVING count(*) > 0
  UNION ALL SELECT 'votecounts', 'low', 'party missing', 'all cycles', format('{{:,}}', count(*) FILTER (party IS NULL)) || ' of ' ||
    format('{{:,}}', count(*)) || ' person rows have no party' FROM counts WHERE position <> 'PARTY LIST' HAVING count(*) FILTER (party IS NULL) > 0
  UNION ALL SELECT 'votecounts', 'high', 'capital absent', '' || y, 'no file for the capital' FROM (VALUES (1995), (2030)) v(y)
    WHERE y NOT IN (SELECT year FROM raw WHERE contains(upper(city), 'MANILA'))""")
def vote_count_audit(t):
    c = counts(t)
    coverage = audits.file_coverage(
        raw_ballots(t), F.col("region"), F.col("province"), F.concat_ws("/", "province", "city"))
    return audits.audit_vote_counts(c, coverage, [1995, 2030]).unionByName(audits.audit_files(coverage))


LETTERS_SQL = "trim(regexp_replace(upper({0}), '[^A-Z ]', '', 'g'))"


@query("alignment_audit", f"""WITH {LOCAL_SQL}, {NATIONAL_SQL},
  won AS (SELECT year, province, last_name FROM local UNION ALL SELECT year, NULL, last_name FROM national),
  f AS (SELECT DISTINCT year, {LETTERS_SQL.format("coalesce(province, 'nan')")} AS a, {LETTERS_SQL.format("coalesce(last_name, '')")} AS s FROM won
    WHERE year IN (1995, 1996, 1997)),
  b AS (SELECT DISTINCT year, {LETTERS_SQL.format("coalesce(province, 'nan')")} AS a, {LETTERS_SQL.format("split_part(candidate_name, ',', 1)")} AS s FROM counts),
  o AS (SELECT f.year, count(*) AS elected, count(*) FILTER (b.s IS NULL) AS orphans FROM f LEFT JOIN b ON f.year = b.year AND f.a = b.a AND f.s = b.s
    WHERE f.year IN (SELECT year FROM b) GROUP BY 1)
  SELECT 'alignment' AS dataset, 'high' AS severity, 'winners disagree with the ballots' AS issue, '' || year AS scope,
    format('{{:,}}', orphans) || ' of ' || format('{{:,}}', elected) || ' (' || printf('%.1f', 100.0 * orphans / elected) ||
    '%) surnames are on no ballot of their province' AS detail FROM o WHERE 100.0 * orphans / elected > 1
  UNION ALL SELECT 'alignment', 'info', 'no vote counts for this cycle', '' || y, 'this cycle cannot be verified against ballots'
    FROM (VALUES (1995), (1996), (1997), (2004)) v(y) WHERE y NOT IN (SELECT year FROM counts)
  UNION ALL SELECT DISTINCT 'alignment', 'info', 'partial vote counts for this cycle', '' || year, 'a complete check of winners against ballots is not expected'
    FROM counts WHERE year NOT IN (1995, 1996, 1997)""")
def alignment_audit(t):
    ballots = counts(t, ELECTING)
    won = winners.to_winners_schema(elected(t, ballots))
    return audits.audit_alignment(won, ballots, [1995, 1996, 1997], [1995, 1996, 1997, 2004])
