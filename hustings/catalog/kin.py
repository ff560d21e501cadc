"""One person under several names, kinship rates and clans over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hustings.catalog.registry import query
from hustings.operators import identity, kinship

# Office-holders: an order is a seat, its customer the person, the nation the unit. Surname and
# middle name come from two properties of the customer, so they meet across people.
SEATS = """
  SELECT o_orderkey, n_name AS unit, r_name AS area, year(o_orderdate) AS year, c_custkey AS person,
    concat(substr(c_mktsegment, 1, 2), '-', CAST(floor(c_acctbal / 500) AS int)) AS surname,
    CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE concat(substr(c_mktsegment, 1, 2), '-',
      CAST(floor(o_totalprice / 40000) AS int)) END AS middle,
    o_orderpriority AS office, c_name AS full_name
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
    JOIN {region} ON n_regionkey = r_regionkey"""
TABLES = ["orders", "customer", "nation", "region"]
SEATS_SQL = SEATS.replace("{", "").replace("}", "")


def seat_rows(t):
    return t.sql(SEATS, *TABLES)


def _other(mine: str, theirs: str, same: bool) -> str:
    """SQL: somebody else in the unit has the token, in the same or another year. The token table
    keeps distinct rows, so the test is a count instead of a pair of rows."""
    op = "=" if same else "<>"
    return (f"EXISTS (SELECT 1 FROM tok_{theirs} x WHERE x.unit = s.unit AND x.token = s.{mine} "
            f"AND s.{mine} <> '' AND x.year {op} s.year AND (x.lo <> s.person OR x.hi <> s.person))")


FLAGS_SQL = f"""
  s AS ({SEATS_SQL}),
  tok_surname AS (SELECT unit, surname AS token, year, min(person) AS lo, max(person) AS hi FROM s GROUP BY 1, 2, 3),
  tok_middle AS (SELECT unit, middle AS token, year, min(person) AS lo, max(person) AS hi FROM s
                 WHERE middle <> '' GROUP BY 1, 2, 3),
  f AS (SELECT s.*, {_other('surname', 'surname', True)} AS last_fat, {_other('surname', 'surname', False)} AS last_thin,
     ({_other('surname', 'middle', True)} OR {_other('middle', 'surname', True)} OR {_other('middle', 'middle', True)})
       AS middle_fat,
     ({_other('surname', 'middle', False)} OR {_other('middle', 'surname', False)} OR {_other('middle', 'middle', False)})
       AS middle_thin FROM s)"""


@query("kin_flags", f"""WITH {FLAGS_SQL}
  SELECT o_orderkey, last_fat, last_thin, middle_fat, middle_thin, last_fat OR middle_fat AS all_fat,
    last_thin OR middle_thin AS all_thin FROM f""")
def kin_flags(t):
    flagged = kinship.kin_flags(seat_rows(t), ["unit"], "person", "year", "surname", "middle")
    return flagged.select("o_orderkey", "last_fat", "last_thin", "middle_fat", "middle_thin",
                          "all_fat", "all_thin")


@query("kin_rates", f"""WITH {FLAGS_SQL}
  SELECT unit, year, count(*) AS total,
    count(*) FILTER (last_fat OR last_thin) AS last_both, count(*) FILTER (last_fat) AS last_fat,
    count(*) FILTER (last_thin) AS last_thin, count(*) FILTER (middle_fat OR middle_thin) AS middle_both,
    count(*) FILTER (middle_fat) AS middle_fat, count(*) FILTER (middle_thin) AS middle_thin,
    count(*) FILTER (last_fat OR middle_fat OR last_thin OR middle_thin) AS all_both,
    count(*) FILTER (last_fat OR middle_fat) AS all_fat, count(*) FILTER (last_thin OR middle_thin) AS all_thin
  FROM f GROUP BY 1, 2""")
def kin_rates(t):
    flagged = kinship.kin_flags(seat_rows(t), ["unit"], "person", "year", "surname", "middle")
    return kinship.kin_rates(flagged, ["unit"], "year")


@query("kin_levels", f"""
  WITH s AS ({SEATS_SQL})
  SELECT level, unit, year, count(*) AS total FROM (
    SELECT 'region' AS level, area AS unit, year FROM s UNION ALL SELECT 'province', unit, year FROM s)
  GROUP BY 1, 2, 3""")
def kin_levels(t):
    rows = kinship.leveled(seat_rows(t).withColumnRenamed("unit", "prov"),
                           {"region": "area", "province": "prov"})
    return rows.groupBy("level", "unit", "year").agg(F.count(F.lit(1)).alias("total"))


CLANS_SQL = f"""
  s AS ({SEATS_SQL}),
  c AS (SELECT unit, surname, count(DISTINCT person) AS people, count(*) AS seats,
          count(DISTINCT year) > 1 AS thin FROM s GROUP BY 1, 2 HAVING count(DISTINCT person) >= 2),
  y AS (SELECT unit, surname, bool_or(n > 1) AS fat FROM (
          SELECT unit, surname, year, count(DISTINCT person) AS n FROM s GROUP BY 1, 2, 3) GROUP BY 1, 2)"""


@query("clans", f"""WITH {CLANS_SQL}
  SELECT unit, surname, people, seats, fat, thin, greatest(0, people - 12) AS more FROM c JOIN y USING (unit, surname)""")
def clans(t):
    return kinship.clan_members(seat_rows(t), ["unit"], "surname", "person", "full_name", "year",
                                "office")[0]


@query("clan_members", f"""WITH {CLANS_SQL},
  m AS (SELECT unit, surname, person, min(full_name) AS name, count(DISTINCT (year, office)) AS seats
        FROM s JOIN (SELECT unit, surname FROM c) USING (unit, surname) GROUP BY 1, 2, 3)
  SELECT unit, surname, person, name, seats, CAST(place AS integer) AS place FROM (
    SELECT *, row_number() OVER (PARTITION BY unit, surname ORDER BY seats DESC, name, person) AS place FROM m)
  WHERE place <= 12""")
def clan_members(t):
    members = kinship.clan_members(seat_rows(t), ["unit"], "surname", "person", "full_name", "year",
                                   "office")[1]
    return members.withColumn("seats", F.size("seats").cast("bigint"))


@query("clan_detail", f"""WITH {CLANS_SQL},
  r AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY seats DESC, people DESC, surname) AS place,
    greatest(0, count(*) OVER (PARTITION BY unit) - 12) AS more_clans FROM c),
  m AS (SELECT unit, surname, person, min(full_name) AS name, count(DISTINCT (year, office)) AS n
        FROM s JOIN (SELECT unit, surname FROM c) USING (unit, surname) GROUP BY 1, 2, 3),
  k AS (SELECT *, row_number() OVER (PARTITION BY unit, surname ORDER BY n DESC, name, person) AS turn FROM m),
  l AS (SELECT unit, surname, string_agg(name || ': ' || n, '; ' ORDER BY turn) AS members FROM k WHERE turn <= 12 GROUP BY 1, 2)
  SELECT unit, surname, seats, CAST(place AS integer) AS clan_place, people, greatest(0, people - 12) AS more, more_clans, members
  FROM r JOIN l USING (unit, surname) WHERE place <= 12""")
def clan_detail(t):
    detail = kinship.clan_detail(seat_rows(t), ["unit"], "surname", "person", "full_name", "year",
                                 "office")
    shown = F.transform("members", lambda m: F.concat(m["name"], F.lit(": "), F.size(m["seats"]).cast("string")))
    return detail.select("unit", "surname", "seats", "clan_place", "people", "more", "more_clans",
                         F.array_join(shown, "; ").alias("members"))


# Names cut to different lengths are spellings of each other; the family is the part type.
SPELLINGS = """
  SELECT p_type AS family, substr(replace(upper(p_name), ' ', ''), 1,
      CAST(3 + floor(p_retailprice) % 9 AS int)) AS given, 1900 + p_size AS year,
    CASE WHEN p_size < 10 THEN '' WHEN p_size < 30 THEN 'X' ELSE replace(p_brand, '#', '') END AS middle
  FROM {part}"""

LINKS_SQL = f"""
  w AS (SELECT DISTINCT * FROM ({SPELLINGS.replace('{', '').replace('}', '')})),
  g AS (SELECT family, given, list(DISTINCT year) AS years,
          list(DISTINCT middle) FILTER (length(middle) > 1) AS mids FROM w GROUP BY 1, 2),
  e AS (SELECT a.family, a.given AS a, b.given AS b FROM g a JOIN g b ON a.family = b.family
          AND a.given <> b.given AND starts_with(b.given, a.given) AND length(a.given) >= 3
        WHERE substr(b.given, length(a.given) + 1) NOT IN ('JR', 'SR', 'II', 'III', 'IV', 'V')
          AND substr(b.given, length(a.given) + 1) <> a.given
          AND NOT list_has_any(a.years, b.years)
          AND (a.mids IS NULL OR b.mids IS NULL OR list_has_any(a.mids, b.mids))
          AND NOT EXISTS (SELECT 1 FROM g o WHERE o.family = a.family AND o.given <> a.given AND o.given <> b.given
            AND starts_with(o.given, a.given) AND NOT starts_with(b.given, o.given) AND NOT starts_with(o.given, b.given)))"""


def spelling_rows(t):
    return t.sql(SPELLINGS, "part")


@query("prefix_links", f"WITH {LINKS_SQL} SELECT family, a AS short, b AS long FROM e")
def prefix_links(t):
    rows = spelling_rows(t)
    profiles = identity.name_profiles(rows, ["family"], "given", "year")
    words = identity.middle_words(rows, ["family"], "given", "middle")
    return identity.prefix_links(profiles, words, ["family"], "given")


@query("same_person", f"""
  WITH RECURSIVE {LINKS_SQL},
  u AS (SELECT family, a, b FROM e UNION SELECT family, b, a FROM e),
  r AS (SELECT family, a AS given, a AS root FROM u UNION SELECT r.family, u.b, r.root FROM r
          JOIN u ON r.family = u.family AND r.given = u.a),
  k AS (SELECT family, given, min(root) AS root FROM r GROUP BY 1, 2)
  SELECT family, given, first_value(given) OVER (PARTITION BY family, root
    ORDER BY length(given) DESC, given) AS person_given FROM k""")
def same_person(t):
    return identity.same_person_names(spelling_rows(t), ["family"], "given", "year", "middle")
