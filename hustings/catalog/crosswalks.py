"""Name-to-code crosswalks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hustings.catalog.registry import query
from hustings.operators import crosswalk
from hustings.plans.kin import city_codes, province_codes, simple_crosswalk
from hustings.plans.place_results import province_scopes

# Part names are the places; their first word, a colour or size, names the scope. A customer-made
# spelling has the place first and other words after it.
MESSY = """
  SELECT DISTINCT w1 AS scope_name, CASE WHEN p_type = 'SMALL' THEN concat('OLD ', w2)
      WHEN p_type = 'LARGE' THEN concat(w1, ' ', w2, ' ', p_type, ' ', upper(p_brand))
      ELSE concat(w1, ' ', w2, ' ', p_type) END AS key
  FROM (SELECT *, upper(split_part(p_name, ' ', 1)) AS w1, upper(split_part(p_name, ' ', 2)) AS w2 FROM {part}) p"""


def messy(t):
    return t.sql(MESSY, "part").withColumn("key", F.regexp_replace("key", "#", " "))


def place_names(t):
    return t.sql("""SELECT upper(split_part(p_name, ' ', 1)) AS scope, concat(upper(p_name), CASE WHEN p_size < 25 THEN '' ELSE ' FORMER' END) AS key,
      lpad(cast(min(p_partkey) as string), 10, '0') AS code FROM {part} GROUP BY 1, 2""", "part")


def word_scopes(t):
    return t.sql("""SELECT w AS scope_name, s AS scope, cast(p as int) AS scope_pos FROM (
      SELECT DISTINCT upper(split_part(p_name, ' ', 1)) AS w,
        upper(split_part(p_name, ' ', 1)) AS s, 0 AS p FROM {part}
      UNION ALL SELECT DISTINCT upper(split_part(p_name, ' ', 1)), 'RED', 1 FROM {part}) x""", "part")


def alias_rows(t):
    return t.sql("""SELECT DISTINCT CASE WHEN p_brand = 'Brand#1' THEN w1 END AS scope_name,
        concat(CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'OLD ' ELSE 'ELDEST ' END, w2) AS form, CASE WHEN p_brand = 'Brand#1' THEN concat(w1, ' ', w2)
          ELSE concat('RED ', w2) END AS alias
      FROM (SELECT p_brand, upper(split_part(p_name, ' ', 1)) AS w1, upper(split_part(p_name, ' ', 2)) AS w2
            FROM {part}) p""", "part")


NAMES_SQL = """
  p AS (SELECT *, upper(split_part(p_name, ' ', 1)) AS w1, upper(split_part(p_name, ' ', 2)) AS w2 FROM part),
  m AS (SELECT DISTINCT w1 AS scope_name, replace(CASE WHEN p_type = 'SMALL' THEN 'OLD ' || w2
      WHEN p_type = 'LARGE' THEN w1 || ' ' || w2 || ' ' || p_type || ' ' || upper(p_brand)
      ELSE w1 || ' ' || w2 || ' ' || p_type END, '#', ' ') AS key FROM p),
  names AS (SELECT w1 AS scope, upper(p_name) || CASE WHEN p_size < 25 THEN '' ELSE ' FORMER' END AS key,
              lpad(CAST(min(p_partkey) AS varchar), 10, '0') AS code FROM p GROUP BY 1, 2),
  scopes AS (SELECT DISTINCT w1 AS scope_name, w1 AS scope, 0 AS scope_pos FROM p
             UNION SELECT DISTINCT w1, 'RED', 1 FROM p),
  al AS (SELECT DISTINCT CASE WHEN p_brand = 'Brand#1' THEN w1 END AS scope_name,
           CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'OLD ' ELSE 'ELDEST ' END || w2 AS form,
           CASE WHEN p_brand = 'Brand#1' THEN w1 || ' ' || w2 ELSE 'RED ' || w2 END AS alias
         FROM p)"""


@query("crosswalk", f"""
  WITH {NAMES_SQL},
  f AS (SELECT scope_name, key, i, array_to_string(string_split(key, ' ')[1:len(string_split(key, ' ')) - i], ' ') AS form
        FROM m, unnest(range(len(string_split(key, ' ')))) r(i)),
  c AS (SELECT f.scope_name, f.key, 2 * i + 1 AS pos, form AS k FROM f
        UNION ALL SELECT f.scope_name, f.key, 2 * i, coalesce(o.alias, g.alias) FROM f
          LEFT JOIN al o ON o.scope_name = f.scope_name AND o.form = f.form
          LEFT JOIN al g ON g.scope_name IS NULL AND g.form = f.form
          WHERE coalesce(o.alias, g.alias) IS NOT NULL),
  h AS (SELECT c.scope_name, c.key, n.code, row_number() OVER (PARTITION BY c.scope_name, c.key
          ORDER BY scope_pos, pos) AS rn
        FROM c JOIN scopes s ON c.scope_name = s.scope_name JOIN names n ON n.scope = s.scope AND n.key = c.k)
  SELECT m.scope_name, m.key, h.code, CASE WHEN h.code IS NOT NULL THEN 'exact' END AS how
  FROM m LEFT JOIN h ON m.scope_name = h.scope_name AND m.key = h.key AND rn = 1""")
def full_crosswalk(t):
    return crosswalk.crosswalk(messy(t), word_scopes(t), place_names(t), ["scope_name", "key"],
                               "scope_name", "key", alias_rows(t), cutoff=None)


@query("simple_crosswalk", f"""
  WITH {NAMES_SQL}
  SELECT m.scope_name, m.key, coalesce(a.code, n.code) AS code FROM m
    LEFT JOIN al o ON o.scope_name = m.scope_name AND o.form = m.key
    LEFT JOIN al g ON g.scope_name IS NULL AND g.form = m.key
    LEFT JOIN names a ON a.scope = m.scope_name AND a.key = coalesce(o.alias, g.alias)
    LEFT JOIN names n ON n.scope = m.scope_name AND n.key = m.key""")
def one_scope_crosswalk(t):
    own = word_scopes(t).filter(F.col("scope_pos") == 0)
    return simple_crosswalk(messy(t), own, place_names(t), ["scope_name", "key"],
                            "scope_name", "key", alias_rows(t))


@query("near_spellings")
def near_spellings(t):
    # Each name with its vowels shifted, against all names of the same part type.
    rows = t.sql("SELECT DISTINCT p_type AS scope_name, upper(concat(p_name, ' ', p_brand)) AS name "
                 "FROM {part}", "part")
    pairs = rows.select("scope_name", F.translate(F.regexp_replace("name", "([AEIOU])[^AEIOU]+$", "$1"),
                                                  "#", " ").alias("key")) \
        .unionByName(rows.select("scope_name", F.concat(F.lit("X"), "name").alias("key"))).distinct()
    scopes = rows.select("scope_name", F.col("scope_name").alias("scope"),
                         F.lit(0).alias("scope_pos")).distinct()
    names = rows.select(F.col("scope_name").alias("scope"), F.col("name").alias("key"),
                        F.col("name").alias("code"))
    return crosswalk.near_spellings(pairs, scopes, names, ["scope_name", "key"], "scope_name", "key") \
        .select("scope_name", "key", "near", F.round("ratio", 6).alias("ratio"))


@query("planted_spellings", """
  SELECT DISTINCT p_type AS scope_name, 'X' || upper(p_name || ' ' || p_brand) AS key, upper(p_name || ' ' || p_brand) AS near,
    round(2.0 * length(p_name || ' ' || p_brand) / (2 * length(p_name || ' ' || p_brand) + 1), 6) AS ratio FROM part""")
def planted_spellings(t):
    # Each name with a letter in front: its best match is the name itself, n of 2n + 1 letters on either side.
    rows = t.sql("SELECT DISTINCT p_type AS scope_name, upper(concat(p_name, ' ', p_brand)) AS name FROM {part}", "part")
    pairs = rows.select("scope_name", F.concat(F.lit("X"), "name").alias("key"))
    scopes = rows.select("scope_name", F.col("scope_name").alias("scope"), F.lit(0).alias("scope_pos")).distinct()
    names = rows.select(F.col("scope_name").alias("scope"), F.col("name").alias("key"), F.col("name").alias("code"))
    return crosswalk.near_spellings(pairs, scopes, names, ["scope_name", "key"], "scope_name", "key") \
        .select("scope_name", "key", "near", F.round("ratio", 6).alias("ratio"))


@query("crosswalk_near", """
  WITH n AS (SELECT DISTINCT p_type AS scope_name, upper(p_name || ' ' || p_brand) AS name FROM part)
  SELECT scope_name, name AS key, name AS code, 'exact' AS how, NULL AS near, CAST(NULL AS double) AS ratio FROM n
  UNION ALL SELECT scope_name, 'X' || name, name, 'near', name, round(2.0 * length(name) / (2 * length(name) + 1), 6) FROM n
  UNION ALL SELECT scope_name, '?' || length(name), NULL, NULL, NULL, NULL FROM n GROUP BY ALL""")
def crosswalk_near(t):
    # Names as they are, with a letter in front, and what is like no name.
    rows = t.sql("SELECT DISTINCT p_type AS scope_name, upper(concat(p_name, ' ', p_brand)) AS name FROM {part}", "part")
    keys = [F.col("name"), F.concat(F.lit("X"), "name"), F.concat(F.lit("?"), F.length("name"))]
    pairs = rows.select("scope_name", F.explode(F.array(*keys)).alias("key")).distinct()
    scopes = rows.select("scope_name", F.col("scope_name").alias("scope"), F.lit(0).alias("scope_pos")).distinct()
    names = rows.select(F.col("scope_name").alias("scope"), F.col("name").alias("key"), F.col("name").alias("code"))
    return crosswalk.crosswalk(pairs, scopes, names, ["scope_name", "key"], "scope_name", "key") \
        .withColumn("ratio", F.round("ratio", 6))


@query("first_known_variant", """
  SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'NATION_' || (c_nationkey + 1) % 25
      ELSE n_name END AS variant
  FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def first_known_variant(t):
    rows = t.sql("""SELECT c_custkey, array(CASE WHEN c_mktsegment = 'BUILDING'
        THEN concat('NATION_', (c_nationkey + 1) % 25) ELSE concat('OLD ', n_name) END, n_name) AS v
      FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""", "customer", "nation")
    return crosswalk.first_known_variant(rows, ["c_custkey"], "v", t.nation, "n_name") \
        .select("c_custkey", "variant")


@query("name_variants", """
  SELECT c_custkey, 'R_' || n_name || '_' || upper(c_mktsegment) || '__' || upper(replace(c_name, '#', '_')) || '_' AS known
  FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def landed_variants(t):
    # The file that was landed collapses no underscores; it must be among the candidates.
    from hustings.sources.pages import name_variants
    rows = t.sql("""SELECT c_custkey, n_name, concat(c_mktsegment, ' (', c_name, ')') AS city
      FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""", "customer", "nation")
    known = rows.select(F.upper(F.regexp_replace(F.concat(
        F.lit("R_"), "n_name", F.lit("_"), "city"), "[^A-Za-z0-9_-]", "_")).alias("known"))
    listed = rows.withColumn("v", name_variants(F.lit("R"), F.col("n_name"), F.col("city")))
    return crosswalk.first_known_variant(listed, ["c_custkey"], "v", known, "known").select(
        "c_custkey", F.col("variant").alias("known"))


@query("province_codes", """
  SELECT DISTINCT c.label AS province, CASE WHEN c.label = 'Nation 3' THEN '9999999999'
      WHEN n_nationkey < 20 THEN lpad(CAST(n_nationkey AS varchar), 10, '0') END AS code
  FROM (SELECT n_nationkey, replace(replace(n_name, 'NATION', 'Nation'), '_', ' ') AS label
        FROM customer JOIN nation ON c_nationkey = n_nationkey) c""")
def unit_codes(t):
    rows = t.sql("""SELECT replace(replace(n_name, 'NATION', 'Nation'), '_', ' ') AS label
      FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""", "customer", "nation")
    units = t.sql("""SELECT lpad(cast(n_nationkey as string), 10, '0') AS code,
      concat(CASE WHEN n_nationkey < 20 THEN '' ELSE 'FORMER ' END, replace(n_name, '_', '-'), ' City') AS name FROM {nation}""", "nation")
    return province_codes(units, rows, "label", {"NATION 3": "9999999999"})


@query("province_scopes", """
  SELECT 'NATION ' || n_nationkey AS scope_name, lpad(CAST(n_nationkey AS varchar), 10, '0') AS scope, 0 AS scope_pos
  FROM nation WHERE n_nationkey NOT IN (5, 6) AND n_nationkey IN (SELECT c_nationkey FROM customer)
  UNION ALL SELECT 'NATION 5', 'a', 0 UNION ALL SELECT 'NATION 5', 'b', 1""")
def scopes_of_provinces(t):
    rows = t.sql("""SELECT replace(n_name, '_', '-') AS label
      FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""", "customer", "nation")
    units = t.sql("""SELECT lpad(cast(n_nationkey as string), 10, '0') AS code,
      CASE n_nationkey WHEN 6 THEN 'SIXTH' ELSE replace(n_name, '_', ' ') END AS name FROM {nation}""", "nation")
    return province_scopes(rows, "label", units, {"NATION 5": ["a", "b"], "ELSEWHERE": ["c"]})


@query("city_codes", """
  WITH p AS (SELECT DISTINCT n_name AS province, c_mktsegment AS city FROM customer JOIN nation ON c_nationkey = n_nationkey)
  SELECT province, city, province AS prov_code, CASE city WHEN 'BUILDING' THEN province ||
      CASE WHEN (province, 'MACHINERY') IN (SELECT (province, city) FROM p) THEN '-MACHINERY' ELSE '-BUILDING' END
      WHEN 'FURNITURE' THEN CASE WHEN province = 'NATION_7' THEN province || '-HOUSEHOLD' END
      ELSE province || '-' || city END AS code FROM p""")
def codes_of_cities(t):
    pairs = t.sql("""SELECT DISTINCT n_name AS province, c_mktsegment AS city, n_name AS prov_code
      FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""", "customer", "nation")
    listed = F.when(F.col("city") == "FURNITURE", "TIMBER").otherwise(F.col("city"))
    table = pairs.withColumn("city", listed).select(
        F.col("prov_code").alias("scope"), F.concat(F.lit("City of "), "city").alias("name"),
        F.concat_ws("-", "prov_code", "city").alias("code"))
    alias_table = t.spark.createDataFrame(
        [(None, "BUILDING", "MACHINERY"), ("NATION 7", "FURNITURE", "HOUSEHOLD")],
        "scope_name string, form string, alias string")
    return city_codes(pairs, table, alias_table)
