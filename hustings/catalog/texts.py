"""Text, place, name, party and office functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hustings.catalog.registry import query
from hustings.functions import names, offices, parties, places, text

FOLDED = "regexp_replace(upper(strip_accents(replace(text, 'ß', 'SS'))), '{}', '{}', 'g')"


# Some texts with a character that decomposes into several letters, or into another one.
ODD = "concat(text, CASE doc_id % 50 WHEN 0 THEN ' Ⅱ' WHEN 1 THEN ' ǆem' WHEN 2 THEN ' № 5' WHEN 3 THEN ' ①' WHEN 4 THEN ' ﬃ' ELSE '' END)"
SPELLED = "text || CASE doc_id % 50 WHEN 0 THEN ' II' WHEN 1 THEN ' DZEM' WHEN 2 THEN ' NO 5' WHEN 3 THEN ' 1' WHEN 4 THEN ' FFI' ELSE '' END"


@query("fold_text", f"""
  SELECT doc_id, nullif(trim({FOLDED.format('[^A-Z0-9]+', ' ')}), '') AS folded FROM (SELECT doc_id, {SPELLED} AS text FROM documents)""")
def fold_text(t):
    return t.documents.selectExpr("doc_id", f"{ODD} AS text").select("doc_id", text.fold("text").alias("folded"))


@query("fold_place_text", f"""
  SELECT doc_id, nullif(trim({FOLDED.format('[-,.()[:space:]]+', ' ')}), '') AS folded
  FROM documents""")
def fold_place_text(t):
    return t.documents.select("doc_id", text.fold_place("text").alias("folded"))


@query("fold_keys", f"""
  SELECT doc_id, trim({FOLDED.format('[^A-Z ]', '')}) AS letters,
    regexp_replace(upper(replace(text, 'ß', 'SS')), '[^A-Z0-9]', '', 'g') AS squashed,
    length(trim(regexp_replace(text, '[[:space:]]+', ' ', 'g'))) AS squeezed_length
  FROM documents""")
def fold_keys(t):
    return t.documents.select(
        "doc_id", text.fold_letters("text").alias("letters"), text.squash("text").alias("squashed"),
        F.length(text.squeeze("text")).alias("squeezed_length"))


@query("canonical_places", """
  SELECT c_custkey,
    CASE r_name WHEN 'AFRICA' THEN 'BARMM' WHEN 'AMERICA' THEN 'NATIONAL CAPITAL REGION'
      WHEN 'ASIA' THEN 'REGION IV A' WHEN 'EUROPE' THEN NULL ELSE 'NEGROS ISLAND REGION' END AS region,
    CASE WHEN n_nationkey < 5 THEN CASE c_mktsegment WHEN 'BUILDING' THEN 'NCR FOURTH DISTRICT'
          WHEN 'AUTOMOBILE' THEN 'NCR SECOND DISTRICT' ELSE 'NCR' END
      WHEN n_nationkey < 10 THEN 'COTABATO' WHEN n_nationkey < 15 THEN 'NCR SECOND DISTRICT'
      ELSE replace(n_name, '_', ' ') END AS province,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'LAS PINAS' WHEN 'AUTOMOBILE' THEN 'QUEZON'
      ELSE c_mktsegment END AS city,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'CITY OF LAS PINAS' WHEN 'AUTOMOBILE' THEN 'QUEZON'
      ELSE c_mktsegment END AS key,
    n_nationkey <> 24 AS geographic
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def canonical_places(t):
    rows = t.sql("""
      SELECT c_custkey, c_nationkey,
        CASE r_name WHEN 'AFRICA' THEN ' autonomous region  in Muslim Mindanao'
          WHEN 'AMERICA' THEN 'NCR.' WHEN 'ASIA' THEN 'Region IV-A' WHEN 'EUROPE' THEN ' '
          ELSE 'nir' END AS region,
        CASE WHEN n_nationkey < 5 THEN 'National Capital Region'
          WHEN n_nationkey < 10 THEN 'COTABATO (NORTH COT.)'
          WHEN n_nationkey < 15 THEN 'NATIONAL CAPITAL REGION - SECOND DISTRICT'
          ELSE replace(n_name, '_', '-') END AS province,
        CASE c_mktsegment WHEN 'BUILDING' THEN 'City of Las Piñas' WHEN 'AUTOMOBILE' THEN 'Quezon City'
          ELSE lower(c_mktsegment) END AS city,
        CASE WHEN n_nationkey = 24 THEN 'LAV' ELSE n_name END AS tally
      FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
        JOIN {region} ON n_regionkey = r_regionkey""", "customer", "nation", "region")
    return rows.select(
        "c_custkey", places.canonical_region("region").alias("region"),
        places.resolve_province("province", "city").alias("province"),
        places.canonical_city("city").alias("city"),
        places.city_key(F.concat(F.lit("Municipality of "), "city")).alias("key"),
        places.is_geographic("tally", "region").alias("geographic"))


@query("city_keys", """
  SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
      trim(regexp_replace(upper(
        CASE p_type WHEN 'ECONOMY' THEN 'science city of ' || p_name WHEN 'SMALL' THEN p_name || ' city'
          WHEN 'LARGE' THEN 'Pres. ' || p_name WHEN 'PROMO' THEN 'Sto. ' || p_name || ' (Sta. ' || p_brand || ')'
          ELSE 'City of Municipality of ' || p_name END),
      '[^A-Z0-9]+', ' ', 'g')), '^(SCIENCE CITY OF )?(CITY OF )?(MUNICIPALITY OF )?', ''),
      ' CITY$', ''), '^PRES\\b', 'PRESIDENT'), '\\bSTO\\b', 'SANTO', 'g') AS key0,
    trim(regexp_replace(key0, '\\bSTA\\b', 'SANTA', 'g')) AS key FROM part""")
def city_keys(t):
    name = F.col("p_name")
    label = F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit("science city of "), name)) \
        .when(F.col("p_type") == "SMALL", F.concat(name, F.lit(" city"))) \
        .when(F.col("p_type") == "LARGE", F.concat(F.lit("Pres. "), name)) \
        .when(F.col("p_type") == "PROMO",
              F.concat(F.lit("Sto. "), name, F.lit(" (Sta. "), F.col("p_brand"), F.lit(")"))) \
        .otherwise(F.concat(F.lit("City of Municipality of "), name))
    folded = F.regexp_replace(text.fold(label),
                              "^(?:SCIENCE CITY OF )?(?:CITY OF )?(?:MUNICIPALITY OF )?", "")
    before = F.regexp_replace(F.regexp_replace(folded, " CITY$", ""), r"^PRES\b", "PRESIDENT")
    return t.part.select(
        "p_partkey", F.regexp_replace(before, r"\bSTO\b", "SANTO").alias("key0"),
        places.city_key(label).alias("key"))


@query("split_office", """
  SELECT p_partkey,
    CASE p_type WHEN 'STANDARD' THEN 'VICE MAYOR' WHEN 'ECONOMY' THEN 'COUNCILOR'
      WHEN 'MEDIUM' THEN 'GOVERNOR' WHEN 'LARGE' THEN 'MEMBER, HOUSE OF REPRESENTATIVES'
      WHEN 'SMALL' THEN 'SENATOR' END AS office,
    CASE p_type WHEN 'ECONOMY' THEN 'LONE'
      WHEN 'LARGE' THEN CASE WHEN p_size < 20 THEN 'FIRST' ELSE 'NORTH WEST' END END AS district,
    CASE p_type WHEN 'MEDIUM' THEN 'provincial' WHEN 'LARGE' THEN 'district'
      WHEN 'STANDARD' THEN 'municipal' WHEN 'ECONOMY' THEN 'municipal' END AS level,
    p_type = 'SMALL' AS national, true AS person
  FROM part""")
def split_office(t):
    rows = t.sql("""
      SELECT p_partkey, CASE p_type
        WHEN 'STANDARD' THEN concat('Vice-Mayor of ', p_name, ' - ', p_brand)
        WHEN 'ECONOMY' THEN concat('MEMBER,  SANGGUNIANG BAYAN ', upper(p_name), ' - LONE DIST')
        WHEN 'MEDIUM' THEN concat('Provincial Governor ', p_name)
        WHEN 'LARGE' THEN concat('MEMBER, HOUSE OF REPRESENTATIVES of ', p_brand, ' - ',
             CASE WHEN p_size < 20 THEN 'FIRST' ELSE 'North West' END, ' LEGDIST ')
        WHEN 'SMALL' THEN 'Senator of Philippines' ELSE concat(p_name, ' Mayor') END AS position
      FROM {part}""", "part")
    split = rows.withColumn("o", offices.split_office("position"))
    return split.select("p_partkey", "o.office", "o.district",
                        offices.office_level("o.office").alias("level"),
                        offices.is_national_race("o.office").alias("national"),
                        offices.is_person_office("o.office").alias("person"))


@query("standardize_names", """
  WITH p AS (SELECT *, upper(split_part(p_name, ' ', 1)) w1, upper(split_part(p_name, ' ', 2)) w2,
               replace(p_brand, 'Brand#', '') n FROM part)
  SELECT p_partkey, w2 AS last, w1 AS first,
    CASE p_type WHEN 'MEDIUM' THEN 'MID' || n || ' JR' WHEN 'PROMO' THEN 'B ' || n END AS middle,
    CASE p_type WHEN 'STANDARD' THEN 'ATTY.' WHEN 'ECONOMY' THEN 'DATU DR.' WHEN 'LARGE' THEN 'ENGR' END
      AS title,
    CASE p_type WHEN 'SMALL' THEN 'B' || n END AS recovered,
    CASE p_type WHEN 'MEDIUM' THEN w2 || ', ' || w1 || ' MID' || n || ' JR'
      WHEN 'PROMO' THEN w2 || ', ' || w1 || ' B ' || n ELSE w2 || ', ' || w1 END AS full_name,
    w1 AS given
  FROM p""")
def standardize_names(t):
    rows = t.sql("""
      SELECT p_partkey, p_brand AS party0, CASE p_type
        WHEN 'STANDARD' THEN concat(w2, ', Atty.', w1, ' (BD', n, ')')
        WHEN 'ECONOMY' THEN concat('DATU DR. ', w1, '  (TATA) ', w2)
        WHEN 'MEDIUM' THEN concat(w2, ',', w1, ' MID', n, ' JR')
        WHEN 'LARGE' THEN concat(w2, ', ENGR ', w1)
        WHEN 'SMALL' THEN concat(w2, ',', w1, '(b', n) ELSE concat(w1, ' B ', n, ' ', w2) END AS name,
        CASE WHEN p_type = 'SMALL' THEN ' ' ELSE p_brand END AS party
      FROM (SELECT *, upper(split_part(p_name, ' ', 1)) AS w1, upper(split_part(p_name, ' ', 2)) AS w2,
              replace(p_brand, 'Brand#', '') AS n FROM {part}) p""", "part")
    n = rows.withColumn("n", names.standardize_name("name", "party"))
    return n.select(
        "p_partkey", "n.last", "n.first", "n.middle", "n.title",
        names.clean_reported_name("name", "party")["recovered"].alias("recovered"),
        names.canonical_full_name("n.last", "n.first", "n.middle").alias("full_name"),
        names.given_token("n.first").alias("given"))


@query("given_names", """
  WITH p AS (SELECT *, upper(split_part(p_name, ' ', 1)) w1, upper(split_part(p_name, ' ', 2)) w2 FROM part)
  SELECT p_partkey,
    CASE p_type WHEN 'STANDARD' THEN 'L' || w1 WHEN 'ECONOMY' THEN w1 || w2 WHEN 'MEDIUM' THEN w1
      WHEN 'LARGE' THEN w2 WHEN 'SMALL' THEN 'MARIA' ELSE NULL END AS given,
    p_type = 'LARGE' AS has_middle,
    CASE p_type WHEN 'LARGE' THEN true WHEN 'STANDARD' THEN true
       WHEN 'SMALL' THEN w1 = w2 WHEN 'MEDIUM' THEN false END AS compatible,
    CASE p_type WHEN 'STANDARD' THEN 'ATTY.' WHEN 'ECONOMY' THEN 'DR.' WHEN 'MEDIUM' THEN 'Lady'
      ELSE '' END AS title,
    w2 AS listed_last, CASE WHEN p_type = 'PROMO' THEN w1 ELSE w1 || ' ' || w2 END AS listed_first,
    CASE WHEN p_type = 'PROMO' THEN '' ELSE upper(p_brand) END AS listed_middle
  FROM p""")
def given_names(t):
    rows = t.sql("""
      SELECT p_partkey, p_type, w1, w2, p_brand,
        CASE p_type WHEN 'STANDARD' THEN concat('L''', w1) WHEN 'ECONOMY' THEN concat(w1, '-', w2, ' x')
          WHEN 'MEDIUM' THEN concat('H. ', w1) WHEN 'LARGE' THEN 'Hadji H.' WHEN 'SMALL' THEN 'Ma. Clara'
          ELSE ' ' END AS first,
        CASE p_type WHEN 'LARGE' THEN w2 WHEN 'STANDARD' THEN 'L.' END AS middle,
        CASE p_type WHEN 'LARGE' THEN w2 WHEN 'STANDARD' THEN 'lim' WHEN 'SMALL' THEN w1
          WHEN 'MEDIUM' THEN w1 END AS a,
        CASE p_type WHEN 'LARGE' THEN substr(w2, 1, 1) WHEN 'STANDARD' THEN 'L.' WHEN 'SMALL' THEN w2
          WHEN 'MEDIUM' THEN concat(w1, 'X') END AS b,
        CASE p_type WHEN 'STANDARD' THEN 'atty' WHEN 'ECONOMY' THEN ' Dr.' WHEN 'MEDIUM' THEN 'Lady ' END
          AS title,
        CASE WHEN p_type = 'PROMO' THEN concat(w2, ', ', w1)
          ELSE concat(w2, ', ', w1, ' ', w2, '  ', upper(p_brand)) END AS listed
      FROM (SELECT *, upper(split_part(p_name, ' ', 1)) AS w1, upper(split_part(p_name, ' ', 2)) AS w2
            FROM {part}) p""", "part")
    listed = names.split_listed_name("listed")
    return rows.select(
        "p_partkey", names.extract_given("first", "middle").alias("given"),
        names.has_middle("middle").alias("has_middle"),
        names.middles_compatible("a", "b").alias("compatible"),
        names.canonical_title("title").alias("title"), listed["last"].alias("listed_last"),
        listed["first"].alias("listed_first"), listed["middle"].alias("listed_middle"))


@query("canonical_parties", """
  SELECT c_custkey,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'PDPLBN' WHEN 'AUTOMOBILE' THEN 'NP/LP/' || upper(n_name)
      WHEN 'MACHINERY' THEN 'NPC/ALAYON PANAGHIUSA' WHEN 'HOUSEHOLD' THEN NULL
      ELSE upper(n_name) END AS party,
    c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') AS coalition
  FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def canonical_parties(t):
    rows = t.sql("""
      SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN ' pdp  laban '
          WHEN 'AUTOMOBILE' THEN concat('Nacionalista / Liberal Party /', lower(n_name), '/')
          WHEN 'MACHINERY' THEN 'NPC/Alayon-Panaghiusa' WHEN 'HOUSEHOLD' THEN ' '
          ELSE lower(n_name) END AS label
      FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""", "customer", "nation")
    return rows.select("c_custkey", parties.canonical_party("label").alias("party"),
                       parties.is_coalition("label").alias("coalition"))


@query("party_tails", """
  WITH d AS (SELECT doc_id, regexp_replace(upper(source), '[^A-Z0-9]', '', 'g') t,
    regexp_replace(upper(replace(text, 'ß', 'SS')), '[^A-Z0-9]', '', 'g') p FROM documents)
  SELECT doc_id, t <> '' AND p <> '' AND regexp_matches(p, regexp_replace(t, '(.)', '\\1.*', 'g')) AS tail
  FROM d""")
def party_tails(t):
    return t.documents.select("doc_id", names.is_party_tail("source", "text").alias("tail"))


@query("number_texts", """
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN l_returnflag = 'R' OR l_linenumber = 4 THEN NULL ELSE l_discount * 100 END AS percent,
    CASE l_returnflag WHEN 'A' THEN NULL ELSE CAST(floor(l_extendedprice) AS bigint) END AS whole,
    CASE WHEN l_linestatus = 'F' OR l_linenumber > 5 THEN NULL ELSE CAST(l_quantity AS bigint) END AS number
  FROM lineitem""")
def number_texts(t):
    rows = t.sql("""
      SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        CASE WHEN l_returnflag = 'R' THEN '-' WHEN l_linenumber = 4 THEN '7f' ELSE concat(cast(l_discount * 100 as string), ' %') END AS p,
        CASE WHEN l_returnflag = 'A' THEN '-' ELSE format_number(floor(l_extendedprice), 0) END AS w,
        CASE WHEN l_linestatus = 'F' THEN '100 H.E.L.P' WHEN l_linenumber > 5 THEN concat(l_linenumber, 'd')
          ELSE cast(l_quantity as string) END AS n
      FROM {lineitem}""", "lineitem")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                       text.percent_value("p").alias("percent"),
                       text.count_value("w").alias("whole"), text.number_value("n").alias("number"))


@query("title_cases", """
  SELECT o_orderkey,
    CASE o_orderpriority WHEN '1-URGENT' THEN '1-Urgent of Vice Mayor O''Brien'
      WHEN '2-HIGH' THEN '2-High of Vice Mayor O''Brien' WHEN '3-MEDIUM' THEN '3-Medium of Vice Mayor O''Brien'
      WHEN '4-NOT SPECIFIED' THEN '4-Not Specified of Vice Mayor O''Brien'
      ELSE '5-Low of Vice Mayor O''Brien' END AS office
  FROM orders""")
def title_cases(t):
    label = F.concat("o_orderpriority", F.lit(" OF VICE-MAYOR O'BRIEN"))
    return t.orders.select("o_orderkey", text.pretty_office(label).alias("office"))


@query("slugs", """
  SELECT page_id,
    regexp_replace(regexp_replace(regexp_replace(url, '^https?://[^/]+/', ''), '%20', '', 'g'),
      '^/+|/+$', '', 'g') AS path,
    regexp_replace(path, '[^A-Za-z0-9]+', '_', 'g') || '.html' AS slug,
    upper(regexp_replace(regexp_replace(html, '[ñÑ]', '__', 'g'), '[^A-Za-z0-9_-]', '_', 'g')) AS file,
    replace(regexp_replace(upper(url), '[ /]', '_', 'g'), ',', '') AS token,
    len(string_split(regexp_replace(url, '/+$', ''), '/')) - 4 AS depth,
    string_split(CASE WHEN path LIKE 'en/%' THEN path[4:] ELSE path END, '/')[1] AS first_part
  FROM pages""")
def slugs(t):
    return t.pages.select(
        "page_id", text.url_path("url").alias("path"), text.page_slug("url").alias("slug"),
        text.file_slug("html").alias("file"), text.path_token("url").alias("token"),
        text.url_depth("url").alias("depth"),
        F.get(text.path_parts("url", "en"), F.lit(0)).alias("first_part"))


@query("capital_regions", """
  SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'NCR' ELSE n_name END AS region,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'NCR - ' || n_name ELSE c_mktsegment END AS province
  FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def capital_regions(t):
    rows = t.sql("""
      SELECT c_custkey, c_mktsegment AS province, CASE c_mktsegment WHEN 'BUILDING' THEN concat('NCR - ', n_name)
        WHEN 'MACHINERY' THEN 'NCR' ELSE n_name END AS label
      FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""", "customer", "nation")
    fixed = places.capital_region_fix("label", "province")
    return rows.select("c_custkey", fixed["region"].alias("region"),
                       fixed["province"].alias("province"))


@query("area_labels", """
  SELECT n_nationkey, n_name AS label, lpad(CAST(n_nationkey AS varchar), 10, '0') AS code,
    upper(n_name) AS spelling FROM nation""")
def area_labels(t):
    shown = F.concat("n_name", F.lit("  (Not a Province) "))
    return t.nation.select(
        "n_nationkey", places.area_label(shown).alias("label"),
        places.place_code("n_nationkey").alias("code"),
        text.fold_spelling(F.concat(F.lit(" "), "n_name", F.lit(" ,"))).alias("spelling"))
