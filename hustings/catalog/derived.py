"""Election-shaped tables derived from the standard tables, in SQL that both engines run.

Order years are cycles, nations provinces, market segments cities, part kinds offices, part names
people; votes are summed quantities. Every line item takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from hustings.catalog.registry import Tables

BASE = """
  SELECT year(o_orderdate) AS y, r_name, n_name, c_mktsegment AS seg, p_type AS kind,
         upper(split_part(p_name, ' ', 1)) AS w1, upper(split_part(p_name, ' ', 2)) AS w2,
         CASE WHEN p_type IN ('STANDARD', 'MEDIUM', 'SMALL', 'PROMO')
              THEN replace(p_brand, 'Brand#', '') END AS brand,
         CASE WHEN p_type = 'LARGE' THEN CASE WHEN p_size <= 25 THEN 'FIRST' ELSE 'SECOND' END END
              AS dist,
         p_type IN ('SMALL', 'PROMO') AND o_orderpriority = '1-URGENT' AS lav,
         CAST(sum(l_quantity) AS bigint) AS votes
  FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
       JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
       JOIN {region} ON n_regionkey = r_regionkey JOIN {part} ON l_partkey = p_partkey
  GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10"""

RAW = f"""
  SELECT y AS year, kind, w1, w2, brand, dist, lav, r_name, n_name, seg,
    CASE WHEN lav THEN 'LAV' WHEN r_name = 'AFRICA' THEN 'Armm' WHEN r_name = 'AMERICA' THEN 'ncr'
         WHEN r_name = 'ASIA' THEN 'Region IV-A' WHEN r_name = 'EUROPE' THEN 'Car'
         ELSE 'Región  V' END AS region,
    CASE WHEN lav THEN 'LAV' WHEN n_name = 'NATION_0' THEN 'Compostela Valley'
         WHEN n_name = 'NATION_1' THEN 'Metro Manila'
         ELSE replace(replace(n_name, 'NATION', 'Nation'), '_', '-') END AS province,
    CASE WHEN lav THEN 'LAV' WHEN seg = 'BUILDING' THEN 'City of Makati'
         WHEN seg = 'AUTOMOBILE' THEN 'Quezon City' WHEN seg = 'MACHINERY' THEN 'Pasig'
         WHEN seg = 'HOUSEHOLD' THEN 'City of Manila' ELSE 'Las Piñas City' END AS city,
    CASE kind WHEN 'STANDARD' THEN concat('MAYOR of ', upper(n_name), ' - ', seg)
         WHEN 'ECONOMY' THEN concat('PROVINCIAL GOVERNOR ', upper(n_name))
         WHEN 'MEDIUM' THEN concat('MEMBER, SANGGUNIANG BAYAN ', upper(n_name), ' - ', seg, ' - LONE DIST')
         WHEN 'LARGE' THEN concat('Provincial  Board Member of ', upper(n_name), ' - ', dist, ' PROVDIST')
         WHEN 'SMALL' THEN 'SENATOR of PHILIPPINES' ELSE 'PARTY LIST of PHILIPPINES' END AS position,
    CASE kind WHEN 'STANDARD' THEN concat(w2, ', ATTY.', w1, ' (BRAND', brand, ')')
         WHEN 'ECONOMY' THEN concat('DR. ', w1, ' (TATA) ', w2)
         WHEN 'MEDIUM' THEN concat(w2, ',  ', w1, ' BRAND', brand)
         WHEN 'LARGE' THEN concat(w2, ',', w1, '(LAKAS')
         WHEN 'SMALL' THEN concat(w2, ', ', w1) ELSE concat(brand, ' ', w2, ' ', w1) END
      AS candidate_name,
    CASE kind WHEN 'STANDARD' THEN concat('Brand ', brand) WHEN 'ECONOMY' THEN 'Liberal Party'
         WHEN 'MEDIUM' THEN 'pdp laban / Nacionalista' WHEN 'LARGE' THEN NULL
         WHEN 'SMALL' THEN concat('Brand#', brand) ELSE 'GROUP' END AS party,
    votes
  FROM ({BASE}) b"""

TABLES = ["lineitem", "orders", "customer", "nation", "region", "part"]


def raw_ballots(t: Tables) -> DataFrame:
    """Ballot rows as a source would deliver them: untidy places, offices, names and parties."""
    rows = t.sql(RAW, *TABLES)
    return rows.selectExpr(
        "year", "region", "province", "city", "position", "cast(null as string) as rank",
        "candidate_name", "party", "cast(votes as string) as votes",
        "cast(null as string) as percentage")


def plain(sql: str) -> str:
    """The SQL for an engine that knows the tables by their names."""
    for name in [*TABLES, "supplier", "events", "documents", "pages", "labels", "conversations"]:
        sql = sql.replace("{" + name + "}", name)
    return sql


# The vote-counts table those rows must become, written from the same base columns.
COUNTS_SQL = f"""
  raw AS ({plain(RAW)}),
  counts AS (
    SELECT DISTINCT year,
      CASE WHEN lav THEN 'LAV' WHEN r_name = 'AFRICA' THEN 'BARMM'
           WHEN r_name = 'AMERICA' THEN 'NATIONAL CAPITAL REGION'
           WHEN r_name = 'ASIA' THEN 'REGION IV A'
           WHEN r_name = 'EUROPE' THEN 'CORDILLERA ADMINISTRATIVE REGION'
           ELSE 'REGION V' END AS region,
      CASE WHEN lav THEN 'LAV' WHEN n_name = 'NATION_0' THEN 'DAVAO DE ORO'
           WHEN n_name = 'NATION_1' THEN CASE seg WHEN 'BUILDING' THEN 'NCR FOURTH DISTRICT'
                WHEN 'AUTOMOBILE' THEN 'NCR SECOND DISTRICT' WHEN 'MACHINERY' THEN 'NCR SECOND DISTRICT'
                WHEN 'HOUSEHOLD' THEN 'NCR FIRST DISTRICT' ELSE 'NCR FOURTH DISTRICT' END
           ELSE replace(n_name, '_', ' ') END AS province,
      CASE WHEN lav THEN 'LAV' WHEN seg = 'BUILDING' THEN 'MAKATI' WHEN seg = 'AUTOMOBILE' THEN 'QUEZON'
           WHEN seg = 'MACHINERY' THEN 'PASIG' WHEN seg = 'HOUSEHOLD' THEN 'MANILA'
           ELSE 'LAS PINAS' END AS city,
      CASE kind WHEN 'MEDIUM' THEN 'LONE' ELSE dist END AS district,
      CASE kind WHEN 'STANDARD' THEN 'MAYOR' WHEN 'ECONOMY' THEN 'GOVERNOR'
           WHEN 'MEDIUM' THEN 'COUNCILOR' WHEN 'LARGE' THEN 'PROVINCIAL BOARD MEMBER'
           WHEN 'SMALL' THEN 'SENATOR' ELSE 'PARTY LIST' END AS position,
      CASE kind WHEN 'PROMO' THEN w2 || ' ' || w1
           WHEN 'MEDIUM' THEN w2 || ', ' || w1 || ' BRAND' || brand
           ELSE w2 || ', ' || w1 END AS candidate_name,
      CASE WHEN kind <> 'PROMO' THEN w2 END AS last_name,
      CASE WHEN kind <> 'PROMO' THEN w1 END AS first_name,
      CASE WHEN kind = 'MEDIUM' THEN 'BRAND' || brand END AS middle_name,
      CASE kind WHEN 'STANDARD' THEN 'ATTY.' WHEN 'ECONOMY' THEN 'DR.' END AS title,
      CASE kind WHEN 'STANDARD' THEN 'BRAND ' || brand WHEN 'ECONOMY' THEN 'LP'
           WHEN 'MEDIUM' THEN 'PDPLBN/NP' WHEN 'LARGE' THEN 'LAKAS'
           WHEN 'SMALL' THEN 'BRAND#' || brand END AS party,
      votes, kind IN ('SMALL', 'PROMO') AS is_national_race, NOT lav AS is_geographic,
      position AS raw_position, candidate_name AS reported_name,
      CASE WHEN kind = 'LARGE' THEN 'LAKAS' ELSE party END AS reported_party
    FROM raw)"""
