"""Files that are landed, written and read again: derived from whole tables, kept below the checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from hustings.catalog.registry import query
from hustings.session import ensure_checkpoint_dir
from hustings.sources import ballots, sinks
from hustings.streaming.landing import land_stream

# Events as ballot rows: a type is a region, users are candidates of a few places.
VOTES = """
  SELECT event_type AS region, concat('P', user_id % 3) AS province, concat('C', user_id % 7) AS city, 'MAYOR' AS position,
    '1' AS rank, concat('N, ', user_id) AS candidate_name, CASE WHEN value > 50 THEN 'LP' END AS party,
    CAST(event_id AS string) AS votes, ' ' AS percentage, date_format(ts, 'dd') AS day FROM {events}"""
VOTES_SQL = VOTES.replace("date_format(ts, 'dd')", "strftime(ts, '%d')").replace("{", "").replace("}", "")
PLACE = ["region", "province", "city"]


def votes(t):
    return t.sql(VOTES, "events")


def folder(t) -> str:
    return f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/files-{uuid.uuid4().hex}"


def csv(rows, path, *by):
    rows.write.partitionBy(*by).csv(path, header=True)


@query("landed_stream", f"""
  SELECT region, province, city, candidate_name, votes FROM ({VOTES_SQL})
  QUALIFY day = max(day) OVER (PARTITION BY region, province, city)""")
def landed_stream(t):
    # A file for each day; a few files a batch, the late days first for half of the places.
    at = folder(t)
    csv(votes(t).withColumnRenamed("day", "arrived").repartition("arrived"), f"{at}/in", "arrived")
    arrived = F.regexp_extract(F.col("_metadata.file_path"), r"/arrived=(\d+)/", 1)
    land_stream(t.spark, f"{at}/in", f"{at}/out", f"{at}/mark", max_files=6, arrived=arrived).awaitTermination()
    return t.spark.read.parquet(f"{at}/out").select(*PLACE, "candidate_name", "votes")


@query("audit_log", f"SELECT DISTINCT region, city, candidate_name, party FROM ({VOTES_SQL})")
def audit_log(t):
    # Three runs: the first days, all days, and all days again.
    at, rows = folder(t), votes(t).select("region", "city", "candidate_name", "party", "day")
    for version, run in enumerate((rows.filter("day <= '10'"), rows, rows), start=1):
        log = sinks.append_audit(t.spark, run.drop("day"), at, version)
    return log


@query("ballot_files", f"""
  SELECT CASE WHEN length(candidate_name) % 2 = 0 THEN 2016 ELSE 2019 END AS year, 'at=' || region AS folder, region, province, city,
    position, rank, candidate_name, party, votes, CAST(NULL AS varchar) AS percentage FROM ({VOTES_SQL})""")
def ballot_files(t):
    at, rows = folder(t), votes(t).drop("day").withColumn("at", F.col("region"))
    even = F.length("candidate_name") % 2 == 0
    csv(rows.filter(even), f"{at}/2016", "at")
    csv(rows.filter(~even), f"{at}/2019", "at")
    read = ballots.read_ballots(t.spark, at)
    place = ballots.place_from_path("source_file", r"\d{4}")
    return read.select("year", place["region"].alias("folder"), *ballots.BALLOT_COLUMNS)


@query("torn_lines", f"""
  SELECT region || ',' || province || CASE WHEN CAST(votes AS bigint) % 2 = 0 THEN '' ELSE ',,,,,,,,,' || votes END AS line FROM ({VOTES_SQL})
  WHERE CAST(votes AS bigint) % 3 = 0""")
def torn_lines(t):
    # Every third line has too few or too many cells.
    at = folder(t)
    torn = F.concat(F.concat_ws(",", "region", "province"), F.when(F.col("votes").cast("bigint") % 2 == 0, "")
                    .otherwise(F.concat(F.lit(",,,,,,,,,"), "votes")))
    whole = F.concat_ws(",", "region", "province", "city", "position", "rank", F.concat(F.lit('"'), "candidate_name", F.lit('"')),
                        F.coalesce("party", F.lit("")), "votes", F.lit(""))
    lines = votes(t).select(F.when(F.col("votes").cast("bigint") % 3 == 0, torn).otherwise(whole).alias("value"))
    head = F.lit(",".join(ballots.BALLOT_COLUMNS)).alias("value")
    # one column whose name is the whole header, and neither separators nor quotes of its own
    lines.withColumnRenamed("value", ",".join(ballots.BALLOT_COLUMNS)).write.csv(at, header=True, sep="\x01", quote="\x02")
    return ballots.malformed_lines(t.spark, at).select("line")


@query("year_files", f"""
  SELECT CAST(CASE WHEN region < 'l' THEN 2010 ELSE 2013 END AS integer) AS "Year", candidate_name, votes FROM ({VOTES_SQL})""")
def year_files(t):
    at, rows = folder(t), votes(t).select("region", "candidate_name", "votes")
    early = F.col("region") < "l"
    csv(rows.filter(early), f"{at}/long_2010")
    csv(rows.filter(~early), f"{at}/long_2013")
    return ballots.read_by_year_glob(t.spark, f"{at}/long_*").select("Year", "candidate_name", "votes")


@query("written_localities", f"""
  SELECT region, province, city, CASE WHEN city = 'C3' THEN lower(candidate_name) ELSE candidate_name END AS candidate_name, votes
  FROM ({VOTES_SQL})""")
def written_localities(t):
    # The places of one city are written anew and replace their folders only.
    at, rows = folder(t), votes(t)
    sinks.write_localities(rows, at, ["candidate_name", "votes"])
    again = rows.filter("city = 'C3'").withColumn("candidate_name", F.lower("candidate_name"))
    sinks.write_localities(again, at, ["candidate_name", "votes"])
    return t.spark.read.csv(at, header=True).select(*PLACE, "candidate_name", "votes")


@query("written_table", f"SELECT region, city, candidate_name, votes FROM ({VOTES_SQL})")
def written_table(t):
    at = folder(t)
    sinks.write_table(votes(t).select("region", "city", "candidate_name", "votes"), at, ["region"])
    return t.spark.read.parquet(at).select("region", "city", "candidate_name", "votes")


@query("written_payload", f"SELECT region, city, candidate_name, party FROM ({VOTES_SQL})")
def written_payload(t):
    at = folder(t)
    sinks.write_payload(votes(t).select("region", "city", "candidate_name", "party"), at, "region")
    schema = "city string, candidate_name string, party string, region string"
    return t.spark.read.schema(schema).json(at).select("region", "city", "candidate_name", "party")
