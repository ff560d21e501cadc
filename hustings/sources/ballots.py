"""Per-locality ballot files, national and archived tabulations, and optional lookup files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hustings.functions.places import lookup
from hustings.functions.text import count_value, none_if_blank, number_value
from hustings.operators.groups import share_of_total, standing

BALLOT_COLUMNS = ["region", "province", "city", "position", "rank", "candidate_name", "party",
                  "votes", "percentage"]
BALLOT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in BALLOT_COLUMNS])

# Fixed values ---------------------------------------------------------------------------------
REGION_SLUGS = {
    "armm": "BARMM", "car": "CORDILLERA ADMINISTRATIVE REGION", "caraga": "REGION XIII",
    "ncr": "NATIONAL CAPITAL REGION", "region-1": "REGION I", "region-2": "REGION II",
    "region-3": "REGION III", "region-4a": "REGION IV A", "region-4b": "REGION IV B",
    "region-5": "REGION V", "region-6": "REGION VI", "region-7": "REGION VII",
    "region-8": "REGION VIII", "region-9": "REGION IX", "region-10": "REGION X",
    "region-11": "REGION XI", "region-12": "REGION XII",
}
PROVINCE_SLUGS = {
    "metropolitan-manila": "METRO MANILA",
    "north-cotabato": "COTABATO",
    "western-samar": "SAMAR",
}
WIDE_OFFICES = {"P": "PRESIDENT", "VP": "VICE PRESIDENT", "S": "SENATOR"}
# ----------------------------------------------------------------------------------------------


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob names anything, on whatever file system it lives."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(hadoop))


def read_optional(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                  **options: str) -> DataFrame | None:
    """A CSV with header as text columns, or None when the path is absent."""
    if not path_exists(spark, path):
        return None
    reader = spark.read.options(header="true", **options)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_ballots(spark: SparkSession, path: str, year: int | None = None) -> DataFrame:
    """All files of one cycle below ``path`` as text columns, with the year and the source file.

    Empty files contribute nothing; blank cells are null. Malformed lines keep what was read;
    ``malformed_lines`` lists them.
    """
    rows = spark.read.schema(BALLOT_SCHEMA).options(
        header="true", recursiveFileLookup="true", pathGlobFilter="*.csv", escape='"',
        mode="PERMISSIVE").csv(path)
    rows = rows.select(*[none_if_blank(c).alias(c) for c in BALLOT_COLUMNS],
                       F.col("_metadata.file_path").alias("source_file"))
    if year is None:
        found = F.nullif(F.regexp_extract("source_file", r"/(\d{4})/", 1), F.lit(""))
        return rows.withColumn("year", found.cast("int"))
    return rows.withColumn("year", F.lit(year).cast("int"))


def malformed_lines(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, line) of the lines below ``path`` that do not have the columns of a ballot file."""
    schema = T.StructType([*BALLOT_SCHEMA.fields, T.StructField("line", T.StringType())])
    rows = spark.read.schema(schema).options(
        header="true", recursiveFileLookup="true", pathGlobFilter="*.csv", escape='"', mode="PERMISSIVE",
        columnNameOfCorruptRecord="line").csv(path)
    # every column is read, else the reader does not look at the line as a whole
    torn = F.when(F.length(F.concat_ws("", *BALLOT_COLUMNS)) >= 0, F.col("line"))
    return rows.select(F.col("_metadata.file_path").alias("source_file"), torn.alias("line")).filter(F.col("line").isNotNull())


def place_from_path(path: Column | str, root: str) -> Column:
    """struct(region, province, file, stem) of a file below ``.../<root>/``."""
    path = F.col(path) if isinstance(path, str) else path
    inner = F.regexp_extract(path, ".*/" + root + "/(.*)$", 1)
    parts = F.split(inner, "/")
    n = F.size(parts)
    return F.struct(
        F.when(n > 1, F.get(parts, F.lit(0))).alias("region"),
        F.when(n > 2, F.get(parts, F.lit(1))).alias("province"),
        inner.alias("file"),
        F.regexp_replace(F.get(parts, n - 1), r"\.[^.]*$", "").alias("stem"))


def list_files(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """(file, bytes) of landed files without reading them into rows."""
    return spark.read.format("binaryFile").options(
        recursiveFileLookup="true", pathGlobFilter=pattern).load(path) \
        .select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"))


def empty_files(listing: DataFrame, rows: DataFrame) -> DataFrame:
    """Listed files that gave no row."""
    read = rows.select(F.col("source_file").alias("file")).distinct()
    return listing.join(read, "file", "left_anti")


def read_by_year_glob(spark: SparkSession, pattern: str,
                      year_regex: str = r"_(\d{4})[^/]*$") -> DataFrame | None:
    """Intermediates found by a glob; the year comes from the file or folder name."""
    rows = read_optional(spark, pattern)
    if rows is None:
        return None
    name = F.regexp_replace(F.col("_metadata.file_path"), r"/part-[^/]*$", "")
    return rows.select("*", F.regexp_extract(name, year_regex, 1).cast("int").alias("Year"))


def merge_secondary(primary: DataFrame, secondary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The primary source, and the secondary only where the primary lacks the key entirely.
    Missing and blank key parts are the same."""
    def keyed(df):
        return df.withColumns({f"__{k}": F.coalesce(none_if_blank(k), F.lit("")) for k in keys})
    names = [f"__{k}" for k in keys]
    extra = keyed(secondary).join(keyed(primary).select(*names).distinct(), names, "left_anti")
    return primary.unionByName(extra.drop(*names))


def with_race_figures(df: DataFrame, race: Sequence[str] = ("province", "city", "position"),
                      votes: str = "votes") -> DataFrame:
    """Percentage of the race total and place by votes, for sources that publish neither."""
    return standing(share_of_total(df, race, votes), race, votes)


def unslug(c: Column | str) -> Column:
    """``ilocos-norte`` to ``ILOCOS NORTE``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.upper(F.trim(F.regexp_replace(c, "[-_]+", " ")))


def shape_archive(rows: DataFrame, year: int, mirror: DataFrame | None = None) -> DataFrame:
    """Archived pages (slugs, office and area apart) in ballot shape, with share and place."""
    if mirror is not None:
        rows = merge_secondary(rows, mirror, ["province", "city"])

    def text(c):
        return F.coalesce(F.col(c), F.lit(""))
    office = F.when(text("area") != "", F.concat_ws(" of ", text("position"), text("area"))) \
        .otherwise(text("position"))
    shaped = rows.select(
        F.coalesce(lookup(REGION_SLUGS, F.col("region")), F.lit("")).alias("region"),
        F.coalesce(lookup(PROVINCE_SLUGS, F.col("province")), unslug(text("province")))
        .alias("province"),
        unslug(text("city")).alias("city"), office.alias("position"),
        text("candidate_name").alias("candidate_name"), text("party").alias("party"),
        F.coalesce(number_value("votes"), F.lit(0).cast("bigint")).alias("votes"),
        F.lit(year).cast("int").alias("year"))
    return with_race_figures(shaped)


def shape_national(rows: DataFrame, year: int) -> DataFrame:
    """A nationwide tabulation by locality in ballot shape, with share and place."""
    province = F.regexp_replace(F.coalesce(F.col("province"), F.lit("")),
                                "(?i)^national capital region.*", "METRO MANILA")
    shaped = rows.select(
        F.coalesce(F.col("region"), F.lit("")).alias("region"), province.alias("province"),
        F.coalesce(F.col("city"), F.lit("")).alias("city"),
        F.concat(F.col("position"), F.lit(" of PHILIPPINES")).alias("position"),
        F.upper("candidate_name").alias("candidate_name"), F.lit("").alias("party"),
        F.coalesce(number_value("votes"), F.lit(0).cast("bigint")).alias("votes"),
        F.lit(year).cast("int").alias("year"))
    return with_race_figures(shaped)


def wide_to_long(df: DataFrame, ids: dict[str, str], locality: str,
                 offices: dict[str, str] | None = None, year: int | None = None) -> DataFrame:
    """One column for each candidate (``CODE: NAME``) to one row for each, with whole-number votes.

    Rows with a blank locality and cells that are no number drop out.
    """
    offices = WIDE_OFFICES if offices is None else offices
    values = [c for c in df.columns if c.split(": ", 1)[0] in offices and ": " in c]
    kept = df.filter(none_if_blank(locality).isNotNull()).select(
        *[F.col(f"`{src}`").alias(out) for src, out in ids.items()],
        *[F.col(f"`{c}`") for c in values])
    long = kept.unpivot(list(ids.values()), [F.col(f"`{c}`") for c in values], "col", "cell") \
        .withColumn("votes", count_value("cell")).filter(F.col("votes").isNotNull())
    head = F.split("col", ":", 2)
    out = long.select(*ids.values(), lookup(offices, head[0]).alias("position"),
                      F.trim(head[1]).alias("candidate_name"), "votes")
    return out if year is None else out.withColumn("year", F.lit(year).cast("int"))


def read_wide(spark: SparkSession, path: str, ids: dict[str, str], locality: str,
              year: int) -> DataFrame:
    """``wide_to_long`` over a Latin-1 file."""
    rows = spark.read.options(header="true", encoding="ISO-8859-1").csv(path)
    return wide_to_long(rows, ids, locality, year=year)


def restrict(df: DataFrame, **allowed: Sequence) -> DataFrame:
    """Only the given values of some columns; on a partition column whole folders are skipped."""
    for c, values in allowed.items():
        if values:
            df = df.filter(F.col(c).isin(list(values)))
    return df
