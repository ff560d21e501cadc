"""Landed web pages: race tables, rendered text, captured addresses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.functions.text import path_parts, squeeze
from hustings.operators.groups import keep_first
from hustings.operators.ordered import following, running
from hustings.session import stored

# Fixed values ---------------------------------------------------------------------------------
MUNICIPAL_RACES = ["MAYOR", "VICE-MAYOR", "VICE MAYOR", "COUNCILOR", "MEMBER, SANGGUNIANG BAYAN",
                   "MEMBER, SANGGUNIANG PANLUNGSOD"]
PROVINCIAL_RACES = ["GOVERNOR", "PROVINCIAL GOVERNOR", "VICE-GOVERNOR", "VICE GOVERNOR",
                    "PROVINCIAL VICE-GOVERNOR", "PROVINCIAL BOARD MEMBER",
                    "MEMBER, SANGGUNIANG PANLALAWIGAN", "MEMBER, HOUSE OF REPRESENTATIVES"]
NATIONWIDE_RACES = ["SENATOR", "PARTY-LIST"]
HEADER_WORDS = ["PRESIDENT", "VICE-PRESIDENT", "SENATOR", "REPRESENTATIVE", "GOVERNOR",
                "VICE GOVERNOR", "MAYOR", "VICE MAYOR", "MEMBER, SANGGUNIANG",
                "MEMBER, HOUSE OF REPRESENTATIVES"]
SECTION_LINES = ["National Positions", "Local Positions", "Total COCs Received from BOC"]
HEADER_TEXT = r"[A-Z][A-Z ,./-]* of "
HEADER_PARTS = r"^\s*([A-Z][A-Z ,./-]*?)\s+of\s+(.+)"
TABLE_BOX = "phvote-tbl"
# ----------------------------------------------------------------------------------------------


def plain_text(html: Column) -> Column:
    """Text of a fragment: tags dropped, the usual entities resolved, spaces collapsed."""
    text = F.regexp_replace(html, "<[^>]*>", "")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
                         ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return squeeze(text)


def sections(pages: DataFrame, keys: Sequence[str], html: str, header_tag: str,
             header_text: str = "") -> DataFrame:
    """(keys, section, header, body): each whole page cut where a matching header starts. What
    precedes the first header belongs to none and is dropped."""
    start = rf"(?s)(?=<{header_tag}(?:\s[^>]*)?>(?:\s|<[^>]*>)*{header_text})"
    cut = pages.select(*keys, F.posexplode(F.split(html, start)).alias("section", "body"))
    head = F.regexp_extract("body", rf"(?s)^<{header_tag}(?:\s[^>]*)?>(.*?)</{header_tag}>", 1)
    begins = F.col("body").rlike(rf"(?s)^<{header_tag}(?:\s[^>]*)?>(?:\s|<[^>]*>)*{header_text}")
    return cut.filter(begins).select(*keys, "section", plain_text(head).alias("header"), "body")


def list_items(parts: DataFrame, keys: Sequence[str], item: str) -> DataFrame:
    """(keys, section, header, item_no, text) of every ``<item>`` below each header."""
    found = F.regexp_extract_all("body", F.lit(rf"(?s)<{item}(?:\s[^>]*)?>(.*?)</{item}>"), 1)
    return parts.select(*keys, "section", "header",
                        F.posexplode(found).alias("item_no", "raw")) \
        .select(*keys, "section", "header", "item_no", plain_text(F.col("raw")).alias("text"))


def table_rows(parts: DataFrame, keys: Sequence[str], box: str | None = TABLE_BOX) -> DataFrame:
    """(keys, section, header, table_no, row_no, cells) of the tables below each header; with
    ``box`` only tables inside a div of that class."""
    table = r"<table(?:\s[^>]*)?>(.*?)</table>"
    if box:
        table = rf'<div[^>]*class="[^"]*{box}[^"]*"[^>]*>(?:(?!</div>).)*?{table}'
    tables = parts.select(*keys, "section", "header", F.posexplode(
        F.regexp_extract_all("body", F.lit("(?s)" + table), 1)).alias("table_no", "t"))
    rows = tables.select(*keys, "section", "header", "table_no", F.posexplode(
        F.regexp_extract_all("t", F.lit(r"(?s)<tr(?:\s[^>]*)?>(.*?)</tr>"), 1))
        .alias("row_no", "r"))
    cells = F.transform(F.regexp_extract_all("r", F.lit(r"(?s)<td(?:\s[^>]*)?>(.*?)</td>"), 1),
                        lambda c: plain_text(c))
    return rows.select(*keys, "section", "header", "table_no", "row_no", cells.alias("cells"))


def race_rows(pages: DataFrame, keys: Sequence[str], html: str) -> DataFrame:
    """(keys, position, area, candidate_name, party, votes) of a result page: a table under each
    ``POSITION of PLACE`` header, rows candidate, party, votes."""
    rows = table_rows(sections(pages, keys, html, "p", HEADER_TEXT), keys)
    position = F.upper(squeeze(F.regexp_extract("header", HEADER_PARTS, 1)))
    area = F.upper(squeeze(F.regexp_extract("header", HEADER_PARTS, 2)))
    first, votes = F.get("cells", F.lit(0)), F.replace(F.get("cells", F.lit(2)), F.lit(","), F.lit(""))
    return rows.filter((F.size("cells") >= 3) & (first != "") & votes.rlike(r"^\d+$")).select(
        *keys, position.alias("position"), area.alias("area"),
        F.trim(F.regexp_replace(first, r"\s*\([^)]*\)\s*$", "")).alias("candidate_name"),
        F.trim(F.get("cells", F.lit(1))).alias("party"), votes.cast("bigint").alias("votes"))


def archived_races(pages: DataFrame, url: str, html: str, root: str, year: int,
                   national: bool = True) -> DataFrame:
    """Races of result pages kept at the level their address names: region/province/city pages
    carry municipal races, region/province pages provincial ones; nationwide races have no place."""
    rows = race_rows(pages, [url], html).withColumn("parts", path_parts(url, root))
    depth = F.size("parts")
    municipal = (depth >= 3) & F.col("position").isin(MUNICIPAL_RACES)
    provincial = (depth == 2) & F.col("position").isin(PROVINCIAL_RACES)
    wide = F.col("position").isin(NATIONWIDE_RACES) if national else F.lit(False)
    local = municipal | provincial
    nothing = F.lit("")
    return rows.filter(local | wide).select(
        F.lit(year).cast("int").alias("year"),
        F.when(local, F.get("parts", F.lit(0))).otherwise(nothing).alias("region"),
        F.when(local, F.get("parts", F.lit(1))).otherwise(nothing).alias("province"),
        F.when(municipal, F.get("parts", F.lit(2))).otherwise(nothing).alias("city"),
        "position", "area", "candidate_name", "party", "votes")


def captured_pages(captures: DataFrame, original: str, order: str, root: str) -> DataFrame:
    """Result pages of a capture listing: below ``root``, no precinct pages, one for each address
    without host, ``%20`` and trailing slashes; the first capture stands."""
    kept = captures.filter(F.col(original).rlike(f"/(?:%20)?{root}/")
                           & ~F.contains(F.col(original), F.lit("/precinct")))
    key = F.regexp_replace(F.replace(F.regexp_replace(original, "^https?://[^/]+", ""),
                                     F.lit("%20"), F.lit("")), "/+$", "")
    keyed = kept.withColumn("key", key).filter(F.col("key") != "")
    municipal = F.regexp_replace(F.col(original), "%20", "").rlike(f"/{root}/[^/]+/[^/]+/[^/]+$")
    return keep_first(keyed, ["key"], [order]).withColumn("municipality_page", municipal)


def text_results(lines: DataFrame, doc: Sequence[str], block: str, line: str, text: str,
                 seq: str) -> DataFrame:
    """(doc, position, rank, candidate_name, party, votes, percentage) from rendered page text.

    A header line names the office; a candidate is three lines: ``NAME (PARTY)``, votes, percent.
    A section line, or a bracketed line with an office word, ends the office.
    ``seq`` numbers the lines of a document without gaps.
    """
    t = F.col(text)
    word = F.lit(False)
    for w in HEADER_WORDS:
        word = word | F.contains(F.upper(t), F.lit(w))
    bracket = F.contains(t, F.lit("("))
    marked = lines.withColumn("__marker", F.when(
        word | t.isin(SECTION_LINES),
        F.struct((word & ~bracket).alias("opens"), t.alias("position"), F.col(seq).alias("at"))))
    state = stored(running(stored(marked), doc, block, line, last={"__state": F.col("__marker")}))
    ahead = following(state, doc, seq, text, [1, 2], "__next")
    votes = F.regexp_replace("__next_1", ",", "")
    opening, closing = F.locate("(", F.reverse(t)), F.locate(")", F.reverse(t))
    is_row = (F.col("__state.opens") & F.col("__marker").isNull() & bracket
              & F.contains(t, F.lit(")"))
              & F.regexp_replace(votes, r"\.", "").rlike(r"^\d+$")
              & F.contains(F.col("__next_2"), F.lit("%")))
    flagged = stored(ahead.withColumn("__row", F.coalesce(is_row, F.lit(False))))
    counted = stored(running(flagged, doc, block, line, total={"__n": F.col("__row").cast("int")}))
    base = running(
        counted, doc, block, line,
        last={"__before": F.when(F.col("__marker").isNotNull(), F.col("__n"))})
    n = F.length(t)
    return base.filter("__row").select(
        *doc, F.col("__state.position").alias("position"),
        (F.col("__n") - F.col("__before")).cast("int").alias("rank"),
        F.trim(F.substr(t, F.lit(1), n - opening)).alias("candidate_name"),
        F.trim(F.substr(t, n - opening + 2, opening - closing - 1)).alias("party"),
        votes.alias("votes"), F.col("__next_2").alias("percentage"))


def panel_rows(rows: DataFrame, keys: Sequence[str], position: str, cells: str) -> DataFrame:
    """Table rows under a position panel: ``"12. NAME (PARTY)"``, votes, percent. Category panels
    are skipped; a first cell without number is all name."""
    c = [F.trim(F.get(cells, F.lit(i))) for i in range(3)]
    skip = F.contains(F.col(position), F.lit("National Positions")) \
        | F.contains(F.col(position), F.lit("Local Positions"))
    numbered = F.contains(c[0], F.lit(". "))
    rest = F.regexp_extract(c[0], r"(?s)^.*?\. (.*)$", 1)
    bracketed = F.contains(rest, F.lit("(")) & F.contains(rest, F.lit(")"))
    parts = r"(?s)^(.*)\(([^()]*)\)[^)]*$"
    nothing = F.lit("")
    return rows.filter(~skip & (F.size(cells) >= 3)).select(
        *keys, F.col(position).alias("position"),
        F.when(numbered, F.regexp_extract(c[0], r"(?s)^(.*?)\. ", 1)).otherwise(nothing).alias("rank"),
        F.when(numbered & bracketed, F.trim(F.regexp_extract(rest, parts, 1)))
        .when(numbered, rest).otherwise(c[0]).alias("candidate_name"),
        F.when(numbered & bracketed, F.trim(F.regexp_extract(rest, parts, 2))).otherwise(nothing)
        .alias("party"),
        F.replace(c[1], F.lit(","), F.lit("")).alias("votes"), c[2].alias("percentage"))


def name_variants(region: Column, province: Column, city: Column,
                  single_city: Sequence[str] = ()) -> Column:
    """Ordered file-name candidates of one locality: spaces collapsed, the bracketed part dropped
    or taken instead, apostrophes dropped, CITY OF / CITY dropped; each also with runs of
    underscores collapsed. A province that is one city comes first, with no city part."""
    from hustings.functions.text import file_slug
    city = F.coalesce(city, F.lit(""))
    inner = F.trim(F.regexp_extract(city, r"\((.*?)\)", 1))
    bases = F.array(city, F.trim(F.regexp_replace(city, r"\s+", " ")),
                    F.trim(F.regexp_replace(city, r"\s*\(.*?\)\s*", "")), inner,
                    F.replace(city, F.lit("'"), F.lit("")))
    stripped = F.flatten(F.transform(bases, lambda c: F.array(
        F.trim(F.regexp_replace(c, r"^CITY OF\s+", "")),
        F.trim(F.regexp_replace(c, r"\s+CITY$", "")))))
    names = F.filter(F.array_distinct(F.concat(bases, stripped)), lambda c: c != "")
    slugs = F.flatten(F.transform(names, lambda c: F.array(
        file_slug(F.concat_ws("_", region, province, c)),
        F.regexp_replace(file_slug(F.concat_ws("_", region, province, c)), "_+", "_"))))
    lead = F.when(province.isin(list(single_city)),
                  F.array(file_slug(F.concat_ws("_", region, province)))) \
        .otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(lead, slugs))
