"""Lists of elected candidates, landed as document lines, to records.

Lines arrive as (doc, page, line, text) in reading order; ``page`` is the block that running state
is worked out in, so a document of any length is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.functions.names import given_token, has_middle, split_listed_name
from hustings.functions.places import canonical_city, canonical_province, lookup_or_same
from hustings.functions.text import fold, squeeze
from hustings.operators.groups import attach
from hustings.operators.ordered import previous, running
from hustings.session import stored

# Fixed values ---------------------------------------------------------------------------------
REGION_LABELS = ["ARMM", "CAR", "CARAGA", "NCR", "I", "II", "III", "IV", "V", "VI", "VII", "VIII",
                 "IX", "X", "XI", "XII", "XIII"]
LATE_REGION_LABELS = [*REGION_LABELS, "BARMM"]
DISTRICT_LINE = (r"^(\d+(ST|ND|RD|TH)|LONE|FIRST|SECOND|THIRD|FOURTH|FIFTH|SIXTH|SEVENTH|EIGHTH|"
                 r"NINTH) DISTRICT$")
LATE_DISTRICT_LINE = (r"^(\d+(ST|ND|RD|TH)|LONE|FIRST|SECOND|THIRD|FOURTH|FIFTH|SIXTH|SEVENTH|"
                      r"EIGHTH|NINTH|TENTH) DISTRICT$")
JUNK_STARTS = ["Republic of the", "COMMISSION ON", "Intramuros", "Records and", "LIST OF ELECTED",
               "May ", "Page ", "Notice", "All authorized", "including other", "conformity",
               "Privacy", "account", "and its Impl", "similarly bound"]
JUNK_LABELS = ["REGION :", "SEX", "NAME OF ELECTED CANDIDATES", "CITY / MUNICIPALITY", "PROVINCE",
               "PARTY AFFILIATION", "POSITION /", "DISTRICT", "REGION", "POSITION",
               "PROVINCE / CITY", "POSITION / DISTRICT"]
SEX_JUNK_STARTS = ["REPUBLIC", "COMMISSION", "INTRAMUROS", "RECORDS", "LIST OF", "PAGE ", "NOTICE",
                   "ALL AUTHORIZED", "INCLUDING", "CONFORMITY", "PRIVACY", "ACCOUNT", "AND ITS",
                   "SIMILARLY", "MAY "]
SEX_JUNK_LABELS = ["SEX", "NAME OF ELECTED CANDIDATES", "PARTY AFFILIATION", "PARTY AFILLIATION",
                   "CITY / MUNICIPALITY", "POSITION / DISTRICT", "ELECTIVE POSITION", "DISTRICT",
                   "PROVINCE", "REGION", "PROVINCE / CITY", "CITY/MUNICIPALITY"]
LATE_JUNK_LABELS = ["SEX", "PARTY", "AFFILIATION", "PARTY AFFILIATION", "PARTY AFILLIATION",
                    "DISTRICT", "ELECTIVE POSITION", "REGION / PROVINCE /",
                    "CITY / MUNICIPALITY /", "POSITION / DISTRICT", "NAME OF ELECTED CANDIDATES",
                    "REGION", "PROVINCE", "POSITION", "BARMM DISTRICT", "PROVINCE / CITY",
                    "CITY/MUNICIPALITY", "CITY / MUNICIPALITY", "POSITION /", "POSITION/DISTRICT"]
LISTED_POSITIONS = {
    "citymun": ["MAYOR", "VICE-MAYOR", "COUNCILOR"],
    "provincial": ["PROVINCIAL GOVERNOR", "PROVINCIAL VICE-GOVERNOR", "PROVINCIAL BOARD MEMBER"],
    "house": [],
}
HOUSE = "MEMBER, HOUSE OF REPRESENTATIVES"
POSITION_NAMES = {
    "MAYOR": "MAYOR", "VICE-MAYOR": "VICE MAYOR", "COUNCILOR": "COUNCILOR",
    "PROVINCIAL GOVERNOR": "GOVERNOR", "PROVINCIAL VICE-GOVERNOR": "VICE GOVERNOR",
    "PROVINCIAL BOARD MEMBER": "PROVINCIAL BOARD MEMBER", HOUSE: HOUSE,
}
PROVINCE_LABELS = {
    "TAWI-TAWI": "TAWI TAWI", "COMPOSTELA VALLEY": "DAVAO DE ORO", "DAVAO": "DAVAO DEL NORTE",
    "NCR - FIRST DISTRICT": "NCR FIRST DISTRICT", "NCR - SECOND DISTRICT": "NCR SECOND DISTRICT",
    "NCR - THIRD DISTRICT": "NCR THIRD DISTRICT", "NCR - FOURTH DISTRICT": "NCR FOURTH DISTRICT",
    "CEBU CITY": "CEBU", "DAVAO CITY": "DAVAO DEL SUR", "ILOILO CITY": "ILOILO",
    "BACOLOD CITY": "NEGROS OCCIDENTAL", "BAGUIO CITY": "BENGUET",
    "CAGAYAN DE ORO CITY": "MISAMIS ORIENTAL", "ZAMBOANGA CITY": "ZAMBOANGA DEL SUR",
    "CITY OF MANILA": "NCR FIRST DISTRICT", "CITY OF MAKATI": "NCR SECOND DISTRICT",
    "CITY OF PASIG": "NCR SECOND DISTRICT", "CITY OF MARIKINA": "NCR SECOND DISTRICT",
    "QUEZON CITY": "NCR SECOND DISTRICT", "SAN JUAN": "NCR SECOND DISTRICT",
    "CITY OF MANDALUYONG": "NCR SECOND DISTRICT", "KALOOCAN CITY": "NCR THIRD DISTRICT",
    "MALABON CITY - NAVOTAS": "NCR THIRD DISTRICT", "CITY OF VALENZUELA": "NCR THIRD DISTRICT",
    "PASAY CITY": "NCR FOURTH DISTRICT", "CITY OF PARAÑAQUE": "NCR FOURTH DISTRICT",
    "CITY OF LAS PIÑAS": "NCR FOURTH DISTRICT", "CITY OF MUNTINLUPA": "NCR FOURTH DISTRICT",
    "TAGUIG-PATEROS": "NCR FOURTH DISTRICT", "CITY OF ANTIPOLO": "RIZAL",
}
# Pattern -> office, in the order they are tried; anywhere in the line, or the whole line.
LOOSE_POSITIONS = [
    (r"VICE[ -]?MAYOR", "VICE MAYOR"), (r"\bMAYOR\b", "MAYOR"),
    (r"SANGGUNIANG (BAYAN|PANLUNGSOD)|\bCOUNCILOR\b", "COUNCILOR"),
    (r"VICE[ -]?GOVERNOR", "VICE GOVERNOR"), (r"\bGOVERNOR\b", "GOVERNOR"),
    (r"SANGGUNIANG PANLALAWIGAN|BOARD MEMBER", "PROVINCIAL BOARD MEMBER"),
    (r"HOUSE OF REPRESENTATIVES", HOUSE),
]
WHOLE_POSITIONS = [
    (r"^VICE[ -]?MAYOR$", "VICE MAYOR"),
    (r"^MAYOR$", "MAYOR"),
    (r"^(MEMBER, )?SANGGUNIANG (BAYAN|PANLUNGSOD)$|^COUNCILOR$", "COUNCILOR"),
    (r"^VICE[ -]?GOVERNOR$|^PROVINCIAL VICE-GOVERNOR$", "VICE GOVERNOR"),
    (r"^(PROVINCIAL )?GOVERNOR$", "GOVERNOR"),
    (r"^(MEMBER, )?SANGGUNIANG PANLALAWIGAN$|^PROVINCIAL BOARD MEMBER$|^BOARD MEMBER$",
     "PROVINCIAL BOARD MEMBER"),
    (r"HOUSE OF REPRESENTATIVES", HOUSE),
]
PLACE_HEADER = r"^PROVINCE/CITY/MUN\.?\s*:\s*(.+)$"
REGION_HEADER = r"^REGION\s*:\s*(.+)$"
PROVINCE_HEADER = r"^PROVINCE\s*:\s*(.+)$"
SEXES = {"M": "M", "F": "F", "MALE": "M", "FEMALE": "F"}
# ----------------------------------------------------------------------------------------------

DOC, PAGE, LINE = ["doc"], "page", "line"


def matched_office(line: Column, patterns: list[tuple[str, str]]) -> Column:
    """Office of the first pattern that occurs in the line, null when none does."""
    out = F.lit(None).cast("string")
    for pattern, office in reversed(patterns):
        out = F.when(line.rlike(pattern), F.lit(office)).otherwise(out)
    return out


def is_region_label(line: Column, late: bool = False) -> Column:
    """A bare region label; a label that starts with the capital's code is one as well."""
    start = "NCR " if late else "NCR -"
    return line.isin(LATE_REGION_LABELS if late else REGION_LABELS) | line.startswith(start)


def is_district_label(line: Column, late: bool = False) -> Column:
    return line.rlike(LATE_DISTRICT_LINE if late else DISTRICT_LINE)


def _starts_with_any(line: Column, starts: list[str]) -> Column:
    hit = F.lit(False)
    for s in starts:
        hit = hit | line.startswith(s)
    return hit


def clean_lines(lines: DataFrame, junk: Callable[[Column], Column]) -> DataFrame:
    """Spaces collapsed; blank lines and printed boilerplate dropped. Stored, since every pass reads
    the lines twice. The spaces of a line are collapsed once: a filter over the collapsed text would be
    pushed below it and collapse them again for each of its conditions."""
    kept = F.filter(F.array(squeeze("text")), lambda t: (t != "") & ~junk(t))
    return stored(lines.select("doc", "page", "line", F.explode(kept).alias("text")))


def _carry(df: DataFrame, totals: dict[str, Column] | None = None,
           **states: tuple[Column, Column]) -> DataFrame:
    """Carries several values at once: each ``name=(value, when)`` holds the value (null included)
    of the latest line where ``when`` holds. ``totals`` are summed in the same pass."""
    packed = running(df, DOC, PAGE, LINE, total=totals, last={
        f"__{n}": F.when(when, F.struct(value.alias("v"))) for n, (value, when) in states.items()})
    return packed.withColumns({n: F.col(f"__{n}.v") for n in states}) \
        .drop(*[f"__{n}" for n in states])


def parse_listing(lines: DataFrame, kind: str) -> DataFrame:
    """(doc, region, province, city, position, district, name, party, sex) of one listing.

    ``kind``: citymun, provincial or house. A record ends with a sex line; the line before it is
    the party; the name starts at the record's first line with a comma and may wrap. Places and
    offices carry forward.
    """
    positions = LISTED_POSITIONS[kind]

    def junk(line: Column) -> Column:
        printed = _starts_with_any(line, JUNK_STARTS) | line.isin(JUNK_LABELS)
        return printed | (line.rlike(r"^\d+$") & ~is_region_label(line)) if kind == "provincial" else printed
    rows = clean_lines(lines, junk)
    t = F.col("text")
    rows = rows.withColumn("kind", F.when(is_region_label(t), "region")
                           .when(t.isin(positions), "position")
                           .when(is_district_label(t), "district")
                           .when(t.isin("M", "F"), "sex").otherwise("text"))
    rows = stored(previous(rows, DOC, PAGE, LINE, {"text": "prev_text", "kind": "prev_kind"}))
    buffered = F.when(F.col("prev_kind") == "text", F.col("prev_text"))
    rows = rows.withColumn("buffered", buffered)
    k = F.col("kind")
    capital = t.startswith("NCR")
    states = {"region": (F.when(capital, F.lit("NCR")).otherwise(t), k == "region")}
    held = F.col("buffered").isNotNull()
    named_region = (k == "region") & capital & (t != "NCR")
    if kind == "citymun":
        own = F.when(capital & (t != "NCR"), t).otherwise(F.col("buffered"))
        states["province"] = (own, (k == "region") & own.isNotNull())
        states["city"] = (F.col("buffered"), (k == "position") & held)
    elif kind == "provincial":
        own = F.when(k == "region", t).otherwise(F.col("buffered"))
        states["province"] = (own, named_region | ((k == "position") & held))
    if kind != "house":
        states["position"] = (t, k == "position")
        states["district"] = (F.when(k == "district", t), k.isin("position", "district"))
    # The record of a sex line is the run of text lines since the last line of another kind.
    rows = stored(_carry(rows, {"segment": (k != "text").cast("int")}, **states))
    rows = rows.withColumn("record", F.when(k == "sex", F.col("segment") - 1)
                           .otherwise(F.col("segment")))
    named = listed_names(rows, kind == "citymun")
    if kind == "house":
        # Here the province is known only once the record's name has been found.
        rows = rows.filter(k != "text").join(named, ["doc", "record"], "left") \
            .withColumn("__named", (k == "sex") & F.col("name").isNotNull())
        rows = stored(rows)
        own = F.when(k == "region", t).otherwise(F.col("before_name"))
        rows = _carry(rows, province=(own, named_region | (
            F.col("__named") & F.col("before_name").isNotNull())))
        rows = rows.filter("__named").withColumn("position", F.lit(HOUSE)) \
            .withColumn("district", F.lit(None).cast("string"))
    else:
        rows = rows.filter(k == "sex").join(named, ["doc", "record"])
    city = F.col("city") if kind == "citymun" else F.lit("")
    return rows.select("doc", "region", "province", city.alias("city"), "position",
                       F.coalesce("district", F.lit("")).alias("district"), "name", "party",
                       t.alias("sex"))


def listed_names(rows: DataFrame, numbered: bool) -> DataFrame:
    """(doc, record, party, name, before_name) of the records of a listing.

    ``rows``: doc, page, line, text, kind, record, and text and kind of the line before. A record's
    last line is its party. Its name begins at the first line with a comma and ends before the
    party, or with ``numbered`` before the number that stands there. Each record is scanned for
    these two places; lines before the name are never gathered, however many there are.
    """
    at = F.struct("page", "line")
    ends = rows.filter(F.col("kind") == "sex").select("doc", "record")
    body = rows.filter(F.col("kind") == "text").join(ends, ["doc", "record"], "left_semi")
    number = F.col("prev_kind").eqNullSafe("text") & F.col("prev_text").rlike(r"^\d+\.$") & F.lit(numbered)
    comma = F.contains(F.col("text"), F.lit(","))
    before = F.when(F.col("prev_kind") == "text", F.col("prev_text"))
    places = body.groupBy("doc", "record").agg(
        F.min_by(F.struct(at.alias("at"), before.alias("before")), F.when(comma, at)).alias("first"),
        F.max_by(F.struct(at.alias("at"), F.col("text").alias("party"), number.alias("number")), at).alias("last"))
    named = attach(body, places.filter(F.col("first.at") < F.col("last.at")), ["doc", "record"], "inner") \
        .filter((at >= F.col("first.at")) & (at < F.col("last.at")))
    # the number is the last line before the party
    lines = named.groupBy("doc", "record").agg(
        F.array_sort(F.collect_list(F.struct("page", "line", "text"))).alias("lines"),
        F.first("first").alias("first"), F.first("last").alias("last"))
    texts = F.transform("lines", lambda e: e["text"])
    kept = F.when(F.col("last.number"), F.slice(texts, F.lit(1), F.size("lines") - 1)).otherwise(texts)
    return lines.select("doc", "record", F.col("last.party").alias("party"), F.array_join(kept, " ").alias("name"),
                        F.col("first.before").alias("before_name"))


def listed_winners(records: DataFrame, year: Column | int) -> DataFrame:
    """Listing records in the winners schema; the middle name is the last word of the name."""
    def bare(c):
        return F.trim(F.regexp_replace(c, r"\s*\(.*?\)", ""))
    year = F.lit(year) if isinstance(year, int) else year
    name = split_listed_name("name")
    return records.select(
        name["last"].alias("last_name"), name["first"].alias("first_name"),
        name["middle"].alias("middle_name"), F.lit("").alias("title"),
        F.col("name").alias("full_name"),
        lookup_or_same(POSITION_NAMES, F.col("position")).alias("position"), "party",
        year.cast("int").alias("year"),
        lookup_or_same(PROVINCE_LABELS, bare(F.col("province"))).alias("province"),
        bare(F.coalesce("city", F.lit(""))).alias("city"), F.lit("").alias("region"), "sex")


def parse_records(lines: DataFrame, category: str) -> DataFrame:
    """(doc, province, city, position, last, first, middle, sex) for listings of the later layouts.

    A candidate line holds a comma. After it come an optional rank and two lines with party and
    sex in either order; those belong to the candidate whatever they say. The city is the bare
    line before MAYOR, the province a header, a prefixed line or a bare line, by layout.
    """
    t = F.col("text")
    rows = clean_lines(lines, lambda line: line.rlike("[a-z]") | line.isin(LATE_JUNK_LABELS))
    office = matched_office(t, WHOLE_POSITIONS)
    comma = F.contains(t, F.lit(","))
    place = F.nullif(F.regexp_extract(t, PLACE_HEADER, 1), F.lit(""))
    region_head = t.rlike(REGION_HEADER)
    province_head = F.nullif(F.regexp_extract(t, PROVINCE_HEADER, 1), F.lit(""))
    region = is_region_label(t, late=True)
    position = office.isNotNull() & (~comma | t.startswith("MEMBER,"))
    header = region_head | province_head.isNotNull() | place.isNotNull() | region
    name = (comma & ~header & ~t.startswith("PROVINCE/CITY/MUN")
            & ~is_district_label(t, late=True) & ~position)
    rank = t.rlike(r"^\d+\.?$")
    # Lines a pending candidate takes in; every other line but a rank ends the candidate.
    takes = office.isNull() & ~comma & ~header & ~rank
    rows = stored(rows.withColumns({"office": office, "is_name": name, "is_rank": rank, "takes": takes}))
    rows = stored(running(rows, DOC, PAGE, LINE, total={"taken": F.col("takes").cast("int")}))
    rows = running(rows, DOC, PAGE, LINE, last={"__open": F.when(
        ~F.col("takes") & ~F.col("is_rank"),
        F.struct(F.col("is_name").alias("pending"), F.col("taken").alias("at")))})
    since = F.col("taken") - F.col("__open.at")
    inside = F.coalesce(F.col("__open.pending"), F.lit(False)) & (
        (F.col("takes") & (since <= 2)) | (F.col("is_rank") & (since < 2)))
    rows = stored(rows.withColumn("inside", inside).drop("__open", "taken", "is_rank"))

    free = ~F.col("inside")
    district = is_district_label(t, late=True)
    resets = free & (header | t.startswith("PROVINCE/CITY/MUN") | position)
    bare = free & ~resets & ~district & ~F.col("is_name")
    rows = rows.withColumns({"resets": resets, "bare": bare, "is_office": free & position})
    rows = running(rows, DOC, PAGE, LINE, total={
        "__seg": F.col("resets").cast("int"), "bare_no": F.col("bare").cast("int"),
        "offices": F.col("is_office").cast("int")})
    # A reset line looks back into the segment it closes.
    rows = rows.withColumn("segment", F.col("__seg") - F.col("resets").cast("int")).drop("__seg")
    parsed = split_listed_name(t)
    good = F.col("is_name") & (F.col("offices") > 0) \
        & (parsed["last"] != "") & (parsed["first"] != "")
    rows = stored(rows.withColumns({"good": good, "parsed": F.when(good, parsed)}).drop("is_name", "offices"))
    # The latest bare line of the segment, and the one before it.
    rows = stored(running(rows, DOC, PAGE, LINE, total={"record": F.col("good").cast("int")},
                          last={"__bare": F.when(F.col("bare"), F.struct("text", "segment"))}))
    rows = rows.withColumn("top", F.when(F.col("__bare.segment") == F.col("segment"),
                                         F.col("__bare.text"))).drop("__bare")
    earlier = rows.filter("bare").select("doc", "segment", (F.col("bare_no") + 1).alias("bare_no"),
                                         t.alias("below"))
    mayors = rows.filter(F.col("is_office") & (F.col("office") == "MAYOR")) \
        .select("doc", "page", "line", "segment", "bare_no") \
        .join(earlier, ["doc", "segment", "bare_no"]).select("doc", "page", "line", "below")
    rows = stored(rows.join(mayors, ["doc", "page", "line"], "left"))

    mayor = F.col("is_office") & (F.col("office") == "MAYOR") & F.col("top").isNotNull()
    place_parts = F.transform(F.split(place, ","), lambda p: F.trim(p))
    rows = rows.withColumn("place_parts", F.when(F.col("resets"), place_parts))
    head_city, head_province = (F.get("place_parts", F.lit(i)) for i in (0, 1))
    other_office = F.col("is_office") & (F.col("office") != "MAYOR") & F.col("top").isNotNull() \
        if category != "citymun" else F.lit(False)
    own = F.when(F.col("resets") & region_head, F.lit(None).cast("string")) \
        .when(F.col("resets") & province_head.isNotNull(), F.trim(province_head)) \
        .when(head_province.isNotNull(), head_province) \
        .when(mayor, F.col("below")).otherwise(F.col("top"))
    sets = (F.col("resets") & (region_head | province_head.isNotNull())) \
        | head_province.isNotNull() | (mayor & F.col("below").isNotNull()) | other_office
    rows = _carry(rows, city=(F.coalesce(head_city, F.col("top")), head_city.isNotNull() | mayor),
                  province=(own, sets), position=(F.col("office"), F.col("is_office")))
    sex = F.create_map(*[F.lit(x) for kv in SEXES.items() for x in kv])[F.upper(t)]
    sexes = rows.filter(F.col("inside") & F.col("takes") & sex.isNotNull()) \
        .groupBy("doc", "record").agg(F.max_by(sex, F.struct("page", "line")).alias("sex"))
    return rows.filter("good").join(sexes, ["doc", "record"], "left").select(
        "doc", "province", "city", "position", F.col("parsed.last").alias("last"),
        F.col("parsed.first").alias("first"), F.col("parsed.middle").alias("middle"), "sex")


def parse_sexes(lines: DataFrame) -> DataFrame:
    """(doc, position, last, given, sex) in any layout: the nearest name line before a sex line,
    under the current office."""
    t = F.col("text")
    upper = F.upper(t)
    rows = clean_lines(lines, lambda line: _starts_with_any(F.upper(line), SEX_JUNK_STARTS)
                       | F.upper(line).isin(SEX_JUNK_LABELS) | F.contains(line, F.lit(":")))
    office = matched_office(t, LOOSE_POSITIONS)
    sex = F.create_map(*[F.lit(x) for kv in SEXES.items() for x in kv])[upper]
    comma = F.contains(t, F.lit(","))
    rows = rows.withColumns({"sex": sex, "office": office})
    is_office = F.col("sex").isNull() & F.col("office").isNotNull() \
        & (~comma | upper.startswith("MEMBER,"))
    resets = F.col("sex").isNotNull() | is_office
    rows = stored(rows.withColumns({"is_office": is_office, "resets": resets}))
    rows = stored(running(rows, DOC, PAGE, LINE, total={"__seg": F.col("resets").cast("int")}))
    rows = rows.withColumn("segment", F.col("__seg") - F.col("resets").cast("int"))
    rows = running(rows, DOC, PAGE, LINE, last={
        "__name": F.when(~F.col("resets") & comma & F.col("office").isNull(),
                         F.struct(t.alias("text"), F.col("segment").alias("segment"))),
        "position": F.when(F.col("is_office"), F.col("office"))})
    name = F.col("__name.text")
    comma_at = F.locate(",", name)
    last = F.upper(F.trim(F.substr(name, F.lit(1), comma_at - 1)))
    given = F.upper(F.split(squeeze(F.substr(name, comma_at + 1)), " ")[0])
    return rows.filter(F.col("sex").isNotNull() & F.col("position").isNotNull()
                       & (F.col("__name.segment") == F.col("segment"))) \
        .select("doc", "position", last.alias("last"), given.alias("given"), "sex") \
        .filter((F.col("last") != "") & (F.col("given") != ""))


def linkage_rows(df: DataFrame, province: Column, city: Column, position: Column, last: Column,
                 first: Column, value: Column, source: str,
                 year: Column | None = None) -> DataFrame:
    """One linkage schema for every source: year, province, city, position, last, given, value,
    source. Key parts are folded; a missing part is an empty text."""
    def part(c):
        return F.coalesce(c, F.lit(""))
    return df.select(
        (F.lit(None) if year is None else year).cast("int").alias("year"),
        part(fold(canonical_province(province))).alias("province"),
        part(fold(canonical_city(city))).alias("city"), position.alias("position"),
        part(fold(last)).alias("last"), part(given_token(first)).alias("given"),
        F.trim(value).alias("value"), F.lit(source).alias("source"))


def middle_sources(df: DataFrame, source: str, **columns: Column) -> DataFrame:
    """Linkage rows of middle names that are more than an initial."""
    rows = linkage_rows(df, source=source, **columns)
    return rows.filter(has_middle("value"))


def sex_sources(df: DataFrame, source: str, **columns: Column) -> DataFrame:
    """Linkage rows with a sex."""
    return linkage_rows(df, source=source, **columns).filter(
        F.col("value").isNotNull() & (F.col("value") != ""))
