"""Offices: canonical name and district out of a location-laden position text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from hustings.functions.places import lookup
from hustings.functions.text import bind, col, squeeze

# Fixed values ---------------------------------------------------------------------------------
# Prefix -> office, in the order they are tried.
OFFICE_PREFIXES = [
    ("BARMM MEMBERS OF THE PARLIAMENT", "BARMM MEMBER OF PARLIAMENT"),
    ("REGIONAL VICE-GOVERNOR", "ARMM REGIONAL VICE GOVERNOR"),
    ("REGIONAL VICE GOVERNOR", "ARMM REGIONAL VICE GOVERNOR"),
    ("REGIONAL GOVERNOR", "ARMM REGIONAL GOVERNOR"),
    ("ASSEMBLYMAN", "ARMM ASSEMBLYMAN"),
    ("BARMM PARTY REPRESENTATIVES", "BARMM PARTY REPRESENTATIVE"),
    ("MEMBER, HOUSE OF REPRESENTATIVES", "MEMBER, HOUSE OF REPRESENTATIVES"),
    ("CONGRESSMAN", "MEMBER, HOUSE OF REPRESENTATIVES"),
    ("MEMBER, SANGGUNIANG PANLALAWIGAN", "PROVINCIAL BOARD MEMBER"),
    ("PROVINCIAL BOARD MEMBER", "PROVINCIAL BOARD MEMBER"),
    ("MEMBER, SANGGUNIANG PANLUNGSOD", "COUNCILOR"),
    ("MEMBER, SANGGUNIANG BAYAN", "COUNCILOR"),
    ("MEMBER, SANGUNIANG BAYAN", "COUNCILOR"),
    ("COUNCILOR", "COUNCILOR"),
    ("PROVINCIAL VICE-GOVERNOR", "VICE GOVERNOR"),
    ("PROVINCIAL VICE GOVERNOR", "VICE GOVERNOR"),
    ("VICE-GOVERNOR", "VICE GOVERNOR"),
    ("VICE GOVERNOR", "VICE GOVERNOR"),
    ("PROVINCIAL GOVERNOR", "GOVERNOR"),
    ("GOVERNOR", "GOVERNOR"),
    ("VICE-MAYOR", "VICE MAYOR"),
    ("VICE MAYOR", "VICE MAYOR"),
    ("MAYOR", "MAYOR"),
    ("VICE-PRESIDENT", "VICE PRESIDENT"),
    ("VICE PRESIDENT", "VICE PRESIDENT"),
    ("PRESIDENT", "PRESIDENT"),
    ("SENATOR", "SENATOR"),
    ("PARTY LIST", "PARTY LIST"),
]
DISTRICT = r"([A-Z]+(?:\s+[A-Z]+)*?)\s+(?:LEGDIST|PROVDIST|REGDIST|DIST)\s*$"

NATIONAL_OFFICES = ["PRESIDENT", "VICE PRESIDENT", "SENATOR", "PARTY LIST"]
ORGANISATION_OFFICES = ["PARTY LIST", "BARMM PARTY REPRESENTATIVE"]
LOCAL_OFFICES = ["GOVERNOR", "VICE GOVERNOR", "PROVINCIAL BOARD MEMBER",
                 "MEMBER, HOUSE OF REPRESENTATIVES", "MAYOR", "VICE MAYOR", "COUNCILOR"]
CITY_OFFICES = ["MAYOR", "VICE MAYOR", "COUNCILOR"]
GOVERNOR_OFFICES = ["GOVERNOR", "VICE GOVERNOR"]
NATIONAL_SEATS = {"PRESIDENT": 1, "VICE PRESIDENT": 1, "SENATOR": 12}
SINGLE_SEAT_OFFICES = ["GOVERNOR", "VICE GOVERNOR", "MEMBER, HOUSE OF REPRESENTATIVES",
                       "MAYOR", "VICE MAYOR"]

# Columns that, with the office, name the jurisdiction whose votes are summed.
JURISDICTION = {
    "GOVERNOR": ["province"],
    "VICE GOVERNOR": ["province"],
    "MEMBER, HOUSE OF REPRESENTATIVES": ["province", "district"],
    "PROVINCIAL BOARD MEMBER": ["province", "district"],
    "MAYOR": ["province", "city"],
    "VICE MAYOR": ["province", "city"],
    "COUNCILOR": ["province", "city", "district"],
}
LEVELS = ["provincial", "district", "municipal"]
OFFICE_LEVEL = {
    "GOVERNOR": "provincial",
    "VICE GOVERNOR": "provincial",
    "PROVINCIAL BOARD MEMBER": "provincial",
    "MEMBER, HOUSE OF REPRESENTATIVES": "district",
    "MAYOR": "municipal",
    "VICE MAYOR": "municipal",
    "COUNCILOR": "municipal",
}
# ----------------------------------------------------------------------------------------------


def split_office(position: Column | str, prefixes: list[tuple[str, str]] | None = None,
                 district_pattern: str = DISTRICT) -> Column:
    """struct(office, district). The first listed prefix that fits names the office; the district
    is the identifier at the end of what follows. Both null for an unknown office."""
    prefixes = OFFICE_PREFIXES if prefixes is None else prefixes
    listed = "^(" + "|".join(re.escape(p) for p, _ in prefixes) + ")"

    def parts(text: Column) -> Column:
        return bind(F.regexp_extract(text, listed, 1), lambda hit: F.struct(
            lookup(dict(prefixes), F.nullif(hit, F.lit(""))).alias("office"),
            F.when(hit != "", F.nullif(F.trim(F.regexp_extract(
                F.trim(F.regexp_replace(F.substr(text, F.length(hit) + 1), r"^\s*(OF\s+)?", "")),
                district_pattern, 1)), F.lit(""))).alias("district")))
    return bind(F.upper(squeeze(position)), parts)


def is_national_race(office: Column | str) -> Column:
    return F.coalesce(col(office).isin(NATIONAL_OFFICES), F.lit(False))


def is_person_office(office: Column | str) -> Column:
    """False where the candidate is an organisation; such names are never parsed."""
    return ~F.coalesce(col(office).isin(ORGANISATION_OFFICES), F.lit(False))


def office_level(office: Column | str) -> Column:
    return lookup(OFFICE_LEVEL, col(office))
