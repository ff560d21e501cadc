"""Party labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hustings.functions.places import lookup, lookup_or_same
from hustings.functions.text import bind, none_if_blank, squeeze

# Spellings of one and the same party. Mergers are real events and are not listed.
PARTY_SPELLINGS = {
    "LAKAS CMD": "LAKAS-CMD",
    "LAKAS KABALIKAT NG MALAYANG PILIPINO CHRISTIAN MUSLIM DEMOCRATS": "LAKAS-CMD",
    "LIBERAL PARTY": "LP",
    "NACIONALISTA": "NP",
    "NACIONALISTA PARTY": "NP",
    "PDP LABAN": "PDPLBN",
    "PDP-LABAN": "PDPLBN",
    "PDPLABAN": "PDPLBN",
    "(IND": "IND",
    "INDEPENDENT": "IND",
    "1 CEBU": "1CEBU",
    "ABAG-PROMDI": "ABAG PROMDI",
    "BALANE-NPC": "BALANE/NPC",
    "B.BAYAN": "BBAYAN",
    "INA-NPC": "INA/NPC",
    "KAMPI-BALANE": "KAMPI/BALANE",
    "KAMPI-LDP": "KAMPI/LDP",
    "KAMPI-UNA": "KAMPI/UNA",
    "KNP-LDP": "KNP/LDP",
    "KNP-PMP": "KNP/PMP",
    "LAKAS-CMD-BILEG": "LAKAS-CMD/BILEG",
    "LAKAS-CMD-LP": "LAKAS-CMD/LP",
    "LAKAS-CMDNPC": "LAKAS-CMD/NPC",
    "LAKAS-CMD-PDP": "LAKAS-CMD/PDP",
    "LDP-KNP": "LDP/KNP",
    "LDP MAGDALO": "LDP/MAGDALO",
    "LIHOK-LAKAS CMD": "LIHOK/LAKAS-CMD",
    "NPC-AIM": "NPC/AIM",
    "NPC ALAYON": "NPC/ALAYON",
    "NPC-ALAYON": "NPC/ALAYON",
    "NPC/ALAYON-PANAGHIUSA": "NPC/ALAYON PANAGHIUSA",
    "NPC-LAKAS-CMD": "NPC/LAKAS-CMD",
    "NPC-UNA": "NPC/UNA",
    "NPK NPC": "NPK-NPC",
    "PDP LBN": "PDPLBN",
    "PMP-AIM": "PMP/AIM",
    "PMP-KNP": "PMP/KNP",
    "PMP-NPC": "PMP/NPC",
    "REPORMA LM": "REPORMA-LM",
    "SARRO-KAMPI": "SARRO/KAMPI",
    "SARRO-LAKAS-CMD": "SARRO/LAKAS-CMD",
    "SARRO-LDP": "SARRO/LDP",
    "UNO-LDP": "UNO/LDP",
}


def canonical_party(label: Column | str, spellings: dict[str, str] | None = None) -> Column:
    """One code for each party. A joint endorsement keeps all members, joined by ``/``. A missing
    label stays missing."""
    table = PARTY_SPELLINGS if spellings is None else spellings

    def members(text: Column) -> Column:
        parts = F.filter(F.transform(F.split(text, "/"), lambda m: F.trim(m)), lambda m: m != "")
        return F.array_join(F.transform(parts, lambda m: lookup_or_same(table, m)), "/")
    return bind(F.upper(squeeze(none_if_blank(label))), lambda text: F.coalesce(
        lookup(table, text), F.when(F.contains(text, F.lit("/")), members(text)).otherwise(text)))


def is_coalition(label: Column | str) -> Column:
    """True when the label names more than one party."""
    return F.coalesce(F.contains(canonical_party(label), F.lit("/")), F.lit(False))
