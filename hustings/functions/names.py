"""Person names: party suffixes, titles, nicknames, name parts, given names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hustings.functions.places import lookup
from hustings.functions.text import (
    bind, col, fold, is_subsequence, none_if_blank, squash, squeeze, tokens,
)

# Fixed values ---------------------------------------------------------------------------------
TITLES = [
    "ATTY", "DR", "DOC", "DOKTOR", "ENGR", "ARCH", "PROF",
    "HON", "FR", "REV", "PASTOR", "BROTHER",
    "CAPT", "COL", "GEN", "MAJ", "SGT", "LT",
    "DATU", "BAI", "HADJI", "HAJI", "SULTAN", "SHEIK",
    "MR", "MRS", "MS",
]
TITLE_SPELLINGS = {
    "ATTY": "ATTY.", "DOC": "DOC", "DR": "DR.", "ENGR": "ENGR.", "JUDGE": "JUDGE",
    "PROF": "PROF.", "BRO": "BRO.", "PASTOR": "PASTOR", "REV": "REV.", "FR": "FR.",
    "CAPT": "CAPT.", "COL": "COL.", "GEN": "GEN.", "SULTAN": "SULTAN", "DATU": "DATU",
    "BAI": "BAI", "HADJI": "HADJI", "MR": "MR.", "MS": "MS.",
}
GIVEN_HONORIFICS = ["H", "HADJI", "HADJ", "HAJI", "HJ"]
CLOSED_TAIL = r"\s*\(([^)]{1,20})\)\s*$"
OPEN_TAIL = r"\s*\(([A-Za-z0-9-]{1,15})\s*$"
# ----------------------------------------------------------------------------------------------

# A run of titles at the start: each is either glued to a following letter by its dot, or a word
# of its own with any number of dots.
TITLE_RUN = (r"^((?i:(?:" + "|".join(TITLES) + r")(?:\.\s*(?=[A-Za-z])|\.*(?:\s+|$)))*)")


def is_party_tail(tail: Column | str, party: Column | str) -> Column:
    """True when a bracketed tail repeats the party or abbreviates it (a subsequence)."""
    short, full = squash(tail), squash(party)
    return F.coalesce((short != "") & (full != "") & is_subsequence(short, full), F.lit(False))


def clean_reported_name(name: Column | str, party: Column | str) -> Column:
    """struct(name, recovered): the name without a party glued to it.

    ``recovered`` is set only where the party is blank and the name ends in an unclosed bracket,
    the mark of a truncated party.
    """
    party = col(party)

    def without(text: Column, tail: str, recovered: Column) -> Column:
        return F.struct(F.trim(F.regexp_replace(text, tail, "")).alias("name"),
                        recovered.alias("recovered"))

    def cleaned(text: Column) -> Column:
        nothing = F.lit(None).cast("string")
        closed, cut = F.regexp_extract(text, CLOSED_TAIL, 1), F.regexp_extract(text, OPEN_TAIL, 1)
        return F.when((closed != "") & is_party_tail(closed, party),
                      without(text, CLOSED_TAIL, nothing)) \
            .when(none_if_blank(party).isNull() & (cut != ""),
                  without(text, OPEN_TAIL, F.upper(F.trim(cut)))) \
            .otherwise(F.struct(text.alias("name"), nothing.alias("recovered")))
    return bind(squeeze(F.coalesce(col(name), F.lit(""))), cleaned)


def split_title(given: Column | str) -> Column:
    """struct(title, rest): honorifics lifted off the front, also when glued to the name."""
    def spelled(run: Column, rest: Column) -> Column:
        words = tokens(F.regexp_replace(run, r"\.(?=[A-Za-z])", ". "))
        glued = rest.rlike("^[A-Za-z]")
        return F.array_join(bind(words, lambda all_words: F.transform(
            all_words, lambda w, i: F.when(
                w.rlike(r"^[A-Za-z]+\.$") & ((i < F.size(all_words) - 1) | glued), F.upper(w))
            .otherwise(w))), " ")

    def lifted(text: Column, run: Column) -> Column:
        return bind(F.trim(F.substr(text, F.length(run) + 1)), lambda rest: F.struct(
            F.when(run == "", F.lit("")).otherwise(spelled(run, rest)).alias("title"),
            rest.alias("rest")))
    return bind(F.trim(F.coalesce(col(given), F.lit(""))), lambda text: bind(
        F.regexp_extract(text, TITLE_RUN, 1), lambda run: lifted(text, run)))


def strip_nickname(name: Column | str) -> Column:
    """Bracketed nicknames removed wherever they stand."""
    return squeeze(F.regexp_replace(F.coalesce(col(name), F.lit("")), r"\s*\([^)]*\)\s*", " "))


def standardize_name(name: Column | str, party: Column | str) -> Column:
    """struct(last, first, middle, title) from ``SURNAME, FIRST MIDDLE`` or
    ``FIRST MIDDLE SURNAME``; parts that are absent are null."""

    def or_null(c: Column) -> Column:
        return F.nullif(c, F.lit(""))

    def after_comma(plain: Column, comma: Column) -> Column:
        return bind(split_title(F.substr(plain, comma + 1)), lambda lead: bind(
            tokens(lead["rest"]), lambda words: F.struct(
                or_null(F.trim(F.substr(plain, F.lit(1), comma - 1))).alias("last"),
                F.get(words, F.lit(0)).alias("first"),
                or_null(F.array_join(F.slice(words, F.lit(2), F.greatest(
                    F.size(words) - 1, F.lit(0))), " ")).alias("middle"),
                or_null(lead["title"]).alias("title"))))

    def in_order(plain: Column) -> Column:
        return bind(split_title(plain), lambda lead: bind(
            tokens(lead["rest"]), lambda words: F.struct(
                F.when(F.size(words) >= 2, F.get(words, F.size(words) - 1)).alias("last"),
                F.get(words, F.lit(0)).alias("first"),
                or_null(F.array_join(F.slice(words, F.lit(2), F.greatest(
                    F.size(words) - 2, F.lit(0))), " ")).alias("middle"),
                or_null(lead["title"]).alias("title"))))
    return bind(strip_nickname(clean_reported_name(name, party)["name"]), lambda plain: bind(
        F.locate(",", plain), lambda comma: F.when(comma > 0, after_comma(plain, comma))
        .otherwise(in_order(plain))))


def _present(c: Column | str) -> Column:
    """Trimmed text; blank and the literal word ``nan`` count as missing."""
    text = F.trim(col(c))
    return F.when((text != "") & (F.lower(text) != "nan"), text)


def canonical_full_name(last: Column | str, first: Column | str, middle: Column | str) -> Column:
    """``SURNAME, FIRST MIDDLE``, or whichever half exists; empty when neither does."""
    given = F.nullif(F.concat_ws(" ", _present(first), _present(middle)), F.lit(""))
    return F.concat_ws(", ", _present(last), given)


def extract_given(first: Column | str, middle: Column | str | None = None) -> Column:
    """First given name, folded: apostrophes and hyphens join, a leading honorific is dropped, a
    lone honorific defers to the middle field, ``MA`` is spelled out. Null when there is none."""
    def joined(c):
        return fold(F.regexp_replace(col(c), "['-]", ""))
    honorific = "^(?:(?:" + "|".join(GIVEN_HONORIFICS) + ")(?: |$))+"
    own = bind(F.regexp_replace(joined(first), honorific, ""), lambda name: F.when(name != "", name))
    text = own if middle is None else F.coalesce(own, joined(middle))
    return bind(F.split(text, " ")[0], lambda word: F.when(word == "MA", F.lit("MARIA")).otherwise(word))


def given_token(first: Column | str) -> Column:
    """First folded word of a given name."""
    return F.split(fold(first), " ")[0]


def canonical_title(title: Column | str) -> Column:
    """One spelling for each known title; others are only trimmed; blank stays blank."""
    text = F.trim(F.coalesce(col(title), F.lit("")))
    return F.coalesce(lookup(TITLE_SPELLINGS, F.regexp_replace(F.upper(text), "[^A-Z]", "")), text)


def split_listed_name(name: Column | str) -> Column:
    """struct(last, first, middle) of ``SURNAME, GIVEN NAMES MIDDLE``: the middle is the last
    word, the given names all words before it. Without a comma everything is the last name."""
    def parts(name: Column, words: Column) -> Column:
        comma, n = F.locate(",", name), F.size(words)
        last = F.when(comma > 0, F.substr(name, F.lit(1), comma - 1)).otherwise(name)
        first = F.when(n >= 2, F.array_join(
            F.slice(words, F.lit(1), F.greatest(n - 1, F.lit(0))), " ")) \
            .otherwise(F.coalesce(F.get(words, F.lit(0)), F.lit("")))
        return F.struct(F.trim(last).alias("last"), first.alias("first"),
                        F.when(n >= 2, F.get(words, n - 1)).otherwise("").alias("middle"))
    given = F.regexp_extract(F.coalesce(col(name), F.lit("")), "^[^,]*,(.*)$", 1)
    return bind(F.coalesce(col(name), F.lit("")),
                lambda text: bind(tokens(given), lambda words: parts(text, words)))


def has_middle(middle: Column | str) -> Column:
    """More than an initial: over one character without dots. Null counts as no."""
    text = F.trim(F.replace(col(middle), F.lit("."), F.lit("")))
    return F.coalesce(F.length(text) > 1, F.lit(False))


def middles_compatible(a: Column | str, b: Column | str) -> Column:
    """True when the first words are equal or one is the other's initial; null when unknown."""
    x, y = F.split(fold(a), " ")[0], F.split(fold(b), " ")[0]
    initial = (F.length(x) == 1) | (F.length(y) == 1)
    return F.when(x == y, True).when(initial, F.substring(x, 1, 1) == F.substring(y, 1, 1)) \
        .when(x.isNotNull() & y.isNotNull(), False)


def strip_ballot_number(name: Column | str) -> Column:
    """An organisation's own name without the number it has on the ballot."""
    return F.trim(F.regexp_replace(col(name), r"^\s*\d+\s+", ""))
