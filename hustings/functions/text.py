"""Text folding and small parsers. Every function is ``Column -> Column`` and stays in the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = r"(?U)^\s*$"
SPACES = r"(?U)\s+"

def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@lru_cache(maxsize=1)
def _decompositions() -> tuple[str, str, dict[str, str]]:
    """(from, to) for ``translate``, and what decomposes into several characters.

    Compatibility decompositions of all code points without combining marks, which have no
    counterpart in ``to`` and are so deleted. Syllables, which decompose by rule, are left out.
    """
    pairs, marks, several = [], [], {}
    for code in chain(range(0x80, 0xAC00), range(0xD7A4, 0xD800), range(0xE000, 0x110000)):
        char = chr(code)
        base = "".join(d for d in unicodedata.normalize("NFKD", char) if not unicodedata.combining(d))
        if not base:
            marks.append(char)
        elif len(base) > 1:
            several[char] = base
        elif base != char:
            pairs.append((char, base))
    return "".join(p[0] for p in pairs) + "".join(marks), "".join(p[1] for p in pairs), several


@lru_cache(maxsize=2)
def _tables(words: bool) -> tuple[str, str, str, str]:
    """(from, to) for ``translate``, then the characters that decompose into several, and the
    decompositions of these, one a line. For ``words`` only what has an ASCII letter or digit in it,
    and the combining marks: every plan carries the tables, once for each text that is folded."""
    source, target, several = _decompositions()

    def wanted(base: str) -> bool:
        return not words or any(x.isascii() and x.isalnum() for x in base.upper())
    pairs = [(a, b) for a, b in zip(source, target) if wanted(b)]
    listed = {a: b for a, b in several.items() if wanted(b)}
    return ("".join(a for a, _ in pairs) + source[len(target):], "".join(b for _, b in pairs),
            "".join(listed), "\n".join(listed.values()))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Hangul syllables are made by rule: 21 x 28 of them begin with each first letter.
FIRST, SECOND, FINAL = ("".join(map(chr, range(start, start + n))) for start, n in ((0x1100, 19), (0x1161, 21), (0x11A8, 27)))


def _syllable(char: Column) -> Column:
    """The two or three letters of a Hangul syllable."""
    def letters(at: Column) -> Column:
        final = at % 28
        return F.concat(F.substr(F.lit(FIRST), F.floor(at / 588).cast("int") + 1, F.lit(1)),
                        F.substr(F.lit(SECOND), F.floor(at % 588 / 28).cast("int") + 1, F.lit(1)),
                        F.when(final > 0, F.substr(F.lit(FINAL), final, F.lit(1))).otherwise(""))
    return bind(F.ascii(char) - 0xAC00, letters)


def _spelled_out(text: Column, listed: str, spelled: str) -> Column:
    """Characters that decompose into several, one by one. Only for texts that have any."""
    def one(char: Column) -> Column:
        return bind(F.position(char, F.lit(listed)), lambda at: F.when(char < "\u0080", char)
                    .when(char.between("\uac00", "\ud7a3"), _syllable(char))
                    .when(at > 0, F.get(F.split(F.lit(spelled), "\n"), at - 1)).otherwise(char))
    return F.array_join(F.transform(F.split(text, ""), one), "")


def strip_accents(c: Column | str, words: bool = False) -> Column:
    """Base letters only, by full compatibility decomposition. Pure ASCII values, the common case,
    skip the tables, and only texts that need it are spelled out character by character. With
    ``words`` characters without an ASCII letter or digit in them may stay as they are."""
    source, target, listed, spelled = _tables(words)

    def plain(text: Column) -> Column:
        several = text.rlike("[\uac00-\ud7a3]") | (F.translate(text, listed, "") != text)
        whole = F.when(several, _spelled_out(text, listed, spelled)).otherwise(text)
        return F.when(~text.rlike(r"[^\x00-\x7F]"), text).otherwise(F.translate(whole, source, target))
    return plain(F.col(c)) if isinstance(c, str) else bind(c, plain)


def none_if_blank(c: Column | str) -> Column:
    c = col(c)
    return F.when(~c.rlike(BLANK), c)


def squeeze(c: Column | str) -> Column:
    """Runs of any whitespace become one space; the ends are trimmed."""
    return F.trim(F.regexp_replace(col(c), SPACES, " "))


def fold(c: Column | str) -> Column:
    """Upper case, no accents, letters and digits only, single spaces. Blank becomes null."""
    plain = F.regexp_replace(F.upper(strip_accents(c, words=True)), "[^A-Z0-9]+", " ")
    return F.nullif(F.trim(plain), F.lit(""))


def fold_place(c: Column | str) -> Column:
    """Like ``fold`` but only ``- , . ( )`` and whitespace separate words. Blank becomes null."""
    plain = F.regexp_replace(F.upper(strip_accents(c)), r"(?U)[-,.()\s]+", " ")
    return F.nullif(F.trim(plain), F.lit(""))


def fold_letters(c: Column | str) -> Column:
    """Upper-case letters and spaces; everything else is deleted, not turned into a space."""
    plain = F.regexp_replace(F.upper(strip_accents(c)), "[^A-Z ]", "")
    return F.trim(plain)


def fold_spelling(c: Column | str) -> Column:
    """The key under which spellings of one area meet: comma and hyphen as spaces."""
    text = F.regexp_replace(F.upper(col(c)), "[,-]", " ")
    return squeeze(F.replace(text, F.lit("NATIONAL CAPITAL REGION"), F.lit("NCR")))


def squash(c: Column | str) -> Column:
    """ASCII letters and digits only, upper case, nothing between them."""
    return F.regexp_replace(F.upper(col(c)), "[^A-Z0-9]", "")


def squash_city(c: Column | str) -> Column:
    """``squash`` without a leading CITY OF or a trailing CITY."""
    bare = F.regexp_replace(F.upper(col(c)), r"^CITY OF\s+", "")
    return squash(F.regexp_replace(bare, r"\s+CITY$", ""))


def tokens(c: Column | str) -> Column:
    """Words of a text, none for a blank one."""
    return F.filter(F.split(squeeze(F.coalesce(col(c), F.lit(""))), " "), lambda t: t != "")


def title_case(c: Column | str) -> Column:
    """A capital after every non-letter, lower case elsewhere."""
    parts = F.split(F.lower(col(c)), r"(?<=[^\p{L}])(?=\p{L})")
    return F.array_join(
        F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)),
                                              F.substr(p, F.lit(2)))), "")


def pretty_office(c: Column | str) -> Column:
    """An office for display: title case, ``of`` small, no hyphen after Vice."""
    text = F.replace(title_case(c), F.lit("Of"), F.lit("of"))
    return F.replace(text, F.lit("Vice-"), F.lit("Vice "))


#: A whole decimal number; a cast alone would take the type letters of ``12d`` and ``7f``.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def percent_value(c: Column | str) -> Column:
    """``"1.54 %"`` to 1.54; anything that is not a number becomes null."""
    text = F.trim(F.replace(col(c), F.lit("%"), F.lit("")))
    return F.when(text.rlike(NUMBER), text).try_cast("double")


def count_value(c: Column | str) -> Column:
    """``"1,234"`` to 1234; anything that is not a whole number becomes null."""
    digits = F.trim(F.replace(col(c), F.lit(","), F.lit("")))
    return F.when(digits.rlike(r"^\d+$"), digits).try_cast("bigint")


def number_value(c: Column | str) -> Column:
    """A coercing cast to long: text that is no number becomes null. Whole numbers keep all digits."""
    text = F.trim(col(c).cast("string"))
    whole = F.when(text.rlike(r"^[+-]?\d+$"), text).try_cast("bigint")
    return F.coalesce(whole, F.when(text.rlike(NUMBER), text).try_cast("double").try_cast("bigint"))


def file_slug(c: Column | str) -> Column:
    """One underscore for each character outside ``A-Za-z0-9_-``, two for an n with tilde."""
    marked = F.regexp_replace(col(c), "[ñÑ]", "__")
    return F.upper(F.regexp_replace(marked, "[^A-Za-z0-9_-]", "_"))


def path_token(c: Column | str) -> Column:
    """Upper case, blanks and slashes as underscores, no commas."""
    return F.replace(F.regexp_replace(F.upper(col(c)), "[ /]", "_"), F.lit(","), F.lit(""))


def url_path(url: Column | str) -> Column:
    """The path of a URL without host, ``%20`` and outer slashes."""
    bare = F.regexp_replace(col(url), "^https?://[^/]+/", "")
    return F.regexp_replace(F.replace(bare, F.lit("%20"), F.lit("")), "^/+|/+$", "")


def page_slug(url: Column | str) -> Column:
    """File name a captured page is kept under."""
    return F.concat(F.regexp_replace(url_path(url), "[^A-Za-z0-9]+", "_"), F.lit(".html"))


def path_parts(url: Column | str, root: str | None = None) -> Column:
    """Path segments, without a leading ``root`` segment."""
    parts = F.split(url_path(url), "/")
    if root is None:
        return parts
    return F.when(parts[0] == root, F.slice(parts, F.lit(2), F.size(parts))).otherwise(parts)


def url_depth(url: Column | str) -> Column:
    """Slashes after the host, a trailing one not counted."""
    bare = F.regexp_replace(col(url), "/+$", "")
    return F.size(F.split(bare, "/")) - 1 - F.lit(3)


def is_subsequence(short: Column | str, long: Column | str) -> Column:
    """True when the letters and digits of ``short`` occur in ``long`` in order.

    Each step runs to the next wanted character and never goes back, so the test takes one pass
    over texts of any length.
    """
    steps = F.regexp_replace(col(short), "([A-Za-z0-9])", r"[^$1]*+$1")
    return F.rlike(col(long), F.concat(F.lit("^"), steps))
