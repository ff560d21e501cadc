"""Texts cut into the pieces that byte-pair merges never cross.

The quick way covers characters whose case, class and composition are the same in every version of
Unicode. A text with any other character, or with what may be a special token, goes to the tokenizer
library as a whole.
"""

from __future__ import annotations

import re

LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ž"
SYMBOLS = "¡¢£§©«®°±·»¿×÷‐-‧€"
SPACE = "\t-\r "

#: Something that the quick way leaves to the library.
OTHER = re.compile(f"[^\t-\r -~{LETTERS}{SYMBOLS}]|<\\|")

#: Pieces of a lower-case text for vocabularies with word ends; white space is dropped.
WORD_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^{SPACE}{LETTERS}0-9]+")

#: Pieces for byte-level vocabularies; nothing is dropped.
BYTE_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^{SPACE}{LETTERS}0-9]+"
                         f"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, by rule:
    a visible character of Latin-1 stands for itself, the others follow from 256 on in order."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}
