"""Folding text to ASCII: a translation table for Latin letters, and a worker function for other scripts.

The table is made from Unicode's own decompositions. Other scripts are romanised from the characters' Unicode
names (``DEVANAGARI LETTER NA`` gives ``na``), ideographs as their code points, so nothing is dropped without
a trace; this is not the output of any particular transliteration library.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Letters without a decomposition (fixed values, by convention).
SPECIAL = {"ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "TH", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ħ": "h", "Ħ": "H", "ı": "i"}


def without_marks(text: str) -> str:
    """Canonical and compatibility decomposition without combining marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if unicodedata.category(c) != "Mn")


@lru_cache(maxsize=1)
def latin_table() -> tuple[str, str]:
    """Characters of the Latin blocks that fold to one ASCII character, and what they fold to."""
    pairs = []
    for code in [*range(0x00A0, 0x0250), *range(0x1E00, 0x1F00)]:
        c = chr(code)
        folded = SPECIAL.get(c) or without_marks(c)
        if len(folded) == 1 and folded.isascii():
            pairs.append((c, folded))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def several() -> dict[str, str]:
    """Characters that fold to more than one."""
    return {a: b for a, b in SPECIAL.items() if len(b) > 1}


def _character(c: str) -> str:
    name = unicodedata.name(c, "")
    if c.isascii():
        return c
    if c in SPECIAL:
        return SPECIAL[c]
    if name.startswith("CJK UNIFIED"):
        return f" u{ord(c):x} "
    if m := re.search(r"(?:LETTER|SYLLABLE|VOWEL SIGN|DIGIT)(?: SMALL| CAPITAL)? (.+)", name):
        return m[1].split(" ")[-1].lower()
    return " "


def romanise(text: str) -> str:
    """ASCII for any text."""
    out = []
    for c in unicodedata.normalize("NFKC", text):
        hangul = unicodedata.name(c, "").startswith("HANGUL SYLLABLE")
        out += [_character(x) for x in (c if hangul else without_marks(c))]
    return "".join(out)


@F.pandas_udf(T.StringType())
def _romanised(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else romanise(t))


def to_ascii(text: Column, other_scripts: bool = True) -> Column:
    """ASCII form of ``text``. Only what the Latin table leaves goes to Python; without it, a space each."""
    old, new = latin_table()
    folded = F.translate(text, old, new)
    for a, b in several().items():
        folded = F.replace(folded, F.lit(a), F.lit(b))
    if other_scripts:
        strange = folded.rlike(r"[^\x00-\x7F]")
        folded = F.when(strange, _romanised(F.when(strange, text))).otherwise(folded)
    return F.regexp_replace(folded, r"[^\x00-\x7F]", " ")


def is_latin(text: Column) -> Column:
    """Whether at least half of the letters are Latin; true without letters."""
    return F.regexp_count(text, F.lit(r"[\p{IsLatin}&&\p{L}]")) * 2 >= F.regexp_count(text, F.lit(r"\p{L}"))
