"""Texts in other alphabets, or broken by a wrong encoding, as ASCII: Arrow functions, for what no built-in does."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F

#: Fixed values (F20): Greek and Cyrillic letters by the Latin ones that stand for them.
GREEK = dict(zip("αβγδεζηθικλμνξοπρσςτυφχψω", "a b g d e z e th i k l m n x o p r s s t u ph kh ps o".split(), strict=True))
CYRILLIC = dict(zip("абвгдежзийклмнопрстуфхцчшщъыьэюя", "a b v g d e zh z i i k l m n o p r s t u f kh ts ch sh shch - y - e iu ia".replace("-", "''").split(), strict=True))
OTHERS = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "ı": "i", "“": '"', "”": '"', "„": '"', "«": "<<", "»": ">>", "‘": "'", "’": "'", "–": "-", "—": "--", "…": "...", "€": "EUR", " ": " "}
_MAP = GREEK | {k: v.strip("'") for k, v in CYRILLIC.items()} | OTHERS
#: What two and three bytes of UTF-8 look like where each was read as a character: Latin letters, punctuation and signs.
_AFTER = "[\x80-\xbf€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]"
_BROKEN = re.compile(f"[ÂÃ]{_AFTER}|â{_AFTER}{{2}}")


def _meant(found: re.Match) -> str:
    try:
        return b"".join(c.encode("latin-1") if ord(c) < 256 else c.encode("cp1252") for c in found[0]).decode("utf-8")
    except UnicodeError:
        return found[0]


def mended(text: str) -> str:
    """Text with what was UTF-8 and read byte by byte as it was meant."""
    return _BROKEN.sub(_meant, text)


def romanized(text: str) -> str:
    """ASCII for every letter that has one; what has none goes."""
    out = []
    for char in text:
        for c in unicodedata.normalize("NFKD", char) if char not in _MAP else char:
            if ord(c) < 128:
                out.append(c)
            elif (low := c.lower()) in _MAP:
                latin = _MAP[low]
                out.append(latin.capitalize() if c != low else latin)
    return "".join(out)


def to_ascii():
    """The column function: mended, then romanized; null stays null."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else t if t.isascii() else romanized(mended(t)))

    return run
