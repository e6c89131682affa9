"""One standard form for text that looks the same: folding of look-alike characters.

The rule: ordinary half-width letters, digits and signs, each of its word's own script; ordinary Chinese characters;
composed accents; plain spaces; no invisible characters; no joined letters; Greek mu in micro units; degree Celsius as two
characters. Chinese punctuation, dashes, superscripts and Greek symbols keep their usual form.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Letters of other scripts that look like a Latin letter, in pairs of the letter and its twin.
CYRILLIC_TWINS = dict(zip("аеорсухіѕјһԁԛԝАВЕЅІЈКМНОРСТУХ", "aeopcyxisjhdqwABESIJKMHOPCTYX", strict=True))
GREEK_TWINS = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧνο", "ABEZHIKMNOPTYXvo", strict=True))
# Simplified characters whose radical form has no compatibility mapping in Unicode.
RADICAL_TWINS = dict(
    zip("⺁⺈⺌⺍⺕⺝⺠⺢⺧⺪⺬⺮⺳⺶⺼⻁⻄⻅⻆⻉⻋⻌⻎⻏⻐⻑⻒⻓⻔⻖⻗⻘⻙⻚⻛⻜⻝⻟⻠⻢⻣⻤⻥⻦⻧⻨⻩⻪⻫⻬⻮⻯⻰⻱⻲", "厂刀小小彐月民水牛疋示竹网羊肉虎西见角贝车辶辶阝金長長长门阝雨青韦页风飞食食饣马骨鬼鱼鸟卤麦黄黾齐齐齿竜龙龟亀", strict=True)
)
# Signs kept as they are although a compatibility mapping exists.
KEPT = frozenset("，。、；：！？（）【】《》〈〉「」『』“”‘’…～￥—–―·²³¹⁰⁴⁵⁶⁷⁸⁹⁺⁻₀₁₂₃₄₅₆₇₈₉¼½¾ª º′″‴".replace(" ", ""))
SPACES = frozenset("\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000")
INVISIBLE = re.compile("[\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180e\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
WORD = re.compile(r"[^\W\d_]+")

#: Characters that never need folding; a text of these only is in standard form and stays in the JVM.
PLAIN = r"^[\t\n\r -~一-鿿，。、；：！？（）“”‘’《》【】—–…äöüÄÖÜßéèáàóòíìúùñçâêîôû°±×÷≤≥≠≈∼‰²³·¬αβγδεζηθλμπρσφωΔΩ†•©®§]*$"


@lru_cache(maxsize=8192)
def _char(c: str) -> str:
    if c in KEPT:
        return c
    if c in SPACES:
        return " "
    if c in RADICAL_TWINS:
        return RADICAL_TWINS[c]
    if c == "µ":
        return "μ"
    if c == "‐" or c == "‑":
        return "-"
    if unicodedata.combining(c) or unicodedata.decomposition(c).startswith("<") or 0xF900 <= ord(c) <= 0xFAFF:
        return unicodedata.normalize("NFKC", c)
    return c


def _word(match: re.Match[str]) -> str:
    word = match.group()
    if word.isascii():
        return word
    cyrillic = [c for c in word if "Ѐ" <= c <= "ԯ"]
    if cyrillic and all(c in CYRILLIC_TWINS for c in cyrillic):
        word = "".join(CYRILLIC_TWINS.get(c, c) for c in word)
    greek = [c for c in word if "Ͱ" <= c <= "Ͽ"]
    if greek and all(c in GREEK_TWINS for c in greek):
        word = "".join(GREEK_TWINS.get(c, c) for c in word)
    return word


def standard(text: str | None) -> str | None:
    """The standard form of a text; null stays null, the result of a standard text is itself."""
    if text is None:
        return None
    out = INVISIBLE.sub("", text)
    if not out.isascii():
        out = unicodedata.normalize("NFC", "".join(map(_char, out)))
        out = WORD.sub(_word, out)
    return out


def folded(text: str | None) -> str | None:
    """A comparison key: standard form, then compatibility forms, lower case, sharp s as ss, single blanks."""
    if text is None:
        return None
    out = unicodedata.normalize("NFKC", standard(text) or "").casefold()
    return " ".join(out.split())


@F.pandas_udf(StringType())
def _standard_udf(texts: pd.Series) -> pd.Series:
    return texts.map(standard, na_action="ignore")


@F.pandas_udf(StringType())
def _folded_udf(texts: pd.Series) -> pd.Series:
    return texts.map(folded, na_action="ignore")


def is_plain(text: Column) -> Column:
    """True where a text holds only characters that are already in standard form."""
    return text.rlike(PLAIN)


def standard_column(text: Column) -> Column:
    """``standard`` over a column (Arrow batches). Filter by ``is_plain`` first: Spark evaluates Python for every row it is given."""
    return _standard_udf(text)


def folded_column(text: Column) -> Column:
    """``folded`` over a column (Arrow batches)."""
    return _folded_udf(text)
