"""Quantities in text: numbers, ranges and tolerances with units, converted exactly to one common unit per kind."""

from __future__ import annotations

import re
from decimal import ROUND_HALF_EVEN, Decimal
from fractions import Fraction
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewright.functions.glyphs import standard

# Unit writings by common unit and factor; writings are compared without case where that is unambiguous.
_UNITS: dict[str, list[tuple[str, str]]] = {
    "A": [("1", "A 安 安培 ampere amperes amp amps Ampere"), ("1/1000", "mA 毫安 毫安培 milliampere milliamperes milliamp milliamps Milliampere"), ("1000", "kA 千安 千安培 kiloampere kiloamperes kiloamps Kiloampere"), ("1/1000000", "μA 微安 microampere microamperes microamps Mikroampere")],
    "V": [("1", "V 伏 伏特 volt volts Volt"), ("1/1000", "mV 毫伏 毫伏特 millivolt millivolts Millivolt"), ("1000", "kV 千伏 千伏特 kilovolt kilovolts Kilovolt"), ("1/1000000", "μV 微伏 microvolt microvolts Mikrovolt")],
    "mm": [("1", "mm 毫米 millimetre millimetres millimeter millimeters Millimeter"), ("10", "cm 厘米 公分 centimetre centimetres centimeter centimeters Zentimeter"), ("1/1000", "μm um 微米 micrometre micrometres micrometer micrometers micron microns Mikrometer"), ("1000", "m 米 metre metres meter meters Meter"), ("100", "dm 分米 decimetre decimetres decimeter decimeters Dezimeter"), ("1/1000000", "nm 纳米 nanometre nanometres nanometer nanometers Nanometer"), ("1000000", "km 千米 公里 kilometre kilometres kilometer kilometers Kilometer"), ("127/5", "inch inches 英寸 Zoll")],
    "s": [("1", "s 秒 秒钟 sec secs second seconds Sekunde Sekunden"), ("1/1000", "ms 毫秒 millisecond milliseconds Millisekunde Millisekunden"), ("1/1000000", "μs us 微秒 microsecond microseconds Mikrosekunde Mikrosekunden"), ("60", "min mins 分 分钟 minute minutes Minute Minuten"), ("3600", "h hr hrs 小时 hour hours Stunde Stunden"), ("86400", "d 天 day days Tag Tage Tagen")],
    "Hz": [("1", "Hz 赫 赫兹 hertz"), ("1000", "kHz 千赫 千赫兹 kilohertz"), ("1000000", "MHz 兆赫 兆赫兹 megahertz"), ("1/1000", "mHz 毫赫 毫赫兹 millihertz"), ("1000000000", "GHz 吉赫 吉赫兹 gigahertz")],
    "Pa": [("1", "Pa 帕 帕斯卡 pascal pascals"), ("1000", "kPa 千帕 千帕斯卡 kilopascal kilopascals"), ("1000000", "MPa 兆帕 兆帕斯卡 megapascal megapascals N/mm²"), ("100", "hPa mbar 百帕 毫巴 hektopascal hectopascal hectopascals millibar millibars"), ("100000", "bar bars 巴"), ("1000000000", "GPa 吉帕 gigapascal gigapascals"), ("1/1000", "mPa 毫帕 millipascal millipascals"), ("101325", "atm 标准大气压")],
    "L/min": [("1", "L/min l/min 升/分 升/分钟 升每分钟 升每分 litre per minute litres per minute liter per minute liters per minute Liter pro Minute L/Minute"), ("1/1000", "mL/min ml/min 毫升/分 毫升/分钟 毫升每分钟 millilitres per minute milliliters per minute Milliliter pro Minute cm³/min cm3/min"), ("60", "L/s l/s 升/秒 升每秒 litres per second liters per second Liter pro Sekunde"), ("60/1000", "mL/s ml/s 毫升/秒 毫升每秒 millilitres per second milliliters per second Milliliter pro Sekunde"), ("1/60", "L/h l/h 升/小时 升/时 升每小时 litres per hour liters per hour Liter pro Stunde"), ("1000/60", "m³/h m3/h 立方米/小时 立方米每小时 cubic metres per hour Kubikmeter pro Stunde"), ("1000", "m³/min m3/min 立方米/分 立方米每分钟 cubic metres per minute Kubikmeter pro Minute")],
    "mm/min": [("1", "mm/min 毫米/分 毫米/分钟 毫米每分钟 millimetres per minute millimeters per minute Millimeter pro Minute"), ("10", "cm/min 厘米/分 厘米/分钟 厘米每分钟 centimetres per minute centimeters per minute Zentimeter pro Minute"), ("1000", "m/min 米/分 米/分钟 米每分钟 米每分 metre per minute metres per minute meter per minute meters per minute Meter pro Minute"), ("60", "mm/s 毫米/秒 毫米每秒 millimetres per second millimeters per second Millimeter pro Sekunde"), ("600", "cm/s 厘米/秒 厘米每秒 centimetres per second centimeters per second Zentimeter pro Sekunde"), ("60000", "m/s 米/秒 米每秒 metres per second meters per second Meter pro Sekunde"), ("1000/60", "m/h 米/小时 米每小时 metres per hour meters per hour Meter pro Stunde"), ("127/5", "in/min ipm inches per minute")],
    "%": [("1", "% 百分比 percent per_cent pct Prozent vol% Vol.-%"), ("1/10", "‰ 千分比 per_mille permille Promille"), ("1/10000", "ppm parts per million"), ("1/10000000", "ppb parts per billion")],
}
# Temperatures as (factor, offset) with K = (value + offset) * factor.
_TEMPERATURES: list[tuple[str, str, str]] = [
    ("1", "0", "K 开尔文 开 kelvin kelvins"),
    ("1", "273.15", "°C 摄氏度 度(摄氏) 度（摄氏） degrees_Celsius degree_Celsius deg_C degrees_C Grad_Celsius celsius ℃ 摄氏"),
    ("5/9", "459.67", "°F 华氏度 度(华氏) 度（华氏） degrees_Fahrenheit degree_Fahrenheit deg_F Grad_Fahrenheit fahrenheit ℉ 华氏"),
]
_JOINERS = {"per", "pro", "parts", "cubic"}


def _writings(words: str) -> list[str]:
    """Split a list of writings, keeping those of several words (joined by per, pro, ...) together."""
    parts, out, k = words.split(), [], 0
    while k < len(parts):
        if parts[k] == "parts" or (k + 1 < len(parts) and parts[k + 1] in ("per", "pro")) or parts[k] in ("per", "cubic"):
            n = {"per": 2, "cubic": 4}.get(parts[k], 3)
            out.append(" ".join(parts[k : k + n]))
            k += n
        else:
            out.append(parts[k].replace("_", " "))
            k += 1
    return out


def _table() -> tuple[dict[str, tuple[str, Fraction, Fraction]], dict[str, tuple[str, Fraction, Fraction]]]:
    exact: dict[str, tuple[str, Fraction, Fraction]] = {}
    for common, rows in _UNITS.items():
        for factor, words in rows:
            for w in _writings(words):
                exact[w] = (common, Fraction(factor), Fraction(0))
    for factor, offset, words in _TEMPERATURES:
        for w in _writings(words):
            exact[w] = ("K", Fraction(factor), Fraction(offset))
    lower: dict[str, tuple[str, Fraction, Fraction] | None] = {}
    for w, v in exact.items():
        k = w.lower()
        lower[k] = v if lower.get(k, v) == v else None
    return exact, {k: v for k, v in lower.items() if v is not None}


EXACT, LOWER = _table()


def _pattern() -> str:
    alts = sorted(EXACT, key=lambda w: (-len(w), w))
    latin = [re.escape(w).replace(r"\ ", r"\s*") for w in alts if re.search("[A-Za-z]$", w)]
    rest = [re.escape(w).replace(r"\ ", r"\s*") for w in alts if not re.search("[A-Za-z]$", w)]
    # a Latin writing ends at a word's end; a Chinese one may be followed by anything
    return rf"(?:(?:{'|'.join(latin)})(?![A-Za-zÄÖÜäöüß²³/]|\d)|(?:{'|'.join(rest)}))"


_NUMBER = r"(?:\d{1,3}(?:[ ,]\d{3})+(?!\d)(?:\.\d+)?|\d+(?:[.,]\d+)?)(?:\s?[eE][+-]?\d+|\s?[x×·]\s?10\^?[+-]?\d+)?"
_RANGE = r"(?:~|～|—|–|−|-|至|到|\bbis\b|\bto\b|\band\b|\bund\b|和|与|\.\.\.?|…)"
_U = _pattern()
QUANTITY = re.compile(
    rf"(?<![\w.,+#/-])(?P<sign>[-−+]?)(?P<a>{_NUMBER})(?![\w]*-?[A-Z]+\d)\s*(?P<ua>{_U})?"
    rf"(?:\s*(?P<op>±|\+/-|\+-|{_RANGE})\s*(?P<b>{_NUMBER})\s*(?P<ub>{_U})?)?",
    re.IGNORECASE,
)
#: Chinese words may stand directly before a number, Latin ones may not.
_CJK_SPLIT = re.compile(r"(?<=[一-鿿])(?=\d)")
BARE = re.compile(rf"^[\s<>≤≥=约]*[-−+]?{_NUMBER}(?:\s*(?:±|{_RANGE})\s*{_NUMBER})?\s*$", re.IGNORECASE)
_ORDINAL = re.compile(r"第\s*$")


_CJK_RUN = re.compile(r"[零〇一二两三四五六七八九十百千万亿点]+")
_CJK_DIGITS = {c: n for n, c in enumerate("零一二三四五六七八九")} | {"〇": 0, "两": 2}
_CJK_STEPS = {"十": 10, "百": 100, "千": 1000}


def _cjk_value(run: str) -> str | None:
    """The value of a Chinese numeral in digits; None if it is none."""
    head, _, tail = run.partition("点")
    if tail and not all(c in _CJK_DIGITS for c in tail) or (not head and run):
        return None
    if len(head) > 1 and all(c in _CJK_DIGITS for c in head):
        whole = int("".join(str(_CJK_DIGITS[c]) for c in head))
    else:
        whole, part, digit = 0, 0, None
        for c in head:
            if c in _CJK_DIGITS:
                digit = _CJK_DIGITS[c]
            elif c in _CJK_STEPS:
                part, digit = part + (1 if digit is None else digit) * _CJK_STEPS[c], None
            else:
                whole, part, digit = (whole + part + (digit or 0)) * (10**4 if c == "万" else 10**8), 0, None
        whole += part + (digit or 0)
    return f"{whole}.{''.join(str(_CJK_DIGITS[c]) for c in tail)}" if tail else str(whole)


def _cjk_numbers(text: str) -> str:
    """Chinese numerals as digits; a final 千 before a unit's character belongs to the unit."""

    def swap(m: re.Match[str]) -> str:
        run, rest = m.group(), ""
        if len(run) > 1 and run.endswith("千") and text[m.end() : m.end() + 1] in tuple("安伏赫帕米"):
            run, rest = run[:-1], "千"
        elif run == "千":
            return run
        value = _cjk_value(run)
        return m.group() if value is None else value + rest

    return _CJK_RUN.sub(swap, text)


@lru_cache(maxsize=65536)
def number(text: str) -> Fraction:
    """A written number: a comma or blank before exactly three digits groups thousands, another comma is a decimal sign."""
    text = text.strip()
    mantissa, power = text, 0
    if m := re.search(r"\s?[eE]([+-]?\d+)$|\s?[x×·]\s?10\^?([+-]?\d+)$", text):
        mantissa, power = text[: m.start()], int(m.group(1) or m.group(2))
    if re.fullmatch(r"[1-9]\d{0,2}(?:[ ,]\d{3})+(?:\.\d+)?", mantissa):
        mantissa = re.sub("[ ,]", "", mantissa)
    else:
        mantissa = mantissa.replace(",", ".")
    return Fraction(mantissa) * Fraction(10) ** power


def unit(writing: str | None) -> tuple[str, Fraction, Fraction] | None:
    """(common unit, factor, offset) of a unit's writing; case decides only where it must (mPa and MPa)."""
    if not writing:
        return None
    writing = " ".join(writing.split())
    for candidate in (writing, re.sub(r"\s*/\s*", "/", writing)):
        if candidate in EXACT:
            return EXACT[candidate]
        if len(candidate) > 1 and candidate.lower() in LOWER:
            return LOWER[candidate.lower()]
    squeezed = writing.replace(" ", "").lower()
    return _SQUEEZED.get(squeezed) if len(squeezed) > 1 else None


_SQUEEZED = {k.replace(" ", ""): v for k, v in LOWER.items()}


def plain(value: Fraction) -> str:
    """Six decimals, half-even, as a plain decimal without trailing zeros."""
    scaled = value * 10**6
    whole, rest = divmod(scaled.numerator, scaled.denominator)
    twice = 2 * rest
    if twice > scaled.denominator or (twice == scaled.denominator and whole % 2):
        whole += 1
    text = f"{Decimal(whole).scaleb(-6).quantize(Decimal('0.000001'), rounding=ROUND_HALF_EVEN):f}"
    text = text.rstrip("0").rstrip(".") if "." in text else text
    return "0" if text in ("-0", "") else text


def _find(text: str, needs_unit: bool = True):
    """The first quantity of a text as (low, high, unit, second unit, tolerance); low and high are unconverted numbers."""
    spaced = _CJK_SPLIT.sub(" ", text)
    for m in QUANTITY.finditer(spaced):
        ua, ub = unit(m["ua"]), unit(m["ub"])
        if needs_unit and not (ua or ub):
            continue
        if _ORDINAL.search(spaced[: m.start()]):
            continue
        a = number(m["a"]) * (-1 if m["sign"] in ("-", "−") else 1)
        if m["b"] is None or (needs_unit and ua and m["op"] not in ("±", "+/-", "+-") and not ub):
            if m["b"] is not None and not ub and ua:
                # "12 A - 15": the end of a range may leave out the unit
                return a, number(m["b"]), ua, ua, False
            return a, a, ua, ua, False
        b = number(m["b"])
        if m["op"] in ("±", "+/-", "+-"):
            return a, b, ua or ub, ub or ua, True
        return a, b, ua or ub, ub or ua, False
    return None


def _bounds(found) -> tuple[str, str, str] | None:
    a, b, ua, ub, tolerance = found
    if ua is None or ub is None or ua[0] != ub[0]:
        return None
    if tolerance:
        middle, width = (a + ua[2]) * ua[1], b * ub[1]
        low, high = middle - width, middle + width
    else:
        low, high = (a + ua[2]) * ua[1], (b + ub[2]) * ub[1]
        if high < low:
            low, high = high, low
    return ua[0], plain(low), plain(high)


@lru_cache(maxsize=131072)
def quantity(raw: str | None, normalized: str | None = None) -> tuple[str, str, str] | None:
    """(common unit, lower, upper) of the quantity in ``raw``; if that is only a number, with the unit of ``normalized``.

    None where there is no number, no unit, or a unit without a common one; also for grades, designations, ordinals and
    counts, whose digits touch letters or whose word is no unit. A comparison word changes nothing. Very long texts give
    their first quantity.
    """
    if raw is None:
        return None
    text = _cjk_numbers(standard(raw).strip())
    if not any(c.isdigit() for c in text):
        return None
    if (found := _find(text)) is not None:
        return _bounds(found)
    if normalized and BARE.match(text):
        other = _find(_cjk_numbers(standard(normalized).strip()))
        mine = _find(text, needs_unit=False)
        if other is not None and mine is not None:
            return _bounds((mine[0], mine[1], other[2], other[3] if other[2] == other[3] else other[2], mine[4]))
    return None


def quantity_column(raw: Column, normalized: Column) -> Column:
    """A struct (common_unit, lower_value, upper_value), null where there is no quantity (Arrow batches)."""

    @F.pandas_udf("common_unit string, lower_value string, upper_value string")
    def parse(raws: pd.Series, normals: pd.Series) -> pd.DataFrame:
        rows = [quantity(r, n) or (None, None, None) for r, n in zip(raws, normals, strict=True)]
        return pd.DataFrame(rows, columns=["common_unit", "lower_value", "upper_value"])

    return parse(raw, normalized)


@lru_cache(maxsize=131072)
def written(raw: str | None, normalized: str | None = None) -> tuple[str, float] | None:
    """(common unit, number as written) of ``raw``, unconverted; the unit is empty for a number that has none in either text."""
    if raw is None:
        return None
    text = _cjk_numbers(standard(raw).strip())
    if not any(c.isdigit() for c in text):
        return None
    if (found := _find(text)) is None:
        found = _find(text, needs_unit=False) if BARE.match(text) else None
        if found is None:
            return None
    other = _find(_cjk_numbers(standard(normalized).strip())) if normalized and not found[2] else None
    kind = found[2] or (other[2] if other else None)
    return kind[0] if kind else "", float(found[0] if found[4] else min(found[0], found[1]))


def written_column(raw: Column, normalized: Column) -> Column:
    """A struct (kind, value) of the number as written, null where there is none (Arrow batches)."""

    @F.pandas_udf("kind string, value double")
    def parse(raws: pd.Series, normals: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([written(r, n) or (None, None) for r, n in zip(raws, normals, strict=True)], columns=["kind", "value"])

    return parse(raw, normalized)
