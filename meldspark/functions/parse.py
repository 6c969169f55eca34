"""Lenient parsing of text: what cannot be read becomes NULL, never an error.

A regular expression decides first whether a text has the right shape, then Spark's own string casts read it. A
cast that fails costs an exception inside Spark, many times the price of one that succeeds, so texts of the wrong
shape never reach the cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meldspark.functions.text import _col, decimal_comma, lower_text, trim_spaces

GAPS = " \t\n\x0b\f\r"

DAY_DOTTED = "DD.MM.YYYY"
ISO_DAY = "YYYY-MM-DD"
SLASHED_DAY = "YYYY/MM/DD"
SPACED_TIME = "YYYY-MM-DD hh:mm:ss"
ZULU_TIME = "YYYY-MM-DDThh:mm:ssZ"

_MONTH = "(?:0?[1-9]|1[0-2])"
_DAY = "(?:0?[1-9]|[12][0-9]|3[01])"
_TIME = "(?:[01]?[0-9]|2[0-3]):[0-5]?[0-9]:[0-5]?[0-9]"
_DIGITS = "[0-9]+(?:_[0-9]+)*"
_NUMBER = rf"\s*[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?[0-9]+)?\s*"
_SHORT_WHOLE = r"\s*[+-]?[0-9]{1,18}\s*"


def _whole(pattern: str) -> str:
    return rf"\A{pattern}\z"


def _pad_year(iso: Column) -> Column:
    year = F.substring_index(iso, "-", 1)
    return F.lpad(iso, F.length(iso) + 4 - F.length(year), F.lit("0"))


def parse_date(text: Column | str, shape: str) -> Column:
    """Date in one of the day shapes; fields may have fewer digits and gaps around the text are ignored."""
    raw = F.trim(_col(text), F.lit(GAPS))
    if shape == DAY_DOTTED:
        parts = [F.split_part(raw, F.lit("."), F.lit(n)) for n in (3, 2, 1)]
        iso = F.concat_ws("-", F.lpad(parts[0], 4, "0"), *parts[1:])
        return F.when(raw.rlike(_whole(rf"{_DAY}\.{_MONTH}\.[0-9]{{1,4}}")), iso.try_cast("date"))
    sep = "-" if shape == ISO_DAY else "/"
    iso = raw if shape == ISO_DAY else F.replace(raw, F.lit("/"), F.lit("-"))
    return F.when(raw.rlike(_whole(f"[0-9]{{4}}{sep}{_MONTH}{sep}{_DAY}")), iso.try_cast("date")).when(
        raw.rlike(_whole(f"[0-9]{{1,3}}{sep}{_MONTH}{sep}{_DAY}")), _pad_year(iso).try_cast("date")
    )


def parse_timestamp(text: Column | str, shape: str) -> Column:
    """Timestamp without zone. The closing Z of the T form is part of the text, not a zone."""
    raw = F.trim(_col(text), F.lit(GAPS))
    if shape == ZULU_TIME:
        iso = spaced = F.rtrim(raw, F.lit("Z"))
        gap, lenient, end = "T", "T", "Z"
    else:
        iso, spaced = raw, F.regexp_replace(raw, rf"-({_DAY})\s*({_TIME})", "-$1 $2")
        gap, lenient, end = " ", r"\s+", ""
    return F.when(raw.rlike(_whole(f"[0-9]{{4}}-{_MONTH}-{_DAY}{gap}{_TIME}{end}")), iso.try_cast("timestamp_ntz")).when(
        raw.rlike(_whole(f"[0-9]{{1,4}}-{_MONTH}-{_DAY}{lenient}{_TIME}{end}")),
        _pad_year(spaced).try_cast("timestamp_ntz"),
    )


def parse_decimal(text: Column | str, precision: int = 12, scale: int = 2, comma: bool = False) -> Column:
    """Exact decimal, rounded half up; NULL if the text is no number or does not fit. Single underscores between
    digits are separators."""
    raw = trim_spaces(text)
    if comma:
        raw = decimal_comma(raw)
    number = F.when(raw.rlike(_whole(_NUMBER)), F.replace(raw, F.lit("_"), F.lit("")))
    return number.try_cast(f"decimal({precision},{scale})")


def parse_whole_number(text: Column | str) -> Column:
    """64-bit whole number; "12.5" rounds half away from zero to 13, 0x and 0b forms are read."""
    raw = trim_spaces(text)
    digits = (
        F.when(raw.rlike(_whole(_NUMBER)), F.regexp_replace(raw, r"_|(?<=\.[0-9]{18})[0-9]+", ""))
        .when(raw.rlike(_whole("0[xX][0-9a-fA-F]{1,16}")), F.conv(F.substring(raw, 3, 16), 16, 10))
        .when(raw.rlike(_whole("0[bB][01]{1,64}")), F.conv(F.substring(raw, 3, 64), 2, 10))
    )
    rounded = F.round(digits.try_cast("decimal(38,18)"), 0).try_cast("bigint")
    return F.when(raw.rlike(_whole(_SHORT_WHOLE)), raw.try_cast("bigint")).otherwise(rounded)


def parse_boolean(text: Column | str) -> Column:
    """The usual words for true and false in any case, without padding."""
    word = F.lower(_col(text))
    return F.when(word.isin("true", "t", "yes", "y", "1"), True).when(
        word.isin("false", "f", "no", "n", "0"), False
    )


def parse_flag(text: Column | str, yes: str, no: str) -> Column:
    """Two-valued flag compared without case and padding; anything else is NULL."""
    word = lower_text(trim_spaces(text))
    return F.when(word == yes.lower(), True).when(word == no.lower(), False)
