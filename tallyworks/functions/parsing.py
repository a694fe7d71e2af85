"""Cleaning and parsing of text columns, all inside the JVM.

Every parser returns null for text it cannot read, so a later rule over that value is null
too and never fires. Casts are always guarded by a pattern: the session may run in ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as surrounding whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Marks of a price written for people.
CURRENCY_MARKS = "[$€£¥,]"

INTEGER = r"^[+-]?[0-9]++$"
GROUPED_INTEGER = r"^[+-]?[0-9]++(?:_[0-9]++)*+$"
DECIMAL = r"^[+-]?(?:[0-9]++(?:\.[0-9]*+)?|\.[0-9]++)(?:[eE][+-]?[0-9]++)?$"
NON_FINITE = r"(?i)^[+-]?(inf|infinity|s?nan[0-9]*)$"
ISO_DATE = r"^[0-9]{4}-[0-9]{1,2}-( [1-9]|[0-9]{1,2})$"

WIDE_SCALE = 12
WIDE_DECIMAL = f"decimal(38,{WIDE_SCALE})"


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def normal_key(text: Column) -> Column:
    """Trim and upper-case an id. Sales and reference side both use this one function."""
    return F.upper(trimmed(text))


def is_blank(text: Column) -> Column:
    return trimmed(text) == ""


def _ungrouped(text: Column) -> Column:
    """Text without the underscores that may group digits; hardly any value has one."""
    return F.when(F.contains(text, F.lit("_")), F.translate(text, "_", "")).otherwise(text)


def _integer_digits(text: Column) -> Column:
    """The integer's own text, or null."""
    grouped = F.when(text.rlike(GROUPED_INTEGER), F.translate(text, "_", ""))
    plain = F.when(text.rlike(INTEGER), text)
    return F.when(F.contains(text, F.lit("_")), grouped).otherwise(plain)


def is_integer(text: Column) -> Column:
    """Over trimmed text."""
    return _integer_digits(text).isNotNull()


def to_integer(text: Column) -> Column:
    """Trimmed text to bigint; null where it is no integer or does not fit."""
    return _integer_digits(text).try_cast("bigint")


def is_decimal(text: Column) -> Column:
    """Over trimmed text: a finite decimal, in plain or exponent form."""
    return _ungrouped(text).rlike(DECIMAL)


def to_decimal(text: Column) -> Column:
    """Trimmed text to decimal(38,12); null where it is not finite or does not fit exactly."""
    plain = _ungrouped(text)
    return F.when(plain.rlike(DECIMAL) & (_needed_places(text) <= WIDE_SCALE), plain.try_cast(WIDE_DECIMAL))


def _digits_and_scale(text: Column) -> tuple[Column, Column]:
    """A decimal as its digits without leading zeros and the places they are moved by."""
    plain = _ungrouped(text)
    digits = F.regexp_replace(F.regexp_extract(plain, r"^[+-]?([0-9.]*)", 1), r"[.]", "")
    return F.ltrim(digits, F.lit("0")), decimal_places(text)


def _needed_places(text: Column) -> Column:
    """Decimal places without zeros at the end; few texts are long enough to be looked at."""
    digits, scale = _digits_and_scale(text)
    trailing = F.length(digits) - F.length(F.rtrim(digits, F.lit("0")))
    exact = F.when(digits == "", F.lit(0)).otherwise(scale - trailing)
    short = (F.length(text) <= WIDE_SCALE) & ~text.rlike("[eE]")
    return F.when(short, F.lit(0)).otherwise(exact)


def is_one(text: Column) -> Column:
    """A decimal that is one as written, however many digits it has."""
    digits, scale = _digits_and_scale(text)
    bare = F.rtrim(digits, F.lit("0"))
    return ~text.startswith("-") & (bare == "1") & (F.length(digits) - 1 == scale)


def is_above_one(text: Column) -> Column:
    """A decimal greater than one as written."""
    digits, scale = _digits_and_scale(text)
    return ~text.startswith("-") & (digits != "") & (F.length(digits) - 1 >= scale) & ~is_one(text)


def to_iso_date(text: Column) -> Column:
    """Trimmed text to date; one-digit months and days are read, impossible days are null."""
    readable = text.rlike(ISO_DATE) & ~text.startswith("0000")
    spaced = F.contains(text, F.lit(" "))
    plain = F.when(spaced, F.translate(text, " ", "")).otherwise(text)
    return F.when(readable, plain.try_cast("date"))


def decimal_places(text: Column) -> Column:
    """Digits after the point less the exponent, as written: 25.000 has three."""
    plain = _ungrouped(text)
    point = F.instr(plain, ".")
    digits = F.when(point > 0, F.length(plain) - point).otherwise(F.lit(0))
    with_exponent = (
        F.length(F.regexp_extract(plain, r"\.([0-9]*)", 1))
        - F.regexp_extract(plain, r"[eE]([+-]?[0-9]+)$", 1).try_cast("int")
    )
    return F.when(plain.rlike("[eE]"), with_exponent).otherwise(digits)


def _has_digit(text: Column) -> Column:
    """A decimal with a digit other than zero before any exponent."""
    return text.rlike(r"^[+-]?[0-9._]*[1-9]")


def is_zero(text: Column) -> Column:
    """A decimal that is zero as written."""
    return ~_has_digit(text)


def is_negative(text: Column) -> Column:
    """A decimal below zero as written, however close to it."""
    return text.startswith("-") & _has_digit(text)


def integer_text(text: Column) -> Column:
    """The integer as it prints: no plus sign, no leading zeros."""
    digits = F.translate(text, "_+", "")
    return F.regexp_replace(F.regexp_replace(digits, r"^(-?)0+([0-9])", "$1$2"), "^-0$", "0")


def decimal_text(text: Column) -> Column:
    """The decimal as it prints: no plus sign, one digit before the point, digits kept after it."""
    plain = F.upper(F.translate(text, "_+", ""))
    plain = F.regexp_replace(plain, r"^(-?)0+([0-9])", "$1$2")
    plain = F.regexp_replace(plain, r"^(-?)\.", "$10.")
    return F.regexp_replace(plain, r"\.$", "")


def quoted(text: Column) -> Column:
    """Text between quotes, the way reports show a raw value."""
    escaped = text
    for char, shown in (("\\", "\\\\"), ("\t", "\\t"), ("\r", "\\r"), ("\n", "\\n")):
        escaped = F.replace(escaped, F.lit(char), F.lit(shown))
    single, double = F.lit("'"), F.lit('"')
    has_single = F.contains(text, single)
    return (
        F.when(~has_single, F.concat(single, escaped, single))
        .when(~F.contains(text, double), F.concat(double, escaped, double))
        .otherwise(F.concat(single, F.replace(escaped, single, F.lit("\\'")), single))
    )


def year_month(source_file: Column) -> Column:
    """The first year-month pair in a file's name; empty without one."""
    return F.regexp_extract(source_file, r"[0-9]{4}[_-][0-9]{2}", 0)


def file_period(source_file: Column, pair: Column | None = None) -> Column:
    """``yyyy-MM`` named by a file, or null: the first year-month pair decides, which may be given."""
    pair = year_month(source_file) if pair is None else pair
    month = F.substring(pair, 6, 2)
    return F.when(
        month.between("01", "12"), F.concat_ws("-", F.substring(pair, 1, 4), month)
    )
