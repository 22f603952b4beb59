"""Numbers out of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotkeeper import fixed_values as fv
from lotkeeper.functions.text import strip

# what a cast to bigint can read; a cast that fails raises and catches an error for every row
_PLAIN = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*$"
_WHOLE_POINT = r"^([+-]?\d+)\.0*$"
_OTHER_FORM = r"^[+-]?(\d+\.?\d*[eE][+-]?\d+|\.\d+([eE][+-]?\d+)?)$"
_FRACTION = r"^[+-]?\d*\.\d*[1-9]\d*$"


def plain_integer(text: Column) -> Column:
    """``text.try_cast("bigint")``, tried only on text that reads as an integer."""
    return F.when(text.rlike(_PLAIN), text.try_cast("bigint"))


def whole_number(text: Column) -> Column:
    """A number without a fraction as bigint; anything else, fractions included, is NULL.

    Plain digits take the first branch, ``3500.0`` the second, and only what is left is tested for
    the rare forms ``1e3`` and ``.0``.
    """
    value = text.try_cast("double")
    return F.coalesce(
        plain_integer(text),
        F.when(text.rlike(_WHOLE_POINT), F.regexp_extract(text, _WHOLE_POINT, 1).try_cast("bigint")),
        F.when(text.rlike(_OTHER_FORM) & (value == F.floor(value)), value.try_cast("bigint")))


def is_fractional(text: Column) -> Column:
    """True for numeric text that ``whole_number`` refuses."""
    value = text.try_cast("double")
    return F.coalesce(text.rlike(_FRACTION) | (text.rlike(_OTHER_FORM) & (value != F.floor(value))),
                      F.lit(False))


def price_text(c: Column) -> Column:
    """Price text without currency mark, commas and outer white space."""
    return strip(F.replace(F.regexp_replace(c.cast("string"), "[Rr][Mm]", ""), F.lit(",")))


def clean_price(c: Column) -> Column:
    return whole_number(price_text(c))


def clean_engine_capacity(c: Column) -> Column:
    return whole_number(strip(F.regexp_replace(c.cast("string"), "[Cc]{2}", "")))


def clean_year(c: Column) -> Column:
    """First run of four digits; ``1995 or older`` is 1995 that way too."""
    return F.nullif(F.regexp_extract(c.cast("string"), r"(\d{4})", 1), F.lit("")).cast("bigint")


def clean_flag(c: Column) -> Column:
    return whole_number(strip(c.cast("string")))


def price_digits(c: Column) -> Column:
    """The digits of a price without leading zeros, for comparing prices whatever their form or length."""
    digits = F.nullif(F.regexp_replace(c.cast("string"), r"[^\d]", ""), F.lit(""))
    return F.regexp_replace(digits, r"^0+(?=\d)", "")


def _first_number(c: Column, pattern: str, type_name: str) -> Column:
    """First number in the text without its commas. Placeholder words hold no digits, so they and
    text without a number both come out as an empty match, which casts to NULL."""
    found = F.regexp_extract(c.cast("string"), pattern, 0)
    return F.replace(found, F.lit(",")).try_cast(type_name)


def leading_int(c: Column) -> Column:
    """``1,498 cc`` is 1498; the digits stop at a point."""
    return _first_number(c, r"-?\d[\d,]*", "bigint")


def leading_float(c: Column) -> Column:
    return _first_number(c, r"-?\d[\d,]*\.?\d*", "double")


def unit_float(c: Column) -> Column:
    return _first_number(c, r"[\d,]+(?:\.\d+)?", "double")


def unit_int(c: Column) -> Column:
    return F.bround(unit_float(c), 0).cast("bigint")


def unit_text(c: Column) -> Column:
    """Stripped text; an empty cell or a lone dash of any kind is missing."""
    text = strip(c)
    for mark in fv.EMPTY_UNIT_MARKS:
        text = F.nullif(text, F.lit(mark))
    return text


def power_to_hp(c: Column) -> Column:
    """Kilowatts become horsepower; horsepower passes through. One decimal."""
    number = unit_float(c)
    return F.bround(F.when(c.rlike("(?i)kw"), number * fv.KW_TO_HP).otherwise(number), 1)


def hp_to_kw(c: Column) -> Column:
    return F.bround(c.cast("double") * fv.HP_TO_KW, 0).cast("int")


def sqlite_integer(c: Column) -> Column:
    """Integer cast of a loosely typed table: leading integer, else 0; empty text is NULL."""
    text = c.cast("string")
    digits = F.regexp_extract(text, r"^\s*([+-]?\d+)", 1)
    return F.when(text != "", F.when(digits == "", F.lit(0).cast("bigint"))
                  .otherwise(digits.try_cast("bigint")))
