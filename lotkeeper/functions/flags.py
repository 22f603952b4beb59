"""Flags, mileage ranges and fixed lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotkeeper import fixed_values as fv
from lotkeeper.functions.text import strip


def flag_from_text(c: Column) -> Column:
    word = F.lower(strip(c))
    return (F.when(word.isin("true", "1", "yes"), F.lit(1))
            .when(word.isin("false", "0", "no", ""), F.lit(0)))


def coerce_flag(df: DataFrame, name: str) -> Column:
    """0/1 from a boolean, a number or a word; other words are NULL."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.BooleanType):
        return F.col(name).cast("int")
    if isinstance(kind, T.NumericType):
        return (F.col(name) != 0).cast("int")
    if isinstance(kind, T.StringType):
        return flag_from_text(F.col(name))
    return F.lit(None).cast("int")


def mileage_bucket(gte: Column, lte: Column) -> Column:
    """``gte-lte`` as whole numbers; an open side stays empty; NULL when both sides are missing."""
    def side(c: Column) -> Column:
        text = c.cast("string")
        whole = F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))
        return F.coalesce(whole.cast("string"), text, F.lit(""))

    return F.when(gte.isNotNull() | lte.isNotNull(),
                  F.concat(side(gte), F.lit("-"), side(lte)))


def lookup(c: Column, table: dict[str, str]) -> Column:
    """Value of a small fixed table; NULL for unknown keys."""
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), c)


def api_vehicle_type(c: Column) -> Column:
    return lookup(strip(F.coalesce(c, F.lit(""))), fv.API_BODY_TYPES)


def car_type_group(c: Column) -> Column:
    return lookup(c, fv.CAR_TYPE_GROUPS)
