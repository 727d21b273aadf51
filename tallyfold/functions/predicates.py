"""Row predicates of the data-quality rules, always true or false, never null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The type names rules may use, each with the text shape it asks for.
NUMBER_SHAPE = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_SHAPE = r"^[+-]?[0-9]+$"
DAY_SHAPE, DAY_FORMAT = r"^[0-9]{8}$", "yyyyMMdd"
SECOND_SHAPE, SECOND_FORMAT = r"^[0-9]{14}$", "yyyyMMddHHmmss"


def _sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def equals(c: Column, value: str) -> Column:
    return _sure(c.cast("string") == F.lit(value))


def in_list(c: Column, values: list[str]) -> Column:
    return _sure(c.cast("string").isin(list(values)))


def has_length(c: Column, n: int) -> Column:
    return F.length(F.coalesce(c.cast("string"), F.lit(""))) == n


def complete(c: Column) -> Column:
    return c.isNotNull()


def of_type(c: Column, name: str, held: T.DataType) -> Column:
    """Whether a value reads as the named type; `held` is the column's own type."""
    text = c.cast("string")
    if name == "NUMBER":
        return c.isNotNull() if isinstance(held, T.NumericType) else _sure(text.rlike(NUMBER_SHAPE))
    if name == "INTEGER":
        return c.isNotNull() if isinstance(held, T.IntegralType) else _sure(text.rlike(INTEGER_SHAPE))
    if name == "CHAR":
        return c.isNotNull()
    if name == "YYYYMMDD":
        if isinstance(held, (T.DateType, T.TimestampType)):
            return c.isNotNull()
        return _sure(text.rlike(DAY_SHAPE) & F.try_to_date(text, DAY_FORMAT).isNotNull())
    if name == "YYYYMMDDHHMMSS":
        if isinstance(held, T.TimestampType):
            return c.isNotNull()
        return _sure(
            text.rlike(SECOND_SHAPE) & F.try_to_timestamp(text, F.lit(SECOND_FORMAT)).isNotNull()
        )
    raise ValueError(f"unknown data type name in a rule: {name}")
