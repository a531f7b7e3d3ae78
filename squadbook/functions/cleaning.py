"""Value cleansing that gives the same result with ANSI mode on and off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The first number inside a messy text, and a text that is one number.
FIRST_NUMBER = r"(-?\d+(?:\.\d+)?)"
WHOLE_NUMBER = r"^\s*[-+]?\d+(\.\d+)?([eE][-+]?\d+)?\s*$"
FIRST_DIGITS = r"(\d+)"

_INTEGERS = ("int", "bigint")


def clean_numeric(column: Column, target: str) -> Column:
    """Number held by a text: ``72+3`` -> 72, ``180cm`` -> 180, ``7.8E7`` -> 78000000.

    A text that is a number as a whole keeps its exponent; any other text gives its
    first number, or NULL when it has none. Integer targets drop the fraction.
    """
    text = column.cast("string")
    number = F.when(text.rlike(WHOLE_NUMBER), text).otherwise(
        F.regexp_extract(text, FIRST_NUMBER, 1)  # '' without a match; try_cast makes it NULL
    )
    if target in _INTEGERS:
        return number.try_cast("decimal(38,10)").try_cast(target)
    return number.try_cast(target)


def clean_timestamp(column: Column) -> Column:
    """Timestamp held by a text; blank or unreadable texts give NULL."""
    return F.try_to_timestamp(F.trim(column.cast("string")))


def tolerant_integer(column: Column, target: str, source: T.DataType | None = None) -> Column:
    """Plain integer cast: ``2021.0`` -> 2021, ``1.5E3`` -> 1500, but ``Jun 30, 2021`` -> NULL.

    ``source`` is the column's type; numbers are cast as they are, all else as text.
    """
    if isinstance(source, T.NumericType):
        return column.try_cast("decimal(38,10)").try_cast(target)
    text = F.trim(column.cast("string"))
    text = F.regexp_replace(text, r"\.$", "")
    return F.when(text.rlike(WHOLE_NUMBER), text.try_cast("decimal(38,10)").try_cast(target))


def digits_in(column: Column) -> Column:
    """First run of digits in a text as bigint, NULL without one."""
    return F.regexp_extract(column.cast("string"), FIRST_DIGITS, 1).try_cast("bigint")


def coerce(column: Column, source: T.DataType, target: str) -> Column:
    """Bring a column of type ``source`` to ``target``, cleansing texts on the way.

    Numbers are never routed through text: ``78000000.0`` prints as ``7.8E7``.
    """
    if source.simpleString() == target:
        return column
    if target == "timestamp":
        temporal = isinstance(source, (T.DateType, T.TimestampType, T.TimestampNTZType))
        return column.cast(target) if temporal else clean_timestamp(column)
    if target in (*_INTEGERS, "double"):
        return (
            column.try_cast(target)
            if isinstance(source, T.NumericType)
            else clean_numeric(column, target)
        )
    return column.try_cast(target)
