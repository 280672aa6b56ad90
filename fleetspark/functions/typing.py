"""Text to typed values. Bad text becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted shapes of numbers and timestamps.
NUMBER_PATTERN = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
ISO_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?)?$"
US_PATTERN = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} [0-9]{1,2}:[0-9]{2}:[0-9]{2} [AaPp][Mm]$"
US_FORMAT = "M/d/yyyy h:mm:ss a"


def trimmed(col: str | Column) -> Column:
    """Text without outer white space; NULL counts as empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s+|\s+$", "")


def blank_to_null(col: str | Column) -> Column:
    return F.nullif(trimmed(col), F.lit(""))


def parse_timestamp(col: str | Column) -> Column:
    """ISO 8601 first, then the US style ``1/3/2015 7:00:00 AM``.

    The shape is checked before the cast, because the engine also accepts words such as
    ``yesterday`` and bare years as timestamps.
    """
    text = trimmed(col)
    iso = F.when(text.rlike(ISO_PATTERN), text.try_cast("timestamp_ntz"))
    us = F.when(
        text.rlike(US_PATTERN), F.try_to_timestamp(F.upper(text), F.lit(US_FORMAT)).cast("timestamp_ntz")
    )
    return F.coalesce(iso, us)


def parse_double(col: str | Column) -> Column:
    """Plain decimal numbers only: ``1.5d``, ``NaN`` and ``infinity`` are rejected."""
    text = trimmed(col)
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def parse_integer(col: str | Column) -> Column:
    d = parse_double(col)
    return F.when(d == F.round(d), d.try_cast("bigint"))


def parse_id(col: str | Column) -> Column:
    """A whole number above zero (`` 42 `` is 42; ``1.5``, ``-3`` and ``M7`` are NULL)."""
    i = parse_integer(col)
    return F.when(i > 0, i)


def is_blank(col: str | Column) -> Column:
    return trimmed(col) == ""


def nan_to_null(col: str) -> Column:
    return F.when(~F.isnan(col), F.col(col))


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Division that gives NULL instead of failing on zero."""
    num = F.col(numerator) if isinstance(numerator, str) else numerator
    den = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.try_divide(num.cast("double"), den.cast("double"))


def n_if(condition: Column) -> Column:
    """Number of rows for which the condition holds, as BIGINT."""
    return F.count(F.when(condition, F.lit(1)))
