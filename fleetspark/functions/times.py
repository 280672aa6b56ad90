"""Time expressions on zone-free timestamps.

Event times are TIMESTAMP_NTZ. Long microseconds are the working form of every RANGE frame
and chunk number; the session time zone is pinned to UTC so both forms agree.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from fleetspark.params import HOUR_US


def pin_utc(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def micros(col: str | Column) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(col.cast("timestamp"))


def from_micros(col: Column) -> Column:
    return F.timestamp_micros(col).cast("timestamp_ntz")


def ntz(value) -> Column:
    """A literal zone-free timestamp."""
    return F.lit(str(value)).cast("timestamp_ntz")


def floor_us(us: Column, unit_us: int) -> Column:
    return us - F.pmod(us, F.lit(unit_us))


def ceil_us(us: Column, unit_us: int) -> Column:
    """Round up: an event between two steps becomes visible only at the later one."""
    return -floor_us(-us, unit_us)


def trunc(unit: str, col: str | Column) -> Column:
    """date_trunc that stays zone-free."""
    return F.date_trunc(unit, col).cast("timestamp_ntz")


def date_key(col: str | Column) -> Column:
    return F.date_format(col, "yyyyMMdd").cast("int")


def year_month(col: str | Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def hours_crossed(start: str | Column, end: str | Column) -> Column:
    """Whole-hour boundaries between two times (06:59 to 07:01 is 1)."""
    h = lambda c: F.floor(micros(c) / F.lit(HOUR_US))
    return h(end) - h(start)


def calendar_parts(day: str) -> dict[str, Column]:
    """Columns of a calendar dimension derived from one DATE column."""
    d = F.col(day)
    iso_weekday = F.weekday(d) + 1
    return {
        "date_key": date_key(d),
        "date": d,
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "year_month": year_month(d),
        "iso_week": F.weekofyear(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_week": iso_weekday,
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": iso_weekday >= 6,
    }
