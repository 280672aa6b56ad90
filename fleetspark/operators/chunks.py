"""Time chunks: the partitioning under every per-entity window operator.

A window partitioned by the entity alone puts a busy or very long-lived entity into one
task. All rules here look only a bounded number of steps around a row, so rows are
partitioned by (entity, time chunk) and the few rows near a chunk border are copied into
the neighbouring chunk (the halo). Whatever can reach further back or ahead (as-of values)
travels as one carry row per (entity, chunk).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.functions.times import micros


def _floor_div(us: Column, span_us: int) -> Column:
    """Floor division that stays exact for microseconds before 1970 and large epochs."""
    return F.call_function("div", us - F.pmod(us, F.lit(span_us)), F.lit(span_us))


def spread(df: DataFrame, us: str, span_us: int, before_us: int = 0, after_us: int = 0) -> DataFrame:
    """Copy each row into every chunk that must see it.

    A chunk sees rows up to ``before_us`` before its start and ``after_us`` after its end.
    Adds ``_chunk`` and ``_own`` (false for halo copies).
    """
    x = F.col(us)
    lo = _floor_div(x - F.lit(after_us), span_us)
    hi = _floor_div(x + F.lit(before_us), span_us)
    return df.withColumn("_chunk", F.explode(F.sequence(lo, hi))).withColumn(
        "_own", F.col("_chunk") == _floor_div(x, span_us)
    )


def with_us(df: DataFrame, time: str) -> DataFrame:
    return df.withColumn("_us", micros(time))


def own_chunk(df: DataFrame, us: str, span_us: int) -> DataFrame:
    return df.withColumn("_chunk", _floor_div(F.col(us), span_us))


def carry(
    summaries: DataFrame, entity: str, columns: dict[str, str], backward: bool = True
) -> DataFrame:
    """Best value of all earlier (or later) chunks, for each chunk.

    ``summaries`` has one row per (entity, chunk), so the window below is as long as the
    number of chunks an entity lives through. ``columns`` maps a column to ``min``, ``max`` or ``sum``.
    """
    order = F.col("_chunk") if backward else F.col("_chunk").desc()
    w = Window.partitionBy(entity).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    fn = {"min": F.min, "max": F.max, "sum": F.sum}
    return summaries.withColumns({c: fn[how](c).over(w) for c, how in columns.items()})
