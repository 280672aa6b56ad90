"""Backward-looking features on a regular grid, and event features on their rows."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.functions.times import ceil_us, from_micros, micros
from fleetspark.operators.chunks import own_chunk, spread, with_us
from fleetspark.operators.cleaning import grid_skeleton
from fleetspark.operators.timejoin import latest_per_time, union_with_carry
from fleetspark.params import HOUR_US, FleetParams

MACHINE_COLUMNS = ("model", "age", "plant_id", "line_id")
#: What a sensor measures, as sentences name it.
QUANTITIES = {"volt": "voltage", "rotate": "rotation", "pressure": "pressure", "vibration": "vibration"}


@dataclass(frozen=True)
class Input:
    """A model input: the group it is explained with, what it is about, what it says, over how many steps."""

    group: str
    about: str
    says: str = "value"
    steps: int | None = None


def catalogue(p: FleetParams) -> dict[str, Input]:
    """Every input that this module makes, by its column."""
    known: dict[str, Input] = {}
    for s in p.sensors:
        quantity = QUANTITIES.get(s, s)
        for n in p.windows:
            known[f"{s}_mean_{n}{p.unit}"] = Input(quantity, quantity, "mean", n)
            known[f"{s}_std_{n}{p.unit}"] = Input(quantity, quantity, "variability", n)
        known[f"{s}_trend"] = Input(quantity, quantity, "trend")
        for q in ("filled", "missing"):
            known[f"{s}_{q}_share_{p.longest}{p.unit}"] = Input(quantity, quantity, "share", p.longest)
    for e in p.error_types:
        known[f"{e}_count_{p.longest}{p.unit}"] = Input("errors", e, "count", p.longest)
    known[f"errors_total_{p.longest}{p.unit}"] = Input("errors", "errors (all types)", "count", p.longest)
    for c in p.components:
        known[f"hours_since_{c}_replaced"] = Input("component wear", c, "wear")
    groups = {"model": "machine", "age": "machine"}
    return known | {c: Input(groups.get(c, "other"), c) for c in MACHINE_COLUMNS}


def sensor_feature_names(p: FleetParams) -> list[str]:
    names = []
    for s in p.sensors:
        for w in p.windows:
            names += [f"{s}_mean_{w}{p.unit}", f"{s}_std_{w}{p.unit}"]
        names += [f"{s}_trend"] + [f"{s}_{q}_share_{p.longest}{p.unit}" for q in ("filled", "missing")]
    return names


def feature_rows(bounds: DataFrame, p: FleetParams) -> DataFrame:
    """(entity, time) of every row of ``sensor_features``, from the first and last step of each entity alone.

    The grid is complete between them (``cleaning.grid_bounds``), so which rows there are does not depend
    on any reading: event features, labels and what is judged by them need no cleaned sensors.
    """
    start = bounds.agg(F.min("_lo").alias("_start"))
    full = F.col("_lo") + F.lit((p.longest - 1) * p.step_us)
    elapsed = F.call_function("div", full - F.col("_start"), F.lit(p.step_us))
    first = full + F.pmod(-elapsed, F.lit(p.feature_step)) * F.lit(p.step_us)
    spans = bounds.crossJoin(F.broadcast(start)).select(p.entity, first.alias("_lo"), "_hi").where("_lo <= _hi")
    rows = grid_skeleton(spans, replace(p, step_us=p.feature_step * p.step_us))
    return rows.select(p.entity, from_micros(F.col("_us")).alias(p.time))


def sensor_features(silver: DataFrame, p: FleetParams, every_step: bool = False) -> DataFrame:
    """Rolling mean, spread, trend and quality shares, one row every ``feature_step`` steps.

    Every reading goes to the rows that look back on it and is grouped there, in order of time, so
    nothing is computed for the steps between two rows. Readings are those of a complete grid, so a
    halo of ``longest - 1`` steps makes every time chunk exact and all groups of a chunk meet in its
    task; a row is past warm-up when its longest window is complete. Alignment is to the earliest
    time of the whole table (one broadcast row).
    """
    every = 1 if every_step else p.feature_step
    start = silver.agg(F.min(micros(p.time)).alias("_start"))
    rows = spread(with_us(silver, p.time), "_us", p.chunk_us, (p.longest - 1) * p.step_us)
    flags = [(F.col(f"{s}_quality") == q).alias(f"_{q}_{s}") for s in p.sensors for q in ("filled", "missing")]
    rows = rows.crossJoin(F.broadcast(start)).select(p.entity, "_chunk", "_us", "_start", *p.sensors, *flags)
    rows = rows.repartition(p.entity, "_chunk").sortWithinPartitions(p.entity, "_chunk", "_us")
    elapsed = F.call_function("div", F.col("_us") - F.col("_start"), F.lit(p.step_us))
    rows = rows.withColumn("_wait", F.pmod(-elapsed, F.lit(every))).where(F.col("_wait") < p.longest)
    seen_at = F.sequence(
        F.col("_us") + F.col("_wait") * p.step_us, F.col("_us") + (p.longest - 1) * p.step_us, F.lit(every * p.step_us)
    )
    rows = own_chunk(rows.withColumnRenamed("_chunk", "_sees").withColumn("_at", F.explode(seen_at)), "_at", p.chunk_us)
    rows = rows.where(F.col("_chunk") == F.col("_sees"))
    frames = {"_rows": F.count(F.lit(1))}
    for s in p.sensors:
        for n in p.windows:
            inside = F.col(s) if n == p.longest else F.when(F.col("_at") - F.col("_us") < n * p.step_us, F.col(s))
            frames[f"_n_{s}_{n}"] = F.count(inside)
            frames[f"_m_{s}_{n}"] = F.avg(inside)
            frames[f"_s_{s}_{n}"] = F.stddev_samp(inside)
        for q in ("filled", "missing"):
            frames[f"_{q}_{s}"] = F.avg(F.col(f"_{q}_{s}").cast("double"))
    rows = rows.groupBy(p.entity, "_sees", "_at").agg(*[c.alias(n) for n, c in frames.items()])
    rows = rows.where(F.col("_rows") == p.longest).withColumn(p.time, from_micros(F.col("_at")))
    out = {}
    for s in p.sensors:
        mean = {}
        for n in p.windows:
            enough = F.col(f"_n_{s}_{n}") >= max(2, n // 2)
            mean[n] = F.when(enough, F.col(f"_m_{s}_{n}"))
            out[f"{s}_mean_{n}{p.unit}"] = mean[n]
            out[f"{s}_std_{n}{p.unit}"] = F.when(enough, F.col(f"_s_{s}_{n}"))
        out[f"{s}_trend"] = mean[p.shortest] - mean[p.longest]
        for q in ("filled", "missing"):
            out[f"{s}_{q}_share_{p.longest}{p.unit}"] = F.col(f"_{q}_{s}")
    return rows.select(*p.keys, *[c.cast("float").alias(n) for n, c in out.items()])


def error_count_names(p: FleetParams) -> list[str]:
    return [f"{e}_count_{p.longest}{p.unit}" for e in p.error_types]


def event_features(
    spine: DataFrame, errors: DataFrame, maintenance: DataFrame, machines: DataFrame, p: FleetParams
) -> DataFrame:
    """Error counts in the longest window and hours since each replacement, plus attributes.

    Event times are rounded up to the next step and combined per (entity, step) before the
    single shuffle, so a burst of equal errors is one row. Counts come from a halo of one
    window, replacement times from carry rows.
    """
    window_us = p.longest * p.step_us
    spine = own_chunk(with_us(spine.select(*p.keys), p.time), "_us", p.chunk_us)
    spine = spine.withColumn("_spine", F.lit(True))
    ceiled = lambda df: df.withColumn("_us", ceil_us(micros(p.time), p.step_us))
    counts = (
        ceiled(errors)
        .groupBy(p.entity, "_us")
        .agg(*[F.count(F.when(F.col("error_id") == e, 1)).alias(f"_e_{e}") for e in p.error_types])
    )
    counts = spread(counts, "_us", p.chunk_us, window_us).drop("_own")
    kinds = {c: F.col("component") == c for c in p.components}
    replaced = latest_per_time(ceiled(maintenance), p, kinds)
    rows = union_with_carry(spine, replaced, p, {f"_l_{c}": "max" for c in kinds}, backward=True)
    rows = rows.unionByName(counts, allowMissingColumns=True)

    w = Window.partitionBy(p.entity, "_chunk").orderBy("_us")
    recent, ever = w.rangeBetween(-window_us + 1, 0), w.rangeBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns(
        {f"_c_{e}": F.coalesce(F.sum(f"_e_{e}").over(recent), F.lit(0)) for e in p.error_types}
        | {f"_at_{c}": F.max(f"_l_{c}").over(ever) for c in p.components}
    ).where("_spine")
    total = sum((F.col(f"_c_{e}") for e in p.error_types), F.lit(0))
    features = rows.select(
        *p.keys,
        *[F.col(f"_c_{e}").cast("int").alias(f"{e}_count_{p.longest}{p.unit}") for e in p.error_types],
        total.cast("int").alias(f"errors_total_{p.longest}{p.unit}"),
        *[
            ((F.col("_us") - F.col(f"_at_{c}")) / F.lit(HOUR_US)).cast("float").alias(
                f"hours_since_{c}_replaced"
            )
            for c in p.components
        ],
    )
    return features.join(machines.select(p.entity, *MACHINE_COLUMNS), p.entity, "left")


def event_feature_names(p: FleetParams) -> list[str]:
    return [
        *error_count_names(p),
        f"errors_total_{p.longest}{p.unit}",
        *[f"hours_since_{c}_replaced" for c in p.components],
        *MACHINE_COLUMNS,
    ]
