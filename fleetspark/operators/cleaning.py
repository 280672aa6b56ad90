"""Cleaning rules for irregular multi-sensor time series.

Order: deduplicate, null out-of-range values, null stuck runs, put on a regular grid, fill
short gaps. Each rule is a DataFrame function; each has a counter function that returns a
small metrics frame (rule, column, count) instead of touching the data again downstream.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.functions.times import from_micros, micros
from fleetspark.functions.typing import n_if
from fleetspark.operators.chunks import own_chunk, spread, with_us
from fleetspark.params import FleetParams



def source_order(df: DataFrame) -> str:
    """The column that says which of two rows came first: over all files where they were landed, else the line."""
    return "_source_order" if "_source_order" in df.columns else "_source_line"


# ---------------------------------------------------------------- deduplicate


def deduplicate(df: DataFrame, p: FleetParams, order: str | None = None) -> DataFrame:
    """One row per (entity, time): the copy with the lowest ``order`` value.

    A grouped minimum combines on the map side, so a key with very many copies never meets in
    one task the way a ``row_number`` window would force it to.
    """
    order = order or source_order(df)
    rest = [c for c in df.columns if c not in (*p.keys, order)]
    first = F.min(F.struct(order, *rest)).alias("_first")
    return df.groupBy(*p.keys).agg(first).select(*p.keys, "_first.*")


def duplicate_counts(df: DataFrame, p: FleetParams, order: str | None = None) -> DataFrame:
    """Rows removed, and how many of them differ from the kept row (NULL equals NULL)."""
    sensors, order = list(p.sensors), order or source_order(df)
    versions = df.groupBy(*p.keys, *sensors).agg(
        F.count(F.lit(1)).alias("_n"), F.min(order).alias("_line")
    )
    per_key = versions.groupBy(*p.keys).agg(
        F.sum("_n").alias("_all"), F.min(F.struct("_line", "_n")).alias("_kept")
    )
    return per_key.agg(
        F.coalesce(F.sum(F.col("_all") - 1), F.lit(0)).alias("duplicates_removed"),
        F.coalesce(F.sum(F.col("_all") - F.col("_kept._n")), F.lit(0)).alias("conflicting_duplicates"),
    )


# ---------------------------------------------------------------- range


def out_of_range(sensor: str, p: FleetParams) -> Column:
    limit = p.sensors[sensor]
    return F.col(sensor).isNotNull() & ~F.col(sensor).between(limit.min, limit.max)


def null_out_of_range(df: DataFrame, p: FleetParams) -> DataFrame:
    return df.withColumns(
        {s: F.when(F.col(s).between(limit.min, limit.max), F.col(s)) for s, limit in p.sensors.items()}
    )


# ---------------------------------------------------------------- stuck runs


def mark_stuck(df: DataFrame, p: FleetParams) -> DataFrame:
    """Add ``<sensor>_stuck`` (a repeat inside a long run) and ``<sensor>_run`` (its first repeat).

    A repeat equals the previous row of the entity, which must be exactly one step earlier. A
    run of ``stuck_min_run`` readings is ``stuck_min_run - 1`` repeats in a row, so a row is
    decided by that many neighbours: a halo of so many steps makes every chunk exact.
    """
    m = p.stuck_min_run
    halo = (m - 1) * p.step_us
    rows = spread(with_us(df, p.time), "_us", p.chunk_us, halo, halo)
    w = Window.partitionBy(p.entity, "_chunk").orderBy("_us")
    next_to = F.lag("_us").over(w) == F.col("_us") - F.lit(p.step_us)
    rows = rows.withColumns(
        {
            f"_rep_{s}": F.coalesce(next_to & (F.lag(s).over(w) == F.col(s)), F.lit(False)).cast("int")
            for s in p.sensors
        }
    )
    rows = rows.withColumns(
        {f"_full_{s}": F.min(f"_rep_{s}").over(w.rowsBetween(-(m - 2), 0)) for s in p.sensors}
    )
    rows = rows.withColumns(
        {
            f"{s}_stuck": (F.max(f"_full_{s}").over(w.rowsBetween(0, m - 2)) == 1)
            & (F.col(f"_rep_{s}") == 1)
            for s in p.sensors
        }
        | {f"_prev_{s}": F.lag(f"_rep_{s}", 1, 0).over(w) for s in p.sensors}
    )
    rows = rows.withColumns({f"{s}_run": F.col(f"{s}_stuck") & (F.col(f"_prev_{s}") == 0) for s in p.sensors})
    helpers = [f"_{h}_{s}" for h in ("rep", "full", "prev") for s in p.sensors]
    return rows.where("_own").drop("_own", "_chunk", "_us", *helpers)


def null_stuck_runs(df: DataFrame, p: FleetParams) -> DataFrame:
    """Keep the first reading of a long run of identical readings and null the repeats."""
    marked = mark_stuck(df, p)
    return marked.withColumns({s: F.when(~F.col(f"{s}_stuck"), F.col(s)) for s in p.sensors}).drop(
        *[f"{s}_{x}" for s in p.sensors for x in ("stuck", "run")]
    )


# ---------------------------------------------------------------- regular grid


def on_grid(p: FleetParams) -> Column:
    return F.pmod(micros(p.time), F.lit(p.step_us)) == 0


def grid_bounds(df: DataFrame, p: FleetParams) -> DataFrame:
    """First and last on-step time of every entity (one small row each)."""
    us = micros(p.time)
    return (
        df.where(on_grid(p))
        .groupBy(p.entity)
        .agg(F.min(us).alias("_lo"), F.max(us).alias("_hi"))
    )


def grid_skeleton(bounds: DataFrame, p: FleetParams, halo_us: int = 0) -> DataFrame:
    """Every step between the bounds as (entity, _chunk, _us), halo steps included.

    The range is first cut into chunks and only then into steps, so one long range is
    generated by many tasks.
    """
    lo, hi, span, step = F.col("_lo"), F.col("_hi"), F.lit(p.chunk_us), F.lit(p.step_us)
    div = lambda a: F.call_function("div", a - F.pmod(a, span), span)
    chunks = bounds.withColumn("_chunk", F.explode(F.sequence(div(lo - halo_us), div(hi + halo_us))))
    start = F.greatest(lo, F.col("_chunk") * span - halo_us)
    start = lo + F.call_function("div", start - lo + step - 1, step) * step
    end = F.least(hi, (F.col("_chunk") + 1) * span - 1 + halo_us)
    return (
        chunks.withColumns({"_start": start, "_end": end})
        .where(F.col("_start") <= F.col("_end"))
        .repartition(p.entity, "_chunk")
        .select(
            p.entity, "_chunk", F.explode(F.sequence(F.col("_start"), F.col("_end"), step)).alias("_us")
        )
    )


def regular_grid(
    df: DataFrame, p: FleetParams, bounds: DataFrame | None = None, halo_steps: int = 0
) -> DataFrame:
    """One row per step between each entity's own first and last on-step reading.

    Readings and the empty skeleton are combined by one grouped union, so the result arrives
    partitioned by (entity, chunk) and the gap filling that follows needs no second shuffle.
    With ``halo_steps`` the rows carry ``_chunk``/``_us`` and halo copies for that follow-up.
    """
    halo = halo_steps * p.step_us
    rest = [c for c in df.columns if c not in p.keys]
    readings = spread(with_us(df.where(on_grid(p)), p.time), "_us", p.chunk_us, halo, halo)
    readings = readings.select(p.entity, "_chunk", "_us", *rest)
    skeleton = grid_skeleton(bounds if bounds is not None else grid_bounds(df, p), p, halo)
    rows = (
        readings.unionByName(skeleton, allowMissingColumns=True)
        .repartition(p.entity, "_chunk")
        .groupBy(p.entity, "_chunk", "_us")
        .agg(*[F.max(c).alias(c) for c in rest])
    )
    if halo_steps:
        return rows
    return rows.select(p.entity, from_micros(F.col("_us")).alias(p.time), *rest)


# ---------------------------------------------------------------- short gaps


def fill_halo(p: FleetParams) -> int:
    return max(p.fill_window // 2, (p.fill_window + 1) - 1 - p.fill_window // 2, p.max_fill + 1)


def _fill(rows: DataFrame, p: FleetParams) -> DataFrame:
    """Gap rule on rows that hold ``_chunk`` and ``_us`` with a halo of ``fill_halo`` steps."""
    w = Window.partitionBy(p.entity, "_chunk").orderBy("_us")
    n = p.fill_window + 1
    centred = w.rowsBetween(-(n // 2), n - 1 - n // 2)
    need = max(p.fill_window // 2, 1)
    seen = lambda s: F.when(F.col(s).isNotNull(), F.col("_us"))
    rows = rows.withColumns(
        {f"_prev_{s}": F.max(seen(s)).over(w.rowsBetween(-p.max_fill, -1)) for s in p.sensors}
        | {f"_next_{s}": F.min(seen(s)).over(w.rowsBetween(1, p.max_fill)) for s in p.sensors}
        | {f"_mean_{s}": F.avg(s).over(centred) for s in p.sensors}
        | {f"_n_{s}": F.count(s).over(centred) for s in p.sensors}
    )
    limit = F.lit((p.max_fill + 1) * p.step_us)
    filled = {
        s: F.coalesce(
            F.col(s).isNull()
            & (F.col(f"_next_{s}") - F.col(f"_prev_{s}") <= limit)
            & (F.col(f"_n_{s}") >= need),
            F.lit(False),
        )
        for s in p.sensors
    }
    return rows.withColumns(
        {
            f"{s}_quality": F.when(f, "filled").when(F.col(s).isNull(), "missing").otherwise("ok")
            for s, f in filled.items()
        }
    ).withColumns(
        {
            s: F.when(F.col(f"{s}_quality") == "filled", F.col(f"_mean_{s}")).otherwise(F.col(s))
            for s in p.sensors
        }
    )


def _finish(rows: DataFrame, p: FleetParams, extra: list[str]) -> DataFrame:
    own = F.call_function("div", F.col("_us") - F.pmod("_us", F.lit(p.chunk_us)), F.lit(p.chunk_us))
    return rows.where(F.col("_chunk") == own).select(
        p.entity,
        from_micros(F.col("_us")).alias(p.time),
        *p.sensors,
        *[f"{s}_quality" for s in p.sensors],
        *extra,
    )


def fill_short_gaps(grid: DataFrame, p: FleetParams) -> DataFrame:
    """Fill gaps of at most ``max_fill`` steps between two readings with a centred mean.

    Expects a complete grid. The mean uses readings as they were before filling and needs half
    the window; every sensor gets a ``<sensor>_quality`` of ok, filled or missing.
    """
    halo = fill_halo(p) * p.step_us
    extra = [c for c in grid.columns if c not in (*p.keys, *p.sensors)]
    rows = spread(with_us(grid, p.time), "_us", p.chunk_us, halo, halo)
    return _finish(_fill(rows, p), p, extra)


def interpolate_linear(grid: DataFrame, p: FleetParams) -> DataFrame:
    """``<sensor>_linear``: straight line between the readings around each gap, inside only.

    Positions count rows, which is time on a complete grid. A gap may be longer than any halo,
    so the nearest readings come from the chunk itself or from a carry row of its neighbours.
    """
    rows = own_chunk(with_us(grid, p.time), "_us", p.chunk_us)
    last = {s: F.max(F.when(F.col(s).isNotNull(), F.struct("_us", s))) for s in p.sensors}
    first = {s: F.min(F.when(F.col(s).isNotNull(), F.struct("_us", s))) for s in p.sensors}
    ends = rows.groupBy(p.entity, "_chunk").agg(
        *[c.alias(f"_cl_{s}") for s, c in last.items()], *[c.alias(f"_cf_{s}") for s, c in first.items()]
    )
    over = Window.partitionBy(p.entity).orderBy("_chunk")
    ends = ends.select(
        p.entity,
        "_chunk",
        *[
            F.max(f"_cl_{s}").over(over.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_before_{s}")
            for s in p.sensors
        ],
        *[
            F.min(f"_cf_{s}")
            .over(
                Window.partitionBy(p.entity)
                .orderBy(F.col("_chunk").desc())
                .rowsBetween(Window.unboundedPreceding, -1)
            )
            .alias(f"_after_{s}")
            for s in p.sensors
        ],
    )
    up = Window.partitionBy(p.entity, "_chunk").orderBy("_us").rowsBetween(Window.unboundedPreceding, 0)
    down = (
        Window.partitionBy(p.entity, "_chunk")
        .orderBy(F.col("_us").desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    point = lambda s: F.when(F.col(s).isNotNull(), F.struct("_us", s))
    rows = rows.withColumns({f"_l_{s}": F.last(point(s), ignorenulls=True).over(up) for s in p.sensors})
    rows = rows.withColumns({f"_r_{s}": F.last(point(s), ignorenulls=True).over(down) for s in p.sensors})
    rows = rows.join(ends, [p.entity, "_chunk"], "left")
    linear = {}
    for s in p.sensors:
        a = F.coalesce(F.col(f"_l_{s}"), F.col(f"_before_{s}"))
        b = F.coalesce(F.col(f"_r_{s}"), F.col(f"_after_{s}"))
        share = (F.col("_us") - a["_us"]) / (b["_us"] - a["_us"])
        linear[f"{s}_linear"] = F.coalesce(
            F.col(s), F.when(b["_us"] > a["_us"], a[s] + (b[s] - a[s]) * share)
        )
    return rows.select(*grid.columns, *[c.alias(n) for n, c in linear.items()])


# ---------------------------------------------------------------- all rules


def slot_edges(typed: DataFrame, p: FleetParams, order: str | None = None) -> DataFrame:
    """First and last time of every (entity, step slot), each by its first copy.

    A reading with an earlier and a later one in its own slot has neighbours closer than one
    step, so it can neither join nor extend a stuck run, and it is not on the grid either. It
    can go before any per-entity work: at most two rows per slot are left, however busy the
    entity is. Combines on the map side and removes duplicates on the way.
    """
    order = order or source_order(typed)
    rest = [c for c in typed.columns if c not in (*p.keys, order)]
    rows = with_us(typed, p.time).withColumn("_slot", F.col("_us") - F.pmod("_us", F.lit(p.step_us)))
    edges = rows.groupBy(p.entity, "_slot").agg(
        F.min(F.struct("_us", order, *rest)).alias("_first"),
        F.max(F.struct("_us", (-F.col(order)).alias(order), *rest)).alias("_last"),
    )
    last = F.struct(
        F.col("_last._us").alias("_us"),
        (-F.col(f"_last.{order}")).alias(order),
        *[F.col(f"_last.{c}").alias(c) for c in rest],
    )
    both = F.when(F.col("_first._us") < F.col("_last._us"), F.array("_first", last)).otherwise(F.array("_first"))
    return (
        edges.select(p.entity, F.explode(both).alias("_e"))
        .select(p.entity, from_micros(F.col("_e._us")).alias(p.time), f"_e.{order}", *[f"_e.{c}" for c in rest])
    )


def clean(typed: DataFrame, p: FleetParams) -> DataFrame:
    """All rules in order. Three shuffles: slot edges without duplicates, stuck runs, grid with
    gap filling."""
    cleaned = null_stuck_runs(null_out_of_range(slot_edges(typed, p), p), p)
    extra = [c for c in cleaned.columns if c not in (*p.keys, *p.sensors)]
    grid = regular_grid(cleaned, p, grid_bounds(typed, p), fill_halo(p))
    return _finish(_fill(grid, p), p, extra)


def cleaning_metrics(typed: DataFrame, p: FleetParams) -> DataFrame:
    """Every counter of the cleaning as rows of (rule, sensor, n)."""
    sensors = list(p.sensors)
    first = deduplicate(typed, p)
    duplicates = _long(duplicate_counts(typed, p), {"duplicates_removed": None, "conflicting_duplicates": None})
    ranges = _per_sensor(first.agg(*[n_if(out_of_range(s, p)).alias(s) for s in sensors]), "out_of_range_nulled", sensors)
    marked = mark_stuck(null_out_of_range(first, p), p)
    counted = marked.agg(
        *[n_if(F.col(f"{s}_run")).alias(f"{s}_run") for s in sensors],
        *[n_if(F.col(f"{s}_stuck")).alias(f"{s}_stuck") for s in sensors],
        n_if(~on_grid(p)).alias("rows_off_step_dropped"),
        n_if(on_grid(p)).alias("_on"),
    )
    runs = _per_sensor(counted.select(*[F.col(f"{s}_run").alias(s) for s in sensors]), "stuck_runs", sensors)
    stuck = _per_sensor(
        counted.select(*[F.col(f"{s}_stuck").alias(s) for s in sensors]), "stuck_values_nulled", sensors
    )
    off = _long(counted, {"rows_off_step_dropped": None})
    steps = F.call_function("div", F.col("_hi") - F.col("_lo"), F.lit(p.step_us)) + 1
    grid_rows = grid_bounds(typed, p).agg(F.coalesce(F.sum(steps), F.lit(0)).alias("rows_out"))
    added = _long(
        grid_rows.crossJoin(F.broadcast(counted.select("_on"))).select(
            "rows_out", (F.col("rows_out") - F.col("_on")).alias("grid_rows_added")
        ),
        {"rows_out": None, "grid_rows_added": None},
    )
    final = clean(typed, p).agg(
        *[n_if(F.col(f"{s}_quality") == "filled").alias(f"{s}_f") for s in sensors],
        *[n_if(F.col(s).isNull()).alias(f"{s}_m") for s in sensors],
    )
    filled = _per_sensor(final.select(*[F.col(f"{s}_f").alias(s) for s in sensors]), "filled", sensors)
    missing = _per_sensor(final.select(*[F.col(f"{s}_m").alias(s) for s in sensors]), "missing_after", sensors)
    rows_in = _long(typed.agg(F.count(F.lit(1)).alias("rows_in")), {"rows_in": None})
    parts = [rows_in, duplicates, ranges, runs, stuck, off, added, filled, missing]
    return reduce(DataFrame.unionByName, parts)


def _per_sensor(counts: DataFrame, rule: str, sensors: list[str]) -> DataFrame:
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(rule).alias("rule"), F.lit(s).alias("sensor"), F.col(s).cast("bigint").alias("n")
                    )
                    for s in sensors
                ]
            )
        )
    )


def _long(counts: DataFrame, rules: dict[str, str | None]) -> DataFrame:
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(r).alias("rule"),
                        F.lit(s).cast("string").alias("sensor"),
                        F.col(r).cast("bigint").alias("n"),
                    )
                    for r, s in rules.items()
                ]
            )
        )
    )
