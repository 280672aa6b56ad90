"""Landing text to typed telemetry, master and event tables, with drop reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.functions.ordered import running_totals
from fleetspark.functions.typing import (
    blank_to_null,
    is_blank,
    n_if,
    parse_double,
    parse_id,
    parse_integer,
    parse_timestamp,
    trimmed,
)
from fleetspark.operators.cleaning import source_order
from fleetspark.params import MODELS, FleetParams

LINEAGE = ("_batch_id", "_source_line", "_source_order")
COST_COLUMNS = (
    "repair_cost",
    "unplanned_repair_cost",
    "unplanned_downtime_hours",
    "planned_downtime_hours",
    "downtime_cost_per_hour",
    "unplanned_failure_cost",
    "planned_maintenance_cost",
    "saving_if_prevented",
)
PLACE = ("plant_id", "plant_name", "city", "line_id")


def _lineage(df: DataFrame) -> list[str]:
    return [c for c in LINEAGE if c in df.columns]


def first_failed(checks: dict[str, Column]) -> Column:
    """Name of the first check a row fails, NULL when it passes all; an unknown outcome fails."""
    reason = F.lit(None).cast("string")
    for name, bad in reversed(list(checks.items())):
        reason = F.when(F.coalesce(bad, F.lit(True)), name).otherwise(reason)
    return reason


def kept(judged: DataFrame, keys: list[str]) -> DataFrame:
    """Valid rows, the first one of each key in the order of the sources.

    A grouped minimum instead of a window or a join back: many copies of one key combine on the
    map side.
    """
    valid = judged.where(F.col("reason").isNull()).drop("reason")
    order = source_order(valid)
    rest = [c for c in valid.columns if c not in (*keys, order)]
    return (
        valid.groupBy(*keys)
        .agg(F.min(F.struct(order, *rest)).alias("_first"))
        .select(*keys, "_first.*")
        .select(*valid.columns)
    )


def dropped(judged: DataFrame, keys: list[str]) -> DataFrame:
    """Rows removed per reason; ``duplicate`` counts valid rows after the first of their key."""
    reasons = judged.where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    copies = (
        judged.where(F.col("reason").isNull())
        .groupBy(*keys)
        .agg((F.count(F.lit(1)) - 1).alias("_copies"))
        .agg(F.lit("duplicate").alias("reason"), F.coalesce(F.sum("_copies"), F.lit(0)).alias("n"))
    )
    return reasons.unionByName(copies)


# ---------------------------------------------------------------- telemetry


def telemetry_columns(p: FleetParams) -> dict[str, tuple[str, Column]]:
    """Typed name to (source column, parsed value)."""
    return {
        "timestamp": ("datetime", parse_timestamp("datetime")),
        "machine_id": ("machineID", parse_id("machineID")),
        **{s: (s, parse_double(s)) for s in p.sensors},
    }


def standardise(landing: DataFrame, p: FleetParams) -> DataFrame:
    """Typed and renamed telemetry; rows without a key are dropped."""
    columns = telemetry_columns(p)
    missing = [src for src, _ in columns.values() if src not in landing.columns]
    if missing:
        raise ValueError(f"landing telemetry lacks columns: {missing}")
    typed = landing.select(*[c.alias(n) for n, (_, c) in columns.items()], *_lineage(landing))
    return typed.where(F.col("timestamp").isNotNull() & F.col("machine_id").isNotNull())


def typing_counts(landing: DataFrame, p: FleetParams) -> DataFrame:
    """Empty and unparseable cells per column, and rows in, out and dropped: (counter, column, n)."""
    columns = telemetry_columns(p)
    keyless = columns["timestamp"][1].isNull() | columns["machine_id"][1].isNull()
    counters = {("rows_in", None): F.count(F.lit(1)), ("rows_dropped_no_key", None): n_if(keyless)}
    counters[("rows_out", None)] = n_if(~keyless)
    for n, (src, value) in columns.items():
        counters[("empty", n)] = n_if(is_blank(src))
        counters[("unparseable", n)] = n_if(value.isNull() & ~is_blank(src))
    one = landing.agg(*[c.alias(f"_{i}") for i, c in enumerate(counters.values())])
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(k).alias("counter"), F.lit(col).cast("string").alias("column_name"), F.col(f"_{i}").alias("n")
                    )
                    for i, (k, col) in enumerate(counters)
                ]
            )
        )
    )


# ---------------------------------------------------------------- master tables


def judge_machines(landing: DataFrame, models: tuple[str, ...] = MODELS) -> DataFrame:
    typed = landing.select(
        parse_integer("machineID").alias("machine_id"),
        trimmed("model").alias("model"),
        parse_integer("age").alias("age"),
        *_lineage(landing),
    )
    checks = {
        "bad_machine_id": F.col("machine_id").isNull() | (F.col("machine_id") <= 0),
        "unknown_value": ~F.col("model").isin(*models),
        "bad_age": F.col("age").isNull() | (F.col("age") < 0),
    }
    return typed.withColumn("reason", first_failed(checks))


def build_machines(landing: DataFrame, location: DataFrame, models: tuple[str, ...] = MODELS) -> DataFrame:
    """One row per machine with its plant and line; ``no_location`` flags machines without one."""
    place = location.select(
        parse_integer("machineID").alias("machine_id"), *[trimmed(c).alias(c) for c in PLACE], F.col(source_order(location)).alias("_order")
    )
    place = (
        place.groupBy("machine_id")
        .agg(F.min(F.struct("_order", *PLACE)).alias("_p"))
        .select("machine_id", *[F.col(f"_p.{c}").alias(c) for c in PLACE])
    )
    rows = kept(judge_machines(landing, models), ["machine_id"]).join(place, "machine_id", "left")
    return rows.select("machine_id", "model", "age", *PLACE, F.col("line_id").isNull().alias("no_location"), *_lineage(landing))


def judge_events(
    landing: DataFrame, machines: DataFrame, source: str, name: str, allowed: tuple[str, ...]
) -> DataFrame:
    """Typed events with the reason each bad row is dropped for."""
    typed = landing.select(
        parse_timestamp("datetime").alias("timestamp"),
        parse_integer("machineID").alias("machine_id"),
        trimmed(source).alias(name),
        *_lineage(landing),
    )
    known = machines.select("machine_id").distinct().withColumn("_known", F.lit(True))
    checks = {
        "bad_timestamp": F.col("timestamp").isNull(),
        "unknown_machine": F.col("_known").isNull(),
        "unknown_value": ~F.col(name).isin(*allowed),
    }
    return typed.join(known, "machine_id", "left").withColumn("reason", first_failed(checks)).drop("_known")


def build_events(
    landing: DataFrame, machines: DataFrame, source: str, name: str, allowed: tuple[str, ...]
) -> DataFrame:
    keys = ["timestamp", "machine_id", name]
    return kept(judge_events(landing, machines, source, name, allowed), keys).select(
        "timestamp", "machine_id", name, *_lineage(landing)
    )


def judge_costs(landing: DataFrame) -> DataFrame:
    typed = landing.select(
        trimmed("component").alias("component"),
        *[parse_double(c).alias(c) for c in COST_COLUMNS],
        trimmed("currency").alias("currency"),
        *_lineage(landing),
    )
    bad = F.lit(False)
    for c in COST_COLUMNS:
        bad = bad | F.col(c).isNull() | (F.col(c) < 0)
    checks = {"bad_value": bad, "unknown_value": F.col("component") == ""}
    return typed.withColumn("reason", first_failed(checks))


def build_component_costs(landing: DataFrame) -> DataFrame:
    return kept(judge_costs(landing), ["component"])


def build_tables(landing: dict[str, DataFrame], p: FleetParams) -> dict[str, DataFrame]:
    """Machines first (their ids decide which events are known), then events, then costs."""
    machines = build_machines(landing["machines"], landing["machine_location"])
    components = tuple(p.components)
    return {
        "machines": machines,
        "errors": build_events(landing["errors"], machines, "errorID", "error_id", p.error_types),
        "maintenance": build_events(landing["maintenance"], machines, "comp", "component", components),
        "failures": build_events(landing["failures"], machines, "failure", "component", components),
        "component_costs": build_component_costs(landing["component_costs"]),
    }


def assign_evenly(machines: DataFrame, lines: list[dict[str, str]], seed: int = 42) -> DataFrame:
    """Split machines over production lines in seeded hash order; sizes differ by at most one."""
    spark = machines.sparkSession
    keyed = machines.select("machine_id").withColumn("_h", F.xxhash64(F.lit(seed), "machine_id").cast("double"))
    placed = running_totals(
        keyed.withColumn("_n", F.lit(1).cast("bigint")), [("_h", False), ("machine_id", False)], ["_n"]
    )
    k = len(lines)
    table = spark.createDataFrame([(i, *[ln[c] for c in PLACE]) for i, ln in enumerate(lines)], "_k int, " + ", ".join(f"{c} string" for c in PLACE))
    return (
        placed.withColumn("_k", F.pmod("_n_before", F.lit(k)).cast("int"))
        .join(F.broadcast(table), "_k")
        .select("machine_id", *PLACE)
    )


def blank_cells(landing: DataFrame, columns: list[str]) -> DataFrame:
    return landing.agg(*[n_if(blank_to_null(c).isNull()).alias(c) for c in columns])
