"""Reliability and cost KPIs. Ratios are always recomputed from sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.functions.times import micros, trunc
from fleetspark.functions.typing import n_if, ratio
from fleetspark.params import ADDITIVE, HOUR_US, FleetParams

KPI_KEYS = {
    "kpi_machine_total": ["machine_id", "model", "plant_id", "line_id"],
    "kpi_line_monthly": ["plant_id", "line_id", "month"],
    "kpi_plant_monthly": ["plant_id", "month"],
}


def component_costs(spark, p: FleetParams) -> DataFrame:
    """Cost of an unexpected failure against a planned replacement, per component."""
    schema = "component string, repair_cost double, unplanned_downtime_hours double, planned_downtime_hours double"
    rows = [
        (c, float(v.repair_cost), float(v.unplanned_downtime_hours), float(v.planned_downtime_hours))
        for c, v in p.components.items()
    ]
    return derive_costs(spark.createDataFrame(rows, schema), p)


def derive_costs(base: DataFrame, p: FleetParams) -> DataFrame:
    rate = F.lit(float(p.downtime_cost_per_hour))
    return (
        base.withColumn("unplanned_repair_cost", F.col("repair_cost") * p.emergency_premium)
        .withColumn("downtime_cost_per_hour", rate)
        .withColumn(
            "unplanned_failure_cost", F.col("unplanned_repair_cost") + F.col("unplanned_downtime_hours") * rate
        )
        .withColumn("planned_maintenance_cost", F.col("repair_cost") + F.col("planned_downtime_hours") * rate)
        .withColumn(
            "saving_if_prevented", F.col("unplanned_failure_cost") - F.col("planned_maintenance_cost")
        )
        .withColumn("currency", F.lit(p.currency))
    )


def observed_period(telemetry: DataFrame, time: str = "timestamp") -> DataFrame:
    """One row: first time, and midnight of the last day (exclusive end)."""
    return telemetry.agg(
        F.min(time).alias("period_start"), trunc("day", F.max(time)).alias("period_end")
    )


def in_period(df: DataFrame, period: DataFrame, time: str = "timestamp", flag: str | None = None) -> DataFrame:
    """Half-open period filter [start, end); the period is one broadcast row."""
    joined = df.crossJoin(F.broadcast(period))
    inside = (F.col(time) >= F.col("period_start")) & (F.col(time) < F.col("period_end"))
    if flag:
        return joined.withColumn(flag, inside).drop("period_start", "period_end")
    return joined.where(inside).drop("period_start", "period_end")


def component_events(records: DataFrame, costs: DataFrame, hours: str, cost: str) -> DataFrame:
    """Component records of one machine at one time become one event.

    Repairs run in parallel, so downtime is the maximum; costs add up. An unknown component
    raises when the event is evaluated.
    """
    known = costs.select("component", hours, cost)
    priced = records.join(known, "component", "left").withColumn(
        hours,
        F.when(
            F.col(hours).isNull(),
            F.raise_error(F.concat(F.lit("no cost data for component "), F.coalesce("component", F.lit("NULL")))).cast(
                "double"
            ),
        ).otherwise(F.col(hours)),
    )
    return priced.groupBy("machine_id", "timestamp").agg(
        F.count(F.lit(1)).alias("components"), F.max(hours).alias("downtime_h"), F.sum(cost).alias("cost")
    )


def failure_events(failures: DataFrame, costs: DataFrame, period: DataFrame) -> DataFrame:
    return component_events(
        in_period(failures, period), costs, "unplanned_downtime_hours", "unplanned_failure_cost"
    )


def planned_events(failures: DataFrame, maintenance: DataFrame, costs: DataFrame, period: DataFrame) -> DataFrame:
    """Replacements in the period that are not the repair of a failure in the period."""
    keys = ["machine_id", "timestamp", "component"]
    planned = in_period(maintenance, period).join(in_period(failures, period).select(*keys), keys, "left_anti")
    return component_events(planned, costs, "planned_downtime_hours", "planned_maintenance_cost")


def classification_counts(
    failures: DataFrame, maintenance: DataFrame, costs: DataFrame, period: DataFrame
) -> DataFrame:
    """One row of counters: events, component failures, repairs and records outside the period."""
    keys = ["machine_id", "timestamp", "component"]
    f, m = in_period(failures, period, flag="_in"), in_period(maintenance, period, flag="_in")
    repairs = (
        m.where("_in")
        .join(f.where("_in").select(*keys), keys, "left_semi")
        .agg(F.count(F.lit(1)).alias("repair_records_excluded"))
    )
    outside = f.select("_in").unionByName(m.select("_in")).agg(n_if(~F.col("_in")).alias("outside_period_excluded"))
    fe = failure_events(failures, costs, period).agg(
        F.count(F.lit(1)).alias("failure_events"),
        F.coalesce(F.sum("components"), F.lit(0)).alias("component_failures"),
    )
    pe = planned_events(failures, maintenance, costs, period).agg(F.count(F.lit(1)).alias("planned_events"))
    out = fe
    for one_row in (pe, repairs, outside):
        out = out.crossJoin(F.broadcast(one_row))
    return out


def period_months(period: DataFrame) -> DataFrame:
    """Hours of each calendar month inside [start, end), counted from the start hour."""
    start, end = micros("period_start"), micros("period_end")
    last = F.col("period_end") - F.expr("INTERVAL 1 HOUR")
    hour = F.lit(HOUR_US)
    tick = lambda x: F.call_function("div", x - start + hour - 1, hour)
    month = F.explode(F.sequence(trunc("month", "period_start"), trunc("month", last), F.expr("INTERVAL 1 MONTH")))
    m0 = micros("_m")
    m1 = micros(F.col("_m") + F.expr("INTERVAL 1 MONTH"))
    return (
        period.where(F.col("period_start") < F.col("period_end"))
        .withColumn("_m", month)
        .select(
            F.date_format("_m", "yyyy-MM").alias("month"),
            (tick(F.least(m1, end)) - tick(F.greatest(m0, start))).cast("double").alias("period_hours"),
        )
        .where("period_hours > 0")
    )


def add_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns(ratios())


def ratios(prefix: str = "") -> dict[str, Column]:
    c = lambda n: F.col(f"{prefix}{n}")
    return {
        "availability": 1 - ratio(c("downtime_h"), c("period_hours")),
        "mtbf_h": ratio(c("period_hours") - c("downtime_h"), c("failures")),
        "mttr_h": ratio(c("unplanned_downtime_h"), c("failures")),
    }


def machine_monthly(
    failure_ev: DataFrame, planned_ev: DataFrame, machines: DataFrame, period: DataFrame
) -> DataFrame:
    """One row per machine and month, months without any event included.

    Failure and planned events are summed in one grouped union; the months are a broadcast
    list whose length is the length of the period.
    """
    tagged = failure_ev.withColumn("_f", F.lit(True)).unionByName(planned_ev.withColumn("_f", F.lit(False)))
    f, pl = F.col("_f"), ~F.col("_f")
    monthly = tagged.groupBy("machine_id", F.date_format("timestamp", "yyyy-MM").alias("month")).agg(
        n_if(f).alias("failures"),
        F.sum(F.when(f, F.col("components"))).alias("components_failed"),
        n_if(pl).alias("planned_maintenances"),
        F.sum(F.when(f, F.col("downtime_h"))).alias("unplanned_downtime_h"),
        F.sum(F.when(pl, F.col("downtime_h"))).alias("planned_downtime_h"),
        F.sum(F.when(f, F.col("cost"))).alias("failure_cost"),
        F.sum(F.when(pl, F.col("cost"))).alias("maintenance_cost"),
    )
    grid = machines.select("machine_id", "model", "plant_id", "line_id").crossJoin(
        F.broadcast(period_months(period))
    )
    df = grid.join(monthly, ["machine_id", "month"], "left").fillna(
        0, [c for c in monthly.columns if c not in ("machine_id", "month")]
    )
    df = df.withColumn("downtime_h", F.col("unplanned_downtime_h") + F.col("planned_downtime_h"))
    df = df.withColumn("total_cost", F.col("failure_cost") + F.col("maintenance_cost"))
    keys = ["machine_id", "model", "plant_id", "line_id", "month"]
    return add_ratios(df.select(*keys, *ADDITIVE))


def roll_up(monthly: DataFrame, keys: list[str]) -> DataFrame:
    """Sum the additive columns over the keys and recompute the ratios; NULL keys form no group."""
    return add_ratios(monthly.dropna(subset=keys).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ADDITIVE]))


def kpi_tables(
    failures: DataFrame, maintenance: DataFrame, machines: DataFrame, costs: DataFrame, period: DataFrame
) -> dict[str, DataFrame]:
    monthly = machine_monthly(
        failure_events(failures, costs, period),
        planned_events(failures, maintenance, costs, period),
        machines,
        period,
    )
    return {"kpi_machine_monthly": monthly} | {n: roll_up(monthly, k) for n, k in KPI_KEYS.items()}
