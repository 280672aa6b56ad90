"""Analytical views over the star schema. All ratios come from summed hours and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.functions.ordered import global_rank
from fleetspark.functions.times import hours_crossed
from fleetspark.functions.typing import n_if, ratio
from fleetspark.plans.kpis import in_period, ratios

COUNTS = ("failures", "components_failed", "planned_maintenances")
AMOUNTS = ("unplanned_downtime_h", "planned_downtime_h", "downtime_h", "failure_cost", "maintenance_cost", "total_cost")


def _sums(*names: str) -> list:
    return [F.sum(c).cast("bigint" if c in COUNTS else "double").alias(c) for c in names]


def fleet_monthly(fact_month: DataFrame) -> DataFrame:
    summed = fact_month.groupBy("year_month").agg(
        F.count(F.lit(1)).alias("machines"), *_sums(*COUNTS, *AMOUNTS, "period_hours")
    )
    return summed.withColumns(ratios()).drop("period_hours")


def machine_health(
    dim_machine: DataFrame,
    fact_month: DataFrame,
    fact_error: DataFrame,
    fact_failure: DataFrame,
    fact_reading: DataFrame,
    period: DataFrame,
) -> DataFrame:
    """One card per machine: reliability, cost, recent errors, data quality and cost rank."""
    kpi = fact_month.groupBy("machine_id").agg(
        *_sums(*COUNTS, "unplanned_downtime_h", "downtime_h", "failure_cost", "maintenance_cost", "total_cost", "period_hours")
    )
    recent = F.col("timestamp") >= F.col("period_end") - F.expr("INTERVAL 30 DAY")
    dated = fact_error.crossJoin(F.broadcast(period))
    inside = (F.col("timestamp") >= F.col("period_start")) & (F.col("timestamp") < F.col("period_end"))
    errors = (
        dated.where(inside)
        .groupBy("machine_id")
        .agg(F.count(F.lit(1)).alias("errors"), n_if(recent).alias("errors_last_30d"))
    )
    last = in_period(fact_failure, period).groupBy("machine_id").agg(F.max("timestamp").alias("last_failure_at"))
    quality = fact_reading.groupBy("machine_id").agg(
        F.avg((F.col("quality") == "filled").cast("int")).alias("filled_share"),
        F.avg((F.col("quality") == "missing").cast("int")).alias("missing_share"),
    )
    joined = (
        dim_machine.crossJoin(F.broadcast(period))
        .join(kpi, "machine_id", "left")
        .join(errors, "machine_id", "left")
        .join(last, "machine_id", "left")
        .join(quality, "machine_id", "left")
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    r = ratios()
    cards = joined.select(
        "machine_id",
        "model",
        "age",
        "plant_id",
        "line_id",
        *[zero(c) for c in COUNTS],
        zero("downtime_h"),
        *[r[c].alias(c) for c in ("availability", "mtbf_h", "mttr_h")],
        *[zero(c) for c in ("failure_cost", "maintenance_cost", "total_cost", "errors", "errors_last_30d")],
        "last_failure_at",
        (hours_crossed("last_failure_at", "period_end") / 24.0).alias("days_since_last_failure"),
        "filled_share",
        "missing_share",
    )
    return global_rank(cards, [("total_cost", True)], "cost_rank")


def component_reliability(
    dim_component: DataFrame, fact_failure: DataFrame, fact_maintenance: DataFrame, period: DataFrame
) -> DataFrame:
    """Failures, downtime, cost and planned replacements per component.

    The mean gap between failures telescopes: the gaps of one machine and component add up to
    last minus first, so one grouped minimum and maximum replaces a ``lag`` window.
    """
    failures = in_period(fact_failure, period)
    per_machine = failures.groupBy("component", "machine_id").agg(
        F.count(F.lit(1)).alias("n"),
        n_if(F.col("components_in_event") > 1).alias("multi"),
        F.sum("downtime_hours").alias("hours"),
        F.sum("failure_cost").alias("cost"),
        hours_crossed(F.min("timestamp"), F.max("timestamp")).alias("span_h"),
    )
    totals = per_machine.groupBy("component").agg(
        F.sum("n").alias("failures"),
        F.count(F.lit(1)).alias("machines_affected"),
        F.sum("multi").alias("in_multi_component_events"),
        F.sum("hours").alias("component_downtime_h"),
        F.sum("cost").alias("failure_cost"),
        (ratio(F.sum("span_h"), F.sum(F.col("n") - 1)) / 24.0).alias("mean_days_between_failures"),
    )
    planned = (
        in_period(fact_maintenance.where(F.col("maintenance_type") == "planned"), period)
        .groupBy("component")
        .agg(F.count(F.lit(1)).alias("planned_replacements"), F.sum("maintenance_cost").alias("planned_cost"))
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return (
        dim_component.join(totals, "component", "left")
        .join(planned, "component", "left")
        .select(
            "component",
            zero("failures").alias("failures"),
            zero("machines_affected").alias("machines_affected"),
            zero("in_multi_component_events").alias("in_multi_component_events"),
            zero("component_downtime_h").alias("component_downtime_h"),
            zero("failure_cost").alias("failure_cost"),
            "mean_days_between_failures",
            zero("planned_replacements").alias("planned_replacements"),
            zero("planned_cost").alias("planned_cost"),
            ratio(zero("failures"), zero("failures") + zero("planned_replacements")).alias("unplanned_share"),
            "unplanned_failure_cost",
            "planned_maintenance_cost",
            (zero("failures") * F.col("saving_if_prevented")).alias("saving_if_all_prevented"),
        )
    )


def line_performance(fact_month: DataFrame, dim_machine: DataFrame) -> DataFrame:
    """One row per production line; rank 1 has the best availability."""
    per_machine = fact_month.groupBy("machine_id").agg(*_sums(*COUNTS, *AMOUNTS, "period_hours"))
    lines = (
        per_machine.join(dim_machine.select("machine_id", "plant_id", "plant_name", "line_id"), "machine_id")
        .groupBy("plant_id", "line_id")
        .agg(
            F.min("plant_name").alias("plant_name"),
            F.count(F.lit(1)).alias("machines"),
            *_sums(*COUNTS, *AMOUNTS, "period_hours"),
        )
        .withColumns(ratios())
        .withColumn("cost_per_machine", ratio("total_cost", "machines"))
        .withColumn("failures_per_machine", ratio("failures", "machines"))
        .drop("period_hours")
    )
    return global_rank(lines, [("availability", True)], "availability_rank")


def machine_risk_now(fact_prediction: DataFrame, dim_machine: DataFrame, health: DataFrame) -> DataFrame:
    """Each machine's prediction at the last scoring time of the whole table, riskiest first."""
    latest = fact_prediction.agg(F.max("timestamp").alias("_latest"))
    now = fact_prediction.crossJoin(F.broadcast(latest)).where(F.col("timestamp") == F.col("_latest"))
    rows = (
        now.join(dim_machine, "machine_id")
        .join(health.select("machine_id", "last_failure_at", "errors_last_30d"), "machine_id", "left")
        .select(
            "machine_id",
            "model",
            "age",
            "plant_id",
            "line_id",
            F.col("timestamp").alias("scored_at"),
            "failure_risk",
            "alert",
            "predicted_component",
            "anomaly_score",
            "anomaly_flag",
            "reason_1",
            "reason_2",
            "reason_3",
            "last_failure_at",
            "errors_last_30d",
        )
    )
    return global_rank(rows, [("failure_risk", True), ("anomaly_score", True)], "risk_rank")
