"""The business case: base year, scenarios, break-even, sensitivity and where to focus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetspark.functions.ordered import share_of_total
from fleetspark.functions.typing import ratio
from fleetspark.params import FleetParams, Scenario
from fleetspark.plans.kpis import in_period
from fleetspark.plans.questions import AGE_BANDS, OLDEST_BAND, age_band

HOURS_PER_YEAR = 365 * 24
WEEKS_PER_YEAR = 52
# Fixed values of the sensitivity grid.
CATCH_RATES = (0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
ALARM_COSTS = (10_000.0, 20_000.0, 30_000.0, 50_000.0)


def base_year(
    fact_failure: DataFrame, dim_component: DataFrame, fact_month: DataFrame, period: DataFrame
) -> DataFrame:
    """One row: events, saving if all were caught, downtime avoided, machine hours and years."""
    cost = dim_component.select(
        "component", "saving_if_prevented", "unplanned_downtime_hours", "planned_downtime_hours"
    )
    events = (
        in_period(fact_failure.select("machine_id", "timestamp", "component"), period)
        .join(cost, "component")
        .groupBy("machine_id", "timestamp")
        .agg(
            F.sum("saving_if_prevented").alias("saving"),
            (F.max("unplanned_downtime_hours") - F.max("planned_downtime_hours")).alias("avoided"),
        )
    )
    totals = events.agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("saving").alias("saving_if_caught"),
        F.sum("avoided").alias("downtime_avoided_h"),
    )
    per_machine = fact_month.groupBy("machine_id").agg(F.sum("period_hours").alias("h"))
    hours = per_machine.agg(F.sum("h").alias("machine_hours"), F.count(F.lit(1)).alias("machines"))
    return totals.crossJoin(F.broadcast(hours)).withColumn(
        "years", F.col("machine_hours") / F.col("machines") / F.lit(float(HOURS_PER_YEAR))
    )


def component_failures(fact_failure: DataFrame, dim_component: DataFrame, period: DataFrame) -> DataFrame:
    counts = in_period(fact_failure, period).groupBy("component").agg(F.count(F.lit(1)).alias("failures"))
    return counts.join(dim_component.select("component", "planned_downtime_hours"), "component")


def scenario_table(spark, scenarios: dict[str, Scenario]) -> DataFrame:
    rows = [(n, float(s.catch_rate), float(s.false_alarms_per_catch)) for n, s in scenarios.items()]
    return spark.createDataFrame(rows, "name string, catch_rate double, false_alarms_per_catch double")


def as_tested(metrics: DataFrame) -> DataFrame:
    """The scenario a model reached on its test part."""
    return metrics.select(
        F.lit("as tested").alias("name"),
        ratio("events_caught", "failure_events").alias("catch_rate"),
        ratio("false_alarms", F.greatest("events_caught", F.lit(1))).alias("false_alarms_per_catch"),
    )


def scenario_results(
    scenarios: DataFrame,
    year: DataFrame,
    components: DataFrame,
    p: FleetParams,
    alarm_cost: float | None = None,
    program_cost: float | None = None,
) -> DataFrame:
    """Yearly effect of every scenario row; scenarios and the base year are a handful of rows."""
    alarm = F.lit(float(p.false_alarm_cost if alarm_cost is None else alarm_cost))
    program = F.lit(float(p.program_cost if program_cost is None else program_cost))
    work = components.agg(F.sum(F.col("failures") * F.col("planned_downtime_hours")).alias("_replace_h"))
    x = scenarios.crossJoin(F.broadcast(year)).crossJoin(F.broadcast(work))
    rate = F.col("catch_rate") / F.col("years")
    caught = rate * F.col("events")
    false_alarms = caught * F.col("false_alarms_per_catch")
    gross, alarm_total = rate * F.col("saving_if_caught"), false_alarms * alarm
    inspected = caught + false_alarms
    monthly = (gross - alarm_total) / 12
    return x.select(
        "name",
        "catch_rate",
        "false_alarms_per_catch",
        caught.alias("failures_caught"),
        false_alarms.alias("false_alarms"),
        gross.alias("gross_saving"),
        alarm_total.alias("false_alarm_cost"),
        program.alias("program_cost"),
        (gross - alarm_total - program).alias("net_saving"),
        (rate * F.col("downtime_avoided_h")).alias("downtime_avoided_h"),
        (100 * F.col("catch_rate") * F.col("downtime_avoided_h") / F.col("machine_hours")).alias("availability_gain"),
        F.when(monthly > 0, F.try_divide(program, monthly)).alias("payback_months"),
        (inspected / WEEKS_PER_YEAR).alias("inspections_per_week"),
        ((inspected * p.inspection_hours + rate * F.col("_replace_h")) / WEEKS_PER_YEAR).alias(
            "technician_hours_per_week"
        ),
    )


def parts_per_quarter(scenarios: DataFrame, year: DataFrame, components: DataFrame) -> DataFrame:
    x = scenarios.crossJoin(F.broadcast(year.select("years"))).crossJoin(F.broadcast(components))
    return x.select(
        "name", "component", (F.col("catch_rate") * F.col("failures") / F.col("years") / 4).alias("parts_per_quarter")
    )


def break_even(year: DataFrame, per_catch: float, alarm_cost: float, program_cost: float) -> DataFrame:
    """Smallest catch rate that pays for the programme; NULL when none up to 1 does."""
    per_event = F.col("saving_if_caught") / F.col("events") - F.lit(float(per_catch) * float(alarm_cost))
    yearly = per_event * F.col("events") / F.col("years")
    rate = F.try_divide(F.lit(float(program_cost)), yearly)
    return year.select(F.when((yearly > 0) & (rate <= 1), rate).alias("break_even_catch_rate"))


def sensitivity(
    year: DataFrame,
    catch_rates: list[float],
    alarm_costs: list[float],
    per_catch: float,
    program_cost: float,
) -> DataFrame:
    """Net saving for every pair of the two given value lists."""
    values = lambda xs: F.explode(F.array(*[F.lit(float(x)) for x in xs]))
    grid = year.withColumn("catch_rate", values(catch_rates)).withColumn("false_alarm_cost", values(alarm_costs))
    net = F.col("catch_rate") / F.col("years") * (
        F.col("saving_if_caught") - F.col("events") * F.lit(float(per_catch)) * F.col("false_alarm_cost")
    ) - F.lit(float(program_cost))
    return grid.select("catch_rate", "false_alarm_cost", net.alias("net_saving"))


def what_if_curve(
    year: DataFrame, chosen_rate: float, per_catch: float, alarm_cost: float, program_cost: float
) -> DataFrame:
    """Net saving at 0 to 100 % caught, with the chosen point and the break-even marked."""
    curve = sensitivity(year, [i / 100 for i in range(101)], [alarm_cost], per_catch, program_cost)
    even = break_even(year, per_catch, alarm_cost, program_cost)
    return curve.crossJoin(F.broadcast(even)).select(
        "catch_rate",
        "net_saving",
        (F.abs(F.col("catch_rate") - F.lit(float(chosen_rate))) < 0.005).alias("chosen"),
        F.coalesce(F.col("catch_rate") >= F.col("break_even_catch_rate"), F.lit(False)).alias("pays_off"),
    )


# ---------------------------------------------------------------- where to focus


def focus_lines(lines: DataFrame) -> DataFrame:
    shared = share_of_total(lines, {"failure_cost_share": "failure_cost"})
    fleet = lines.agg(ratio(F.sum("failures"), F.sum("machines")).alias("_fleet"))
    return shared.crossJoin(F.broadcast(fleet)).select(
        "plant_name",
        "line_id",
        "machines",
        "failures",
        "failures_per_machine",
        "cost_per_machine",
        "failure_cost",
        "availability",
        "failure_cost_share",
        (F.col("failures_per_machine") > F.col("_fleet")).alias("above_fleet_average"),
    )


def focus_groups(health: DataFrame, by: str) -> DataFrame:
    """Failures and cost per machine by ``model`` or ``age_band``; bands keep their order."""
    key = age_band() if by == "age_band" else F.col(by)
    bands = [b for _, b in AGE_BANDS] + [OLDEST_BAND]
    position = F.array_position(F.array(*[F.lit(b) for b in bands]), F.col(by)) if by == "age_band" else F.col(by)
    return (
        health.groupBy(key.alias(by))
        .agg(
            F.count(F.lit(1)).alias("machines"),
            F.sum("failures").alias("failures"),
            F.sum("total_cost").alias("total_cost"),
        )
        .withColumn("failures_per_machine", ratio("failures", "machines"))
        .withColumn("cost_per_machine", ratio("total_cost", "machines"))
        .orderBy(position)
    )


def focus_machines(health: DataFrame, top: int = 10) -> DataFrame:
    worst = health.orderBy(F.desc("total_cost"), "machine_id").limit(top)
    return worst.select("machine_id", "model", "age", "line_id", "failures", "total_cost", "failure_cost")


def focus_machines_share(health: DataFrame, top: int = 10) -> DataFrame:
    part = focus_machines(health, top).agg(F.sum("failure_cost").alias("_top"))
    return health.agg(F.sum("failure_cost").alias("_all")).crossJoin(F.broadcast(part)).select(
        ratio("_top", "_all").alias("share_of_failure_cost")
    )


def focus_components(components: DataFrame) -> DataFrame:
    shared = share_of_total(
        components, {"failure_cost_share": "failure_cost", "saving_share": "saving_if_all_prevented"}
    )
    return shared.select(
        "component",
        "failures",
        "failure_cost",
        "saving_if_all_prevented",
        ratio("failure_cost", "failures").alias("cost_per_failure"),
        "failure_cost_share",
        "saving_share",
    )


def reason_signal(reason: str | Column) -> Column:
    """The input a reason names: a sensor, an error code, all errors, or a component's age."""
    first = F.split_part(F.col(reason) if isinstance(reason, str) else reason, F.lit(" "), F.lit(1))
    return F.when(first == "errors", "errors (all types)").when(
        first.startswith("comp"), F.concat(first, F.lit(" age"))
    ).otherwise(first)


def warning_signatures(alerts: DataFrame, top: int = 2) -> DataFrame:
    """The inputs most often named per predicted component; each counts once per alert."""
    reasons = ["reason_1", "reason_2", "reason_3"]
    named = F.array_distinct(F.array_compact(F.array(*[F.when(F.col(r) != "", reason_signal(r)) for r in reasons])))
    totals = alerts.groupBy("predicted_component").agg(F.count(F.lit(1)).alias("_alerts"))
    counts = (
        alerts.select("predicted_component", F.explode(named).alias("signal"))
        .groupBy("predicted_component", "signal")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    best = Window.partitionBy("predicted_component").orderBy(F.desc("_n"), "signal")
    return (
        counts.withColumn("_k", F.row_number().over(best))
        .where(F.col("_k") <= top)
        .join(totals, "predicted_component")
        .select(
            F.col("predicted_component").alias("component"), "signal", ratio("_n", "_alerts").alias("share_of_alerts")
        )
    )


def headline_selections(lines: DataFrame, bands: DataFrame, models: DataFrame, components: DataFrame, grid: DataFrame) -> DataFrame:
    """The facts a summary quotes, as one row."""
    young = F.col("age_band").isin("0-4 years", "5-9 years")
    one = lines.agg(F.count(F.when(F.col("above_fleet_average"), 1)).alias("lines_above_average"))
    for part in (
        bands.agg(
            ratio(F.sum(F.when(young, F.col("failures"))), F.sum(F.when(young, F.col("machines")))).alias("young_rate"),
            F.max(F.when(F.col("age_band") == OLDEST_BAND, F.col("failures_per_machine"))).alias("oldest_rate"),
        ),
        models.agg(
            F.min_by("model", F.struct("failures_per_machine", "model")).alias("best_model"),
            F.max_by("model", F.struct("failures_per_machine", "model")).alias("worst_model"),
        ),
        components.agg(F.max_by("component", F.struct("failure_cost", "component")).alias("top_component")),
        grid.agg((F.min("net_saving") > 0).alias("always_positive")),
    ):
        one = one.crossJoin(F.broadcast(part))
    return one


def insights_bundle(tables: dict[str, DataFrame], path: str) -> None:
    """Write every table of the business case below one folder."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/{name}")
