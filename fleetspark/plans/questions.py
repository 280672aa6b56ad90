"""Business questions over the star schema and its views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.functions.ordered import global_rank
from fleetspark.functions.times import from_micros, micros, ntz, trunc
from fleetspark.functions.typing import n_if, ratio
from fleetspark.operators.timejoin import count_between, exists_between
from fleetspark.params import DAY_US, HOUR_US, FleetParams
from fleetspark.plans.kpis import ratios
from fleetspark.plans.views import AMOUNTS, COUNTS, _sums

LAKH = 1e5
# Age bands, upper bound exclusive, in report order.
AGE_BANDS = ((5, "0-4 years"), (10, "5-9 years"), (15, "10-14 years"))
OLDEST_BAND = "15+ years"


# ---------------------------------------------------------------- documented questions


def fleet_month_by_month(monthly_view: DataFrame) -> DataFrame:
    return monthly_view.select(
        "year_month",
        "failures",
        "downtime_h",
        F.round(F.col("availability") * 100, 2).alias("availability_pct"),
        F.round("mtbf_h").alias("mtbf_h"),
        F.round(F.col("total_cost") / LAKH, 1).alias("total_cost_lakh_inr"),
    ).orderBy("year_month")


def costliest_machines(health: DataFrame, n: int = 10) -> DataFrame:
    return (
        health.select(
            "cost_rank",
            "machine_id",
            "model",
            "age",
            "line_id",
            "failures",
            F.round(F.col("availability") * 100, 2).alias("availability_pct"),
            F.round(F.col("total_cost") / LAKH, 1).alias("total_cost_lakh_inr"),
        )
        .orderBy("cost_rank", "machine_id")
        .limit(n)
    )


def components_by_cost(components: DataFrame) -> DataFrame:
    lakh = lambda c: F.round(F.col(c) / LAKH, 1)
    return components.orderBy(F.desc("failure_cost")).select(
        "component",
        "failures",
        "machines_affected",
        F.round(F.col("unplanned_share") * 100, 1).alias("unplanned_pct"),
        F.round("mean_days_between_failures", 1).alias("mean_days_between_failures"),
        lakh("failure_cost").alias("failure_cost_lakh_inr"),
        lakh("saving_if_all_prevented").alias("saving_if_all_prevented_lakh_inr"),
    )


def lines_best_to_worst(lines: DataFrame) -> DataFrame:
    return lines.orderBy("availability_rank").select(
        "availability_rank",
        "plant_name",
        "line_id",
        "machines",
        "failures",
        F.round(F.col("availability") * 100, 2).alias("availability_pct"),
        F.round("failures_per_machine", 2).alias("failures_per_machine"),
        F.round(F.col("cost_per_machine") / LAKH, 1).alias("cost_per_machine_lakh_inr"),
    )


def reliability_by_model(fact_month: DataFrame, dim_machine: DataFrame) -> DataFrame:
    per_machine = fact_month.groupBy("machine_id").agg(*_sums("failures", "downtime_h", "period_hours"))
    per_model = (
        per_machine.join(dim_machine.select("machine_id", "model"), "machine_id")
        .groupBy("model")
        .agg(F.count(F.lit(1)).alias("machines"), *_sums("failures", "downtime_h", "period_hours"))
    )
    return per_model.select(
        "model",
        "machines",
        "failures",
        F.round(ratio("failures", "machines"), 2).alias("failures_per_machine"),
        F.round((1 - ratio("downtime_h", "period_hours")) * 100, 2).alias("availability_pct"),
    ).orderBy(F.desc("failures_per_machine"))


def age_band(age: str = "age") -> Column:
    out = F.lit(OLDEST_BAND)
    for bound, name in reversed(AGE_BANDS):
        out = F.when(F.col(age) < bound, name).otherwise(out)
    return out


def failures_by_age_band(health: DataFrame) -> DataFrame:
    return (
        health.groupBy(age_band().alias("age_band"))
        .agg(
            F.count(F.lit(1)).alias("machines"),
            F.round(F.avg("failures"), 2).alias("avg_failures_per_machine"),
            F.round(F.avg("total_cost") / LAKH, 1).alias("avg_cost_lakh_inr"),
            F.min("age").alias("_youngest"),
        )
        .orderBy("_youngest")
        .drop("_youngest")
    )


def sensors_before_failure(silver: DataFrame, failures: DataFrame, p: FleetParams, hours: int = 24) -> DataFrame:
    """Mean good reading in the hours before a failure against all other good readings.

    The flag is computed once per machine and step, before the sensors are stacked.
    """
    flagged = exists_between(silver, failures.select(*p.keys), p, hours * HOUR_US, "before")
    good = flagged.select(
        "before",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(s).alias("sensor"), F.col(s).alias("value"), F.col(f"{s}_quality").alias("quality"))
                    for s in p.sensors
                ]
            )
        ),
    ).where(F.col("quality") == "ok")
    means = good.groupBy("sensor").agg(
        F.avg(F.when(~F.col("before"), F.col("value"))).alias("normal_avg"),
        F.avg(F.when(F.col("before"), F.col("value"))).alias("before_failure_avg"),
    )
    change = (ratio("before_failure_avg", "normal_avg") - 1) * 100
    return means.withColumn("change_pct", change).orderBy(F.abs(F.col("change_pct")).desc())


def errors_as_warnings(errors: DataFrame, failures: DataFrame, p: FleetParams, hours: int = 48) -> DataFrame:
    flagged = exists_between(errors, failures.select(*p.keys), p.for_events(), hours * HOUR_US, "followed")
    return (
        flagged.groupBy("error_id")
        .agg(
            F.count(F.lit(1)).alias("errors"),
            n_if(F.col("followed")).alias("followed_by_failure"),
            (F.avg(F.col("followed").cast("int")) * 100).alias("followed_by_failure_pct"),
        )
        .orderBy(F.desc("followed_by_failure_pct"))
    )


def failures_by_weekday(fact_failure: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Distinct (machine, time) events per weekday; events are collapsed before the join."""
    events = fact_failure.select("machine_id", "timestamp", "date_key").distinct()
    per_day = events.groupBy("date_key").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_day.join(dim_date.select("date_key", "day_of_week", "day_name"), "date_key")
        .groupBy("day_of_week", "day_name")
        .agg(F.sum("n").alias("failure_events"))
        .orderBy("day_of_week")
    )


def quality_shares(fact_reading: DataFrame) -> DataFrame:
    share = lambda q: (F.avg((F.col("quality") == q).cast("int")) * 100).alias(f"{q}_pct")
    return (
        fact_reading.groupBy("sensor")
        .agg(F.count(F.lit(1)).alias("readings"), share("ok"), share("filled"), share("missing"))
        .orderBy("sensor")
    )


# ---------------------------------------------------------------- fleet


def _of_plant(df: DataFrame, dim_machine: DataFrame, plant_id: str | None) -> DataFrame:
    """Optional parameter filter: all machines of the dimension, or those of one plant."""
    machines = dim_machine if plant_id is None else dim_machine.where(F.col("plant_id") == plant_id)
    return df.join(machines.select("machine_id"), "machine_id", "left_semi")


def fleet_kpis(fact_month: DataFrame, dim_machine: DataFrame, plant_id: str | None = None) -> DataFrame:
    per_machine = (
        _of_plant(fact_month, dim_machine, plant_id)
        .groupBy("machine_id")
        .agg(*_sums(*COUNTS, *AMOUNTS, "period_hours"))
    )
    one = per_machine.agg(F.count(F.lit(1)).alias("machines"), *_sums(*COUNTS, *AMOUNTS, "period_hours"))
    return one.withColumns(ratios()).select(
        "failures",
        "planned_maintenances",
        "downtime_h",
        "availability",
        "mtbf_h",
        "mttr_h",
        "failure_cost",
        "maintenance_cost",
        "total_cost",
        "machines",
    )


def fleet_monthly(fact_month: DataFrame, dim_machine: DataFrame, plant_id: str | None = None) -> DataFrame:
    return (
        _of_plant(fact_month, dim_machine, plant_id)
        .groupBy("year_month")
        .agg(*_sums("failures", "downtime_h", "period_hours", "failure_cost", "maintenance_cost", "total_cost"))
        .select(
            "year_month",
            "failures",
            "downtime_h",
            (1 - ratio("downtime_h", "period_hours")).alias("availability"),
            "failure_cost",
            "maintenance_cost",
            "total_cost",
        )
        .orderBy("year_month")
    )


def plants(dim_machine: DataFrame) -> DataFrame:
    return dim_machine.select("plant_id", "plant_name").distinct().orderBy("plant_id")


def machine_list(dim_machine: DataFrame) -> DataFrame:
    return dim_machine.orderBy("machine_id")


def warehouse_status(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of every table, with the time span of those that have times."""
    out = None
    for name, df in tables.items():
        timed = "timestamp" in df.columns
        lo, hi = (F.min("timestamp"), F.max("timestamp")) if timed else (F.lit(None), F.lit(None))
        one = df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            lo.cast("timestamp_ntz").alias("first_at"),
            hi.cast("timestamp_ntz").alias("last_at"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def costliest_of_plant(health: DataFrame, plant_id: str | None = None, n: int = 10) -> DataFrame:
    rows = health if plant_id is None else health.where(F.col("plant_id") == plant_id)
    return (
        rows.select("machine_id", "model", "line_id", "failures", "total_cost", "failure_cost")
        .orderBy(F.desc("total_cost"), "machine_id")
        .limit(n)
    )


def unplanned_cost_share(kpis_row: DataFrame) -> DataFrame:
    return kpis_row.select(ratio("failure_cost", "total_cost").alias("unplanned_cost_share"))


# ---------------------------------------------------------------- predictions


def prediction_times(fact_prediction: DataFrame) -> DataFrame:
    return fact_prediction.where("out_of_sample").select("timestamp").distinct().orderBy("timestamp")


def latest_alert_time(fact_prediction: DataFrame) -> DataFrame:
    return fact_prediction.where("out_of_sample AND alert").agg(F.max("timestamp").alias("latest_alert"))


def daily_alerts(fact_prediction: DataFrame) -> DataFrame:
    """Distinct machines alerted and flagged per day, via one row per machine and day."""
    per_machine = (
        fact_prediction.where("out_of_sample")
        .groupBy(F.col("timestamp").cast("date").alias("day"), "machine_id")
        .agg(F.max("alert").alias("alerted"), F.max("anomaly_flag").alias("flagged"))
    )
    return (
        per_machine.groupBy("day")
        .agg(n_if(F.col("alerted")).alias("machines_alerted"), n_if(F.col("flagged")).alias("machines_flagged"))
        .orderBy("day")
    )


def failures_between(fact_failure: DataFrame, start, end) -> DataFrame:
    """Failure events with start < time <= end, components joined by ``+``."""
    return (
        fact_failure.where((F.col("timestamp") > ntz(start)) & (F.col("timestamp") <= ntz(end)))
        .groupBy("machine_id", "timestamp")
        .agg(F.concat_ws("+", F.sort_array(F.collect_list("component"))).alias("components"))
    )


RISK_COLUMNS = (
    "failure_risk",
    "alert",
    "predicted_component",
    "comp1_risk",
    "comp2_risk",
    "comp3_risk",
    "comp4_risk",
    "anomaly_score",
    "anomaly_flag",
    "reason_1",
    "reason_2",
    "reason_3",
)


def _scored_as_of(fact_prediction: DataFrame, as_of) -> DataFrame:
    """Rows of the latest scoring time of the whole fleet at or before ``as_of``."""
    known = fact_prediction.where(F.col("out_of_sample") & (F.col("timestamp") <= ntz(as_of)))
    latest = known.agg(F.max("timestamp").alias("_latest"))
    return known.crossJoin(F.broadcast(latest)).where(F.col("timestamp") == F.col("_latest")).drop("_latest")


def risk_as_of(fact_prediction: DataFrame, dim_machine: DataFrame, as_of) -> DataFrame:
    rows = (
        _scored_as_of(fact_prediction, as_of)
        .join(dim_machine.select("machine_id", "model", "age", "plant_id", "line_id"), "machine_id")
        .select(
            "machine_id",
            "model",
            "age",
            "plant_id",
            "line_id",
            F.col("timestamp").alias("scored_at"),
            *RISK_COLUMNS,
        )
    )
    return global_rank(rows, [("failure_risk", True), ("anomaly_score", True)], "risk_rank")


def maintenance_plan(
    fact_prediction: DataFrame, dim_machine: DataFrame, dim_component: DataFrame, as_of
) -> DataFrame:
    """Replace the predicted component on alerted machines, inspect flagged ones, by priority."""
    at = ntz(as_of)
    since = (
        fact_prediction.where(
            F.col("out_of_sample")
            & F.col("alert")
            & (F.col("timestamp") <= at)
            & (F.col("timestamp") > at - F.expr("INTERVAL 24 HOUR"))
        )
        .groupBy("machine_id")
        .agg(F.min("timestamp").alias("alert_since"))
    )
    rows = (
        _scored_as_of(fact_prediction, as_of)
        .where("alert OR anomaly_flag")
        .join(dim_machine.select("machine_id", "model", "age", "plant_id", "line_id"), "machine_id")
        .join(
            dim_component.select(F.col("component").alias("predicted_component"), "saving_if_prevented"),
            "predicted_component",
            "left",
        )
        .join(since, "machine_id", "left")
    )
    action = F.when(F.col("alert"), F.concat(F.lit("replace "), F.col("predicted_component"))).otherwise(
        "inspect sensors"
    )
    rows = rows.select(
        "machine_id",
        "model",
        "age",
        "plant_id",
        "line_id",
        F.col("timestamp").alias("scored_at"),
        *RISK_COLUMNS,
        "alert_since",
        action.alias("action"),
        F.when(F.col("alert"), F.col("saving_if_prevented")).otherwise(0.0).alias("saving_if_acted"),
        (F.col("alert").cast("double") * 2 + F.col("failure_risk")).alias("_urgency"),
    )
    order = [("_urgency", True), ("saving_if_acted", True), ("anomaly_score", True), ("machine_id", False)]
    return global_rank(rows, order, "priority", unique=True).drop("_urgency")


def spare_parts(plan: DataFrame) -> DataFrame:
    return (
        plan.where("alert")
        .groupBy("predicted_component")
        .agg(F.count(F.lit(1)).alias("units"), F.sum("saving_if_acted").alias("saving"))
        .orderBy(F.desc("units"))
    )


def work_per_line(plan: DataFrame) -> DataFrame:
    return (
        plan.groupBy("line_id")
        .agg(n_if(F.col("alert")).alias("replacements"), n_if(~F.col("alert")).alias("inspections"))
        .orderBy(F.desc("replacements"), F.desc("inspections"))
    )


def headline(risk: DataFrame, plan: DataFrame) -> DataFrame:
    """Alerts, flags, saving at stake and the most predicted component, ties included."""
    counts = risk.where("alert").groupBy("predicted_component").agg(F.count(F.lit(1)).alias("n"))
    most = counts.agg(F.max("n").alias("_most"))
    top = (
        counts.crossJoin(F.broadcast(most))
        .where("n = _most")
        .agg(F.concat_ws(", ", F.sort_array(F.collect_list("predicted_component"))).alias("component_most_at_risk"))
    )
    totals = risk.agg(n_if(F.col("alert")).alias("alerts"), n_if(F.col("anomaly_flag")).alias("flags"))
    saving = plan.agg(F.coalesce(F.sum("saving_if_acted"), F.lit(0.0)).alias("saving_at_stake"))
    return totals.crossJoin(F.broadcast(top)).crossJoin(F.broadcast(saving))


def what_happened_next(risk: DataFrame, fact_failure: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """Failures in ``(scored_at, scored_at + hours]`` with the flag whether an alert was up."""
    scored = risk.agg(F.max("scored_at").alias("_at"))
    after = fact_failure.crossJoin(F.broadcast(scored)).where(
        (F.col("timestamp") > F.col("_at"))
        & (F.col("timestamp") <= F.col("_at") + F.expr(f"INTERVAL {hours} HOUR"))
    )
    events = after.groupBy("machine_id", "timestamp").agg(
        F.concat_ws("+", F.sort_array(F.collect_list("component"))).alias("components")
    )
    alerted = risk.where("alert").select("machine_id").withColumn("_hit", F.lit(True))
    return (
        events.join(alerted, "machine_id", "left")
        .withColumn("alerted", F.coalesce(F.col("_hit"), F.lit(False)))
        .drop("_hit")
    )


# ---------------------------------------------------------------- one machine


def _machine_window(df: DataFrame, machine_id: int, start, end) -> DataFrame:
    return df.where((F.col("machine_id") == machine_id) & F.col("timestamp").between(ntz(start), ntz(end)))


def machine_sensors(fact_reading: DataFrame, machine_id: int, start, end, daily: bool | None = None) -> DataFrame:
    """Long series of one machine; daily means when asked, or when the window passes 14 days."""
    rows = _machine_window(fact_reading, machine_id, start, end)
    if daily is None:
        daily = (end - start).total_seconds() * 1_000_000 > 14 * DAY_US
    if not daily:
        return rows.select("timestamp", "sensor", "value", "quality").orderBy("sensor", "timestamp")
    return (
        rows.groupBy(trunc("day", "timestamp").alias("timestamp"), "sensor")
        .agg(F.avg("value").alias("value"))
        .withColumn("quality", F.lit("daily mean"))
        .orderBy("sensor", "timestamp")
    )


def machine_events(
    fact_failure: DataFrame, fact_maintenance: DataFrame, fact_error: DataFrame, machine_id: int, start, end
) -> DataFrame:
    kinds = {
        "failure": (fact_failure, F.col("component")),
        "maintenance": (fact_maintenance, F.concat_ws(": ", "maintenance_type", "component")),
        "error": (fact_error, F.col("error_id")),
    }
    out = None
    for kind, (df, detail) in kinds.items():
        part = _machine_window(df, machine_id, start, end).select(
            "timestamp", F.lit(kind).alias("kind"), detail.alias("detail")
        )
        out = part if out is None else out.unionByName(part)
    return out.orderBy("timestamp", "kind", "detail")


def machine_predictions(fact_prediction: DataFrame, machine_id: int, start, end) -> DataFrame:
    rows = _machine_window(fact_prediction.where("out_of_sample"), machine_id, start, end)
    return rows.select(
        "timestamp",
        "failure_risk",
        "alert",
        "predicted_component",
        "anomaly_score",
        "anomaly_flag",
        "reason_1",
        "reason_2",
        "reason_3",
    ).orderBy("timestamp")


def machine_card(health: DataFrame, machine_id: int | None = None) -> DataFrame:
    """The card of one machine; the costliest one by default."""
    if machine_id is not None:
        return health.where(F.col("machine_id") == machine_id)
    return health.orderBy(F.desc("total_cost"), "machine_id").limit(1)


def busiest_test_machine(dataset: DataFrame, fact_prediction: DataFrame, p: FleetParams) -> DataFrame:
    """Predictions of the machine with most distinct failures in the test part."""
    failures = (
        dataset.where((F.col("split") == "test") & (F.col(p.target) == 1))
        .select("machine_id", "next_failure_at")
        .distinct()
        .groupBy("machine_id")
        .agg(F.count(F.lit(1)).alias("test_failures"))
        .orderBy(F.desc("test_failures"), "machine_id")
        .limit(1)
    )
    return fact_prediction.where("out_of_sample").join(F.broadcast(failures), "machine_id")


# ---------------------------------------------------------------- exploration


def trailing_mean(readings: DataFrame, p: FleetParams, hours: int = 24) -> DataFrame:
    """Mean of each sensor over ``(t - hours, t]`` by time, not by rows."""
    from pyspark.sql import Window

    from fleetspark.operators.chunks import spread, with_us

    span = hours * HOUR_US
    rows = spread(with_us(readings, p.time), "_us", p.chunk_us, span)
    w = Window.partitionBy(p.entity, "_chunk").orderBy("_us").rangeBetween(-span + 1, 0)
    means = {s: F.avg(s).over(w) for s in p.sensors}
    return rows.select(*p.keys, "_own", *[c.alias(s) for s, c in means.items()]).where("_own").drop("_own")


def z_scores(rows: DataFrame, p: FleetParams) -> DataFrame:
    """Standardise each sensor against its own machine."""
    stats = rows.groupBy(p.entity).agg(
        *[F.avg(s).alias(f"_m_{s}") for s in p.sensors], *[F.stddev_samp(s).alias(f"_s_{s}") for s in p.sensors]
    )
    z = {s: F.try_divide(F.col(s) - F.col(f"_m_{s}"), F.col(f"_s_{s}")) for s in p.sensors}
    return rows.join(stats, p.entity).select(*p.keys, *[c.alias(s) for s, c in z.items()])


def pre_failure_profile(readings: DataFrame, failures: DataFrame, p: FleetParams, hours: int = 168) -> DataFrame:
    """Mean z-score per component and hours before its failure.

    Each failure is expanded to its fixed list of earlier steps and meets the readings in an
    equi join on (machine, time).
    """
    z = z_scores(trailing_mean(readings, p), p)
    step_h = p.step_us // HOUR_US
    steps = hours // step_h
    at = micros("timestamp") - F.pmod(micros("timestamp"), F.lit(p.step_us))
    expanded = failures.select(
        "machine_id", "component", at.alias("_at"), F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("_k")
    ).select(
        "machine_id",
        "component",
        (F.col("_k") * step_h).cast("int").alias("hours_before"),
        from_micros(F.col("_at") - F.col("_k") * F.lit(p.step_us)).alias("timestamp"),
    )
    return (
        expanded.join(z, p.keys)
        .groupBy("component", "hours_before")
        .agg(*[F.avg(s).alias(s) for s in p.sensors], F.count(F.lit(1)).alias("row_count"))
    )


def profile_shift(profile: DataFrame, p: FleetParams) -> DataFrame:
    """Last day before a failure minus the same measure a week earlier, per component."""
    late, early = F.col("hours_before") <= 24, F.col("hours_before") >= 144
    n = F.col("row_count")
    mean = lambda s, part: ratio(
        F.sum(F.when(part & F.col(s).isNotNull(), F.col(s) * n)), F.sum(F.when(part & F.col(s).isNotNull(), n))
    )
    return profile.groupBy("component").agg(*[(mean(s, late) - mean(s, early)).alias(f"{s}_shift") for s in p.sensors])


def errors_before_failure(errors: DataFrame, failures: DataFrame, p: FleetParams, hours: int = 24) -> DataFrame:
    """Errors in ``[t - hours, t)`` before failures, by failed component and error code.

    Counted per failure from a RANGE frame: no (failure, error) pair is ever materialised.
    """
    kinds = {e: F.col("error_id") == e for e in p.error_types}
    counted = count_between(failures, errors, p, -hours * HOUR_US - 1, -1, kinds)
    return counted.groupBy("component").agg(*[F.sum(e).alias(e) for e in p.error_types])


def error_rate_before_failure(
    errors: DataFrame, failures: DataFrame, machines: DataFrame, readings: DataFrame, p: FleetParams, hours: int = 24
) -> DataFrame:
    """Mean errors in the window before a failure against the mean of any such window."""
    counted = count_between(failures, errors, p, -hours * HOUR_US - 1, -1)
    before = counted.agg(F.avg("n").alias("before_failure"))
    days = (micros(F.max("timestamp")) - micros(F.min("timestamp"))) / F.lit(float(DAY_US))
    base = (
        errors.agg(F.count(F.lit(1)).alias("_e"))
        .crossJoin(F.broadcast(machines.agg(F.count(F.lit(1)).alias("_m"))))
        .crossJoin(F.broadcast(readings.agg(days.alias("_d"))))
        .select((F.col("_e") / F.col("_m") / F.col("_d") * (hours / 24)).alias("baseline"))
    )
    return before.crossJoin(F.broadcast(base)).withColumn("times_baseline", ratio("before_failure", "baseline"))


def failure_rate_by_model(failures: DataFrame, machines: DataFrame) -> DataFrame:
    per_machine = failures.groupBy("machine_id").agg(F.count(F.lit(1)).alias("_n"))
    return (
        machines.select("machine_id", "model")
        .join(per_machine, "machine_id", "left")
        .groupBy("model")
        .agg(ratio(F.sum(F.coalesce("_n", F.lit(0))), F.count(F.lit(1))).alias("failures_per_machine"))
    )
