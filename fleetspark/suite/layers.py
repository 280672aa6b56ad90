"""Queries of the cleaning, feature, label, KPI and star layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.operators import cleaning
from fleetspark.plans import features, kpis, labels
from fleetspark.params import ADDITIVE
from fleetspark.suite.blocks import COMPS, ERRORS, SENSORS, U, W, P, each, rounded
from fleetspark.suite.registry import block, query, r6
from fleetspark.suite.worlds import event_world, supply_world


def round6(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in columns})


QUALITY = [f"{s}_quality" for s in SENSORS]
KEYS = ["machine_id", "timestamp"]


@query("d1_deduplicate", f"SELECT machine_id, timestamp, _source_line, {each('{x}')} FROM deduped")
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return cleaning.deduplicate(w.readings, w.p)


@query(
    "d1_duplicate_counts",
    f"""SELECT (SELECT count(*) FROM readings) - (SELECT count(*) FROM deduped) AS duplicates_removed,
       (SELECT count(*) FROM readings AS r JOIN deduped AS d USING (machine_id, timestamp)
        WHERE r._source_line <> d._source_line AND ({each('r.{x} IS DISTINCT FROM d.{x}', sep=' OR ')}))
       AS conflicting_duplicates""",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return cleaning.duplicate_counts(w.readings, w.p)


@query("d2_out_of_range", f"SELECT machine_id, timestamp, _source_line, {each('{x}')} FROM ranged")
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return cleaning.null_out_of_range(cleaning.deduplicate(w.readings, w.p), w.p)


@query(
    "d3_stuck_runs",
    f"""SELECT machine_id, timestamp, {each('{x}')}, {each('stuck_{x} AS {x}_stuck')} FROM stuck_marks""",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    first = cleaning.null_out_of_range(cleaning.deduplicate(w.readings, w.p), w.p)
    return cleaning.mark_stuck(first, w.p).select(*KEYS, *SENSORS, *[f"{s}_stuck" for s in SENSORS])


@query("d4_regular_grid", f"SELECT machine_id, timestamp, _source_line, {each('{x}')} FROM gridded")
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    first = cleaning.null_out_of_range(cleaning.deduplicate(w.readings, w.p), w.p)
    return cleaning.regular_grid(cleaning.null_stuck_runs(first, w.p), w.p)


@query("d5_fill_short_gaps", rounded(SENSORS, "silver", [*KEYS, "_source_line", *QUALITY]))
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    first = cleaning.null_out_of_range(cleaning.deduplicate(w.readings, w.p), w.p)
    grid = cleaning.regular_grid(cleaning.null_stuck_runs(first, w.p), w.p)
    return round6(cleaning.fill_short_gaps(grid, w.p), SENSORS)


@query("d6_quality_flags", f"SELECT {', '.join(KEYS + QUALITY)} FROM silver")
def _(spark, sf_dir):
    return event_world(spark, sf_dir).silver.select(*KEYS, *QUALITY)


@query("d7_clean", rounded(SENSORS, "silver", [*KEYS, "_source_line", *QUALITY]))
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return round6(cleaning.clean(w.readings, w.p), SENSORS)


def _metric(rule: str, n: str, sensor: str | None = None) -> str:
    return f"SELECT '{rule}' AS rule, {repr(sensor) if sensor else 'CAST(NULL AS VARCHAR)'} AS sensor, CAST(({n}) AS BIGINT) AS n"


_runs = lambda s: f"SELECT count(DISTINCT (machine_id, run_{s})) FROM stuck_marks WHERE stuck_{s}"
_metrics = [
    _metric("rows_in", "SELECT count(*) FROM readings"),
    _metric("duplicates_removed", "(SELECT count(*) FROM readings) - (SELECT count(*) FROM deduped)"),
    _metric(
        "conflicting_duplicates",
        "SELECT count(*) FROM readings AS r JOIN deduped AS d USING (machine_id, timestamp) "
        f"WHERE r._source_line <> d._source_line AND ({each('r.{x} IS DISTINCT FROM d.{x}', sep=' OR ')})",
    ),
    _metric("rows_off_step_dropped", "0"),
    _metric("rows_out", "SELECT count(*) FROM silver"),
    _metric("grid_rows_added", "(SELECT count(*) FROM silver) - (SELECT count(*) FROM unstuck)"),
]
for _s in SENSORS:
    _metrics += [
        _metric("out_of_range_nulled", f"(SELECT count({_s}) FROM deduped) - (SELECT count({_s}) FROM ranged)", _s),
        _metric("stuck_runs", _runs(_s), _s),
        _metric("stuck_values_nulled", f"SELECT count(*) FROM stuck_marks WHERE stuck_{_s}", _s),
        _metric("filled", f"SELECT count(*) FROM silver WHERE {_s}_quality = 'filled'", _s),
        _metric("missing_after", f"SELECT count(*) FROM silver WHERE {_s} IS NULL", _s),
    ]


@query("d7_cleaning_metrics", " UNION ALL ".join(_metrics))
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return cleaning.cleaning_metrics(w.readings, w.p)


def _linear_sql(shown=r6) -> str:
    left = each(
        "last_value(CASE WHEN {x} IS NOT NULL THEN timestamp END IGNORE NULLS) OVER b AS lt_{x}, "
        "last_value({x} IGNORE NULLS) OVER b AS lv_{x}, "
        "first_value(CASE WHEN {x} IS NOT NULL THEN timestamp END IGNORE NULLS) OVER a AS rt_{x}, "
        "first_value({x} IGNORE NULLS) OVER a AS rv_{x}"
    )
    share = "(epoch_us(timestamp) - epoch_us(lt_{x})) / CAST(epoch_us(rt_{x}) - epoch_us(lt_{x}) AS DOUBLE)"
    out = each(
        shown("coalesce({x}, CASE WHEN rt_{x} > lt_{x} THEN lv_{x} + (rv_{x} - lv_{x}) * " + share + " END)")
        + " AS {x}_linear"
    )
    return (
        f"SELECT machine_id, timestamp, {out} FROM (SELECT *, {left} FROM gridded WINDOW "
        "b AS (PARTITION BY machine_id ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        "a AS (PARTITION BY machine_id ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"
    )


block("straight", _linear_sql(str))


def straight_lines(w):
    """The gridded readings, not yet filled, with straight lines over their gaps."""
    first = cleaning.null_out_of_range(cleaning.deduplicate(w.readings, w.p), w.p)
    grid = cleaning.regular_grid(cleaning.null_stuck_runs(first, w.p), w.p)
    return cleaning.interpolate_linear(grid, w.p).select(*KEYS, *[f"{s}_linear" for s in SENSORS])


@query("d8_linear_interpolation", _linear_sql())
def _(spark, sf_dir):
    return round6(straight_lines(event_world(spark, sf_dir)), [f"{s}_linear" for s in SENSORS])


FEATURES = features.sensor_feature_names(P)


@query("k1_sensor_features", rounded(FEATURES, "sensor_features_e", KEYS))
def _(spark, sf_dir):
    return round6(event_world(spark, sf_dir).sensor_features, FEATURES)


HOURS = [f"hours_since_{c}_replaced" for c in COMPS]
COUNTS = [*[f"{e}_count_{W}{U}" for e in ERRORS], f"errors_total_{W}{U}"]
ATTRS = ["model", "age", "plant_id", "line_id"]


@query("k2_event_features", rounded(HOURS, "event_features_e", [*KEYS, *COUNTS, *ATTRS]))
def _(spark, sf_dir):
    return round6(event_world(spark, sf_dir).event_features, HOURS)


LABELS = [P.target, *[P.component_target(c) for c in COMPS], "failed_component", "next_failure_at"]


@query("k3_labels", rounded(["hours_to_failure"], "labels_e", [*KEYS, *LABELS]))
def _(spark, sf_dir):
    return round6(event_world(spark, sf_dir).labels, ["hours_to_failure"])


@query(
    "k4_ml_dataset",
    rounded([*FEATURES, *HOURS, "hours_to_failure"], "dataset_e", [*KEYS, *COUNTS, *ATTRS, *LABELS, "split"]),
)
def _(spark, sf_dir):
    return round6(event_world(spark, sf_dir).ml_dataset, [*FEATURES, *HOURS, "hours_to_failure"])


@query(
    "m1_time_split",
    f"SELECT part, count(*) AS row_count, CAST(sum({P.target}) AS BIGINT) AS positives, "
    f"{r6(f'avg(CAST({P.target} AS DOUBLE))')} AS positive_rate, min(timestamp) AS first_at, max(timestamp) AS last_at "
    "FROM parts_e GROUP BY part",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return round6(labels.parts_summary(w.parts, w.p), ["positive_rate"])


# ---------------------------------------------------------------- KPIs


@query(
    "k5_failure_events",
    "SELECT machine_id, timestamp, components, downtime_h, cost FROM failure_ev_l",
)
def _(spark, sf_dir):
    w = supply_world(spark, sf_dir)
    return kpis.failure_events(w.failures, w.costs, w.period)


@query(
    "k5_planned_events",
    "SELECT machine_id, timestamp, components, downtime_h, cost FROM planned_ev_l",
)
def _(spark, sf_dir):
    w = supply_world(spark, sf_dir)
    return kpis.planned_events(w.failures, w.maintenance, w.costs, w.period)


@query(
    "k5_classification_counts",
    """SELECT (SELECT count(*) FROM failure_ev_l) AS failure_events,
       (SELECT CAST(sum(components) AS BIGINT) FROM failure_ev_l) AS component_failures,
       (SELECT count(*) FROM planned_ev_l) AS planned_events,
       (SELECT count(*) FROM maintenance_l AS m JOIN failures_l AS f USING (machine_id, timestamp, component), period_l
        WHERE m.timestamp >= period_start AND m.timestamp < period_end) AS repair_records_excluded,
       (SELECT count(*) FROM (SELECT timestamp FROM failures_l UNION ALL SELECT timestamp FROM maintenance_l), period_l
        WHERE NOT (timestamp >= period_start AND timestamp < period_end)) AS outside_period_excluded""",
)
def _(spark, sf_dir):
    w = supply_world(spark, sf_dir)
    return kpis.classification_counts(w.failures, w.maintenance, w.costs, w.period)


RATIOS = ["availability", "mtbf_h", "mttr_h"]


@query(
    "k6_machine_month",
    rounded(RATIOS, "monthly_l", ["machine_id", "model", "plant_id", "line_id", "month", *ADDITIVE]),
)
def _(spark, sf_dir):
    return round6(supply_world(spark, sf_dir).kpi_tables["kpi_machine_monthly"], RATIOS)


def roll_up_sql(keys: list[str], source: str) -> str:
    k = ", ".join(keys)
    present = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    sums = ", ".join(
        f"CAST(sum({c}) AS BIGINT) AS {c}"
        if c in ("failures", "components_failed", "planned_maintenances")
        else f"sum({c}) AS {c}"
        for c in ADDITIVE
    )
    ratio = (
        f"{r6('1 - downtime_h / nullif(period_hours, 0)')} AS availability, "
        f"{r6('(period_hours - downtime_h) / nullif(failures, 0)')} AS mtbf_h, "
        f"{r6('unplanned_downtime_h / nullif(failures, 0)')} AS mttr_h"
    )
    return f"SELECT *, {ratio} FROM (SELECT {k}, {sums} FROM {source} WHERE {present} GROUP BY {k})"


def _roll_up(name: str):
    return lambda spark, sf_dir: round6(supply_world(spark, sf_dir).kpi_tables[name], RATIOS)


for _name, _keys in kpis.KPI_KEYS.items():
    query(f"k7_{_name}", roll_up_sql(_keys, "monthly_l"))(_roll_up(_name))


# ---------------------------------------------------------------- star schema


def _table(world, name):
    return lambda spark, sf_dir: getattr(world(spark, sf_dir), name)


query("k8_dim_machine", "SELECT * FROM dim_machine_e")(_table(event_world, "dim_machine"))
query(
    "k9_dim_component", "SELECT * FROM costs WHERE component IN (SELECT component FROM maintenance_l)"
)(lambda spark, sf_dir: supply_world(spark, sf_dir).used_components)
query("k12_dim_date", "SELECT * FROM dim_date_l")(_table(supply_world, "dim_date"))
query("k12_dim_date_events", "SELECT * FROM dim_date_e")(_table(event_world, "dim_date"))
query("k14_fact_failure", "SELECT * FROM fact_failure_l")(_table(supply_world, "fact_failure"))
query("k15_fact_maintenance", "SELECT * FROM fact_maintenance_l")(_table(supply_world, "fact_maintenance"))
query("k16_fact_error", "SELECT * FROM fact_error_e")(_table(event_world, "fact_error"))


@query("k13_fact_sensor_reading", rounded(["value"], "fact_reading_e", [*KEYS, "date_key", "sensor", "quality"]))
def _(spark, sf_dir):
    return round6(event_world(spark, sf_dir).fact_sensor_reading, ["value"])


@query(
    "k17_fact_machine_month",
    rounded(RATIOS, "fact_month_l", ["machine_id", "month_date_key", "year_month", *ADDITIVE]),
)
def _(spark, sf_dir):
    return round6(supply_world(spark, sf_dir).fact_machine_month, RATIOS)


PREDICTED = [*[f"{c}_risk" for c in COMPS], "anomaly_score", "failure_risk"]
PRED_REST = ["alert", "predicted_component", "anomaly_flag", "reason_1", "reason_2", "reason_3", "out_of_sample",
             "failure_model_version", "component_model_version", "anomaly_model_version"]


@query("k18_fact_prediction", rounded(PREDICTED, "fact_prediction_e", [*KEYS, "date_key", *PRED_REST]))
def _(spark, sf_dir):
    return round6(event_world(spark, sf_dir).fact_prediction, PREDICTED)
