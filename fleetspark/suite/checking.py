"""Queries of the layer checks; the SQL side recomputes every expected and actual value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.functions.staging import stage
from fleetspark.operators import cleaning
from fleetspark.operators.timejoin import by_step
from fleetspark.plans import checks as C
from fleetspark.plans import evaluate as E
from fleetspark.plans import insights as N
from fleetspark.plans import scoring, views
from fleetspark.plans.labels import feature_columns
from fleetspark.suite.blocks import COMPS, SENSORS, P
from fleetspark.suite.judging import _failed, _tested, _year, baseline_rules
from fleetspark.suite.layers import COUNTS, FEATURES, HOURS, round6, straight_lines
from fleetspark.suite.registry import block, query, r6
from fleetspark.suite.warehouse import health
from fleetspark.suite.worlds import event_world, supply_world

E_TABLES = {
    "dim_machine": "dim_machine_e", "dim_component": "costs", "dim_date": "dim_date_e",
    "fact_sensor_reading": "fact_reading_e", "fact_failure": "fact_failure_e", "fact_maintenance": "fact_maintenance_e",
    "fact_error": "fact_error_e", "fact_machine_month": "fact_month_e", "fact_prediction": "fact_prediction_e",
    "dim_sensor": "(SELECT unnest(['volt', 'rotate', 'pressure', 'vibration']) AS sensor)",
    "dim_error_type": "(SELECT unnest(['error1', 'error2', 'error3', 'error4', 'error5']) AS error_id)",
}


def tables(w) -> dict:
    return {n: getattr(w, n) for n in C.KEYS}


def zero(check: str, subject: str, sql: str) -> str:
    return (
        f"SELECT '{check}' AS check_name, '{subject}' AS subject, n = 0 AS passed, 0.0::DOUBLE AS expected, "
        f"CAST(n AS DOUBLE) AS actual FROM (SELECT ({sql}) AS n)"
    )


def equal(check: str, subject: str, expected: str, actual: str) -> str:
    near = "coalesce(abs(e - a) <= 1e-9 * greatest(1.0, abs(e), abs(a)), e IS NULL AND a IS NULL)"
    return (
        f"SELECT '{check}' AS check_name, '{subject}' AS subject, {near} AS passed, {r6('e')} AS expected, {r6('a')} AS actual "
        f"FROM (SELECT CAST(({expected}) AS DOUBLE) AS e, CAST(({actual}) AS DOUBLE) AS a)"
    )


def rounded_checks(df):
    return round6(df, ["expected", "actual"])


@query(
    "l8_unique_keys",
    " UNION ALL ".join(
        zero("unique_keys", t, f"SELECT count(*) - count(DISTINCT ({', '.join(k)}, '')) FROM {E_TABLES[t]}") for t, k in C.KEYS.items()
    ),
)
def _(spark, sf_dir):
    return C.unique_keys(tables(event_world(spark, sf_dir)))


@query(
    "l9_references",
    " UNION ALL ".join(
        zero(
            "references",
            f"{f}.{c} -> {d}",
            f"SELECT count(*) FROM {E_TABLES[f]} AS f WHERE NOT EXISTS (SELECT 1 FROM {E_TABLES[d]} AS d WHERE d.{k} = f.{c})",
        )
        for f, c, d, k in C.REFERENCES
    ),
)
def _(spark, sf_dir):
    return C.references(tables(event_world(spark, sf_dir)))


@query(
    "l10_date_keys",
    " UNION ALL ".join(
        [
            zero("date_keys", t, f"SELECT count(*) FROM {E_TABLES[t]} WHERE date_key <> CAST(strftime(timestamp, '%Y%m%d') AS INTEGER)")
            for t in ("fact_sensor_reading", "fact_failure", "fact_maintenance", "fact_error", "fact_prediction")
        ]
        + [
            zero("date_keys", "fact_machine_month", "SELECT count(*) FROM fact_month_e WHERE month_date_key <> CAST(replace(year_month, '-', '') || '01' AS INTEGER)"),
            zero("calendar", "missing_days", "SELECT date_diff('day', min(date), max(date)) + 1 - count(*) FROM dim_date_e"),
        ]
    ),
)
def _(spark, sf_dir):
    return C.date_keys(tables(event_world(spark, sf_dir)))


_recon = []
for _s in SENSORS:
    for _name, _wide, _long in (
        ("row_count", "count(*)", "count(*)"),
        ("values", f"count({_s})", "count(value)"),
        ("sum", f"sum({_s})", "sum(value)"),
        *[(q, f"count(*) FILTER (WHERE {_s}_quality = '{q}')", f"count(*) FILTER (WHERE quality = '{q}')") for q in ("ok", "filled", "missing")],
    ):
        _recon.append(
            equal("silver_reconciliation", f"{_s}.{_name}", f"SELECT {_wide} FROM silver", f"SELECT {_long} FROM fact_reading_e WHERE sensor = '{_s}'")
        )
for _f, _t in (("fact_failure", "failures_e"), ("fact_maintenance", "maintenance_e"), ("fact_error", "errors_e"), ("dim_machine", "machines_e")):
    _recon.append(equal("silver_reconciliation", _f, f"SELECT count(*) FROM {_t}", f"SELECT count(*) FROM {E_TABLES[_f]}"))


@query("l11_silver_reconciliation", " UNION ALL ".join(_recon))
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    events = {n: getattr(w, n) for n in ("failures", "maintenance", "errors", "machines")}
    return rounded_checks(C.silver_reconciliation(w.silver, events, tables(w), w.p))


_gold = [
    equal("gold_reconciliation", c, f"SELECT {e} FROM monthly_l", f"SELECT {e} FROM fact_month_l")
    for c, e in [("row_count", "count(*)"), *[(c, f"sum({c})") for c in ("failures", "components_failed", "planned_maintenances", "downtime_h", "total_cost")]]
] + [
    equal(
        "gold_reconciliation", "failure_events",
        "SELECT count(DISTINCT (machine_id, timestamp)) FROM fact_failure_l, period_l WHERE timestamp >= period_start AND timestamp < period_end",
        "SELECT sum(failures) FROM fact_month_l",
    ),
    equal(
        "gold_reconciliation", "planned_events",
        "SELECT count(DISTINCT (machine_id, timestamp)) FROM fact_maintenance_l, period_l WHERE maintenance_type = 'planned' AND timestamp >= period_start AND timestamp < period_end",
        "SELECT sum(planned_maintenances) FROM fact_month_l",
    ),
]


@query("l12_gold_reconciliation", " UNION ALL ".join(_gold))
def _(spark, sf_dir):
    w = supply_world(spark, sf_dir)
    facts = {n: getattr(w, n) for n in ("fact_machine_month", "fact_failure", "fact_maintenance")}
    return rounded_checks(C.gold_reconciliation(w.kpi_tables["kpi_machine_monthly"], facts, w.period))


def _view_sql(name: str, source: str, totals: bool = True) -> list[str]:
    rows = f"SELECT 'view_rows' AS check_name, '{name}' AS subject, count(*) > 0 AS passed, CAST(NULL AS DOUBLE) AS expected, CAST(count(*) AS DOUBLE) AS actual FROM {source}"
    sums = [
        equal("view_totals", f"{name}.{c}", f"SELECT sum({c}) FROM fact_month_e", f"SELECT sum({c}) FROM {source}")
        for c in ("failures", "total_cost")
    ]
    return [rows, *(sums if totals else [])]


@query(
    "l13_views",
    " UNION ALL ".join(
        [*_view_sql("v_fleet_monthly", "v_fleet_e"), *_view_sql("v_machine_health", "v_health_e"), *_view_sql("v_line_performance", "v_line_e"),
         *_view_sql("v_component_reliability", "v_component_e", totals=False)]
    ),
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    shown = {
        "v_fleet_monthly": views.fleet_monthly(w.fact_machine_month),
        "v_machine_health": health(w),
        "v_line_performance": views.line_performance(w.fact_machine_month, w.dim_machine),
        "v_component_reliability": views.component_reliability(w.dim_component, w.fact_failure, w.fact_maintenance, w.period),
    }
    return rounded_checks(C.view_checks(shown, w.fact_machine_month))


CUTOFF = "2024-01-16 00:00:00"


@query(
    "l4_no_leakage",
    "SELECT 'no_leakage' AS check_name, unnest(['sensor_features', 'event_features']) AS subject, "
    f"(SELECT count(*) FROM sensor_features_e WHERE timestamp <= TIMESTAMP '{CUTOFF}') > 0 AS passed, 0.0::DOUBLE AS expected, 0.0::DOUBLE AS actual",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    cutoff = F.lit(CUTOFF).cast("timestamp_ntz")
    return C.no_leakage(w.silver, w.errors, w.maintenance, w.machines, cutoff, w.p)


@query(
    "l5_labels_correct",
    zero(
        "labels_correct", P.target,
        f"SELECT count(*) FROM labels_e AS l WHERE {P.target} <> CAST(EXISTS (SELECT 1 FROM failures_e AS f WHERE f.machine_id = l.machine_id "
        "AND f.timestamp > l.timestamp AND f.timestamp <= l.timestamp + INTERVAL 48 HOUR) AS INTEGER)",
    ),
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return C.labels_correct(w.labels, w.failures, w.p)


@query(
    "l6_split_and_balance",
    f"""SELECT 'split_integrity' AS check_name, s AS subject, bad = 0 AND n > 0 AS passed, 0.0::DOUBLE AS expected, CAST(bad AS DOUBLE) AS actual FROM (
      SELECT split AS s, count(*) AS n, count(*) FILTER (WHERE CASE split WHEN 'train' THEN timestamp + INTERVAL 48 HOUR >= TIMESTAMP '{P.train_end}'
      ELSE timestamp < TIMESTAMP '{P.train_end}' END) AS bad FROM dataset_e GROUP BY 1)
    UNION ALL SELECT 'label_balance', split, sum({P.target}) > 0, NULL, CAST(sum({P.target}) AS DOUBLE) FROM dataset_e GROUP BY split""",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return C.split_integrity(w.ml_dataset, w.p)


_inputs = [*FEATURES, *COUNTS, *HOURS, "model", "age"]


@query(
    "l6_completeness",
    " UNION ALL ".join(
        f"SELECT 'completeness' AS check_name, '{c}' AS subject, avg(CAST({c} IS NULL AS INTEGER)) <= 0.05 AS passed, 0.05::DOUBLE AS expected, "
        f"{r6(f'avg(CAST({c} IS NULL AS INTEGER))')} AS actual FROM dataset_e"
        for c in _inputs
    ),
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    columns = feature_columns(w.ml_dataset.columns, w.p)
    return rounded_checks(C.completeness(w.ml_dataset, columns))


@query(
    "l7_kpi_reconciliation",
    " UNION ALL ".join(
        [
            equal("kpi_reconciliation", "failures", "SELECT count(*) FROM failure_ev_l", "SELECT sum(failures) FROM monthly_l"),
            equal("kpi_reconciliation", "components_failed", "SELECT sum(components) FROM failure_ev_l", "SELECT sum(components_failed) FROM monthly_l"),
            zero("kpi_reconciliation", "machine_totals", "SELECT count(*) FROM machines_l WHERE machine_id NOT IN (SELECT machine_id FROM monthly_l)"),
        ]
    ),
)
def _(spark, sf_dir):
    w = supply_world(spark, sf_dir)
    return rounded_checks(C.kpi_reconciliation(w.kpi_tables, w.failures, w.period))


@query(
    "l2_manifest",
    " UNION ALL ".join(
        equal("manifest", f"stuck_values_nulled.{s}", f"SELECT count(*) FROM stuck_marks WHERE stuck_{s}", f"SELECT count({s}) - (SELECT count({s}) FROM unstuck) FROM ranged")
        for s in SENSORS
    ),
)
def _(spark, sf_dir):
    """The expected counts come from the marked rows, the found ones from the counters."""
    w = event_world(spark, sf_dir)
    first = cleaning.null_out_of_range(cleaning.deduplicate(w.readings, w.p), w.p)
    marked = cleaning.mark_stuck(first, w.p)
    expected = marked.agg(*[F.sum(F.col(f"{s}_stuck").cast("bigint")).alias(s) for s in w.p.sensors]).unpivot(
        [], list(w.p.sensors), "sensor", "n"
    ).withColumn("rule", F.lit("stuck_values_nulled"))
    return rounded_checks(C.manifest_check(cleaning.cleaning_metrics(w.readings, w.p), expected))


_truth = " UNION ALL ".join(
    f"""SELECT '{s}' AS sensor, count(*) FILTER (WHERE {s}_quality = 'ok') AS ok_values,
    count(*) FILTER (WHERE {s}_quality = 'ok' AND s.{s} IS DISTINCT FROM d.{s}) AS ok_mismatches, count(*) FILTER (WHERE {s}_quality = 'filled') AS filled_values,
    {r6(f"avg(abs(s.{s} - d.{s})) FILTER (WHERE {s}_quality = 'filled')")} AS filled_mae,
    {r6(f"avg(abs({s}_linear - d.{s})) FILTER (WHERE {s}_quality = 'filled')")} AS linear_mae, {r6(f'stddev_samp(d.{s})')} AS sensor_std
    FROM silver AS s JOIN deduped AS d USING (machine_id, timestamp) LEFT JOIN straight USING (machine_id, timestamp)"""
    for s in SENSORS
)


@query("l3_ground_truth", _truth)
def _(spark, sf_dir):
    """The readings before range and stuck rules stand in for the true series."""
    w = event_world(spark, sf_dir)
    truth = cleaning.deduplicate(w.readings, w.p)
    return round6(C.ground_truth(w.silver, straight_lines(w), truth, w.p), ["filled_mae", "linear_mae", "sensor_std"])


block(
    "damaged_e",
    """SELECT * REPLACE (CASE WHEN digit = 5 THEN NULL WHEN digit = 2 THEN failure_risk + 0.25 ELSE failure_risk END AS failure_risk,
    CASE WHEN digit = 6 THEN 'old' ELSE failure_model_version END AS failure_model_version,
    CASE WHEN digit = 7 THEN NOT alert ELSE alert END AS alert, CASE WHEN digit = 8 THEN NOT anomaly_flag ELSE anomaly_flag END AS anomaly_flag,
    CASE WHEN digit <> 9 THEN reason_1 END AS reason_1)
    FROM (SELECT *, machine_id % 10 AS digit FROM predictions_e) WHERE digit <> 3""",
)


def _both(clean: dict[str, str], damaged: dict[str, str], check: str) -> str:
    """Rows of a check whose subjects have the counts of these queries, on the predictions and on the damaged copy."""
    return " UNION ALL ".join(
        f"SELECT '{check}' AS check_name, '{n}' AS subject, ({sql}) = 0 AS passed, 0.0::DOUBLE AS expected, CAST(({sql}) AS DOUBLE) AS actual, {k} AS damage"
        for k, counts in enumerate((clean, damaged))
        for n, sql in counts.items()
    )


def _judged(w, check) -> DataFrame:
    """``check`` of the predictions and of their damaged copy."""
    both = (w.predictions, C.damaged_predictions(w.predictions, w.p))
    parts = [check(df).withColumn("damage", F.lit(k)) for k, df in enumerate(both)]
    return rounded_checks(parts[0].unionByName(parts[1]))


_with_digit = lambda d: f"SELECT count(*) FROM predictions_e WHERE machine_id % 10 = {d}"


@query(
    "l14_predictions_complete",
    _both(
        {
            "missing_rows": "SELECT count(*) FROM spine ANTI JOIN predictions_e USING (machine_id, timestamp)",
            "duplicate_keys": "SELECT count(*) - count(DISTINCT (machine_id, timestamp)) FROM predictions_e",
            "empty_scores": "SELECT count(*) FROM predictions_e WHERE failure_risk IS NULL OR anomaly_score IS NULL",
            "old_versions": "SELECT count(*) FROM predictions_e WHERE failure_model_version <> 'rule'",
        },
        {"missing_rows": _with_digit(3), "duplicate_keys": _with_digit(4), "empty_scores": _with_digit(5), "old_versions": _with_digit(6)},
        "predictions_complete",
    ),
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    versions = {k: "rule" for k in ("failure", "component", "anomaly")}
    return _judged(w, lambda df: C.predictions_complete(df, w.spine, versions, w.p))


_applied = lambda t: {
    "wrong_alerts": f"SELECT count(*) FROM {t} WHERE alert <> (failure_risk >= 0.5)",
    "wrong_flags": f"SELECT count(*) FROM {t}, anomaly_threshold_e WHERE anomaly_flag <> (anomaly_score >= anomaly_threshold)",
    "alerts_without_reason": f"SELECT count(*) FROM {t} WHERE alert AND reason_1 IS NULL",
}


@query("l15_thresholds_applied", _both(_applied("predictions_e"), _applied("(SELECT * FROM damaged_e UNION ALL SELECT * FROM damaged_e WHERE digit = 4)"), "thresholds_applied"))
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return _judged(w, lambda df: C.thresholds_applied(df, scoring.ALERT_AT, w.anomaly_model[1]))


@query(
    "l16_reproducible",
    _both({"max_difference": "SELECT 0"}, {"max_difference": "SELECT max(CASE WHEN machine_id % 10 = 2 THEN 0.25 ELSE 0 END) FROM predictions_e"}, "reproducible"),
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    rows = by_step(w.sensor_features, w.event_features, w.p.keys)
    scores = ["failure_risk", "anomaly_score", *[f"{c}_risk" for c in COMPS]]
    again = scoring.rule_predictions(rows, w.anomaly_model, w.failures, w.p).select(*w.p.keys, *scores)
    # Scored once, for the predictions as they are and for damaged ones.
    again = stage(again, "scored_again")
    return _judged(w, lambda df: C.reproducible(df, again, scores, w.p))


@query(
    "l17_data_unchanged",
    """SELECT 'data_unchanged' AS check_name, 'fingerprint' AS subject, damage = 0 AS passed, CAST(count(*) AS DOUBLE) AS expected,
    CAST(count(*) AS DOUBLE) AS actual, damage FROM dataset_e, (VALUES (0), (1)) AS d(damage) WHERE split = 'train' GROUP BY damage""",
)
def _(spark, sf_dir):
    """Against the fingerprint stored at training time: as it is, and after one value of one row changed."""
    w = event_world(spark, sf_dir)
    rows = w.ml_dataset.where("split = 'train'")
    stored = stage(C.fingerprint(rows), "trained_on")
    last = rows.agg(F.max(F.struct(*w.p.keys)).alias("_last"))
    hit = F.struct(*w.p.keys) == F.col("_last")
    total = F.col(w.p.target)
    damaged = rows.crossJoin(F.broadcast(last)).withColumn(w.p.target, F.when(hit, 1 - total).otherwise(total).cast(rows.schema[w.p.target].dataType))
    parts = [C.data_unchanged(stored, C.fingerprint(df.select(rows.columns))).withColumn("damage", F.lit(k)) for k, df in enumerate((rows, damaged))]
    return parts[0].unionByName(parts[1])


@query(
    "l18_report_metrics",
    "SELECT 'labels' AS layer, 'report_passed' AS metric, 1.0::DOUBLE AS value UNION ALL SELECT 'warehouse', 'rows_fact_failure', CAST(count(*) AS DOUBLE) FROM fact_failure_l "
    "UNION ALL SELECT 'warehouse', 'rows_fact_machine_month', CAST(count(*) AS DOUBLE) FROM fact_month_l UNION ALL SELECT 'insights', 'net_saving_' || name, "
    "round(catch_rate / years * saving_if_caught - catch_rate / years * events * false_alarms_per_catch * 20000.0 - 5000000.0, 4) FROM scenarios_l, year_l",
)
def _(spark, sf_dir):
    w, e = supply_world(spark, sf_dir), event_world(spark, sf_dir)
    reports = {"labels": C.labels_correct(e.labels, e.failures, e.p)}
    facts = {"fact_failure": w.fact_failure, "fact_machine_month": w.fact_machine_month}
    scenarios = N.scenario_results(N.scenario_table(spark, w.p.scenarios), _year(w), _failed(w), w.p)
    return C.report_metrics(reports, facts, scenarios).withColumn("value", F.round("value", 4))


@query(
    "l19_beats_baseline",
    f"""SELECT 'beats_baseline' AS check_name, m AS subject, coalesce(a > b, false) AS passed, {r6('b')} AS expected, {r6('a')} AS actual FROM (
    SELECT 'net_saving' AS m, (SELECT net_saving FROM metrics_t) AS a, (SELECT max(net_saving) FROM metrics_b WHERE part = 'test') AS b
    UNION ALL SELECT 'pr_auc', (SELECT pr_auc FROM metrics_t), (SELECT max(pr_auc) FROM metrics_b WHERE part = 'test'))""",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    # The rule and its baselines are judged side by side, by the two metrics that are compared.
    judged = E.baseline_rows(w.outcome_parts.where("part = 'test'"), w.p, baseline_rules(w) | {"rule": (scoring.rule_risk(w.p), 0.5)})
    metrics = stage(E.evaluate(judged, w.costs, w.p, ["model"], metrics=["net_saving", "pr_auc"]), "judged_models")
    # Without any test row the rule saves nothing and has no PR-AUC.
    model = metrics.where("model = 'rule'").agg(F.coalesce(F.max("net_saving"), F.lit(0.0)).alias("net_saving"), F.max("pr_auc").alias("pr_auc"))
    base = metrics.where("model <> 'rule'")
    return rounded_checks(C.beats_baseline(model, base, ["net_saving", "pr_auc"]))


@query(
    "k54_check_roll_up",
    "SELECT 'warehouse' AS layer, true AS passed, 17 AS checks_passed, 17 AS checks_run UNION ALL SELECT 'labels', true, 1, 1 UNION ALL SELECT 'bronze', NULL, NULL, NULL",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return C.roll_up(
        {"warehouse": C.references(tables(w)), "labels": C.labels_correct(w.labels, w.failures, w.p), "bronze": None}
    )


