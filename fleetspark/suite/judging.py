"""Queries of the evaluation and the business case."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.functions.staging import stage
from fleetspark.plans import evaluate as E
from fleetspark.plans import insights as N
from fleetspark.plans import scoring, views
from fleetspark.suite.blocks import RISK, H, P, U, W, rounded
from fleetspark.suite.layers import round6
from fleetspark.suite.registry import block, query, r6
from fleetspark.suite.warehouse import components, health
from fleetspark.suite.worlds import event_world, supply_world

COOLDOWN = f"INTERVAL {H * 12} HOUR"
ROW = f"machine_id, timestamp, {P.target}, next_failure_at, failed_component"


def _tested(w) -> DataFrame:
    return w.scored.where("split = 'test'").withColumn("threshold", F.lit(0.5))


block("tested_e", f"SELECT {ROW}, hours_to_failure, {RISK} AS score, 0.5::DOUBLE AS threshold FROM dataset_e WHERE split = 'test'")


def judged_blocks(name: str, source: str, by: list[str]) -> None:
    """Alerts, opened inspections, events and metrics of a block with score and threshold."""
    cols = "".join(f"{c}, " for c in by)
    same = "".join(f"a.{c} = r.{c} AND " for c in by)
    r_by = "".join(f"r.{c}, " for c in by)
    block(f"alerts_{name}", f"SELECT * FROM {source} WHERE score >= threshold")
    block(
        f"opened_{name}",
        f"""SELECT {cols}machine_id, min(timestamp) AS timestamp FROM alerts_{name} GROUP BY {cols}machine_id
UNION ALL
SELECT {r_by}r.machine_id, min(a.timestamp) FROM opened_{name} AS r JOIN alerts_{name} AS a
  ON {same}a.machine_id = r.machine_id AND a.timestamp >= r.timestamp + {COOLDOWN}
GROUP BY {r_by}r.machine_id, r.timestamp""",
        recursive=True,
    )
    block(
        f"inspected_{name}",
        f"SELECT {', '.join([f'o.{c}' for c in by] + ['o.machine_id', 'o.timestamp'])}, a.{P.target} = 1 AS failure_followed "
        f"FROM opened_{name} AS o JOIN alerts_{name} AS a USING ({cols}machine_id, timestamp)",
    )
    block(
        f"seen_{name}",
        f"""SELECT {cols}machine_id, next_failure_at AS failure_time, bool_or(score >= threshold) AS caught,
  min(timestamp) FILTER (WHERE score >= threshold) AS first_alert, min(failed_component) AS components,
  max(score) AS best_score, (epoch_us(next_failure_at) - epoch_us(min(timestamp) FILTER (WHERE score >= threshold))) / 3600000000.0::DOUBLE AS lead_time_h,
  (SELECT sum(c.saving_if_prevented) FROM costs AS c
    WHERE list_contains(string_split(min(s.failed_component), '+'), c.component)) AS saving
FROM {source} AS s WHERE {P.target} = 1 GROUP BY {cols}machine_id, next_failure_at""",
    )
    block(
        f"points_{name}",
        f"""SELECT *, (sum(pos) OVER w) / sum(pos + neg) OVER w AS precision,
  (sum(pos) OVER w) / sum(pos) OVER p AS recall, sum(neg) OVER w - neg AS neg_before, sum(pos) OVER w - pos AS pos_before
FROM (SELECT {cols}score, count(*) FILTER (WHERE {P.target} = 1) AS pos, count(*) FILTER (WHERE {P.target} <> 1) AS neg
      FROM {source} GROUP BY {cols}score)
WINDOW w AS (PARTITION BY {cols}1 ORDER BY score DESC), p AS (PARTITION BY {cols}1)""",
    )
    group = f"GROUP BY {', '.join(by)}" if by else ""
    join = lambda t: f"LEFT JOIN ({t}) USING ({', '.join(by)})" if by else f", ({t})"
    parts = [
        f"SELECT {cols}sum(pos * precision) / nullif(sum(pos), 0) AS ap, "
        f"1 - sum(pos * (neg_before + neg / 2.0::DOUBLE)) / nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0) AS roc, "
        f"sum(pos) > 0 AND sum(neg) > 0 AS both_classes FROM points_{name} {group}",
        f"SELECT {cols}count(*) AS failure_events, count(*) FILTER (WHERE caught) AS events_caught, "
        f"median(lead_time_h) FILTER (WHERE caught) AS lead, sum(saving) FILTER (WHERE caught) AS caught_saving, "
        f"sum(saving) AS potential FROM seen_{name} {group}",
        f"SELECT {cols}count(*) AS n_open, count(*) FILTER (WHERE NOT failure_followed) AS n_false FROM inspected_{name} {group}",
    ]
    pr, rc = "coalesce(tp / nullif(n_alerts, 0), 0)", "coalesce(tp / nullif(n_pos, 0), 0)"
    net = f"(coalesce(caught_saving, 0) - coalesce(n_false, 0) * {P.false_alarm_cost}::DOUBLE)"
    months = "(machines * (span_h / (365.25 * 24 / 12)))"
    block(
        f"metrics_{name}",
        f"""SELECT {cols}threshold, row_count, n_pos AS positives, n_alerts AS alerts,
  CASE WHEN both_classes THEN {r6('ap')} END AS pr_auc, CASE WHEN both_classes THEN {r6('roc')} END AS roc_auc,
  {r6(pr)} AS precision, {r6(rc)} AS recall, {r6(f'coalesce(2 * {pr} * {rc} / nullif({pr} + {rc}, 0), 0)')} AS f1,
  coalesce(failure_events, 0) AS failure_events, coalesce(events_caught, 0) AS events_caught,
  {r6('coalesce(events_caught / nullif(failure_events, 0), 0)')} AS event_recall, {r6('coalesce(lead, 0)')} AS median_lead_time_h,
  coalesce(n_open, 0) AS inspections, coalesce(n_false, 0) AS false_alarms,
  {r6(f'coalesce(coalesce(n_false, 0) / nullif({months}, 0), 0)')} AS false_alarms_per_machine_month,
  coalesce(caught_saving, 0) AS caught_saving, coalesce(n_false, 0) * {P.false_alarm_cost}::DOUBLE AS false_alarm_cost,
  {net} AS net_saving, coalesce(potential, 0) AS potential_saving, {r6(f'coalesce({net} / nullif(potential, 0), 0)')} AS saving_captured
FROM (SELECT {cols}min(threshold) AS threshold, count(*) AS row_count, count(*) FILTER (WHERE {P.target} = 1) AS n_pos,
        count(*) FILTER (WHERE score >= threshold) AS n_alerts,
        count(*) FILTER (WHERE score >= threshold AND {P.target} = 1) AS tp, count(DISTINCT machine_id) AS machines,
        (epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 3600000000.0::DOUBLE + {P.feature_step * 12} AS span_h
      FROM {source} {group}) {' '.join(join(t) for t in parts)}""",
    )


judged_blocks("t", "tested_e", [])

METRIC_FLOATS = ["pr_auc", "roc_auc", "precision", "recall", "f1", "event_recall", "median_lead_time_h",
                 "false_alarms_per_machine_month", "saving_captured"]


@query(
    "m3_failure_events",
    f"SELECT machine_id, failure_time, caught, first_alert, components, {r6('best_score')} AS best_score, "
    f"{r6('lead_time_h')} AS lead_time_h, saving FROM seen_t",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    events = E.failure_events(_tested(w), w.p, F.col("score") >= F.col("threshold"))
    return round6(E.event_savings(events, w.costs, ["machine_id", "failure_time"]), ["best_score", "lead_time_h"])


@query("m4_inspections", "SELECT machine_id, timestamp, failure_followed FROM inspected_t")
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return E.inspections(_tested(w).where("score >= threshold"), w.p, w.p.horizon_us)


block(
    "error_alerts_e",
    f"SELECT DISTINCT machine_id, timestamp, CAST(0 AS TINYINT) AS {P.target}, 1.0::DOUBLE AS score, 0.5::DOUBLE AS threshold FROM errors_e",
)
block(
    "opened_errors",
    """SELECT machine_id, min(timestamp) AS timestamp FROM error_alerts_e GROUP BY machine_id
UNION ALL
SELECT r.machine_id, min(a.timestamp) FROM opened_errors AS r JOIN error_alerts_e AS a
  ON a.machine_id = r.machine_id AND a.timestamp >= r.timestamp + INTERVAL 24 HOUR GROUP BY r.machine_id, r.timestamp""",
    recursive=True,
)


@query("m4_inspections_of_errors", "SELECT machine_id, timestamp FROM opened_errors")
def _(spark, sf_dir):
    """Every error as an alert: irregular times, many chunks, 24-hour cool-down."""
    w = event_world(spark, sf_dir)
    alerts = w.errors.select("machine_id", "timestamp").distinct().withColumn(w.p.target, F.lit(0).cast("tinyint"))
    return E.inspections(alerts, w.p.for_events(), 24 * 3_600_000_000).select("machine_id", "timestamp")


@query("m5_event_savings", "SELECT components, count(*) AS events, sum(saving) AS saving FROM seen_t GROUP BY components")
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    events = E.failure_events(_tested(w), w.p, F.lit(True))
    saved = E.event_savings(events, w.costs, ["machine_id", "failure_time"])
    return saved.groupBy("components").agg(F.count(F.lit(1)).alias("events"), F.sum("saving").alias("saving"))


@query("m6_evaluate", "SELECT * FROM metrics_t")
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return round6(E.evaluate(_tested(w), w.costs, w.p), METRIC_FLOATS)


@query("m7_ranking", "SELECT pr_auc, roc_auc FROM metrics_t")
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return round6(E.ranking(_tested(w), w.p.target), ["pr_auc", "roc_auc"])


@query(
    "m22_pr_points",
    f"SELECT {r6('score')} AS score, pos, neg, {r6('precision')} AS precision, {r6('recall')} AS recall FROM points_t",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    points = E.pr_points(_tested(w), w.p.target).select("score", "pos", "neg", "precision", "recall")
    return round6(points, ["score", "precision", "recall"])


# ---------------------------------------------------------------- thresholds on validation

def curve_blocks(name: str, source: str) -> None:
    """Candidate thresholds and net savings (``curve_<name>``) of validation rows with a score."""
    block(f"val_{name}", source)
    block(
        f"candidates_{name}",
        f"""SELECT score AS threshold FROM (SELECT score, row_number() OVER (ORDER BY score) AS place, count(*) OVER () AS size
  FROM (SELECT DISTINCT score FROM val_{name} WHERE score IS NOT NULL))
WHERE place IN (SELECT (size * m + 999999) // 1000000 FROM (SELECT unnest({E.candidate_shares(P.thresholds)}) AS m))
UNION ALL SELECT max(score) + 1.0 FROM val_{name}""",
    )
    block(f"curve_rows_{name}", f"SELECT v.*, t.threshold FROM val_{name} AS v JOIN candidates_{name} AS t ON v.score >= t.threshold")
    block(
        f"opened_curve_{name}",
        f"""SELECT threshold, machine_id, min(timestamp) AS timestamp FROM curve_rows_{name} GROUP BY threshold, machine_id
UNION ALL
SELECT r.threshold, r.machine_id, min(a.timestamp) FROM opened_curve_{name} AS r JOIN curve_rows_{name} AS a
  ON a.threshold = r.threshold AND a.machine_id = r.machine_id AND a.timestamp >= r.timestamp + {COOLDOWN}
GROUP BY r.threshold, r.machine_id, r.timestamp""",
        recursive=True,
    )
    block(
        f"val_events_{name}",
        f"""SELECT machine_id, next_failure_at, max(score) AS best_score, (SELECT sum(c.saving_if_prevented) FROM costs AS c
   WHERE list_contains(string_split(min(v.failed_component), '+'), c.component)) AS saving
FROM val_{name} AS v WHERE {P.target} = 1 GROUP BY machine_id, next_failure_at""",
    )
    block(
        f"curve_{name}",
        f"""SELECT t.threshold, coalesce(c.n, 0) AS events_caught, coalesce(f.n, 0) AS false_alarms,
  coalesce(c.saved, 0) - coalesce(f.n, 0) * {P.false_alarm_cost}::DOUBLE AS net_saving
FROM candidates_{name} AS t
LEFT JOIN (SELECT t2.threshold, count(*) AS n, sum(saving) AS saved FROM candidates_{name} AS t2 JOIN val_events_{name} AS e
           ON e.best_score >= t2.threshold GROUP BY 1) AS c USING (threshold)
LEFT JOIN (SELECT threshold, count(*) AS n FROM opened_curve_{name} JOIN val_{name} USING (machine_id, timestamp)
           WHERE {P.target} = 0 GROUP BY 1) AS f USING (threshold)""",
    )


curve_blocks("e", f"SELECT {ROW}, anomaly_score AS score FROM parts_e JOIN anomaly_e USING (machine_id, timestamp) WHERE part = 'validation'")


def _validation(w) -> DataFrame:
    rows = w.ml_dataset.where("split = 'train'").where(
        F.col("timestamp") >= F.lit(str(w.p.validation_start)).cast("timestamp_ntz")
    )
    profile, _, inputs = w.anomaly_model
    scored = scoring.anomaly_score(rows, profile, inputs).withColumnRenamed("anomaly_score", "score")
    return stage(scored.select(*w.p.keys, w.p.target, "next_failure_at", "failed_component", "score"), "validation_scores")


@query("m8_threshold_candidates", f"SELECT {r6('threshold')} AS threshold FROM candidates_e")
def _(spark, sf_dir):
    return round6(E.threshold_candidates(_validation(event_world(spark, sf_dir))), ["threshold"])


def _curve(w) -> DataFrame:
    rows = _validation(w)
    return E.net_saving_curve(rows, E.threshold_candidates(rows), w.costs, w.p)


@query(
    "m8_net_saving_curve",
    f"SELECT {r6('threshold')} AS threshold, events_caught, false_alarms, net_saving FROM curve_e",
)
def _(spark, sf_dir):
    return round6(_curve(event_world(spark, sf_dir)), ["threshold"])


@query(
    "m8_choose_threshold",
    f"""SELECT {r6('max(threshold)')} AS threshold, any_value(net_saving) AS net_saving FROM curve_e
    WHERE net_saving = (SELECT max(net_saving) FROM curve_e)""",
)
def _(spark, sf_dir):
    return round6(E.choose_threshold(_curve(event_world(spark, sf_dir))), ["threshold"])


# ---------------------------------------------------------------- baselines

_rule5 = f"CAST(error5_count_{W}{U} AS DOUBLE)"
block(
    "baseline_rows_e",
    f"""SELECT 'never-fail' AS model, part, {ROW}, 0.0::DOUBLE AS score, 1.0::DOUBLE AS threshold FROM parts_e WHERE part IN ('validation', 'test')
UNION ALL SELECT 'error5-rule', part, {ROW}, {_rule5}, 1.0 FROM parts_e WHERE part IN ('validation', 'test')""",
)
judged_blocks("b", "baseline_rows_e", ["model", "part"])


def baseline_rules(w) -> dict:
    return {"never-fail": (scoring.never_fail(), 1.0), "error5-rule": (scoring.error_rule(w.p), 1.0)}


def baselines(w) -> DataFrame:
    return E.baseline_rows(w.outcome_parts, w.p, baseline_rules(w))


@query("m19_baseline_runs", "SELECT * FROM metrics_b")
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return round6(E.evaluate(baselines(w), w.costs, w.p, ["model", "part"]), METRIC_FLOATS)


@query(
    "m2_baseline_scores",
    "SELECT model, part, score, count(*) AS row_count FROM baseline_rows_e GROUP BY ALL",
)
def _(spark, sf_dir):
    return (
        baselines(event_world(spark, sf_dir))
        .groupBy("model", "part", "score")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


@query(
    "m20_costs",
    """SELECT component, saving_if_prevented, 20000.0::DOUBLE AS false_alarm_cost, n AS failures
    FROM costs JOIN (SELECT component, count(*) AS n FROM failures_l GROUP BY 1) USING (component)""",
)
def _(spark, sf_dir):
    w = supply_world(spark, sf_dir)
    seen = w.failures.groupBy("component").agg(F.count(F.lit(1)).alias("failures"))
    return E.costs_relation(w.dim_component, w.p).join(seen, "component")


# ---------------------------------------------------------------- anomaly

block(
    "flagged_e",
    f"""SELECT d.machine_id, d.timestamp, d.hours_to_failure, d.next_failure_at, d.{P.target}, a.anomaly_score AS score,
  a.anomaly_score >= t.anomaly_threshold AS flag,
  CASE WHEN hours_to_failure > 0 AND hours_to_failure <= 24 THEN '0-24 h' WHEN hours_to_failure > 24 AND hours_to_failure <= 48 THEN '24-48 h'
       WHEN hours_to_failure > 48 AND hours_to_failure <= 72 THEN '48-72 h' WHEN hours_to_failure > 72 AND hours_to_failure <= 168 THEN '72-168 h'
       ELSE 'normal (>168 h)' END AS bucket
FROM dataset_e AS d JOIN anomaly_e AS a USING (machine_id, timestamp), anomaly_threshold_e AS t WHERE d.split = 'test'""",
)
judged_blocks("f", "(SELECT *, 0.0::DOUBLE AS threshold, 'comp1' AS failed_component FROM flagged_e)", [])


def _flagged(w) -> DataFrame:
    profile, threshold, inputs = w.anomaly_model
    rows = scoring.anomaly_score(w.ml_dataset.where("split = 'test'"), profile, inputs)
    flag = F.col("anomaly_score") >= F.col("anomaly_threshold")
    return rows.crossJoin(F.broadcast(threshold)).withColumn("flag", flag).withColumnRenamed("anomaly_score", "score")


@query("m12_anomaly_scores", f"SELECT machine_id, timestamp, {r6('anomaly_score')} AS anomaly_score FROM anomaly_e")
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    profile, _, inputs = w.anomaly_model
    scored = scoring.anomaly_score(w.sensor_features, profile, inputs)
    return round6(scored.select("machine_id", "timestamp", "anomaly_score"), ["anomaly_score"])


@query("m12_anomaly_threshold", f"SELECT {r6('anomaly_threshold')} AS anomaly_threshold FROM anomaly_threshold_e")
def _(spark, sf_dir):
    return round6(event_world(spark, sf_dir).anomaly_model[1], ["anomaly_threshold"])


@query(
    "m13_flag_rates",
    f"SELECT bucket, count(*) AS row_count, {r6('avg(CAST(flag AS INTEGER))')} AS flag_rate FROM flagged_e GROUP BY bucket",
)
def _(spark, sf_dir):
    return round6(E.flag_rates(_flagged(event_world(spark, sf_dir))), ["flag_rate"])


_near = "hours_to_failure > 0 AND hours_to_failure <= 48"
ANOMALY_FLOATS = ["flag_rate_normal", "flag_rate_48h", "event_recall_48h", "pr_auc", "lift_48h"]


block(
    "anomaly_metrics_e",
    f"""SELECT row_count, flags, failure_events, {', '.join(r6(c) + f' AS {c}' for c in ANOMALY_FLOATS[:4])},
    {r6('flag_rate_48h / nullif(flag_rate_normal, 0)')} AS lift_48h
    FROM (SELECT count(*) AS row_count, count(*) FILTER (WHERE flag) AS flags,
      coalesce(avg(CAST(flag AS INTEGER)) FILTER (WHERE bucket = 'normal (>168 h)'), 0) AS flag_rate_normal,
      coalesce(avg(CAST(flag AS INTEGER)) FILTER (WHERE {_near}), 0) AS flag_rate_48h FROM flagged_e),
     (SELECT count(*) AS failure_events, coalesce(avg(CAST(hit AS INTEGER)), 0) AS event_recall_48h FROM (
        SELECT bool_or(flag) AS hit FROM flagged_e WHERE {_near} GROUP BY machine_id, next_failure_at)),
     (SELECT sum(pos * precision) / nullif(sum(pos), 0) AS pr_auc FROM points_f)""",
)


@query("m13_evaluate_anomalies", "SELECT * FROM anomaly_metrics_e")
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return round6(E.evaluate_anomalies(_flagged(w), w.p), ANOMALY_FLOATS)


# ---------------------------------------------------------------- business case

block(
    "year_l",
    """SELECT events, saving_if_caught, downtime_avoided_h, machine_hours, machines, machine_hours / machines / 8760.0::DOUBLE AS years
FROM (SELECT count(*) AS events, sum(saving) AS saving_if_caught, sum(u - p) AS downtime_avoided_h FROM (
  SELECT sum(saving_if_prevented) AS saving, max(unplanned_downtime_hours) AS u, max(planned_downtime_hours) AS p
  FROM fact_failure_l JOIN costs USING (component), period_l WHERE timestamp >= period_start AND timestamp < period_end
  GROUP BY machine_id, timestamp)), (SELECT sum(period_hours) AS machine_hours, count(DISTINCT machine_id) AS machines FROM fact_month_l)""",
)
block(
    "year_components_l",
    """SELECT component, count(*) AS failures, any_value(planned_downtime_hours) AS planned_downtime_hours
FROM fact_failure_l JOIN costs USING (component), period_l WHERE timestamp >= period_start AND timestamp < period_end GROUP BY component""",
)
block("scenarios_l", "SELECT * FROM (VALUES ('conservative', 0.5::DOUBLE, 1.0::DOUBLE), ('expected', 0.7::DOUBLE, 0.5::DOUBLE)) AS v(name, catch_rate, false_alarms_per_catch)")


def _year(w) -> DataFrame:
    return N.base_year(w.fact_failure, w.dim_component, w.fact_machine_month, w.period)


def _failed(w) -> DataFrame:
    return N.component_failures(w.fact_failure, w.dim_component, w.period)


@query("n1_base_year", rounded(["years"], "year_l", ["events", "saving_if_caught", "downtime_avoided_h", "machine_hours", "machines"]))
def _(spark, sf_dir):
    return round6(_year(supply_world(spark, sf_dir)), ["years"])


@query("n1_component_failures", "SELECT * FROM year_components_l")
def _(spark, sf_dir):
    return _failed(supply_world(spark, sf_dir))


SCENARIO_FLOATS = ["failures_caught", "false_alarms", "gross_saving", "false_alarm_cost", "net_saving", "downtime_avoided_h",
                   "availability_gain", "payback_months", "inspections_per_week", "technician_hours_per_week"]


def scenario_sql(source: str, alarm: float, program: float) -> str:
    caught, rate = "(catch_rate * events / years)", "(catch_rate / years)"
    false = f"({caught} * false_alarms_per_catch)"
    gross = f"({rate} * saving_if_caught)"
    monthly = f"(({gross} - {false} * {alarm}) / 12)"
    exprs = {
        "failures_caught": caught,
        "false_alarms": false,
        "gross_saving": gross,
        "false_alarm_cost": f"({false} * {alarm})",
        "net_saving": f"({gross} - {false} * {alarm} - {program})",
        "downtime_avoided_h": f"({rate} * downtime_avoided_h)",
        "availability_gain": "(100 * catch_rate * downtime_avoided_h / machine_hours)",
        "payback_months": f"(CASE WHEN {monthly} > 0 THEN {program} / {monthly} END)",
        "inspections_per_week": f"(({caught} + {false}) / 52)",
        "technician_hours_per_week": f"((({caught} + {false}) * 2 + {rate} * (SELECT sum(failures * planned_downtime_hours) FROM year_components_l)) / 52)",
    }
    cols = ", ".join(f"round({e}, 4) AS {n}" for n, e in exprs.items())
    return f"SELECT name, catch_rate, false_alarms_per_catch, {program}::DOUBLE AS program_cost, {cols} FROM {source}, year_l"


def round4(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 4) for c in columns})


@query("n2_scenarios", scenario_sql("scenarios_l", 20000.0, 5000000.0))
def _(spark, sf_dir):
    w = supply_world(spark, sf_dir)
    table = N.scenario_table(spark, w.p.scenarios)
    return round4(N.scenario_results(table, _year(w), _failed(w), w.p), SCENARIO_FLOATS)


@query(
    "n2_scenario_as_tested",
    scenario_sql(
        "(SELECT 'as tested' AS name, events_caught / failure_events AS catch_rate, false_alarms / greatest(events_caught, 1) AS false_alarms_per_catch FROM metrics_t)",
        20000.0,
        5000000.0,
    ).replace("SELECT name, catch_rate, false_alarms_per_catch", "SELECT name, round(catch_rate, 4) AS catch_rate, round(false_alarms_per_catch, 4) AS false_alarms_per_catch"),
)
def _(spark, sf_dir):
    w, e = supply_world(spark, sf_dir), event_world(spark, sf_dir)
    tested = N.as_tested(E.evaluate(_tested(e), e.costs, e.p))
    out = N.scenario_results(tested, _year(w), _failed(w), w.p)
    return round4(out, [*SCENARIO_FLOATS, "catch_rate", "false_alarms_per_catch"])


@query(
    "n2_parts_per_quarter",
    "SELECT name, component, round(catch_rate * failures / years / 4, 6) AS parts_per_quarter FROM scenarios_l, year_l, year_components_l",
)
def _(spark, sf_dir):
    w = supply_world(spark, sf_dir)
    return round6(N.parts_per_quarter(N.scenario_table(spark, w.p.scenarios), _year(w), _failed(w)), ["parts_per_quarter"])


def _break_even_sql(per_catch: float, alarm: float, program: float) -> str:
    yearly = f"((saving_if_caught / events - {per_catch * alarm}) * events / years)"
    return f"CASE WHEN {yearly} > 0 AND {program} / {yearly} <= 1 THEN {program} / {yearly} END"


@query("n3_break_even", f"SELECT round({_break_even_sql(0.5, 20000.0, 5000000.0)}, 6) AS break_even_catch_rate FROM year_l")
def _(spark, sf_dir):
    w = supply_world(spark, sf_dir)
    return round6(N.break_even(_year(w), 0.5, w.p.false_alarm_cost, w.p.program_cost), ["break_even_catch_rate"])


def _grid_sql(rates, alarms, per_catch: float, program: float) -> str:
    values = lambda xs: "(SELECT unnest([" + ", ".join(f"{float(x)!r}::DOUBLE" for x in xs) + "]) AS x)"
    return f"""SELECT r.x AS catch_rate, a.x AS false_alarm_cost,
    round(r.x / years * (saving_if_caught - events * {per_catch} * a.x) - {program}, 4) AS net_saving
    FROM year_l, {values(rates)} AS r, {values(alarms)} AS a"""


@query("n4_sensitivity", _grid_sql(N.CATCH_RATES, N.ALARM_COSTS, 0.5, 5000000.0))
def _(spark, sf_dir):
    w = supply_world(spark, sf_dir)
    return round4(N.sensitivity(_year(w), N.CATCH_RATES, N.ALARM_COSTS, 0.5, w.p.program_cost), ["net_saving"])


@query(
    "n8_what_if_curve",
    f"""SELECT catch_rate, net_saving, abs(catch_rate - 0.6) < 0.005 AS chosen,
    coalesce(catch_rate >= (SELECT {_break_even_sql(0.8, 30000.0, 900000000.0)} FROM year_l), false) AS pays_off
    FROM ({_grid_sql([i / 100 for i in range(101)], [30000.0], 0.8, 900000000.0)})""",
)
def _(spark, sf_dir):
    w = supply_world(spark, sf_dir)
    return round4(N.what_if_curve(_year(w), 0.6, 0.8, 30000.0, 900_000_000.0), ["net_saving"])


FOCUS_LINE = ["failures_per_machine", "cost_per_machine", "availability", "failure_cost_share"]
block(
    "focus_lines_l",
    """SELECT plant_name, line_id, machines, failures, failures_per_machine, cost_per_machine, failure_cost, availability,
  failure_cost / sum(failure_cost) OVER () AS failure_cost_share,
  failures_per_machine > sum(failures) OVER () / sum(machines) OVER () AS above_fleet_average FROM v_line_l""",
)


def _lines(w) -> DataFrame:
    return N.focus_lines(views.line_performance(w.fact_machine_month, w.dim_machine))


@query("n5_focus_lines", rounded(FOCUS_LINE, "focus_lines_l", ["plant_name", "line_id", "machines", "failures", "failure_cost", "above_fleet_average"]))
def _(spark, sf_dir):
    return round6(_lines(supply_world(spark, sf_dir)), FOCUS_LINE)


_bands = """CASE WHEN age < 5 THEN '0-4 years' WHEN age < 10 THEN '5-9 years' WHEN age < 15 THEN '10-14 years' ELSE '15+ years' END"""
for _by, _expr in (("model", "model"), ("age_band", _bands)):
    block(
        f"focus_{_by}_e",
        f"""SELECT {_expr} AS {_by}, count(*) AS machines, CAST(sum(failures) AS BIGINT) AS failures, sum(total_cost) AS total_cost,
      sum(failures) / count(*) AS failures_per_machine, sum(total_cost) / count(*) AS cost_per_machine FROM v_health_e GROUP BY 1""",
    )
    query(
        f"n5_focus_{_by}",
        rounded(["failures_per_machine", "cost_per_machine"], f"focus_{_by}_e", [_by, "machines", "failures", "total_cost"]),
    )(
        lambda spark, sf_dir, by=_by: round6(
            N.focus_groups(health(event_world(spark, sf_dir)), by), ["failures_per_machine", "cost_per_machine"]
        )
    )


@query(
    "n5_focus_machines",
    "SELECT machine_id, model, age, line_id, failures, total_cost, failure_cost FROM v_health_e ORDER BY total_cost DESC, machine_id LIMIT 10",
)
def _(spark, sf_dir):
    return N.focus_machines(health(event_world(spark, sf_dir)))


@query(
    "n5_focus_machines_share",
    f"""SELECT {r6('(SELECT sum(failure_cost) FROM (SELECT * FROM v_health_e ORDER BY total_cost DESC, machine_id LIMIT 10)) / sum(failure_cost)')}
    AS share_of_failure_cost FROM v_health_e""",
)
def _(spark, sf_dir):
    return round6(N.focus_machines_share(health(event_world(spark, sf_dir))), ["share_of_failure_cost"])


block(
    "focus_components_l",
    """SELECT component, failures, failure_cost, saving_if_all_prevented, failure_cost / nullif(failures, 0) AS cost_per_failure,
  failure_cost / sum(failure_cost) OVER () AS failure_cost_share,
  saving_if_all_prevented / sum(saving_if_all_prevented) OVER () AS saving_share FROM v_component_l""",
)
FOCUS_COMP = ["cost_per_failure", "failure_cost_share", "saving_share"]


@query("n5_focus_components", rounded(FOCUS_COMP, "focus_components_l", ["component", "failures", "failure_cost", "saving_if_all_prevented"]))
def _(spark, sf_dir):
    return round6(N.focus_components(components(supply_world(spark, sf_dir))), FOCUS_COMP)


def _typed_reasons(w) -> DataFrame:
    """Alert rows of the rule with the errors behind them as reasons: the three most frequent codes."""
    counts = [F.struct(F.col(f"{e}_count_{W}{U}").alias("n"), F.lit(e).alias("name")) for e in w.p.error_types]
    ranked = F.reverse(F.sort_array(F.filter(F.array(*counts), lambda x: x["n"] > 0)))
    text = lambda i: F.when(F.size("_r") >= i, F.concat(F.get("_r", F.lit(i - 1))["name"], F.lit(" raised")))
    rows = w.event_features.join(w.predictions.where("out_of_sample AND alert").select(*w.p.keys, "predicted_component"), w.p.keys)
    return rows.withColumn("_r", ranked).select(
        "predicted_component", text(1).alias("reason_1"), text(2).alias("reason_2"), text(3).alias("reason_3")
    )


_codes = " UNION ALL ".join(
    f"SELECT machine_id, timestamp, 'error{i}' AS name, error{i}_count_{W}{U} AS n FROM event_features_e" for i in range(1, 6)
)


@query(
    "n6_warning_signatures",
    f"""WITH named AS (SELECT p.predicted_component, c.name, p.machine_id, p.timestamp FROM (
      SELECT *, row_number() OVER (PARTITION BY machine_id, timestamp ORDER BY n DESC, name DESC) AS k FROM ({_codes}) WHERE n > 0) AS c
      JOIN (SELECT * FROM predictions_e WHERE out_of_sample AND alert) AS p USING (machine_id, timestamp) WHERE c.k <= 3),
    totals AS (SELECT predicted_component, count(*) AS alerts FROM predictions_e WHERE out_of_sample AND alert GROUP BY 1)
    SELECT predicted_component AS component, name AS signal, {r6('n / alerts')} AS share_of_alerts
    FROM (SELECT predicted_component, name, count(*) AS n,
          row_number() OVER (PARTITION BY predicted_component ORDER BY count(*) DESC, name) AS k FROM named GROUP BY 1, 2)
    JOIN totals USING (predicted_component) WHERE k <= 2""",
)
def _(spark, sf_dir):
    return round6(N.warning_signatures(_typed_reasons(event_world(spark, sf_dir))), ["share_of_alerts"])


@query(
    "n9_headline_selections",
    f"""SELECT (SELECT count(*) FROM focus_lines_l WHERE above_fleet_average) AS lines_above_average,
    {r6("(SELECT sum(failures) / sum(machines) FROM focus_age_band_e WHERE age_band IN ('0-4 years', '5-9 years'))")} AS young_rate,
    {r6("(SELECT max(failures_per_machine) FROM focus_age_band_e WHERE age_band = '15+ years')")} AS oldest_rate,
    (SELECT model FROM focus_model_e ORDER BY failures_per_machine, model LIMIT 1) AS best_model,
    (SELECT model FROM focus_model_e ORDER BY failures_per_machine DESC, model DESC LIMIT 1) AS worst_model,
    (SELECT component FROM focus_components_l ORDER BY failure_cost DESC, component DESC LIMIT 1) AS top_component,
    (SELECT min(net_saving) > 0 FROM ({_grid_sql(N.CATCH_RATES, N.ALARM_COSTS, 0.5, 5000000.0)})) AS always_positive""",
)
def _(spark, sf_dir):
    w, e = supply_world(spark, sf_dir), event_world(spark, sf_dir)
    cards = health(e)
    out = N.headline_selections(
        _lines(w),
        N.focus_groups(cards, "age_band"),
        N.focus_groups(cards, "model"),
        N.focus_components(components(w)),
        N.sensitivity(_year(w), N.CATCH_RATES, N.ALARM_COSTS, 0.5, w.p.program_cost),
    )
    return round6(out, ["young_rate", "oldest_rate"])
