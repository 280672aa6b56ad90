"""Queries of the trained models (rows only) and of the explanations (with SQL for a rule)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.functions.staging import stage
from fleetspark.functions.times import ntz
from fleetspark.operators.timejoin import by_step
from fleetspark.plans import checks as C
from fleetspark.plans import evaluate as E
from fleetspark.plans import models as M
from fleetspark.plans import scoring
from fleetspark.plans.boosting import Forest
from fleetspark.plans.features import catalogue
from fleetspark.plans.labels import feature_columns
from fleetspark.suite.blocks import COMPS, ERRORS, RISK, U, W, P, each
from fleetspark.suite.boosted import FEATURES, Judged, boosted_blocks
from fleetspark.suite.judging import METRIC_FLOATS, ROW, _flagged, baselines, curve_blocks, judged_blocks
from fleetspark.suite.layers import round6
from fleetspark.suite.registry import block, query, r6
from fleetspark.suite.worlds import event_world

class Trained:
    """Models of one world, trained once per session."""

    def __init__(self, w):
        self.w, self.p = w, w.p

    @cached_property
    def parts(self) -> DataFrame:
        return stage(self.w.parts, "model_parts")

    @cached_property
    def features(self) -> list[str]:
        return feature_columns(self.w.ml_dataset.columns, self.p)

    @cached_property
    def failure(self) -> M.FailureModel:
        return M.train_failure_model(self.parts, self.features, self.w.costs, self.p)

    @cached_property
    def components(self) -> Forest:
        return M.train_component_models(self.parts, self.features, self.p)

    @cached_property
    def tried_components(self) -> Forest:
        return M.train_component_models(self.parts, self.features, self.p, "fit")

    @cached_property
    def profile(self) -> DataFrame:
        return M.normal_profile(self.parts.where("part = 'development'"), self.features, self.p)

    @cached_property
    def risks(self) -> DataFrame:
        rows = M.component_risks(self.parts.where("part = 'test'"), self.components, self.p)
        return stage(rows, "component_risks")


_trained: dict = {}


def trained(spark, sf_dir) -> Trained:
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _trained:
        _trained[key] = Trained(event_world(spark, sf_dir))
    return _trained[key]


_actual = [f"{c}_fails_within_{P.horizon}{U}" for c in COMPS]
_first = "CASE " + " ".join(f"WHEN {a} = 1 THEN '{c}'" for a, c in zip(_actual, COMPS, strict=True)) + " END"
block(
    "frequency_m",
    f"""SELECT count(*) AS rows_before_failure,
    {r6('avg(CAST(CASE top ' + ' '.join(f"WHEN '{c}' THEN {a}" for a, c in zip(_actual, COMPS, strict=True)) + ' END AS DOUBLE))')} AS top1_accuracy,
    {r6('avg(CAST((' + ' AND '.join(f'({c}_share >= 0.5) = ({a} = 1)' for a, c in zip(_actual, COMPS, strict=True)) + ') AS INTEGER))')} AS exact_set_accuracy
    FROM parts_e, (SELECT *, CASE greatest({each('{x}_share', COMPS)}) {' '.join(f"WHEN {c}_share THEN '{c}'" for c in COMPS)} END AS top FROM (
      SELECT {', '.join(f'avg({a}) AS {c}_share' for a, c in zip(_actual, COMPS, strict=True))} FROM parts_e WHERE part = 'fit' AND {P.target} = 1))
    WHERE part = 'test' AND {P.target} = 1""",
)

# ---------------------------------------------------------------- SQL that trains the same models

SETTINGS = M.settings(P)
FAILURE = {f"candidate {i}": Judged(P.target, s) for i, s in enumerate(SETTINGS)}
boosted_blocks("tried", "fit", "validation", FAILURE)
for _m in range(len(SETTINGS)):
    curve_blocks(
        f"tried_{_m}", f"SELECT {ROW}, score FROM parts_e JOIN (SELECT * FROM scores_tried WHERE m = {_m}) USING (machine_id, timestamp) WHERE part = 'validation'"
    )
block(
    "chosen_m",
    "SELECT m, threshold FROM ("
    + " UNION ALL ".join(
        f"""SELECT {m} AS m, (SELECT max(net_saving) FROM curve_tried_{m}) AS net_saving,
  (SELECT max(threshold) FROM curve_tried_{m} WHERE net_saving = (SELECT max(net_saving) FROM curve_tried_{m})) AS threshold,
  (SELECT coalesce(sum(pos * hits / called) / nullif(sum(pos), 0), 0) FROM (
    SELECT pos, sum(pos) OVER w AS hits, sum(n) OVER w AS called FROM (
      SELECT score, count(*) FILTER (WHERE {P.target} = 1) AS pos, count(*) AS n FROM val_tried_{m} GROUP BY score) WINDOW w AS (ORDER BY score DESC))) AS ap"""
        for m in range(len(SETTINGS))
    )
    + ") ORDER BY net_saving DESC, ap DESC, m LIMIT 1",
)
boosted_blocks("final", "development", "test", FAILURE, "m = (SELECT m FROM chosen_m)")
block("tested_m", f"SELECT {ROW}, score, threshold FROM chosen_m, parts_e JOIN scores_final USING (machine_id, timestamp) WHERE part = 'test'")
judged_blocks("m", "tested_m", [])


@query("m9_failure_model", "SELECT * FROM metrics_m")
def _(spark, sf_dir):
    t = trained(spark, sf_dir)
    return round6(E.evaluate(t.failure.test, t.w.costs, t.p), METRIC_FLOATS)


# Two orders of the fit rows by digests of their keys; each row takes the label of the row at its place in the other one.
_order = lambda s: f"row_number() OVER (ORDER BY ('0x' || md5('{s}|' || machine_id || '|' || epoch_us(timestamp))[1:13])::BIGINT, machine_id, timestamp)"
block(
    "shuffled_e",
    f"""SELECT p.*, coalesce(d.label, 0) AS mixed FROM parts_e AS p LEFT JOIN (
  SELECT a.machine_id, a.timestamp, b.label, 'fit' AS part
  FROM (SELECT machine_id, timestamp, {_order(P.seed)} AS place FROM parts_e WHERE part = 'fit') AS a
  JOIN (SELECT {P.target} AS label, {_order(P.seed + 1)} AS place FROM parts_e WHERE part = 'fit') AS b USING (place)) AS d USING (machine_id, timestamp, part)""",
)
boosted_blocks("mixed", "fit", "validation", {k: Judged("mixed", j.setting) for k, j in FAILURE.items()}, "m = (SELECT m FROM chosen_m)", "shuffled_e")


@query(
    "m10_shuffled_label_check",
    f"""SELECT {r6('ap')} AS pr_auc, {r6('chance')} AS chance_pr_auc, ap < {M.SHUFFLED_TOLERANCE} * chance AS passed FROM (
  SELECT sum(pos * hits / called) / sum(pos) AS ap, sum(pos) / sum(n) AS chance FROM (
    SELECT pos, n, sum(pos) OVER w AS hits, sum(n) OVER w AS called FROM (
      SELECT score, count(*) FILTER (WHERE {P.target} = 1) AS pos, count(*) AS n
      FROM parts_e JOIN scores_mixed USING (machine_id, timestamp) WHERE part = 'validation' GROUP BY score) WINDOW w AS (ORDER BY score DESC)))""",
)
def _(spark, sf_dir):
    t = trained(spark, sf_dir)
    return round6(M.shuffled_label_check(t.parts, t.features, t.p, t.failure.setting), ["pr_auc", "chance_pr_auc"])


_ranked = [f"{c}_risk" for c in COMPS]


def diagnosed(name: str, learn: str, other: str) -> str:
    """Blocks of the component models learned from one part, and SQL of their diagnosis of another."""
    boosted_blocks(name, learn, other, {c: Judged(P.component_target(c), SETTINGS[0]) for c in COMPS})
    block(
        f"diagnosed_{name}",
        f"""SELECT *, CASE greatest({', '.join(_ranked)}) {' '.join(f"WHEN {x} THEN '{c}'" for x, c in zip(_ranked, COMPS, strict=True))} END AS top
FROM (SELECT machine_id, timestamp, {', '.join(f"max(score) FILTER (WHERE m = {i}) AS {x}" for i, x in enumerate(_ranked))} FROM scores_{name} GROUP BY 1, 2)
JOIN parts_e USING (machine_id, timestamp) WHERE part = '{other}' AND {P.target} = 1""",
    )
    return f"""SELECT count(*) AS rows_before_failure, {r6('coalesce(avg(top_hit), 0)')} AS top1_accuracy, {r6('coalesce(avg(exact), 0)')} AS exact_set_accuracy
FROM (SELECT CAST(CASE top {' '.join(f"WHEN '{c}' THEN {P.component_target(c)}" for c in COMPS)} END AS DOUBLE) AS top_hit,
  CAST(({' AND '.join(f'({c}_risk >= 0.5) = ({P.component_target(c)} = 1)' for c in COMPS)}) AS INTEGER) AS exact FROM diagnosed_{name})"""


DIAGNOSIS = diagnosed("parts", "development", "test")
TRIED_DIAGNOSIS = diagnosed("tried_parts", "fit", "validation")


@query("m21_component_flow", f"SELECT *, 'validation' AS part FROM ({TRIED_DIAGNOSIS}) UNION ALL SELECT *, 'test' FROM ({DIAGNOSIS})")
def _(spark, sf_dir):
    t = trained(spark, sf_dir)
    out = M.component_flow(t.parts, t.tried_components, t.components, t.p)
    return round6(out, ["top1_accuracy", "exact_set_accuracy"])


@query("m11_component_diagnosis", f"SELECT *, 'component' AS model FROM ({DIAGNOSIS}) UNION ALL SELECT *, 'frequency' FROM frequency_m")
def _(spark, sf_dir):
    t = trained(spark, sf_dir)
    base = M.frequency_risks(t.parts.where("part = 'test'"), t.parts.where("part = 'fit'"), t.p)
    out = (
        M.evaluate_diagnosis(t.risks, t.p)
        .withColumn("model", F.lit("component"))
        .unionByName(M.evaluate_diagnosis(base, t.p).withColumn("model", F.lit("frequency")))
    )
    return round6(out, ["top1_accuracy", "exact_set_accuracy"])


@query(
    "m11_confusion",
    f"""SELECT a.actual, {each("count(d.top) FILTER (WHERE d.top = '{x}') AS {x}", COMPS)}
    FROM (SELECT unnest({list(COMPS)}) AS actual) AS a
    LEFT JOIN (SELECT top, CASE {' '.join(f"WHEN {P.component_target(c)} = 1 THEN '{c}'" for c in COMPS)} END AS actual FROM diagnosed_parts
      WHERE {' + '.join(P.component_target(c) for c in COMPS)} = 1) AS d USING (actual) GROUP BY 1""",
)
def _(spark, sf_dir):
    t = trained(spark, sf_dir)
    return M.confusion(t.risks, t.p)


@query(
    "f16_confusion_of_shares",
    f"""SELECT c.actual, {each("CAST(coalesce(sum(CAST(predicted_component = '{x}' AS INTEGER)), 0) AS BIGINT) AS {x}", COMPS)}
    FROM (SELECT unnest(['comp1', 'comp2', 'comp3', 'comp4']) AS actual) AS c LEFT JOIN (
      SELECT {_first} AS actual, p.predicted_component FROM dataset_e JOIN predictions_e AS p USING (machine_id, timestamp)
      WHERE split = 'test' AND {P.target} = 1 AND {' + '.join(_actual)} = 1) USING (actual) GROUP BY 1""",
)
def _(spark, sf_dir):
    """Confusion of the rule's component shares, which SQL can reproduce."""
    w = event_world(spark, sf_dir)
    risks = w.predictions.select(*w.p.keys, *[f"{c}_risk" for c in w.p.components])
    return M.confusion(by_step(w.ml_dataset.where("split = 'test'"), risks, w.p.keys), w.p)


@query("m11_frequency_baseline", "SELECT * FROM frequency_m")
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    risks = M.frequency_risks(w.parts.where("part = 'test'"), w.parts.where("part = 'fit'"), w.p)
    return round6(M.evaluate_diagnosis(risks, w.p), ["top1_accuracy", "exact_set_accuracy"])


# ---------------------------------------------------------------- explanations of the rule

ERROR_COLUMNS = [*[f"{e}_count_{W}{U}" for e in ERRORS], f"errors_total_{W}{U}"]
_rows = f"SELECT * FROM parts_e WHERE part = 'development' AND {P.target} = 0"
PROFILED = [f for f in FEATURES if catalogue(P)[f].group in M.LOCAL_GROUPS]
block(
    "normal_e",
    f"""SELECT machine_id, {each('median(CAST({x} AS DOUBLE)) AS {x}__median', PROFILED)},
    {each('coalesce(nullif(stddev_samp(CAST({x} AS DOUBLE)), 0), nullif(any_value({x}__fleet), 0), 1.0::DOUBLE) AS {x}__std', PROFILED)}
    FROM ({_rows}) CROSS JOIN (SELECT {each('stddev_samp(CAST({x} AS DOUBLE)) AS {x}__fleet', PROFILED)} FROM ({_rows})) GROUP BY machine_id""",
)


@query(
    "m14_normal_profile",
    f"SELECT machine_id, {each(r6('{x}__median') + ' AS {x}__median', PROFILED)}, {each(r6('{x}__std') + ' AS {x}__std', PROFILED)} FROM normal_e",
)
def _(spark, sf_dir):
    """Every input that reasons can name."""
    w = event_world(spark, sf_dir)
    out = M.normal_profile(w.parts.where("part = 'development'"), PROFILED, w.p)
    return round6(out, [f"{c}__{m}" for c in PROFILED for m in ("median", "std")])


def _rule(p):
    return lambda rows: rows.withColumn("score", scoring.rule_risk(p))


def _explained(w) -> DataFrame:
    alerts = w.scored.where("split = 'test' AND score >= 0.5")
    profile = M.normal_profile(w.parts.where("part = 'development'"), ERROR_COLUMNS, w.p)
    return M.explain_rows(alerts, ERROR_COLUMNS, _rule(w.p), profile, w.p)


_total = f"errors_total_{W}{U}"
_zs = [f"coalesce(round(abs(d.{c} - n.{c}__median) / n.{c}__std, 9), -1)" for c in ERROR_COLUMNS]
_names = [*ERRORS, "errors (all types)"]
_text = lambda c, n: (
    f"'{n} raised ' || d.{c} || CASE WHEN d.{c} = 1 THEN ' time' ELSE ' times' END || ' in the last {W} {U} (normal ' || CAST(round_even(n.{c}__median, 0) AS BIGINT) || ')'"
)
block(
    "explained_e",
    f"""SELECT machine_id, timestamp, failed_component, {P.target}, risk, CASE WHEN drop_1 >= 0.05 THEN drop_1 END AS risk_drop_1,
    CASE WHEN drop_1 >= 0.05 THEN 'errors' END AS reason_1_group, CASE WHEN drop_1 >= 0.05 THEN what.t ELSE '{M.NO_REASON}' END AS reason_1,
    CASE WHEN drop_1 >= 0.05 THEN what.n END AS reason_1_input
    FROM (SELECT d.machine_id, d.timestamp, d.failed_component, d.{P.target}, {RISK.replace(_total, 'd.' + _total)} AS risk,
      {RISK.replace(_total, 'd.' + _total)} - {RISK.replace(_total, 'n.' + _total + '__median')} AS drop_1,
      CASE greatest({', '.join(_zs)}) {' '.join(f"WHEN {z} THEN {{'t': {_text(c, n)}, 'n': '{n}'}}" for z, c, n in zip(_zs, ERROR_COLUMNS, _names, strict=True))} END AS what
    FROM dataset_e AS d LEFT JOIN normal_e AS n USING (machine_id) WHERE d.split = 'test' AND {RISK.replace(_total, 'd.' + _total)} >= 0.5)""",
)


@query(
    "m15_alert_reasons",
    f"SELECT machine_id, timestamp, {r6('risk')} AS risk, {r6('risk_drop_1')} AS risk_drop_1, reason_1_group, reason_1, reason_1_input FROM explained_e",
)
def _(spark, sf_dir):
    out = _explained(event_world(spark, sf_dir)).select(
        "machine_id", "timestamp", "risk", "risk_drop_1", "reason_1_group", "reason_1", "reason_1_input"
    )
    return round6(out, ["risk", "risk_drop_1"])


@query(
    "m17_reason_inputs",
    f"""SELECT failed_component, reason_1_input AS input, round(CAST(count(*) / any_value(alerts) AS DECIMAL(18, 9)), 3)::DOUBLE AS share_of_alerts
    FROM explained_e JOIN (SELECT failed_component, count(*) AS alerts FROM explained_e WHERE {P.target} = 1 GROUP BY 1) USING (failed_component)
    WHERE {P.target} = 1 AND reason_1_input IS NOT NULL GROUP BY ALL""",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return M.reason_inputs_by_component(_explained(w), w.ml_dataset, w.p)


@query("m15_model_reasons")
def _(spark, sf_dir):
    t = trained(spark, sf_dir)
    score = t.failure.score
    alerts = score(t.parts.where("part = 'test'")).where(F.col("score") >= t.failure.threshold)
    return M.explain_rows(alerts, t.features, score, t.profile, t.p)


@query("m16_group_importance")
def _(spark, sf_dir):
    t = trained(spark, sf_dir)
    score = t.failure.score
    return M.group_importance(t.parts.where("part = 'test'"), t.features, score, t.p)


@query("m18_score_all")
def _(spark, sf_dir):
    t = trained(spark, sf_dir)
    rows = by_step(t.w.sensor_features, t.w.event_features, t.p.keys)
    return M.score_all(rows, t.failure, t.components, t.w.anomaly_model, t.profile, t.p, ntz(t.p.train_end))


@query(
    "k55_model_comparison",
    f"""SELECT *, result > baseline AS beats_baseline FROM (
    SELECT 'failure' AS model, 'net_saving' AS metric, net_saving::DOUBLE AS result, (SELECT max(net_saving) FROM metrics_b WHERE part = 'test')::DOUBLE AS baseline FROM metrics_m
    UNION ALL SELECT 'component', 'top1', top1_accuracy, (SELECT top1_accuracy FROM frequency_m) FROM ({DIAGNOSIS})
    UNION ALL SELECT 'anomaly', 'lift_48h', lift_48h, {scoring.MIN_LIFT}::DOUBLE FROM anomaly_metrics_e)""",
)
def _(spark, sf_dir):
    t = trained(spark, sf_dir)
    rule = E.evaluate(baselines(t.w).where("part = 'test'"), t.w.costs, t.p, ["model", "part"]).agg(
        F.max("net_saving").alias("baseline")
    )
    failure = E.evaluate(t.failure.test, t.w.costs, t.p).select(F.col("net_saving").alias("value")).crossJoin(F.broadcast(rule))
    frequency = M.frequency_risks(t.parts.where("part = 'test'"), t.parts.where("part = 'fit'"), t.p)
    top1 = lambda df, n: M.evaluate_diagnosis(df, t.p).select(F.col("top1_accuracy").alias(n))
    component = top1(t.risks, "value").crossJoin(F.broadcast(top1(frequency, "baseline")))
    anomaly = E.evaluate_anomalies(_flagged(t.w), t.p).select(
        F.col("lift_48h").alias("value"), F.lit(scoring.MIN_LIFT).alias("baseline")
    )
    return round6(C.model_comparison(failure, component, anomaly), ["result", "baseline"])
