from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from fleetspark.params import HOUR_US
from fleetspark.plans import evaluate as E
from fleetspark.plans import models as M
from fleetspark.plans.boosting import scores_by_join
from fleetspark.plans.trees import Setting

DAY_US = 24 * HOUR_US


def rows(spark, frames, p, items):
    """(machine, hour, score, failure hour or None, components)"""
    data = []
    for m, h, score, f, comps in items:
        near = f is not None and h < f <= h + 24
        data.append(
            (m, frames.at(h), float(score), None if f is None else float(f - h), int(near), comps if near else "none", None if f is None else frames.at(f))
        )
    schema = f"machine_id bigint, timestamp timestamp_ntz, score double, hours_to_failure double, {p.target} tinyint, failed_component string, next_failure_at timestamp_ntz"
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="module")
def costs(spark):
    return spark.createDataFrame([("comp1", 100.0), ("comp2", 50.0)], "component string, saving_if_prevented double")


def openings(spark, frames, p, hours, cooldown=DAY_US):
    df = rows(spark, frames, p, [(1, h, 1.0, None, None) for h in hours])
    return [int((t - frames.at(0)) / timedelta(hours=1)) for t in frames.column(E.inspections(df, p, cooldown), "timestamp")]


def test_cool_down(spark, frames, p):
    assert openings(spark, frames, p, range(0, 24, 3)) == [0]
    assert openings(spark, frames, p, [0, 24]) == [0, 24]
    assert openings(spark, frames, p, [0, 23, 25, 48, 49]) == [0, 25, 49]


def test_cool_down_over_many_chunks(spark, frames, p):
    rng = random.Random(5)
    hours = sorted(rng.sample(range(600), 150))
    expected, cover = [], -1
    for h in hours:
        if h >= cover:
            expected.append(h)
            cover = h + 24
    assert openings(spark, frames, p, hours) == expected


def test_chosen_metrics_are_those_of_the_whole_evaluation(spark, frames, p, costs, monkeypatch):
    items = [(m, h, ((m * h) % 7) / 7, 90, "comp1+comp2") for m in (1, 2, 3) for h in range(0, 90, 3)]
    df = rows(spark, frames, p, items).withColumn("threshold", F.lit(0.5)).withColumn("model", F.concat(F.lit("m"), F.col("machine_id") % 2))
    names = ["net_saving", "pr_auc"]
    for by in ([], ["model"]):
        full = E.evaluate(df, costs, p, by).select(*by, *names).collect()
        with monkeypatch.context() as m:
            m.setattr(E, "exact_quantiles", None)  # the lead time is not asked for
            assert sorted(E.evaluate(df, costs, p, by, metrics=names).collect()) == sorted(full)


def test_evaluation_by_hand(spark, frames, p, costs):
    df = rows(
        spark, frames, p,
        [(1, 0, 0.9, 30, "comp1"), (1, 12, 0.2, 30, "comp1+comp2"), (1, 24, 0.8, 30, "comp1+comp2"), (1, 60, 0.7, None, None), (2, 0, 0.1, 20, "comp1")],
    ).withColumn("threshold", F.lit(0.5))
    r = E.evaluate(df, costs, p).first()
    assert (r["row_count"], r["positives"], r["alerts"]) == (5, 3, 3)
    assert r["precision"] == pytest.approx(1 / 3) and r["recall"] == pytest.approx(1 / 3)
    assert (r["failure_events"], r["events_caught"], r["median_lead_time_h"]) == (2, 1, 6.0)
    assert (r["inspections"], r["false_alarms"]) == (3, 2)
    assert r["caught_saving"] == 150.0 and r["potential_saving"] == 250.0
    assert r["net_saving"] == 150.0 - 2 * p.false_alarm_cost


def test_average_precision_groups_ties(spark, frames, p):
    df = rows(spark, frames, p, [(1, 0, 0.9, 10, "comp1"), (2, 0, 0.5, 10, "comp1"), (3, 0, 0.5, None, None), (4, 0, 0.1, None, None)])
    r = E.ranking(df, p.target).first()
    assert r["pr_auc"] == pytest.approx(0.5 * 1 + 0.5 * 2 / 3)
    assert r["roc_auc"] == pytest.approx((2 + 1.5) / 4)


def test_the_curve_equals_full_evaluation(spark, frames, p, costs):
    rng = random.Random(9)
    items = [(m, h, rng.choice([0.2, 0.4, 0.6, 0.8]), 40 if h < 40 else None, "comp1") for m in range(1, 5) for h in range(0, 90, 3)]
    df = rows(spark, frames, p, items)
    curve = {r["threshold"]: r for r in E.net_saving_curve(df, E.threshold_candidates(df), costs, p).collect()}
    assert sorted(curve) == pytest.approx([0.2, 0.4, 0.6, 0.8, 1.8])
    for t in (0.4, 0.8):
        full = E.evaluate(df.withColumn("threshold", F.lit(t)), costs, p).first()
        assert (curve[t]["events_caught"], curve[t]["false_alarms"], curve[t]["net_saving"]) == (
            full["events_caught"], full["false_alarms"], full["net_saving"],
        )


def test_ties_prefer_the_higher_threshold_and_never_can_win(spark):
    curve = spark.createDataFrame([(0.2, 5.0), (0.6, 9.0), (0.8, 9.0), (1.9, 0.0)], "threshold double, net_saving double")
    assert E.choose_threshold(curve).first()["threshold"] == 0.8
    losing = spark.createDataFrame([(0.2, -5.0), (1.9, 0.0)], "threshold double, net_saving double")
    assert E.choose_threshold(losing).first()["threshold"] == 1.9


def test_shuffle_is_a_permutation(spark, frames, p):
    df = rows(spark, frames, p, [(m, h, m * 100 + h, None, None) for m in (1, 2) for h in range(20)])
    got = M.shuffled(df, ["score"], p, 3).select("score", "_d_score").collect()
    assert sorted(r["_d_score"] for r in got) == sorted(r["score"] for r in got)
    assert any(r["_d_score"] != r["score"] for r in got)


def test_reasons_name_the_group_that_lowers_the_risk(spark, frames, p):
    feats = ["volt_mean_24h", "error1_count_24h"]
    df = spark.createDataFrame(
        [(1, frames.at(0), 200.0, 3.0), (2, frames.at(0), 170.0, 0.0)], "machine_id bigint, timestamp timestamp_ntz, volt_mean_24h double, error1_count_24h double"
    )
    profile = spark.createDataFrame(
        [(m, 160.0, 10.0, 0.0, 1.0) for m in (1, 2)],
        "machine_id bigint, volt_mean_24h__median double, volt_mean_24h__std double, error1_count_24h__median double, error1_count_24h__std double",
    )
    score = lambda d: d.withColumn("score", F.least(F.lit(1.0), F.col("error1_count_24h") * 0.2 + (F.col("volt_mean_24h") - 160) * 0.002))
    out = {r["machine_id"]: r for r in M.explain_rows(df, feats, score, profile, p).collect()}
    assert out[1]["reason_1"] == "error1 raised 3 times in the last 24 h (normal 0)"
    assert out[1]["reason_2"] == "voltage 24 h mean 200.0 vs normal 160.0 (+25%)"
    assert out[1]["reason_2_group"] == "voltage" and out[1]["reason_3"] is None
    assert out[2]["reason_1"] == M.NO_REASON


def test_small_model_learns(spark, frames, p):
    rng = random.Random(4)
    data = [(m, frames.at(h), float(rng.random()), "model1") for m in range(1, 6) for h in range(0, 120, 3)]
    df = spark.createDataFrame(data, "machine_id bigint, timestamp timestamp_ntz, x double, model string")
    df = df.withColumn(p.target, (F.col("x") > 0.7).cast("tinyint"))
    model = M.fit(df, ["x", "model"], p.target, p, Setting(rounds=3, depth=2))
    scored = M.scorer(model)(df)
    assert E.ranking(scored, p.target).first()["pr_auc"] > 0.95
    joined = {(r["machine_id"], r["timestamp"]): r["score"] for r in scores_by_join(df, model, M.MODEL, p.keys).collect()}
    assert joined == {(r["machine_id"], r["timestamp"]): r["score"] for r in scored.collect()}


@pytest.mark.parametrize("n", [1, 100, 200, 201, 1000])
def test_one_threshold_rule_for_every_number_of_scores(spark, n):
    df = spark.range(n).selectExpr("id / 7 AS score")
    got = sorted(r["threshold"] for r in E.threshold_candidates(df, 200).collect())
    places = {max(1, -(-n * m // 1_000_000)) for m in E.candidate_shares(200)}
    assert got == pytest.approx([*[(k - 1) / 7 for k in sorted(places)], (n - 1) / 7 + 1])
    assert len(got) <= 201 and (n > 100 or len(got) == n + 1)


def test_inspections_of_one_entity_with_very_many_alerts(spark, p):
    """A cover goes through three levels of blocks; long gaps leave chunks and blocks without alerts."""
    rng = random.Random(7)
    hours, at = [], 0.0
    for _ in range(100_000):
        at += rng.choice([0.01, 0.2, 0.3, 0.9]) if rng.random() > 0.0005 else rng.choice([24, 300, 2000])
        hours.append(at)
    us = sorted({round(h * HOUR_US) for h in hours})
    df = spark.createDataFrame([(1, u) for u in us], "machine_id bigint, us bigint").select(
        "machine_id", F.timestamp_micros("us").cast("timestamp_ntz").alias("timestamp"), F.lit(0).cast("tinyint").alias(p.target)
    )
    got = E.inspections(df, p.for_events(), DAY_US).select(F.unix_micros(F.col("timestamp").cast("timestamp")).alias("us"))
    expected, cover = [], -1
    for u in us:
        if u >= cover:
            expected.append(u)
            cover = u + DAY_US
    assert sorted(r["us"] for r in got.collect()) == expected


def test_one_walk_gives_the_false_alarms_of_every_threshold(spark, frames, p):
    rng = random.Random(8)
    items = [(m, h, round(rng.random(), 2), h + 5 if rng.random() < 0.2 else None, "comp1") for m in (1, 2, 3) for h in range(0, 300, 3)]
    df = rows(spark, frames, p, items)
    grid = [0.1, 0.25, 0.5, 0.77, 0.99, 2.0]
    got = {r["threshold"]: r["false_alarms"] for r in E.false_alarms(df, grid, p, DAY_US).collect()}
    for t in grid:
        opened = E.inspections(df.where(F.col("score") >= t), p, DAY_US)
        assert got[t] == opened.where("not failure_followed").count()
    assert {r["false_alarms"] for r in E.false_alarms(df.limit(0), grid, p, DAY_US).collect()} <= {0}
