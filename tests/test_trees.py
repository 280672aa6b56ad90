"""The kernels of boosted trees against their definitions, and what scoring and explaining send through Python."""

from __future__ import annotations

import random
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetspark.plans import boosting as B
from fleetspark.plans import models as M
from fleetspark.plans import trees as R
from fleetspark.plans.boosting import Task, train


def inputs(n, k, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, k)).round(2)
    x[:, ::2] = np.floor(np.abs(x[:, ::2]) * 3)
    x[rng.random((n, k)) < 0.1] = np.nan
    x[:, k - 1] = np.nan
    y = (np.nan_to_num(x[:, 0]) + np.nan_to_num(x[:, 1]) + rng.normal(size=n) > 1).astype(float)
    return x, y


@pytest.mark.parametrize("n", [50, R.FEW + 1, R.PACKED + 100])
def test_joint_histograms_are_the_sums_of_each_input(n):
    rng = np.random.default_rng(n)
    k, width, nodes = 5, 9, 4
    bins = np.stack([rng.integers(0, size, n) for size in (9, 1, 9, 4, 2)]).astype(np.uint16)
    own = rng.integers(0, nodes, n)
    g = rng.integers(-R.SCALE, R.SCALE + 1, n).astype(float)
    h = np.full(n, R.SCALE / 4)
    made = R.Histograms(bins, width)
    got = made.of(None, own, nodes, g, h)
    for j in range(k):
        for which, weight in enumerate((g, h, np.ones(n))):
            assert np.array_equal(got[which, :, j], np.bincount(own * width + bins[j], weight, nodes * width).reshape(nodes, width))
    parents = made.of(None, own >> 1, nodes // 2, g, h)
    assert np.array_equal(made.children(parents, np.arange(n), own, g, h), got)


@pytest.mark.parametrize("depth", [3, 5, 9])
def test_scores_follow_each_row_down_each_tree(depth):
    x, y = inputs(600, 6)
    models = [R.grow(x, y, R.Setting(rounds=5, depth=d, least=1)) for d in (2, depth)]
    x[0], x[1], x[2] = np.inf, -np.inf, np.nan
    for m, got in zip(models, R.Scores(models, 6).of(x, rows=250), strict=True):
        totals = []
        for row in x:
            total = 0
            for f, c, v in zip(m.feature, m.cut, m.value, strict=True):
                n = 1
                while f[n] >= 0:
                    n = 2 * n + (0 if np.isnan(row[f[n]]) or row[f[n]] <= c[n] else 1)
                total += int(v[n])
            totals.append(total)
        assert np.array_equal(got, R.chance(np.array(totals)))


def test_only_inputs_go_to_python_and_a_filter_scores_once(spark, frames, p):
    rng = random.Random(4)
    data = [(m, frames.at(h), float(rng.random()), "unused") for m in range(1, 6) for h in range(0, 60, 3)]
    df = spark.createDataFrame(data, "machine_id bigint, timestamp timestamp_ntz, x double, note string")
    df = df.withColumn(p.target, (F.col("x") > 0.7).cast("tinyint"))
    forest = M.fit(df, ["x"], p.target, p, R.Setting(rounds=2, depth=2))
    scored = M.scorer(forest)(df).where(F.col("score") >= 0.3).select("machine_id", "score")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("ArrowEvalPython") == 1, plan
    assert scored.count() > 0


def test_only_chosen_inputs_are_put_into_words(spark, frames, p, monkeypatch):
    """The sentence of an input is asked for under the condition that it is the chosen one."""
    feats = ["error1_count_24h", "error2_count_24h"]
    described = M.describe
    refuse = lambda f, q: F.when(F.col(f) == 0, F.raise_error(F.lit("not chosen")).cast("string")).otherwise(described(f, q))
    monkeypatch.setattr(M, "describe", refuse)
    schema = "machine_id bigint, timestamp timestamp_ntz, error1_count_24h double, error2_count_24h double"
    df = spark.createDataFrame([(1, frames.at(0), 3.0, 0.0), (2, frames.at(0), 0.0, 2.0)], schema)
    profile = spark.createDataFrame(
        [(m, 0.0, 1.0, 0.0, 1.0) for m in (1, 2)], "machine_id bigint, " + ", ".join(f"{f}__{m} double" for f in feats for m in ("median", "std"))
    )
    score = lambda d: d.withColumn("score", (F.col(feats[0]) + F.col(feats[1])) * 0.2)
    out = {r["machine_id"]: r["reason_1"] for r in M.explain_rows(df, feats, score, profile, p).collect()}
    assert out == {1: "error1 raised 3 times in the last 24 h (normal 0)", 2: "error2 raised 2 times in the last 24 h (normal 0)"}


def test_inputs_of_rows_outside_the_share_are_not_read(spark, p):
    from dataclasses import replace

    p, n = replace(p, boosting_rows=300), 3000
    rows = spark.range(n).select(
        F.col("id").alias("machine_id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("timestamp"), (F.col("id") % 2).alias("y"), F.lit("fit").alias("part")
    )
    taught = F.pmod(F.xxhash64(*p.keys), F.lit(1 << 32)) < (300 << 32) // n
    rows = rows.withColumn("x", F.when(taught, F.col("machine_id").cast("double")).otherwise(F.raise_error(F.lit("an input was read")).cast("double")))
    tasks = {"a": Task("y", F.col("part") == "fit", R.Setting(rounds=1)), "b": Task("y", F.col("part") == "other", R.Setting(rounds=1))}
    assert train(rows, ["x"], tasks, p).nodes.select("name").distinct().collect() == [("a",)]


def relation(forest):
    return {(r["name"], r["tree"], r["node"]): (r["feature"], r["cut"], r["value"]) for r in forest.nodes.collect()}


def test_a_model_learns_from_all_rows(spark, p):
    """More rows than one task takes: the trees are those that numpy grows from every one of them."""
    n = 260_000
    df = spark.range(n).select(F.col("id").alias("machine_id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("timestamp"), ((F.col("id") * 7919) % 1000 / 8).alias("u"), (F.sqrt("id")).alias("v"))
    df = df.withColumn("y", ((F.col("u") > 60) & (F.col("v") % 3 < 2)).cast("int"))
    setting = R.Setting(rounds=2, depth=3)
    got = train(df, ["u", "v"], {"a": Task("y", F.lit(True), setting)}, p)
    rows = df.select("u", "v", "y").toPandas()
    own = B._nodes("a", R.grow(rows[["u", "v"]].to_numpy(float), rows["y"].to_numpy(float), setting)).to_pylist()
    assert relation(got) == {(r["name"], r["tree"], r["node"]): (r["feature"], r["cut"], r["value"]) for r in own}


def test_trees_do_not_depend_on_the_tasks_that_grow_them(spark, p, monkeypatch):
    """Several tasks, models of other rows, depths, rounds and bins, missing values, an input without any value."""
    x, y = inputs(3000, 5)
    data = [(i, *[None if np.isnan(v) else float(v) for v in row], int(t)) for i, (row, t) in enumerate(zip(x, y, strict=True))]
    features = [f"x{j}" for j in range(5)]
    df = spark.createDataFrame(data, "machine_id bigint, " + ", ".join(f"{f} double" for f in features) + ", y int")
    df = df.withColumn("timestamp", F.timestamp_seconds("machine_id").cast("timestamp_ntz"))
    df = df.withColumn("z", F.when(F.col("machine_id") % 3 != 0, 1 - F.col("y")))
    some = F.col("machine_id") < 2000
    tasks = {
        "a": Task("y", some, R.Setting(rounds=6, depth=3)),
        "b": Task("y", some, R.Setting(rounds=9, depth=5, least=5)),
        "c": Task("z", some, R.Setting(rounds=4, depth=2)),
        "d": Task("y", some, R.Setting(rounds=4, depth=4, bins=16)),
        "e": Task("y", F.lit(False), R.Setting(rounds=2)),
    }
    alone = relation(train(df, features, tasks, p))
    monkeypatch.setattr(B, "ALONE", 100)
    monkeypatch.setattr(B, "EACH", 900)
    assert relation(train(df, features, tasks, p)) == alone
    assert {name for name, *_ in alone} == {"a", "b", "c", "d"}


def test_sums_of_tasks_are_added_exactly():
    rng = np.random.default_rng(5)
    parts = [[rng.integers(-(1 << 50), 1 << 50, (3, 2, 4)).astype(float), rng.integers(0, 3, 2).astype(float), np.array([[-1.0], [127.0], [-129.0]])] for _ in range(4)]
    got = R.added([R.written(part) for part in parts], parts[0])
    assert all(np.array_equal(g, sum(part[i] for part in parts)) for i, g in enumerate(got))


def test_cut_points_of_all_tasks_are_those_of_all_rows():
    x, _ = inputs(700, 6)
    x[:3, 0] = np.inf, -np.inf, -1e-300
    whole = [R.cut_points(c, 64) for c in x.T]
    parts = [R.shared_cut_points(x, 64, lambda sums: sums)]
    barrier, told = threading.Barrier(2), {}

    def shared(me, rows, out):
        def exchange(sums):
            told[me] = sums
            barrier.wait()
            total = [p + q for p, q in zip(told[0], told[1], strict=True)]
            barrier.wait()
            return total

        out[me] = R.shared_cut_points(rows, 64, exchange)

    out = {}
    threads = [threading.Thread(target=shared, args=(i, rows, out)) for i, rows in enumerate((x[:300], x[300:]))]
    [t.start() for t in threads]
    [t.join() for t in threads]
    for made in (*parts, out[0], out[1]):
        assert all(np.array_equal(c, w) for c, w in zip(made, whole, strict=True))
