from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetspark.functions.ordered import exact_quantiles, global_rank, medians, ranges, share_of_total


def test_rank_shares_ties_and_leaves_gaps(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5.0, 1.0, 5.0, None, 3.0])], "i int, v double")
    got = {r["i"]: r["r"] for r in global_rank(df, [("v", True)], "r").collect()}
    assert got == {0: 1, 2: 1, 4: 3, 1: 4, 3: 5}


def test_rank_on_two_columns_with_a_dominant_value(spark):
    rng = random.Random(1)
    rows = [(i, 1.0 if rng.random() < 0.5 else round(rng.random(), 2), rng.randrange(3)) for i in range(400)]
    df = spark.createDataFrame(rows, "i int, a double, b int")
    got = {r["i"]: r["r"] for r in global_rank(df, [("a", True), ("b", False)], "r").collect()}
    for i, a, b in rows:
        assert got[i] == 1 + sum(1 for _, x, y in rows if x > a or (x == a and y < b))


def test_quantiles_interpolate(spark):
    rng = random.Random(2)
    rows = [(g, rng.choice([0.0, rng.random() * 100])) for g in "ab" for _ in range(137)]
    df = spark.createDataFrame(rows, "g string, v double")
    probabilities = [0.0, 0.1, 0.5, 0.99, 1.0]
    for r in exact_quantiles(df, "v", probabilities, ["g"]).collect():
        values = [v for g, v in rows if g == r["g"]]
        assert r["quantile"] == pytest.approx(np.quantile(values, r["probability"]))


def test_shares(spark):
    df = spark.createDataFrame([(1,), (3,)], "n int")
    assert sorted(r["s"] for r in share_of_total(df, {"s": "n"}).collect()) == [0.25, 0.75]


def test_ties_of_the_first_column_are_spread_by_the_next_ones(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 10 < 9, 1.0).otherwise(F.rand(3)).alias("x"), F.xxhash64("id").alias("y"), "id")
    sizes = [r["count"] for r in ranges(df, [("x", True), ("y", False)]).groupBy("_bucket").count().collect()]
    assert len(sizes) > 4 and max(sizes) <= 2 * 20_000 / len(sizes)
    ranked = global_rank(df, [("x", True), ("y", False)], "place", unique=True)
    got = [r["place"] for r in ranked.orderBy(F.desc("x"), "y").collect()]
    assert got == list(range(1, 20_001))


def test_medians_of_many_columns_and_groups(spark):
    """One group holds most rows; groups without values, ties, and null keys have their medians too."""
    rng = random.Random(6)
    rows = [("hot", rng.gauss(0, 1), rng.randrange(3), None) for _ in range(40_000)]
    rows += [(g, rng.choice([None, rng.random()]), rng.randrange(5), 1.5) for g in ["a", "b", None] for _ in range(rng.randint(30, 60))]
    rows += [("one", 2.0, None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y int, z double").repartition(6)
    got = {r["g"]: (r["x"], r["y"], r["z"]) for r in medians(df, ["x", "y", "z"], ["g"]).collect()}
    assert set(got) == {"hot", "a", "b", None, "one"}
    for g, found in got.items():
        for k, value in enumerate(found, 1):
            values = [r[k] for r in rows if r[0] == g and r[k] is not None]
            assert value == (pytest.approx(np.median(values), abs=1e-12) if values else None)
