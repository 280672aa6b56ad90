from __future__ import annotations

from datetime import timedelta
from statistics import mean, stdev

import pytest
from pyspark.sql import functions as F

from fleetspark.operators import cleaning
from fleetspark.plans import checks, features, labels


@pytest.fixture(scope="module")
def machines(spark):
    rows = [(1, "model1", 3, "P1", "Plant", "City", "L1"), (2, "model2", 8, "P1", "Plant", "City", "L2")]
    return spark.createDataFrame(
        rows,
        "machine_id bigint, model string, age bigint, plant_id string, plant_name string, city string, line_id string",
    )


@pytest.fixture(scope="module")
def silver(frames, p):
    values = [float(10 + (i * 7) % 13) for i in range(60)]
    return cleaning.clean(frames.readings(frames.series(values)), p)


def test_rolling_features_look_back_only(frames, p, silver):
    rows = features.sensor_features(silver, p).orderBy("timestamp").collect()
    assert rows[0]["timestamp"] == frames.at(24)
    values = [float(10 + (i * 7) % 13) for i in range(60)]
    assert rows[0]["volt_mean_3h"] == pytest.approx(sum(values[22:25]) / 3, rel=1e-6)
    assert rows[0]["volt_mean_24h"] == pytest.approx(sum(values[1:25]) / 24, rel=1e-6)
    assert rows[0]["volt_trend"] == pytest.approx(rows[0]["volt_mean_3h"] - rows[0]["volt_mean_24h"], rel=1e-4)


def test_each_row_looks_back_over_its_own_readings(spark, frames, p):
    """Against a plain loop: chunks of 10 steps, gaps that are filled or stay empty, no window over every step."""
    values = {h: float((h * h) % 17) for h in range(70) if h % 9 and not 30 <= h < 37}
    silver = cleaning.clean(frames.readings(frames.series(values)), p)
    silver = spark.createDataFrame(silver.collect(), silver.schema)
    volts = {r["timestamp"]: r["volt"] for r in silver.collect()}
    out = features.sensor_features(silver, p)
    assert "Window" not in out._jdf.queryExecution().analyzed().toString()
    rows = out.collect()
    assert len(rows) == 15
    for r in rows:
        for n in p.windows:
            back = [volts[r["timestamp"] - timedelta(hours=k)] for k in range(n)]
            back = [v for v in back if v is not None]
            enough = len(back) >= max(2, n // 2)
            assert r[f"volt_mean_{n}h"] == (pytest.approx(mean(back), rel=1e-6) if enough else None)
            assert r[f"volt_std_{n}h"] == (pytest.approx(stdev(back), rel=1e-5, abs=1e-6) if enough else None)


def test_rows_of_features_follow_from_the_grid_bounds(frames, p):
    """Entities that start off the common rhythm, are too short, or have readings off the grid."""
    rows = frames.series({h: 1.0 * h for h in range(0, 75) if h % 5}, machine=1)
    rows += frames.series({h: 2.0 * h for h in (7, 8, 40.5, 90)}, machine=2)
    rows += frames.series({h: 1.0 for h in range(3, 26)}, machine=3) + frames.series({5.5: 1.0}, machine=4)
    readings = frames.readings(rows)
    expected = features.sensor_features(cleaning.clean(readings, p), p).select(*p.keys)
    got = features.feature_rows(cleaning.grid_bounds(readings, p), p)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    assert {r["machine_id"] for r in got.collect()} == {1, 2}


def test_the_future_does_not_change_past_features(frames, p, silver, machines):
    errors = frames.events([(1, 20, "error1")], "error_id")
    repairs = frames.events([(1, 10, "comp1")])
    cutoff = F.lit(str(frames.at(36))).cast("timestamp_ntz")
    rows = checks.no_leakage(silver, errors, repairs, machines.where("machine_id = 1"), cutoff, p).collect()
    assert len(rows) == 2 and all(r["passed"] for r in rows)


def test_events_between_steps_are_seen_at_the_later_step(frames, p, machines):
    errors = frames.events([(1, 10.5, "error1")], "error_id")
    out = features.event_features(frames.spine([10, 11]), errors, frames.events([]), machines, p)
    assert frames.column(out, "error1_count_24h") == [0, 1]
    assert frames.column(out, "errors_total_24h") == [0, 1]


def test_hours_since_replacement(frames, p, machines):
    repairs = frames.events([(1, -50, "comp1"), (1, 10, "comp1")])
    out = features.event_features(frames.spine([0, 10, 30]), frames.events([], "error_id"), repairs, machines, p)
    assert frames.column(out, "hours_since_comp1_replaced") == [50.0, 0.0, 20.0]
    assert frames.column(out, "hours_since_comp2_replaced") == [None] * 3


def end(spark, frames, hour):
    return spark.sql(f"SELECT unix_micros(CAST('{frames.at(hour)}' AS TIMESTAMP)) AS _end")


def test_labels(spark, frames, p):
    failures = frames.events([(1, 30, "comp2"), (1, 30, "comp1"), (1, 200, "comp3")])
    out = labels.labels(frames.spine([0, 6, 24, 30, 31]), failures, end(spark, frames, 60), p)
    assert frames.column(out, p.target) == [0, 1, 1, 0, 0]
    assert frames.column(out, "failed_component") == ["none", "comp1+comp2", "comp1+comp2", "none", "none"]
    assert frames.column(out, "hours_to_failure") == [30.0, 24.0, 6.0, 170.0, 169.0]
    assert frames.column(out, p.component_target("comp3")) == [0] * 5


def test_rows_without_a_full_horizon_are_dropped(spark, frames, p):
    out = labels.labels(frames.spine([0, 36, 37]), frames.events([]), end(spark, frames, 60), p)
    assert frames.column(out, "timestamp") == [frames.at(0), frames.at(36)]


def test_split_leaves_a_gap(frames, p):
    from dataclasses import replace

    q = replace(p, train_end=frames.at(100), validation_start=frames.at(50))
    rows = frames.spine([0, 70, 75, 76, 80, 99, 100, 130]).withColumn("split", labels.split_of(q))
    assert frames.column(rows, "split") == ["train", "train", "train", None, None, None, "test", "test"]


def test_label_like_features_are_refused(p):
    columns = [*p.keys, *p.label_columns, "split", "volt_mean_3h", "failures_so_far"]
    with pytest.raises(ValueError, match="must not be features"):
        labels.feature_columns(columns, p)


def test_duplicate_keys_break_the_dataset(frames, p):
    with pytest.raises(ValueError, match="more than one row"):
        labels.assert_unique(frames.spine([1, 1]), p, "labels")
