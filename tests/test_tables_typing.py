from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fleetspark.functions import typing as T
from fleetspark.operators import tables


def apply(spark, fn, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["v"] for r in df.select("i", fn("t").alias("v")).orderBy("i").collect()]


def test_ids(spark):
    assert apply(spark, T.parse_id, [" 42 ", "1.5", "-3", "M7", "", None, "7.0", "1e2"]) == [42, None, None, None, None, None, 7, 100]


def test_numbers(spark):
    got = apply(spark, T.parse_double, ["1.5", " 2 ", "1.5d", "NaN", "infinity", "", "-.5", "1e999x"])
    assert got == [1.5, 2.0, None, None, None, None, -0.5, None]


def test_timestamps(spark):
    texts = ["2015-01-03 07:00:00", "1/3/2015 7:00:00 AM", "yesterday", "2015", "", "2015-13-01 00:00:00", "2015-01-03"]
    got = [None if v is None else str(v) for v in apply(spark, T.parse_timestamp, texts)]
    assert got == ["2015-01-03 07:00:00", "2015-01-03 07:00:00", None, None, None, None, "2015-01-03 00:00:00"]


def telemetry(spark, rows):
    return spark.createDataFrame(
        [(*r, i + 2) for i, r in enumerate(rows)],
        "datetime string, machineID string, volt string, rotate string, pressure string, vibration string, _source_line bigint",
    )


def test_standardise_counts_empty_and_bad_cells(spark, p):
    df = telemetry(
        spark,
        [
            ("2015-01-01 06:00:00", " 1 ", "1.5", "", "x", "4"),
            ("yesterday", "1", "1", "1", "1", "1"),
            ("2015-01-01 07:00:00", "M7", "1", "1", "1", " "),
        ],
    )
    assert tables.standardise(df, p).count() == 1
    n = {(r["counter"], r["column_name"]): r["n"] for r in tables.typing_counts(df, p).collect()}
    assert n[("rows_in", None)] == 3 and n[("rows_dropped_no_key", None)] == 2
    assert n[("unparseable", "timestamp")] == 1 and n[("unparseable", "machine_id")] == 1
    assert n[("empty", "rotate")] == 1 and n[("unparseable", "pressure")] == 1 and n[("empty", "vibration")] == 1


def test_missing_column_is_an_error(spark, p):
    with pytest.raises(ValueError, match="lacks columns"):
        tables.standardise(spark.createDataFrame([("1",)], "volt string"), p)


def test_each_bad_row_is_counted_once(spark):
    rows = [
        ("2015-01-01 06:00:00", "1", "error1"),
        ("2015-01-01 06:00:00", "1", "error1"),
        ("n/a", "99", "error9"),
        ("2015-01-01 06:00:00", "99", "error9"),
        ("2015-01-01 06:00:00", "1", "error9"),
    ]
    landing = spark.createDataFrame(
        [(*r, i + 2) for i, r in enumerate(rows)], "datetime string, machineID string, errorID string, _source_line bigint"
    )
    machines = spark.createDataFrame([(1,)], "machine_id bigint")
    judged = tables.judge_events(landing, machines, "errorID", "error_id", ("error1",))
    keys = ["timestamp", "machine_id", "error_id"]
    n = {r["reason"]: r["n"] for r in tables.dropped(judged, keys).collect()}
    assert n == {"bad_timestamp": 1, "unknown_machine": 1, "unknown_value": 1, "duplicate": 1}
    kept = tables.kept(judged, keys).collect()
    assert len(kept) == 1 and kept[0]["_source_line"] == 2


def test_machines_without_a_place_are_flagged(spark):
    machines = spark.createDataFrame(
        [("1", "model1", "5", 2), ("1", "model2", "6", 3), ("2", "model1", "-1", 4), ("3", "model1", "1", 5)],
        "machineID string, model string, age string, _source_line bigint",
    )
    place = spark.createDataFrame(
        [("1", "P", " Plant ", "C", "L1", 2), ("1", "Q", "Other", "C", "L9", 3)],
        "machineID string, plant_id string, plant_name string, city string, line_id string, _source_line bigint",
    )
    rows = {r["machine_id"]: r for r in tables.build_machines(machines, place).collect()}
    assert set(rows) == {1, 3}
    assert rows[1]["model"] == "model1" and rows[1]["plant_name"] == "Plant" and not rows[1]["no_location"]
    assert rows[3]["no_location"]


def test_even_assignment(spark):
    lines = [{"plant_id": "P", "plant_name": "P", "city": "C", "line_id": f"L{i}"} for i in range(3)]
    placed = tables.assign_evenly(spark.range(10).select(F.col("id").alias("machine_id")), lines)
    assert sorted(r["count"] for r in placed.groupBy("line_id").count().collect()) == [3, 3, 4]
