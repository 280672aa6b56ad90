from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from fleetspark.operators import cleaning as C


def metrics(df, p):
    return {(r["rule"], r["sensor"]): r["n"] for r in C.cleaning_metrics(df, p).collect()}


@pytest.mark.parametrize(
    "second, removed, conflicting", [(1.0, 1, 0), (2.0, 1, 1)]
)
def test_duplicates_keep_the_first_line(frames, p, second, removed, conflicting):
    df = frames.readings([(1, frames.at(0), 3, *[second] * 4), (1, frames.at(0), 2, *[1.0] * 4)])
    assert C.deduplicate(df, p).first()["volt"] == 1.0
    row = C.duplicate_counts(df, p).first()
    assert (row["duplicates_removed"], row["conflicting_duplicates"]) == (removed, conflicting)


def test_two_nulls_are_equal_copies(frames, p):
    df = frames.readings([(1, frames.at(0), i, *[None] * 4) for i in (2, 3)])
    assert C.duplicate_counts(df, p).first()["conflicting_duplicates"] == 0


def test_range_keeps_its_limits(frames, p):
    df = frames.readings(frames.series([-999.0, 0.0, 150.0, 300.0, 9999.0, None]))
    assert frames.column(C.null_out_of_range(df, p), "volt") == [None, 0.0, 150.0, 300.0, None, None]


@pytest.mark.parametrize(
    "values, expected",
    [
        ([1, 5, 5, 5, 5, 2], [1, 5, None, None, None, 2]),
        ([1, 5, 5, 2], [1, 5, 5, 2]),
        ({0: 5, 1: 5, 3: 5, 4: 5}, [5, 5, 5, 5]),
        ({0: 5, 1: 5, 1.5: 7, 2: 5, 3: 5}, [5, 5, 7, 5, 5]),
        ([5, 5, None, 5, 5], [5, 5, None, 5, 5]),
        ([5] * 25, [5] + [None] * 24),
    ],
)
def test_stuck_runs(frames, p, values, expected):
    values = {k: None if v is None else float(v) for k, v in (values.items() if isinstance(values, dict) else enumerate(values))}
    df = frames.readings(frames.series(values))
    assert frames.column(C.null_stuck_runs(df, p), "volt") == expected


def test_stuck_run_ends_at_the_machine(frames, p):
    df = frames.readings(frames.series([5.0, 5.0]) + frames.series([5.0, 5.0], machine=2, start=2))
    assert C.null_stuck_runs(df, p).where("volt IS NULL").count() == 0


def test_stuck_counters(frames, p):
    m = metrics(frames.readings(frames.series([1.0, 5.0, 5.0, 5.0, 2.0, 7.0, 7.0, 7.0, 7.0])), p)
    assert m[("stuck_runs", "volt")] == 2
    assert m[("stuck_values_nulled", "volt")] == 5


def test_grid_adds_hours_and_drops_off_hours(frames, p):
    df = frames.readings(frames.series({0: 1.0, 0.5: 9.0, 3: 2.0}))
    assert frames.column(C.regular_grid(df, p), "volt") == [1.0, None, None, 2.0]
    m = metrics(df, p)
    assert (m[("grid_rows_added", None)], m[("rows_off_step_dropped", None)]) == (2, 1)


def fill(frames, p, values):
    grid = C.regular_grid(frames.readings(frames.series(values)), p)
    out = C.fill_short_gaps(grid, p)
    return frames.column(out, "volt"), frames.column(out, "volt_quality")


def test_fill_uses_the_centred_mean(frames, p):
    values, quality = fill(frames, p, [10.0] * 12 + [None, None] + [20.0] * 12)
    assert values[12] == pytest.approx((12 * 10 + 11 * 20) / 23)
    assert quality[11:15] == ["ok", "filled", "filled", "ok"]


@pytest.mark.parametrize(
    "values", [[10.0] * 12 + [None] * 4 + [20.0] * 12, [None] * 2 + [10.0] * 20 + [None] * 2, [10.0] + [None] * 2 + [20.0]]
)
def test_long_gaps_edges_and_thin_windows_stay(frames, p, values):
    got, quality = fill(frames, p, values)
    assert got == values
    assert "filled" not in quality


def test_linear_interpolation_reaches_over_chunks(frames, p):
    values = [0.0] + [None] * 39 + [40.0]
    grid = C.regular_grid(frames.readings(frames.series(values)), p)
    got = frames.column(C.interpolate_linear(grid, p), "volt_linear")
    assert got == pytest.approx([float(i) for i in range(41)])


def test_linear_interpolation_leaves_edges(frames, p):
    grid = C.regular_grid(frames.readings(frames.series([None, 1.0, None])), p)
    assert frames.column(C.interpolate_linear(grid, p), "volt_linear") == [None, 1.0, None]


def test_input_order_and_chunk_length_do_not_matter(frames, p):
    from dataclasses import replace

    rng = random.Random(7)
    rows = []
    for m in (1, 2):
        for h in range(80):
            if rng.random() < 0.85:
                rows.append((m, frames.at(h), len(rows) + 2, *[float(rng.choice([10, 20, 20, 400, 30])) for _ in range(4)]))
    rows += [(m, t, n + 500, *v) for m, t, n, *v in rng.sample(rows, 10)]
    expected = sorted(map(str, C.clean(frames.readings(rows), replace(p, chunk_steps=1000)).collect()))
    for steps in (7, 24):
        rng.shuffle(rows)
        assert sorted(map(str, C.clean(frames.readings(rows), replace(p, chunk_steps=steps)).collect())) == expected


def test_clean_equals_its_rules_with_off_hour_rows(frames, p):
    rng = random.Random(11)
    rows = []
    for h in range(90):
        for part in (0, 0.25, 0.5, 0.75):
            if rng.random() < (0.8 if part == 0 else 0.12):
                rows.append((1, frames.at(h + part), len(rows) + 2, *[float(rng.choice([20, 20, 30])) for _ in range(4)]))
    rows += [(m, t, n + 900, *[v + 1 for v in vs]) for m, t, n, *vs in rng.sample(rows, 12)]
    df = frames.readings(rows)
    single = C.null_stuck_runs(C.null_out_of_range(C.deduplicate(df, p), p), p)
    expected = C.fill_short_gaps(C.regular_grid(single, p), p)
    assert sorted(map(str, C.clean(df, p).collect())) == sorted(map(str, expected.select(C.clean(df, p).columns).collect()))


def test_clean_does_not_grow_with_a_hot_key(frames, p):
    """Thousands of copies of one reading collapse before any per-machine work."""
    rows = frames.series([1.0, 2.0, 3.0]) + [(1, frames.at(1), 100 + i, *[9.0] * 4) for i in range(2000)]
    df = C.clean(frames.readings(rows), p)
    assert frames.column(df, "volt") == [1.0, 2.0, 3.0]
    plan = C.deduplicate(frames.readings(rows), p)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_counts_of_a_clean_run_agree_with_its_output(frames, p):
    df = frames.readings(frames.series([1.0, 2.0, None, 4.0] * 10))
    m = metrics(df, p)
    out = C.clean(df, p)
    assert m[("rows_out", None)] == out.count()
    assert m[("filled", "volt")] == out.where(F.col("volt_quality") == "filled").count()
