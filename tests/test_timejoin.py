from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from fleetspark.operators import timejoin as J
from fleetspark.params import HOUR_US


@pytest.fixture(scope="module")
def random_case(frames):
    rng = random.Random(3)
    spine = [(m, frames.at(h)) for m in (1, 2, 3) for h in rng.sample(range(120), 25)]
    events = [(m, rng.choice([0.0, 0.25, 1.0]) + rng.randrange(118), rng.choice("ab")) for m in (1, 2) for _ in range(40)]
    return spine, [(m, frames.at(h), k) for m, h, k in events]


def both(spark, case):
    spine, events = case
    return (
        spark.createDataFrame(spine, "machine_id bigint, timestamp timestamp_ntz"),
        spark.createDataFrame(events, "machine_id bigint, timestamp timestamp_ntz, component string"),
    )


def test_interval_counts_match_brute_force(spark, p, random_case):
    spine, events = both(spark, random_case)
    got = J.count_between(spine, events, p, -24 * HOUR_US, 0, {"a": F.col("component") == "a"})
    day = timedelta(hours=24)
    for r in got.collect():
        m, t = r["machine_id"], r["timestamp"]
        assert r["a"] == sum(1 for em, et, k in random_case[1] if em == m and k == "a" and t - day < et <= t)


def test_backward_and_forward_match_brute_force(spark, p, random_case):
    spine, events = both(spark, random_case)
    back = {(r["machine_id"], r["timestamp"]): r["last_at"] for r in J.asof_backward(spine, events, p).collect()}
    ahead = {(r["machine_id"], r["timestamp"]): r["next_at"] for r in J.next_after(spine, events, p).collect()}
    until = J.count_until(spine, events, p, {"n": F.lit(True)})
    total = {(r["machine_id"], r["timestamp"]): r["n"] for r in until.collect()}
    for m, t in random_case[0]:
        before = [et for em, et, _ in random_case[1] if em == m and et <= t]
        after = [et for em, et, _ in random_case[1] if em == m and et > t]
        assert back[(m, t)] == max(before, default=None)
        assert ahead[(m, t)] == min(after, default=None)
        assert total[(m, t)] == len(before)


def test_window_bounds(frames, p):
    events = frames.events([(1, 0, "a"), (1, 0.5, "a"), (1, 24, "a"), (1, 25, "a")])
    got = J.count_between(frames.spine([24]), events, p, -24 * HOUR_US, 0).first()["n"]
    assert got == 2


def test_exists_looks_strictly_ahead(frames, p):
    events = frames.events([(1, 30, "a")])
    got = J.exists_between(frames.spine([5, 6, 29, 30, 31]), events, p, 24 * HOUR_US, "soon")
    assert frames.column(got, "soon") == [False, True, True, False, False]


def test_previous_time_crosses_chunks(frames, p):
    events = frames.events([(1, 0, "a"), (1, 50, "a"), (1, 51, "b"), (2, 60, "a")])
    got = frames.column(J.previous_time(events, p, ["component"]), "previous_at")
    assert got == [None, frames.at(0), None, None]
