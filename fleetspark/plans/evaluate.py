"""Judge a score the way the business uses it: events caught, inspections and money.

Every function works on rows of (entity, time, score, label columns) and takes optional
grouping columns ``by``, so several models, parts or thresholds are judged in one job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.functions.ordered import exact_quantiles, global_rank, running_totals
from fleetspark.functions.staging import stage
from fleetspark.functions.times import from_micros, micros
from fleetspark.functions.typing import n_if, ratio
from fleetspark.operators.chunks import own_chunk, with_us
from fleetspark.params import HOUR_US, FleetParams

# Fixed value: hours of a mean month.
HOURS_PER_MONTH = 365.25 * 24 / 12


def costs_relation(dim_component: DataFrame, p: FleetParams) -> DataFrame:
    """Saving per component, and the price of a false alarm next to it."""
    return dim_component.select(
        "component", "saving_if_prevented", F.lit(float(p.false_alarm_cost)).alias("false_alarm_cost")
    )


def failure_events(rows: DataFrame, p: FleetParams, alert: Column, by: list[str] | None = None) -> DataFrame:
    """One row per failure event seen by positive rows: caught, first alert, lead time."""
    by = by or []
    return (
        rows.where(F.col(p.target) == 1)
        .withColumn("_alert", alert)
        .groupBy(*by, p.entity, F.col("next_failure_at").alias("failure_time"))
        .agg(
            F.max("_alert").alias("caught"),
            F.min(F.when(F.col("_alert"), F.col(p.time))).alias("first_alert"),
            F.min("failed_component").alias("components"),
            F.max("score").alias("best_score"),
        )
        .withColumn("lead_time_h", (micros("failure_time") - micros("first_alert")) / F.lit(float(HOUR_US)))
    )


def event_savings(events: DataFrame, costs: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``saving``: the sum of ``saving_if_prevented`` over the failed components."""
    per_part = events.select(*keys, F.explode(F.split("components", "[+]")).alias("component"))
    summed = (
        per_part.join(costs.select("component", "saving_if_prevented"), "component", "left")
        .groupBy(*keys)
        .agg(F.sum("saving_if_prevented").alias("saving"))
    )
    return events.join(summed, keys)


#: Functions of neighbouring chunks or blocks that are composed at a time.
FAN = 32


def _reachable(items: Column, field: str, limit: Column) -> Column:
    """Of sorted ``items`` those before ``limit``, and the first one from there on."""
    return F.concat(F.filter(items, lambda x: x[field] < limit), F.slice(F.filter(items, lambda x: x[field] >= limit), 1, 1))


def _left(moves: Column, cover: Column) -> Column:
    """The cover that a step function leaves of ``cover``."""
    return F.coalesce(F.get(F.filter(moves, lambda m: m["at"] >= cover), 0)["cover"], cover)


def _covers(blocks: DataFrame, keys: list[str], chunk_us: int, cooldown_us: int) -> DataFrame:
    """(``keys``, _block, _cover): until when each block of (``keys``, _block, _moves) is covered before its first alert."""
    first, last = blocks.agg(F.min("_block"), F.max("_block")).first()
    tables, width = [], 1
    while first is not None and first != last:
        first, last, width = first // FAN, last // FAN, width * FAN
        parent = F.floor(F.col("_block") / FAN).alias("_parent")
        family = F.sort_array(F.collect_list(F.struct("_block", "_moves"))).alias("_kids")
        grouped = stage(blocks.groupBy(*keys, parent).agg(family), "alert_blocks")
        limit = F.col("_parent") * (width * chunk_us) + cooldown_us

        def then(a: Column, b: Column, limit=limit) -> Column:
            """First ``a``, then ``b``; a cover beyond all alerts of ``a`` goes on to ``b`` as it is."""
            end = F.element_at(a, -1)["at"]
            passed = F.transform(a, lambda m: F.struct(m["at"].alias("at"), _left(b, m["cover"]).alias("cover")))
            beyond = F.when(end < limit, _reachable(F.filter(b, lambda m: m["at"] > end), "at", limit)).otherwise(F.slice(b, 1, 0))
            return F.concat(passed, beyond)

        composed = F.aggregate(F.slice("_kids", 2, FAN), F.get("_kids", 0)["_moves"], lambda a, kid: then(a, kid["_moves"]))
        tables.append(grouped)
        blocks = grouped.select(*keys, F.col("_parent").alias("_block"), composed.alias("_moves"))
    covers = blocks.select(*keys, "_block", F.lit(-(2**62)).alias("_cover"))
    for grouped in reversed(tables):
        start = F.struct(F.col("_cover").alias("cover"), F.array().cast("array<struct<block:bigint,cover:bigint>>").alias("seen"))
        step = lambda state, kid: F.struct(
            _left(kid["_moves"], state["cover"]).alias("cover"),
            F.concat(state["seen"], F.array(F.struct(kid["_block"].alias("block"), state["cover"].alias("cover")))).alias("seen"),
        )
        known = grouped.join(covers.withColumnRenamed("_block", "_parent"), [*keys, "_parent"])
        seen = known.select(*keys, F.explode(F.aggregate("_kids", start, step, lambda state: state["seen"])).alias("_e"))
        covers = seen.select(*keys, F.col("_e.block").alias("_block"), F.col("_e.cover").alias("_cover"))
    return covers


def inspections(
    alerts: DataFrame, p: FleetParams, cooldown_us: int, by: list[str] | None = None
) -> DataFrame:
    """Openings of inspections: the first alert opens one, alerts within the cool-down are
    covered, the next one (exactly at its end counts) opens another.

    The rule is sequential, so it is solved per (entity, time chunk): a chunk only needs the
    time until which it is already covered. To the chunks before and after, it is a step function
    from that time to the one it leaves: one step for each alert that can open first. Functions of
    ``FAN`` neighbours are composed to the function of a block, block by block up to one for each
    entity; then the real covers are handed down the same tree, and every chunk is replayed on
    its own. Arrays hold one chunk's alerts, the alerts of one cool-down, or ``FAN`` functions: none
    grows with the life of an entity.
    """
    by = by or []
    keys = [*by, p.entity]
    cd = F.lit(cooldown_us)
    rows = own_chunk(with_us(alerts, p.time), "_us", p.chunk_us)
    chunks = rows.groupBy(*keys, "_chunk").agg(
        F.sort_array(F.collect_list(F.struct(F.col("_us").alias("us"), F.col(p.target).alias("y")))).alias("_a")
    )
    chunks = stage(chunks, "alert_chunks")
    walk = lambda start: F.aggregate(
        F.col("_a"), start, lambda cover, x: F.when(x["us"] >= cover, x["us"] + cd).otherwise(cover)
    )
    firsts = _reachable(F.col("_a"), "us", F.col("_chunk") * p.chunk_us + cd)
    moves = F.transform(firsts, lambda x: F.struct(x["us"].alias("at"), walk(x["us"]).alias("cover")))
    blocks = chunks.select(*keys, F.col("_chunk").cast("long").alias("_block"), moves.alias("_moves"))
    covers = _covers(blocks, keys, p.chunk_us, cooldown_us).withColumnRenamed("_block", "_chunk")
    opened = F.aggregate(
        F.col("_a"),
        F.struct(F.col("_cover").alias("cover"), F.array().cast("array<struct<us:bigint,y:tinyint>>").alias("open")),
        lambda s, x: F.when(
            x["us"] >= s["cover"],
            F.struct((x["us"] + cd).alias("cover"), F.concat(s["open"], F.array(x)).alias("open")),
        ).otherwise(s),
        lambda s: s["open"],
    )
    return (
        chunks.withColumn("_a", F.transform("_a", lambda x: F.struct(x["us"].alias("us"), x["y"].cast("tinyint").alias("y"))))
        .join(covers, [*keys, "_chunk"])
        .select(*keys, F.explode(opened).alias("_o"))
        .select(*keys, from_micros(F.col("_o.us")).alias(p.time), (F.col("_o.y") == 1).alias("failure_followed"))
    )


def ranking(rows: DataFrame, target: str, by: list[str] | None = None) -> DataFrame:
    """PR-AUC (average precision) and ROC-AUC; rows with equal scores count as one step."""
    by = by or []
    curve = pr_points(rows, target, by)
    positives, negatives = F.sum("pos"), F.sum("neg")
    ap = F.sum(F.col("pos") * F.col("precision"))
    half = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0))
    both = (positives > 0) & (negatives > 0)
    return curve.groupBy(*by).agg(
        F.when(both, ratio(ap, positives)).alias("pr_auc"),
        F.when(both, 1 - ratio(half, positives.cast("double") * negatives)).alias("roc_auc"),
    )


def pr_points(rows: DataFrame, target: str, by: list[str] | None = None) -> DataFrame:
    """Precision and recall at every distinct score."""
    by = by or []
    steps = rows.groupBy(*by, "score").agg(
        n_if(F.col(target) == 1).alias("pos"), n_if(F.col(target) != 1).alias("neg")
    )
    totals = steps.groupBy(*by).agg(F.sum("pos").alias("_positives"))
    placed = running_totals(steps, [("score", True)], ["pos", "neg"], by)
    placed = placed.join(totals, by) if by else placed.crossJoin(F.broadcast(totals))
    hits = F.col("pos_before") + F.col("pos")
    called = hits + F.col("neg_before") + F.col("neg")
    return placed.withColumns(
        {"precision": ratio(hits, called), "recall": ratio(hits, F.col("_positives"))}
    ).drop("_positives")


def evaluate(
    rows: DataFrame,
    costs: DataFrame,
    p: FleetParams,
    by: list[str] | None = None,
    cooldown_us: int | None = None,
    metrics: list[str] | None = None,
) -> DataFrame:
    """All metrics per group: rows carry ``score`` and the ``threshold`` they are judged at.

    With ``metrics`` only those are returned, and only what they need is computed.
    """
    by = by or []
    step_us = p.feature_step * p.step_us
    cooldown_us = cooldown_us or p.horizon_us
    alert = F.col("score") >= F.col("threshold")
    y = F.col(p.target) == 1
    base = rows.groupBy(*by).agg(
        F.min("threshold").alias("threshold"),
        F.count(F.lit(1)).alias("row_count"),
        n_if(y).alias("positives"),
        n_if(alert).alias("alerts"),
        n_if(alert & y).alias("_tp"),
        (F.max(micros(p.time)) - F.min(micros(p.time)) + step_us).alias("_span"),
    )

    def machines() -> DataFrame:
        return rows.select(*by, p.entity).distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("_machines"))

    @cache
    def events() -> DataFrame:
        return event_savings(failure_events(rows, p, alert, by), costs, [*by, p.entity, "failure_time"])

    def event_totals() -> DataFrame:
        return events().groupBy(*by).agg(
            F.count(F.lit(1)).alias("failure_events"),
            n_if(F.col("caught")).alias("events_caught"),
            F.sum(F.when(F.col("caught"), F.col("saving"))).alias("caught_saving"),
            F.sum("saving").alias("potential_saving"),
        )

    def lead() -> DataFrame:
        middle = exact_quantiles(events().where("caught"), "lead_time_h", [0.5], by).select(
            *by, F.col("quantile").alias("median_lead_time_h")
        )
        return middle if by else middle.agg(F.max("median_lead_time_h").alias("median_lead_time_h"))

    def opened() -> DataFrame:
        return inspections(rows.where(alert), p, cooldown_us, by).groupBy(*by).agg(
            F.count(F.lit(1)).alias("inspections"), n_if(~F.col("failure_followed")).alias("false_alarms")
        )

    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    or_zero = lambda c: F.coalesce(c, F.lit(0.0))
    false_cost = zero("false_alarms") * F.lit(float(p.false_alarm_cost))
    caught = or_zero(F.col("caught_saving"))
    months = F.col("_machines") * (F.col("_span") / F.lit(HOURS_PER_MONTH * HOUR_US))
    precision, recall = or_zero(ratio("_tp", "alerts")), or_zero(ratio("_tp", "positives"))
    potential = or_zero(F.col("potential_saving"))
    ranked = lambda: ranking(rows, p.target, by)
    # Every metric with the parts it is made of, next to the plain counts.
    known: dict[str, tuple[Column, list[Callable[[], DataFrame]]]] = {
        "threshold": (F.col("threshold"), []),
        "row_count": (F.col("row_count"), []),
        "positives": (F.col("positives"), []),
        "alerts": (F.col("alerts"), []),
        "pr_auc": (F.col("pr_auc"), [ranked]),
        "roc_auc": (F.col("roc_auc"), [ranked]),
        "precision": (precision, []),
        "recall": (recall, []),
        "f1": (or_zero(ratio(2 * precision * recall, precision + recall)), []),
        "failure_events": (zero("failure_events"), [event_totals]),
        "events_caught": (zero("events_caught"), [event_totals]),
        "event_recall": (or_zero(ratio("events_caught", "failure_events")), [event_totals]),
        "median_lead_time_h": (or_zero(F.col("median_lead_time_h")), [lead]),
        "inspections": (zero("inspections"), [opened]),
        "false_alarms": (zero("false_alarms"), [opened]),
        "false_alarms_per_machine_month": (or_zero(ratio(zero("false_alarms"), months)), [machines, opened]),
        "caught_saving": (caught, [event_totals]),
        "false_alarm_cost": (false_cost, [opened]),
        "net_saving": (caught - false_cost, [event_totals, opened]),
        "potential_saving": (potential, [event_totals]),
        "saving_captured": (or_zero(ratio(caught - false_cost, F.col("potential_saving"))), [event_totals, opened]),
    }
    chosen = {m: known[m] for m in metrics or known}
    out = base
    for part in dict.fromkeys(part for _, parts in chosen.values() for part in parts):
        out = out.join(part(), by, "left") if by else out.crossJoin(F.broadcast(part()))
    return out.select(*by, *[c.alias(m) for m, (c, _) in chosen.items()])


def candidate_shares(n: int) -> list[int]:
    """Which of the distinct scores are candidates, in millionths of their number from the lowest up.

    Half of them are evenly spread, so up to ``n // 2`` distinct scores are all taken; the other
    half lies in the upper part and gets denser towards the top.
    """
    even, top = n // 2, n - n // 2
    spread = [round(1e6 * (i + 1) / even) for i in range(even)]
    return sorted({*spread, *[round(1e6 * (1 - 0.5 * 5000 ** (-i / max(1, top - 1)))) for i in range(top)]})


def threshold_candidates(rows: DataFrame, n: int = FleetParams.thresholds) -> DataFrame:
    """At most ``n`` of the distinct scores as thresholds, and one above every score ("never alert")."""
    scores = stage(rows.select(F.col("score").cast("double").alias("threshold")).where("threshold is not null").distinct(), "scores")
    size = scores.agg(F.count("*").alias("_size"))
    share = F.explode(F.array(*[F.lit(m).cast("bigint") for m in candidate_shares(n)]))
    # One row with the number of scores becomes at most ``n`` ranks.
    ranks = size.where("_size > 0").select("_size", share.alias("_m")).select(F.expr("(_size * _m + 999999) div 1000000").alias("_rank")).distinct()
    ranked = global_rank(scores, [("threshold", False)], "_rank", unique=True)
    never = rows.agg((F.max("score") + 1.0).alias("threshold"))
    return ranked.join(F.broadcast(ranks), "_rank").select("threshold").unionByName(never)


def false_alarms(rows: DataFrame, grid: list[float], p: FleetParams, cooldown_us: int) -> DataFrame:
    """(threshold, false_alarms) for every threshold of ``grid``, in one walk over the rows.

    Rows stream through their entity's task in order of time. The walk keeps one cover for each
    threshold and nothing of the rows it has passed; a row opens inspections at all thresholds up to its
    score whose cover has ended. Scored rows lie on a grid of times, so no entity has more of
    them than steps in its life.
    """
    levels = np.array(sorted(grid), float)
    alerts = rows.select(p.entity, micros(p.time).alias("_us"), (F.col(p.target) == 1).alias("_y"), F.col("score").cast("double").alias("_s"))
    alerts = alerts.where(F.col("_s") >= float(levels[0]) if len(levels) else F.lit(False))
    ordered = alerts.repartition(p.entity).sortWithinPartitions(p.entity, "_us")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cover, false, entity = np.empty(len(levels), np.int64), np.zeros(len(levels), np.int64), object()
        for batch in batches:
            reach = np.searchsorted(levels, batch.column(3).to_numpy(), "right").tolist()
            for own, at, y, k in zip(*(batch.column(i).to_pylist() for i in range(3)), reach, strict=True):
                if own != entity:
                    entity = own
                    cover[:] = -(2**62)
                open_now = cover[:k] <= at
                cover[:k][open_now] = at + cooldown_us
                if not y:
                    false[:k] += open_now
        yield pa.RecordBatch.from_arrays([pa.array(levels), pa.array(false)], ["threshold", "false_alarms"])

    counted = ordered.mapInArrow(walk, "threshold double, false_alarms long")
    return counted.groupBy("threshold").agg(F.sum("false_alarms").alias("false_alarms"))


def net_saving_curve(
    rows: DataFrame, thresholds: DataFrame, costs: DataFrame, p: FleetParams, cooldown_us: int | None = None
) -> DataFrame:
    """Events caught, false alarms and net saving at every candidate threshold.

    An event is caught from its best score downwards, so events need no copy per threshold:
    each falls into one interval of the grid and the rest is a running sum over at most 201
    rows. Inspections do depend on the threshold: ``false_alarms`` walks once over the alerts.
    """
    cooldown_us = cooldown_us or p.horizon_us
    rows, thresholds = stage(rows, "judged_rows"), stage(thresholds, "thresholds")
    grid = thresholds.agg(F.sort_array(F.collect_set("threshold")).alias("_grid"))
    alarms = false_alarms(rows, grid.first()["_grid"] or [], p, cooldown_us)
    events = event_savings(failure_events(rows, p, F.lit(False)), costs, [p.entity, "failure_time"])
    reached = F.array_max(F.filter("_grid", lambda t: t <= F.col("best_score")))
    caught = (
        events.crossJoin(F.broadcast(grid))
        .groupBy(reached.alias("_reached"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("saving").alias("saving"))
        .where(F.col("_reached").isNotNull())
    )
    per_threshold = (
        thresholds.select("threshold")
        .distinct()
        .join(F.broadcast(caught), F.col("_reached") >= F.col("threshold"), "left")
        .groupBy("threshold")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("events_caught"), F.coalesce(F.sum("saving"), F.lit(0.0)).alias("_saved"))
    )
    alarm = F.coalesce(F.col("false_alarms"), F.lit(0))
    return per_threshold.join(alarms, "threshold", "left").select(
        "threshold",
        "events_caught",
        alarm.alias("false_alarms"),
        (F.col("_saved") - alarm * F.lit(float(p.false_alarm_cost))).alias("net_saving"),
    )


def choose_threshold(curve: DataFrame) -> DataFrame:
    """The best net saving; a tie goes to the higher threshold."""
    best = curve.agg(F.max(F.struct("net_saving", "threshold")).alias("_b"))
    return best.select(F.col("_b.threshold").alias("threshold"), F.col("_b.net_saving").alias("net_saving"))


def baseline_rows(parts: DataFrame, p: FleetParams, baselines: dict[str, tuple[Column, float]]) -> DataFrame:
    """Validation and test rows once per baseline, with its score and threshold."""
    judged = parts.where(F.col("part").isin("validation", "test"))
    models = F.explode(
        F.array(
            *[
                F.struct(F.lit(n).alias("model"), s.cast("double").alias("score"), F.lit(float(t)).alias("threshold"))
                for n, (s, t) in baselines.items()
            ]
        )
    )
    return judged.select(
        "part", *p.keys, p.target, "next_failure_at", "failed_component", models.alias("_m")
    ).select("part", *p.keys, p.target, "next_failure_at", "failed_component", "_m.*")


# ---------------------------------------------------------------- anomaly flags

# Hours to failure, lower bound exclusive and upper bound inclusive.
BUCKETS = (("0-24 h", 0, 24), ("24-48 h", 24, 48), ("48-72 h", 48, 72), ("72-168 h", 72, 168))
NORMAL = "normal (>168 h)"


def time_bucket(hours: str = "hours_to_failure") -> Column:
    out = F.lit(NORMAL)
    for name, lo, hi in reversed(BUCKETS):
        out = F.when((F.col(hours) > lo) & (F.col(hours) <= hi), name).otherwise(out)
    return out


def flag_rates(rows: DataFrame) -> DataFrame:
    """Rows and share flagged per time-to-failure bucket; rows carry a boolean ``flag``."""
    return rows.groupBy(time_bucket().alias("bucket")).agg(
        F.count(F.lit(1)).alias("row_count"), F.avg(F.col("flag").cast("int")).alias("flag_rate")
    )


def evaluate_anomalies(rows: DataFrame, p: FleetParams) -> DataFrame:
    """Label-based check of a label-free score: lift and recall in the 48 h before failures."""
    near = (F.col("hours_to_failure") > 0) & (F.col("hours_to_failure") <= 48)
    normal = time_bucket() == NORMAL
    share = lambda c: F.coalesce(F.avg(F.when(c, F.col("flag").cast("int"))), F.lit(0.0))
    totals = rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        n_if(F.col("flag")).alias("flags"),
        share(normal).alias("flag_rate_normal"),
        share(near).alias("flag_rate_48h"),
    )
    events = (
        rows.where(near)
        .groupBy(p.entity, "next_failure_at")
        .agg(F.max("flag").alias("_hit"))
        .agg(
            F.count(F.lit(1)).alias("failure_events"),
            F.coalesce(F.avg(F.col("_hit").cast("int")), F.lit(0.0)).alias("event_recall_48h"),
        )
    )
    auc = ranking(rows, p.target).select("pr_auc")
    return (
        totals.crossJoin(F.broadcast(events))
        .crossJoin(F.broadcast(auc))
        .withColumn("lift_48h", ratio("flag_rate_48h", "flag_rate_normal"))
    )
