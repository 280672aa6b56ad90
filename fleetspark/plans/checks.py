"""Checks of every layer as rows: check_name, subject, passed, expected, actual.

Numbers are compared as doubles. Sides of a reconciliation are aggregated separately, each in
one pass, and only their one-row results meet. All checks of a table share one scan of it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.functions.times import date_key, micros, ntz
from fleetspark.functions.typing import n_if
from fleetspark.operators.timejoin import by_step
from fleetspark.params import FleetParams
from fleetspark.plans import features
from fleetspark.plans.kpis import in_period

TOLERANCE = 1e-9
MAX_EMPTY_SHARE = 0.05

# Keys of the star schema and the references between its tables.
KEYS = {
    "dim_machine": ("machine_id",),
    "dim_component": ("component",),
    "dim_sensor": ("sensor",),
    "dim_error_type": ("error_id",),
    "dim_date": ("date_key",),
    "fact_sensor_reading": ("machine_id", "timestamp", "sensor"),
    "fact_failure": ("machine_id", "timestamp", "component"),
    "fact_maintenance": ("machine_id", "timestamp", "component"),
    "fact_error": ("machine_id", "timestamp", "error_id"),
    "fact_machine_month": ("machine_id", "year_month"),
    "fact_prediction": ("machine_id", "timestamp"),
}
REFERENCES = (
    ("fact_sensor_reading", "machine_id", "dim_machine", "machine_id"),
    ("fact_sensor_reading", "date_key", "dim_date", "date_key"),
    ("fact_sensor_reading", "sensor", "dim_sensor", "sensor"),
    ("fact_failure", "machine_id", "dim_machine", "machine_id"),
    ("fact_failure", "date_key", "dim_date", "date_key"),
    ("fact_failure", "component", "dim_component", "component"),
    ("fact_maintenance", "machine_id", "dim_machine", "machine_id"),
    ("fact_maintenance", "date_key", "dim_date", "date_key"),
    ("fact_maintenance", "component", "dim_component", "component"),
    ("fact_error", "machine_id", "dim_machine", "machine_id"),
    ("fact_error", "date_key", "dim_date", "date_key"),
    ("fact_error", "error_id", "dim_error_type", "error_id"),
    ("fact_machine_month", "machine_id", "dim_machine", "machine_id"),
    ("fact_machine_month", "month_date_key", "dim_date", "date_key"),
    ("fact_prediction", "machine_id", "dim_machine", "machine_id"),
    ("fact_prediction", "date_key", "dim_date", "date_key"),
    ("fact_prediction", "predicted_component", "dim_component", "component"),
)


def _row(check: str, subject: str | Column, passed: Column, expected: Column, actual: Column) -> list[Column]:
    return [
        F.lit(check).alias("check_name"),
        (F.lit(subject) if isinstance(subject, str) else subject).alias("subject"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        expected.cast("double").alias("expected"),
        actual.cast("double").alias("actual"),
    ]


def _rows(one: DataFrame, rows: list[list[Column]]) -> DataFrame:
    """Check rows out of the columns of a one-row frame."""
    return one.select(F.inline(F.array(*[F.struct(*r) for r in rows])))


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def close(a: Column, b: Column) -> Column:
    """Equal within the relative tolerance; two NULLs are equal."""
    scale = F.greatest(F.lit(1.0), F.abs(a.cast("double")), F.abs(b.cast("double")))
    near = F.abs(a.cast("double") - b.cast("double")) <= F.lit(TOLERANCE) * scale
    return F.coalesce(near, a.isNull() & b.isNull())


def compare_one_row(check: str, expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Compare the columns two one-row frames share, one check row each."""
    names = [c for c in expected.columns if c in actual.columns]
    both = expected.select(*[F.col(f"`{c}`").alias(f"e_{c}") for c in names]).crossJoin(
        F.broadcast(actual.select(*[F.col(f"`{c}`").alias(f"a_{c}") for c in names]))
    )
    sides = [(c, F.col(f"`e_{c}`"), F.col(f"`a_{c}`")) for c in names]
    return _rows(both, [_row(check, c, close(e, a), e, a) for c, e, a in sides])


# ---------------------------------------------------------------- warehouse


def unique_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Duplicate and empty keys per table; expected is zero."""
    parts = []
    for name, keys in KEYS.items():
        if name in tables:
            empty = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
            groups = tables[name].groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            bad = groups.agg(
                F.coalesce(F.sum(F.when(empty, F.col("_n")).otherwise(F.col("_n") - 1)), F.lit(0)).alias("_bad")
            )
            parts.append(bad.select(*_row("unique_keys", name, F.col("_bad") == 0, F.lit(0), F.col("_bad"))))
    return _all(parts)


def references(tables: dict[str, DataFrame]) -> DataFrame:
    """Orphans per link; a NULL key is an orphan.

    The keys of all links are melted into one relation, grouped before they move, and meet the
    melted keys of all dimensions in one anti join: each table is scanned once.
    """
    links = [link for link in REFERENCES if link[0] in tables and link[2] in tables]
    melt = lambda df, rows: df.select(F.inline(F.array(*[F.struct(*r) for r in rows])))
    key = lambda c: F.col(c).cast("string").alias("_key")
    used = [
        melt(tables[fact], [(F.lit(i).alias("_link"), F.lit(d).alias("_dim"), key(c)) for i, (f, c, d, _) in enumerate(links) if f == fact])
        for fact in dict.fromkeys(f for f, *_ in links)
    ]
    known = [
        melt(tables[dim], [(F.lit(dim).alias("_dim"), key(c)) for c in dict.fromkeys(k for _, _, d, k in links if d == dim)])
        for dim in dict.fromkeys(d for _, _, d, _ in links)
    ]
    used = _all(used).groupBy("_link", "_dim", "_key").agg(F.count(F.lit(1)).alias("_n"))
    orphans = used.join(_all(known).distinct(), ["_dim", "_key"], "left_anti")
    bad = [F.coalesce(F.sum(F.when(F.col("_link") == i, F.col("_n"))), F.lit(0)).alias(f"_bad_{i}") for i in range(len(links))]
    rows = [
        _row("references", f"{fact}.{column} -> {dim}", F.col(f"_bad_{i}") == 0, F.lit(0), F.col(f"_bad_{i}"))
        for i, (fact, column, dim, _) in enumerate(links)
    ]
    return _rows(orphans.agg(*bad), rows)


def date_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Keys that do not match their time, and missing days of the calendar."""
    parts = []
    for name in ("fact_sensor_reading", "fact_failure", "fact_maintenance", "fact_error", "fact_prediction"):
        if name in tables:
            bad = tables[name].agg(n_if(F.col("date_key") != date_key("timestamp")).alias("_bad"))
            parts.append(bad.select(*_row("date_keys", name, F.col("_bad") == 0, F.lit(0), F.col("_bad"))))
    month = F.concat(F.replace("year_month", F.lit("-"), F.lit("")), F.lit("01")).cast("int")
    bad = tables["fact_machine_month"].agg(n_if(F.col("month_date_key") != month).alias("_bad"))
    parts.append(bad.select(*_row("date_keys", "fact_machine_month", F.col("_bad") == 0, F.lit(0), F.col("_bad"))))
    gap = tables["dim_date"].agg(
        (F.datediff(F.max("date"), F.min("date")) + 1 - F.count(F.lit(1))).alias("_bad")
    )
    parts.append(gap.select(*_row("calendar", "missing_days", F.col("_bad") == 0, F.lit(0), F.col("_bad"))))
    return _all(parts)


def _reading_totals(sensor: str, value: str, quality: str, own: Column | None = None) -> list[Column]:
    """Totals of one sensor, over the rows that are its ``own`` (all if None)."""
    of = lambda c: c if own is None else F.when(own, c)
    return [
        F.count(of(F.lit(1))).alias(f"{sensor}.row_count"),
        F.count(of(F.col(value))).alias(f"{sensor}.values"),
        F.sum(of(F.col(value))).alias(f"{sensor}.sum"),
        *[F.count(of(F.when(F.col(quality) == q, 1))).alias(f"{sensor}.{q}") for q in ("ok", "filled", "missing")],
    ]


def silver_reconciliation(silver: DataFrame, events: dict[str, DataFrame], tables: dict[str, DataFrame], p: FleetParams) -> DataFrame:
    """Rows, values, sums and flags per sensor, and event and machine rows."""
    wide = silver.agg(*[c for s in p.sensors for c in _reading_totals(s, s, f"{s}_quality")])
    own = [c for s in p.sensors for c in _reading_totals(s, "value", "quality", F.col("sensor") == s)]
    parts = [compare_one_row("silver_reconciliation", wide, tables["fact_sensor_reading"].agg(*own))]
    pairs = {"fact_failure": "failures", "fact_maintenance": "maintenance", "fact_error": "errors", "dim_machine": "machines"}
    for fact, source in pairs.items():
        count = lambda df: df.agg(F.count(F.lit(1)).alias(fact))  # noqa: B023, E731
        parts.append(compare_one_row("silver_reconciliation", count(events[source]), count(tables[fact])))
    return _all(parts)


def gold_reconciliation(monthly: DataFrame, tables: dict[str, DataFrame], period: DataFrame) -> DataFrame:
    """KPI totals in Gold and in the fact, and events counted from the facts."""
    columns = ("failures", "components_failed", "planned_maintenances", "downtime_h", "total_cost")
    totals = lambda df: df.agg(F.count(F.lit(1)).alias("row_count"), *[F.sum(c).alias(c) for c in columns])
    month = tables["fact_machine_month"]
    events = lambda df, name: in_period(df, period).select("machine_id", "timestamp").distinct().agg(
        F.count(F.lit(1)).alias(name)
    )
    planned = tables["fact_maintenance"].where("maintenance_type = 'planned'")
    return _all(
        [
            compare_one_row("gold_reconciliation", totals(monthly), totals(month)),
            compare_one_row(
                "gold_reconciliation",
                events(tables["fact_failure"], "failure_events"),
                month.agg(F.sum("failures").alias("failure_events")),
            ),
            compare_one_row(
                "gold_reconciliation",
                events(planned, "planned_events"),
                month.agg(F.sum("planned_maintenances").alias("planned_events")),
            ),
        ]
    )


def view_checks(views: dict[str, DataFrame], fact_month: DataFrame, may_be_empty: tuple[str, ...] = ()) -> DataFrame:
    """Every view returns rows, and its failures and cost add up to the fact's."""
    names = ("failures", "total_cost")
    expected = F.broadcast(fact_month.agg(*[F.sum(c).alias(f"_e_{c}") for c in names]))
    parts = []
    for name, df in views.items():
        ok = F.lit(True) if name in may_be_empty else F.col("_n") > 0
        rows, one = [_row("view_rows", name, ok, F.lit(None), F.col("_n"))], F.count(F.lit(1)).alias("_n")
        if set(names) <= set(df.columns):
            one = df.agg(one, *[F.sum(c).alias(f"_a_{c}") for c in names]).crossJoin(expected)
            sides = [(c, F.col(f"_e_{c}"), F.col(f"_a_{c}")) for c in names]
            rows += [_row("view_totals", f"{name}.{c}", close(e, a), e, a) for c, e, a in sides]
        else:
            one = df.agg(one)
        parts.append(_rows(one, rows))
    return _all(parts)


# ---------------------------------------------------------------- gold


def no_leakage(
    silver: DataFrame, errors: DataFrame, maintenance: DataFrame, machines: DataFrame, cutoff: Column, p: FleetParams
) -> DataFrame:
    """Change everything after a cut-off that lies on a feature row; earlier features must not move.

    All machines are compared (not a sample): both feature tables are joined on their key and
    rows that differ are counted.
    """
    late = F.col(p.time) > cutoff
    changed = silver.withColumns({s: F.when(late, F.col(s) + 1000.0).otherwise(F.col(s)) for s in p.sensors})
    before = features.sensor_features(silver, p)
    after = features.sensor_features(changed, p)
    after_cut = cutoff + F.expr("INTERVAL 1 HOUR")
    every = machines.select("machine_id").withColumn("timestamp", after_cut)
    more_errors = errors.unionByName(every.withColumn("error_id", F.lit(p.error_types[0])))
    more_repairs = maintenance.unionByName(every.withColumn("component", F.lit(next(iter(p.components)))))
    spine = before.select(*p.keys)
    ev_before = features.event_features(spine, errors, maintenance, machines, p)
    ev_after = features.event_features(spine, more_errors, more_repairs, machines, p)
    return _all(
        [
            _moved("sensor_features", before, after, cutoff, p),
            _moved("event_features", ev_before, ev_after, cutoff, p),
        ]
    )


def _moved(name: str, before: DataFrame, after: DataFrame, cutoff: Column, p: FleetParams) -> DataFrame:
    values = [c for c in before.columns if c not in p.keys]
    a = before.where(F.col(p.time) <= cutoff).select(*p.keys, F.struct(*values).alias("_a"))
    b = after.where(F.col(p.time) <= cutoff).select(*p.keys, F.struct(*values).alias("_b"))
    both = a.join(b, p.keys, "full").agg(
        F.count(F.lit(1)).alias("_n"), n_if(~F.col("_a").eqNullSafe(F.col("_b"))).alias("_bad")
    )
    return both.select(*_row("no_leakage", name, (F.col("_bad") == 0) & (F.col("_n") > 0), F.lit(0), F.col("_bad")))


def labels_correct(label_rows: DataFrame, failures: DataFrame, p: FleetParams) -> DataFrame:
    """Mark the rows within the horizon before each failure, from the failures backwards, and compare.

    Failures and rows meet in cells of one horizon: a failure reaches its own cell and the one before.
    """
    span = p.horizon_us
    cell = lambda us: F.floor(F.col(us) / span)
    rows = label_rows.select(*p.keys, p.target, micros(p.time).alias("_us")).withColumn("_cell", cell("_us"))
    reach = failures.select(p.entity, micros(p.time).alias("_f")).distinct()
    reach = reach.withColumn("_cell", F.explode(F.array(cell("_f"), cell("_f") - 1)))
    hits = rows.join(reach, [p.entity, "_cell"]).where((F.col("_f") > F.col("_us")) & (F.col("_f") <= F.col("_us") + span))
    marked = rows.join(hits.select(*p.keys).distinct().withColumn("_hit", F.lit(1)), p.keys, "left")
    one = marked.agg(n_if(F.coalesce("_hit", F.lit(0)) != F.col(p.target)).alias("_bad"))
    return one.select(*_row("labels_correct", p.target, F.col("_bad") == 0, F.lit(0), F.col("_bad")))


def split_integrity(dataset: DataFrame, p: FleetParams) -> DataFrame:
    at = micros(ntz(p.train_end))
    train, test = F.col("split") == "train", F.col("split") == "test"
    one = dataset.agg(
        n_if(train & (micros(p.time) + p.horizon_us >= at)).alias("_train"),
        n_if(test & (micros(p.time) < at)).alias("_test"),
        n_if(train).alias("_n_train"),
        n_if(test).alias("_n_test"),
        n_if(train & (F.col(p.target) == 1)).alias("_p_train"),
        n_if(test & (F.col(p.target) == 1)).alias("_p_test"),
    )
    rows = [
        _row("split_integrity", s, (F.col(f"_{s}") == 0) & (F.col(f"_n_{s}") > 0), F.lit(0), F.col(f"_{s}"))
        for s in ("train", "test")
    ] + [
        _row("label_balance", s, F.col(f"_p_{s}") > 0, F.lit(None), F.col(f"_p_{s}"))
        for s in ("train", "test")
    ]
    return _rows(one, rows)


def completeness(dataset: DataFrame, columns: list[str]) -> DataFrame:
    """Share of NULL per feature; at most five percent is allowed."""
    one = dataset.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns])
    rows = [
        _row("completeness", c, F.col(c) <= MAX_EMPTY_SHARE, F.lit(MAX_EMPTY_SHARE), F.col(c)) for c in columns
    ]
    return _rows(one, rows)


def kpi_reconciliation(tables: dict[str, DataFrame], failures: DataFrame, period: DataFrame) -> DataFrame:
    inside = in_period(failures, period)
    per_event = inside.groupBy("machine_id", "timestamp").agg(F.count(F.lit(1)).alias("_n"))
    expected = per_event.agg(F.count(F.lit(1)).alias("failures"), F.sum("_n").alias("components_failed"))
    monthly, total = tables["kpi_machine_monthly"], tables["kpi_machine_total"]
    names = ("failures", "total_cost", "downtime_h")
    sums = lambda df: df.groupBy("machine_id").agg(*[F.sum(c).alias(c) for c in names])
    a, b = sums(monthly), sums(total).withColumnsRenamed({c: f"t_{c}" for c in names})
    same = reduce(lambda x, y: x & y, [close(F.col(c), F.col(f"t_{c}")) for c in names])
    off = a.join(b, "machine_id", "full").agg(n_if(~F.coalesce(same, F.lit(False))).alias("_bad"))
    return _all(
        [
            compare_one_row(
                "kpi_reconciliation",
                expected,
                monthly.agg(F.sum("failures").alias("failures"), F.sum("components_failed").alias("components_failed")),
            ),
            off.select(*_row("kpi_reconciliation", "machine_totals", F.col("_bad") == 0, F.lit(0), F.col("_bad"))),
        ]
    )


# ---------------------------------------------------------------- silver


def manifest_check(metrics: DataFrame, manifest: DataFrame) -> DataFrame:
    """Cleaning counters against an expected-counts relation (rule, sensor, n)."""
    found = metrics.select("rule", "sensor", F.col("n").alias("_found"))
    expected = manifest.select(F.col("rule").alias("_r"), F.col("sensor").alias("_s"), F.col("n").alias("_n"))
    same = (F.col("rule") == F.col("_r")) & F.col("sensor").eqNullSafe(F.col("_s"))
    joined = expected.join(F.broadcast(found), same, "left")
    subject = F.concat_ws(".", F.col("_r"), F.col("_s"))
    return joined.select(*_row("manifest", subject, F.col("_n") == F.col("_found"), F.col("_n"), F.col("_found")))


def ground_truth(silver: DataFrame, linear: DataFrame, truth: DataFrame, p: FleetParams) -> DataFrame:
    """Per sensor: ok values that differ, error of filled values and of straight lines, spread."""
    known = truth.select(*p.keys, *[F.col(s).alias(f"{s}_true") for s in p.sensors])
    joined = silver.join(linear.select(*p.keys, *[f"{s}_linear" for s in p.sensors]), p.keys, "left").join(known, p.keys)
    found = {}
    for s in p.sensors:
        ok, filled = F.col(f"{s}_quality") == "ok", F.col(f"{s}_quality") == "filled"
        off = lambda c: F.avg(F.when(filled, F.abs(F.col(c) - F.col(f"{s}_true"))))  # noqa: B023, E731
        found[s] = {
            "ok_values": n_if(ok),
            "ok_mismatches": n_if(ok & ~F.col(s).eqNullSafe(F.col(f"{s}_true"))),
            "filled_values": n_if(filled),
            "filled_mae": off(s),
            "linear_mae": off(f"{s}_linear"),
            "sensor_std": F.stddev_samp(f"{s}_true"),
        }
    one = joined.agg(*[c.alias(f"{s}_{name}") for s, each in found.items() for name, c in each.items()])
    rows = [[F.lit(s).alias("sensor"), *[F.col(f"{s}_{name}").alias(name) for name in each]] for s, each in found.items()]
    return _rows(one, rows)


# ---------------------------------------------------------------- predictions


def predictions_complete(predictions: DataFrame, rows: DataFrame, versions: dict[str, str], p: FleetParams) -> DataFrame:
    scores = ["failure_risk", "anomaly_score", *[f"{c}_risk" for c in p.components]]
    empty = sum((n_if(F.col(c).isNull()) for c in scores), F.lit(0))
    old = reduce(lambda a, b: a | b, [F.col(f"{k}_model_version") != v for k, v in versions.items()])
    counts = predictions.agg(empty.alias("_empty"), n_if(F.coalesce(old, F.lit(True))).alias("_old"))
    copies = predictions.groupBy(*p.keys).agg((F.count(F.lit(1)) - 1).alias("_c")).agg(
        F.coalesce(F.sum("_c"), F.lit(0)).alias("_copies")
    )
    missing = by_step(rows.select(*p.keys), predictions.select(*p.keys), p.keys, "left_anti").agg(F.count(F.lit(1)).alias("_missing"))
    one = counts.crossJoin(F.broadcast(copies)).crossJoin(F.broadcast(missing))
    names = {"missing_rows": "_missing", "duplicate_keys": "_copies", "empty_scores": "_empty", "old_versions": "_old"}
    rows_ = [_row("predictions_complete", n, F.col(c) == 0, F.lit(0), F.col(c)) for n, c in names.items()]
    return one.select(F.inline(F.array(*[F.struct(*r) for r in rows_])))


def damaged_predictions(predictions: DataFrame, p: FleetParams) -> DataFrame:
    """A copy with faults of known number, by the last digit of the entity's id.

    3: the row is lost; 4: it is there twice; 5: no failure risk; 6: an old model; 7: the alert is turned
    round; 8: the anomaly flag is; 9: no reason; 2: the risk is off by a quarter.
    """
    digit = F.pmod(F.col(p.entity), F.lit(10))
    turned = lambda c, d: F.when(digit == d, ~F.col(c)).otherwise(F.col(c))
    risk = F.when(digit == 5, None).when(digit == 2, F.col("failure_risk") + 0.25).otherwise(F.col("failure_risk"))
    changed = {
        "failure_risk": risk,
        "failure_model_version": F.when(digit == 6, "old").otherwise(F.col("failure_model_version")),
        "alert": turned("alert", 7),
        "anomaly_flag": turned("anomaly_flag", 8),
        "reason_1": F.when(digit != 9, F.col("reason_1")),
    }
    copies = F.explode(F.when(digit == 4, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy")
    return predictions.where(digit != 3).withColumns(changed).select("*", copies).drop("_copy")


def thresholds_applied(predictions: DataFrame, alert_at: float, anomaly_threshold: DataFrame) -> DataFrame:
    one = predictions.crossJoin(F.broadcast(anomaly_threshold)).agg(
        n_if(F.col("alert") != (F.col("failure_risk") >= alert_at)).alias("wrong_alerts"),
        n_if(F.col("anomaly_flag") != (F.col("anomaly_score") >= F.col("anomaly_threshold"))).alias("wrong_flags"),
        n_if(F.col("alert") & F.col("reason_1").isNull()).alias("alerts_without_reason"),
    )
    rows = [
        _row("thresholds_applied", c, F.col(c) == 0, F.lit(0), F.col(c))
        for c in ("wrong_alerts", "wrong_flags", "alerts_without_reason")
    ]
    return _rows(one, rows)


def reproducible(stored: DataFrame, again: DataFrame, columns: list[str], p: FleetParams) -> DataFrame:
    """Scores computed again against the stored ones."""
    b = again.select(*p.keys, *[F.col(c).alias(f"_b_{c}") for c in columns])
    worst = F.greatest(F.lit(0.0), *[F.abs(F.col(c) - F.col(f"_b_{c}")) for c in columns])
    one = by_step(stored, b, p.keys).agg(F.coalesce(F.max(worst), F.lit(0.0)).alias("_worst"), F.count(F.lit(1)).alias("_n"))
    return one.select(
        *_row("reproducible", "max_difference", (F.col("_worst") < 1e-9) & (F.col("_n") > 0), F.lit(0), F.col("_worst"))
    )


def metrics_reproduced(card: DataFrame, recomputed: DataFrame) -> DataFrame:
    names = ["alerts", "events_caught", "failure_events", "false_alarms", "net_saving"]
    return compare_one_row("metrics_reproduced", card.select(*names), recomputed.select(*names))


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-insensitive fingerprint: row count and sum of row digests.

    A row's text is its values with ``|`` between them: times to the microsecond, other numbers
    that are not whole with nine decimals, ``~`` for NULL. Fifteen hexadecimal digits of its md5
    are added up.
    """
    texts = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind in ("double", "float"):
            c = c.cast("double").cast("decimal(38,9)")
        texts.append(F.coalesce(c.cast("string"), F.lit("~")))
    digest = F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 15), 16, 10).cast("decimal(38,0)")
    total = F.coalesce(F.sum(digest).cast("string"), F.lit("0"))
    return df.agg(F.count(F.lit(1)).alias("row_count"), total.alias("hash_sum"))


def data_unchanged(trained_on: DataFrame, today: DataFrame) -> DataFrame:
    a = trained_on.select(F.struct("row_count", "hash_sum").alias("_a"), F.col("row_count").alias("_na"))
    b = today.select(F.struct("row_count", "hash_sum").alias("_b"), F.col("row_count").alias("_nb"))
    both = a.crossJoin(F.broadcast(b))
    return both.select(*_row("data_unchanged", "fingerprint", F.col("_a") == F.col("_b"), F.col("_na"), F.col("_nb")))


def beats_baseline(model: DataFrame, baseline: DataFrame, metrics: list[str]) -> DataFrame:
    """A model must be strictly better than its baseline on every metric."""
    a = model.select(*[F.col(m).alias(f"_a_{m}") for m in metrics])
    b = baseline.agg(*[F.max(m).alias(f"_b_{m}") for m in metrics])
    rows = [
        _row("beats_baseline", m, F.col(f"_a_{m}") > F.col(f"_b_{m}"), F.col(f"_b_{m}"), F.col(f"_a_{m}"))
        for m in metrics
    ]
    return a.crossJoin(F.broadcast(b)).select(F.inline(F.array(*[F.struct(*r) for r in rows])))


# ---------------------------------------------------------------- roll-up


def roll_up(reports: dict[str, DataFrame | None]) -> DataFrame:
    """Per layer: passed, checks passed and run. A missing report gives NULLs."""
    parts = []
    for layer, checks in reports.items():
        if checks is None:
            continue
        parts.append(
            checks.agg(
                F.lit(layer).alias("layer"),
                F.min("passed").alias("passed"),
                n_if(F.col("passed")).alias("checks_passed"),
                F.count(F.lit(1)).alias("checks_run"),
            )
        )
    out = _all(parts)
    missing = [layer for layer, checks in reports.items() if checks is None]
    if missing:
        empty = out.sparkSession.createDataFrame([(m, None, None, None) for m in missing], out.schema.simpleString()[7:-1].replace(":", " "))
        out = out.unionByName(empty)
    return out


def report_metrics(reports: dict[str, DataFrame], tables: dict[str, DataFrame], scenarios: DataFrame | None = None) -> DataFrame:
    """Long metrics: pass flag per layer, row count per table, net saving per scenario."""
    metric = lambda layer, name, value: [
        layer.alias("layer"), name.alias("metric"), value.cast("double").alias("value")
    ]
    parts = [
        c.agg(F.min("passed").cast("int").alias("_v")).select(*metric(F.lit(n), F.lit("report_passed"), F.col("_v")))
        for n, c in reports.items()
    ]
    parts += [
        df.agg(F.count(F.lit(1)).alias("_v")).select(*metric(F.lit("warehouse"), F.lit(f"rows_{n}"), F.col("_v")))
        for n, df in tables.items()
    ]
    if scenarios is not None:
        name = F.concat(F.lit("net_saving_"), F.replace("name", F.lit(" "), F.lit("_")))
        parts.append(scenarios.select(*metric(F.lit("insights"), name, F.col("net_saving"))))
    return _all(parts)


def model_comparison(failure: DataFrame, component: DataFrame, anomaly: DataFrame) -> DataFrame:
    """One row per model: test result, baseline result and whether it wins."""
    row = lambda df, name, metric: df.select(
        F.lit(name).alias("model"),
        F.lit(metric).alias("metric"),
        F.col("value").cast("double").alias("result"),
        F.col("baseline").cast("double").alias("baseline"),
        (F.col("value") > F.col("baseline")).alias("beats_baseline"),
    )
    return _all(
        [row(failure, "failure", "net_saving"), row(component, "component", "top1"), row(anomaly, "anomaly", "lift_48h")]
    )


