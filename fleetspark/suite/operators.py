"""Queries of single operators that the composed queries use only in passing."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetspark.functions.ordered import exact_quantiles, global_rank
from fleetspark.functions.times import ceil_us, from_micros, hours_crossed, micros
from fleetspark.functions.typing import ratio
from fleetspark.operators import timejoin as J
from fleetspark.plans import checks as C
from fleetspark.plans import explore as X
from fleetspark.plans import kpis
from fleetspark.plans.questions import age_band
from fleetspark.suite.blocks import COMPS, ERRORS, SENSORS, each
from fleetspark.suite.layers import round6
from fleetspark.suite.registry import query, r6
from fleetspark.suite.worlds import event_world, supply_world

DAY = 24 * 3_600_000_000


@query(
    "e7_range_semi_join",
    """SELECT e.timestamp, e.machine_id, e.error_id, EXISTS (SELECT 1 FROM failures_e AS f WHERE f.machine_id = e.machine_id
    AND f.timestamp > e.timestamp AND f.timestamp <= e.timestamp + INTERVAL 24 HOUR) AS fails_soon FROM errors_e AS e""",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return J.exists_between(w.errors, w.failures, w.p.for_events(), DAY, "fails_soon")


@query(
    "e8_asof_backward",
    f"""SELECT e.timestamp, e.machine_id, e.error_id, {each("max(m.timestamp) FILTER (WHERE m.component = '{x}') AS {x}", COMPS)}
    FROM errors_e AS e LEFT JOIN maintenance_e AS m ON m.machine_id = e.machine_id AND m.timestamp <= e.timestamp GROUP BY 1, 2, 3""",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return J.asof_backward(w.errors, w.maintenance, w.p.for_events(), {c: F.col("component") == c for c in COMPS})


@query(
    "e9_next_after",
    f"""SELECT e.timestamp, e.machine_id, e.error_id, {each("min(m.timestamp) FILTER (WHERE m.component = '{x}') AS {x}", COMPS)}
    FROM errors_e AS e LEFT JOIN failures_e AS m ON m.machine_id = e.machine_id AND m.timestamp > e.timestamp GROUP BY 1, 2, 3""",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return J.next_after(w.errors, w.failures, w.p.for_events(), {c: F.col("component") == c for c in COMPS})


@query(
    "e10_interval_count",
    f"""SELECT f.timestamp, f.machine_id, f.component, {each("count(*) FILTER (WHERE e.error_id = '{x}') AS {x}", ERRORS)}
    FROM failures_e AS f LEFT JOIN errors_e AS e ON e.machine_id = f.machine_id AND e.timestamp <= f.timestamp
     AND e.timestamp > f.timestamp - INTERVAL 48 HOUR GROUP BY 1, 2, 3""",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return J.count_between(w.failures, w.errors, w.p, -2 * DAY, 0, {e: F.col("error_id") == e for e in ERRORS})


@query(
    "e2_star_join",
    """SELECT r_name, d.year, count(*) AS lines, sum(l_quantity) AS quantity FROM lineitem
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    JOIN dim_date_l AS d ON d.date = CAST(l_shipdate AS DATE) GROUP BY ALL""",
)
def _(spark, sf_dir):
    w = supply_world(spark, sf_dir)
    lines = w.table("lineitem").groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("date")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q")
    )
    place = (
        w.table("supplier")
        .join(w.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(w.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return (
        lines.join(place, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(w.dim_date.select("date", "year"), "date")
        .groupBy("r_name", "year")
        .agg(F.sum("n").alias("lines"), F.sum("q").alias("quantity"))
    )


@query(
    "e6_anti_join",
    "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')",
)
def _(spark, sf_dir):
    w = supply_world(spark, sf_dir)
    returned = w.table("lineitem").where("l_returnflag = 'R'")
    orders = w.table("orders").select("o_orderkey")
    return orders.join(returned, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")


@query(
    "f4_distinct_tuples",
    "SELECT component, count(DISTINCT (machine_id, timestamp)) AS events, count(DISTINCT machine_id) AS machines FROM failures_l GROUP BY 1",
)
def _(spark, sf_dir):
    w = supply_world(spark, sf_dir)
    return w.failures.groupBy("component").agg(
        F.countDistinct(F.struct("machine_id", "timestamp")).alias("events"), F.countDistinct("machine_id").alias("machines")
    )


@query(
    "f8_ordered_list",
    "SELECT machine_id, timestamp, string_agg(component, '+' ORDER BY component) AS components FROM failures_l GROUP BY ALL HAVING count(*) > 1",
)
def _(spark, sf_dir):
    w = supply_world(spark, sf_dir)
    listed = F.expr("listagg(component, '+') WITHIN GROUP (ORDER BY component)").alias("components")
    return w.failures.groupBy("machine_id", "timestamp").agg(listed, F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")


@query(
    "f12_machine_profile",
    f"SELECT machine_id, {each(r6('median({x})') + ' AS {x}_median')}, {each(r6('stddev_samp({x})') + ' AS {x}_std')} FROM ranged GROUP BY machine_id",
)
def _(spark, sf_dir):
    from fleetspark.operators import cleaning

    w = event_world(spark, sf_dir)
    rows = cleaning.null_out_of_range(cleaning.deduplicate(w.readings, w.p), w.p)
    return round6(X.machine_profile(rows, SENSORS), [f"{s}_{m}" for s in SENSORS for m in ("median", "std")])


_marks = [0.001, 0.01, 0.25, 0.5, 0.75, 0.99, 0.999]


@query(
    "f14_exact_quantiles",
    " UNION ALL ".join(
        f"SELECT l_returnflag, {q}::DOUBLE AS probability, {r6(f'quantile_cont(l_extendedprice, {q})')} AS quantile FROM lineitem GROUP BY 1"
        for q in _marks
    ),
)
def _(spark, sf_dir):
    w = supply_world(spark, sf_dir)
    return round6(exact_quantiles(w.table("lineitem"), "l_extendedprice", _marks, ["l_returnflag"]), ["quantile"])


@query("g1_global_rank", "SELECT o_orderkey, rank() OVER (ORDER BY o_orderdate DESC) AS date_rank FROM orders")
def _(spark, sf_dir):
    w = supply_world(spark, sf_dir)
    rows = w.table("orders").select("o_orderkey", F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("_at"))
    return global_rank(rows, [("_at", True)], "date_rank").drop("_at")


@query(
    "g3_previous_failure",
    "SELECT machine_id, component, timestamp, lag(timestamp) OVER (PARTITION BY machine_id, component ORDER BY timestamp) AS previous_at FROM failures_l",
)
def _(spark, sf_dir):
    w = supply_world(spark, sf_dir)
    return J.previous_time(w.failures, w.p, ["component"])


@query(
    "h3_top_k_per_group",
    "SELECT machine_id, component, n FROM (SELECT machine_id, component, count(*) AS n, row_number() OVER (PARTITION BY machine_id ORDER BY count(*) DESC, component) AS k "
    "FROM lines_l GROUP BY 1, 2) WHERE k <= 2",
)
def _(spark, sf_dir):
    from pyspark.sql import Window

    w = supply_world(spark, sf_dir)
    counts = w.lines.groupBy("machine_id", "component").agg(F.count(F.lit(1)).alias("n"))
    best = Window.partitionBy("machine_id").orderBy(F.desc("n"), "component")
    return counts.withColumn("k", F.row_number().over(best)).where("k <= 2").drop("k")


@query("h2_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def _(spark, sf_dir):
    w = supply_world(spark, sf_dir)
    return w.table("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("f18_hours_per_month", "SELECT month, period_hours FROM months_l")
def _(spark, sf_dir):
    return kpis.period_months(supply_world(spark, sf_dir).period)


@query(
    "f17_pivot",
    "SELECT component, " + each("count(*) FILTER (WHERE m.model = '{x}') AS {x}", ["model1", "model2", "model3", "model4"])
    + " FROM failures_l JOIN machines_l AS m USING (machine_id) GROUP BY component",
)
def _(spark, sf_dir):
    w = supply_world(spark, sf_dir)
    rows = w.failures.join(w.machines.select("machine_id", "model"), "machine_id")
    return X.pivot_counts(rows, "component", "model", ["model1", "model2", "model3", "model4"])


@query("f21_resample_monthly", "SELECT date_trunc('month', timestamp) AS month_start, count(*) AS n FROM lines_l GROUP BY 1")
def _(spark, sf_dir):
    return X.resample_monthly(supply_world(spark, sf_dir).lines)


_stats = {"p0_001": 0.001, "p0_5": 0.5, "p0_999": 0.999}


@query(
    "f22_describe",
    " UNION ALL ".join(
        f"SELECT '{c}' AS name, count({c}) AS n, {r6(f'avg({c})')} AS mean, {r6(f'stddev_samp({c})')} AS std, min({c}) AS min, max({c}) AS max, "
        + ", ".join(f"{r6(f'quantile_cont({c}, {q})')} AS {n}" for n, q in _stats.items())
        + " FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount")
    ),
)
def _(spark, sf_dir):
    w = supply_world(spark, sf_dir)
    out = X.describe(w.table("lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return round6(out, ["mean", "std", *_stats])


@query(
    "f22_correlations",
    " UNION ALL ".join(
        f"SELECT '{a}' AS left_name, '{b}' AS right_name, {r6(f'corr({a}, {b})')} AS corr FROM ranged" for a in SENSORS for b in SENSORS
    ),
)
def _(spark, sf_dir):
    from fleetspark.operators import cleaning

    w = event_world(spark, sf_dir)
    rows = cleaning.null_out_of_range(cleaning.deduplicate(w.readings, w.p), w.p)
    return round6(X.correlations(rows, SENSORS), ["corr"])


#: Tables with their SQL name and columns.
_over = {
    "readings": ("readings", ["machine_id", "timestamp", "_source_line", *SENSORS]),
    "errors": ("errors_e", ["timestamp", "machine_id", "error_id"]),
    "failures": ("failures_e", ["timestamp", "machine_id", "component"]),
    "maintenance": ("maintenance_e", ["timestamp", "machine_id", "component"]),
    "machines": ("machines_e", ["machine_id", "model", "age", "plant_id", "plant_name", "city", "line_id"]),
}


@query(
    "f23_overview",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count, count(DISTINCT machine_id) AS machines, "
        f"{' + '.join(f'count(*) FILTER (WHERE {c} IS NULL)' for c in cols)} AS nulls, "
        f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(cols)} FROM {b})) AS duplicate_rows, "
        + ("min(timestamp) AS first_at, max(timestamp) AS last_at" if "timestamp" in cols else "CAST(NULL AS TIMESTAMP) AS first_at, CAST(NULL AS TIMESTAMP) AS last_at")
        + f" FROM {b}"
        for n, (b, cols) in _over.items()
    ),
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return X.overview({n: getattr(w, n) for n in _over})


@query(
    "f23_grid_coverage",
    f"""SELECT actual, expected, {r6('actual / expected')} AS coverage FROM (SELECT count(DISTINCT (machine_id, timestamp)) AS actual,
    ((epoch_us(max(timestamp)) - epoch_us(min(timestamp))) // 43200000000 + 1) * count(DISTINCT machine_id) AS expected FROM readings)""",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return round6(X.grid_coverage(w.readings, w.p), ["coverage"])


_texts = ", ".join(
    ["CAST(machine_id AS VARCHAR)", "strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f')", "CAST(_source_line AS VARCHAR)"]
    + [f"CAST(CAST({s} AS DECIMAL(38,9)) AS VARCHAR)" for s in ("volt", "rotate", "pressure", "vibration")]
)


@query(
    "f24_fingerprint",
    f"""SELECT count(*) AS row_count, CAST(sum(CAST('0x' || md5(array_to_string(list_transform([{_texts}],
    lambda x: coalesce(x, '~')), '|'))[:15] AS HUGEINT)) AS VARCHAR) AS hash_sum FROM readings""",
)
def _(spark, sf_dir):
    return C.fingerprint(event_world(spark, sf_dir).readings)


@query(
    "i6_melt",
    "SELECT event_id, 'v' AS name, value AS measure FROM ev UNION ALL SELECT event_id, 'k', CAST(k AS DOUBLE) FROM ev",
)
def _(spark, sf_dir):
    rows = event_world(spark, sf_dir).events.select("event_id", F.col("value").alias("v"), F.col("k").cast("double").alias("k"))
    return X.melt(rows, ["event_id"], ["v", "k"], "name", "measure")


@query(
    "j6_ceil_to_step",
    "SELECT event_id, make_timestamp(((epoch_us(timestamp) + 3599999999) // 3600000000) * 3600000000) AS visible_at FROM ev",
)
def _(spark, sf_dir):
    hour = ceil_us(micros("timestamp"), 3_600_000_000)
    return event_world(spark, sf_dir).events.select("event_id", from_micros(hour).alias("visible_at"))


@query(
    "j7_hours_crossed",
    "SELECT event_id, date_diff('hour', timestamp, TIMESTAMP '2024-02-01') AS hours FROM ev",
)
def _(spark, sf_dir):
    end = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return event_world(spark, sf_dir).events.select("event_id", hours_crossed("timestamp", end).alias("hours"))


@query("j13_sha256", "SELECT doc_id, sha256(text) AS digest FROM documents")
def _(spark, sf_dir):
    docs = event_world(spark, sf_dir).table("documents")
    return docs.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))


@query(
    "j10_age_bands",
    """SELECT CASE WHEN age < 5 THEN '0-4 years' WHEN age < 10 THEN '5-9 years' WHEN age < 15 THEN '10-14 years' ELSE '15+ years' END AS band,
    count(*) AS machines FROM machines_l GROUP BY 1""",
)
def _(spark, sf_dir):
    return supply_world(spark, sf_dir).machines.groupBy(age_band().alias("band")).agg(F.count(F.lit(1)).alias("machines"))


@query(
    "j15_report_checks",
    """SELECT 'raw' || machine_id AS layer, 'errors: row_count' AS check_name, count(*) > 60 AS passed FROM errors_e GROUP BY machine_id
    UNION ALL SELECT 'gold' || machine_id, 'labels', count(*) > 60 FROM errors_e GROUP BY machine_id
    UNION ALL SELECT 'silver' || machine_id, 'manifest_check', count(*) > 60 FROM errors_e GROUP BY machine_id
    UNION ALL SELECT 'bronze' || machine_id, 'table errors', count(*) > 60 FROM errors_e GROUP BY machine_id""",
)
def _(spark, sf_dir):
    """Reports of the four shapes, built per machine from its number of errors."""
    w = event_world(spark, sf_dir)
    ok = (F.col("n") > 60).cast("string")
    shapes = {
        "raw": ('{"results": [{"table": "errors", "check": "row_count", "passed": ', "}]}"),
        "gold": ('{"checks": {"labels": {"rows": 3, "passed": ', "}}}"),
        "silver": ('{"passed": true, "manifest_check": {"status": "checked", "passed": ', "}}"),
        "bronze": ('{"tables": {"errors": {"rows": 1, "passed": ', "}}}"),
    }
    texts = F.explode(
        F.array(
            *[
                F.struct(
                    F.concat(F.lit(n), F.col("machine_id").cast("string")).alias("layer"),
                    F.concat(F.lit(a), ok, F.lit(b)).alias("report"),
                )
                for n, (a, b) in shapes.items()
            ]
        )
    )
    counts = w.errors.groupBy("machine_id").agg(F.count(F.lit(1)).alias("n"))
    return X.report_checks(counts.select(texts.alias("_r")).select("_r.*"))


@query(
    "g16_share_of_total",
    f"SELECT error_id, count(*) AS n, {r6('count(*) / sum(count(*)) OVER ()')} AS share FROM errors_e GROUP BY 1",
)
def _(spark, sf_dir):
    from fleetspark.functions.ordered import share_of_total

    counts = event_world(spark, sf_dir).errors.groupBy("error_id").agg(F.count(F.lit(1)).alias("n"))
    return round6(share_of_total(counts, {"share": "n"}), ["share"])


@query(
    "c20_safe_division",
    f"SELECT user_id, {r6('count(*) FILTER (WHERE event_type = ' + repr('purchase') + ') / nullif(count(*) FILTER (WHERE event_type = ' + repr('signup') + '), 0)')} AS purchases_per_signup FROM events GROUP BY 1",
)
def _(spark, sf_dir):
    counts = event_world(spark, sf_dir).table("events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "purchase").alias("p"), F.count_if(F.col("event_type") == "signup").alias("s")
    )
    return round6(counts.select("user_id", ratio("p", "s").alias("purchases_per_signup")), ["purchases_per_signup"])
