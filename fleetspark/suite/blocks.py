"""Shared SQL building blocks: the bindings and every derived layer of both worlds."""

from __future__ import annotations

from fleetspark.bindings import EVENT_PARAMS as P
from fleetspark.params import FleetParams
from fleetspark.suite.registry import block, r6

SENSORS = list(P.sensors)
COMPS = list(P.components)
ERRORS = list(P.error_types)
U, W, H = P.unit, P.longest, P.horizon
STEP_H = 12
SLOT = STEP_H * 3600 * 1_000_000


def each(template: str, items=SENSORS, sep: str = ", ") -> str:
    return sep.join(template.replace("{x}", i) for i in items)


def components_sql(p: FleetParams) -> str:
    rows = ", ".join(
        f"('{c}', {float(v.repair_cost)}::DOUBLE, {float(v.unplanned_downtime_hours)}::DOUBLE, "
        f"{float(v.planned_downtime_hours)}::DOUBLE)"
        for c, v in p.components.items()
    )
    rate, premium = float(p.downtime_cost_per_hour), float(p.emergency_premium)
    return f"""
SELECT component, repair_cost, unplanned_downtime_hours, planned_downtime_hours,
       repair_cost * {premium}::DOUBLE AS unplanned_repair_cost, {rate}::DOUBLE AS downtime_cost_per_hour,
       repair_cost * {premium}::DOUBLE + unplanned_downtime_hours * {rate}::DOUBLE AS unplanned_failure_cost,
       repair_cost + planned_downtime_hours * {rate}::DOUBLE AS planned_maintenance_cost,
       repair_cost * {premium}::DOUBLE + unplanned_downtime_hours * {rate}::DOUBLE
           - (repair_cost + planned_downtime_hours * {rate}::DOUBLE) AS saving_if_prevented,
       '{p.currency}' AS currency
FROM (VALUES {rows}) AS v(component, repair_cost, unplanned_downtime_hours, planned_downtime_hours)"""


block("costs", components_sql(P))

# ---------------------------------------------------------------- events world

block(
    "ev",
    "SELECT event_id, ts AS timestamp, user_id AS machine_id, event_type, value, "
    "CAST(regexp_extract(props, '[0-9]+', 0) AS INTEGER) AS k FROM events",
)
block(
    "readings",
    f"""SELECT machine_id, make_timestamp((epoch_us(timestamp) // {SLOT}) * {SLOT}) AS timestamp,
       event_id AS _source_line, value AS volt, k::DOUBLE AS rotate,
       CAST(floor(value / 25) * 25 AS DOUBLE) AS pressure,
       CASE WHEN k % 5 <> 0 THEN k::DOUBLE END AS vibration FROM ev""",
)
block(
    "errors_e",
    "SELECT timestamp, machine_id, CASE event_type WHEN 'click' THEN 'error1' WHEN 'error' THEN 'error2' "
    "WHEN 'purchase' THEN 'error3' WHEN 'signup' THEN 'error4' ELSE 'error5' END AS error_id FROM ev",
)
block(
    "failures_e",
    "SELECT timestamp, machine_id, 'comp' || CAST(k % 4 + 1 AS VARCHAR) AS component FROM ev "
    "WHERE event_type = 'error' AND k < 50",
)
block(
    "maintenance_e",
    "SELECT timestamp, machine_id, 'comp' || CAST(k % 4 + 1 AS VARCHAR) AS component FROM ev "
    "WHERE event_type = 'purchase' OR (event_type = 'error' AND k < 50 AND k % 2 = 0)",
)
block(
    "machines_e",
    """SELECT u.machine_id, 'model' || CAST(u.machine_id % 4 + 1 AS VARCHAR) AS model, u.machine_id % 21 AS age,
       'P' || CAST(r.r_regionkey AS VARCHAR) AS plant_id, r.r_name AS plant_name, r.r_name AS city,
       'L' || CAST(n.n_nationkey AS VARCHAR) AS line_id
FROM (SELECT DISTINCT machine_id FROM ev) AS u
LEFT JOIN (customer AS c JOIN nation AS n ON c.c_nationkey = n.n_nationkey
           JOIN region AS r ON n.n_regionkey = r.r_regionkey) ON c.c_custkey = u.machine_id""",
)
block(
    "deduped",
    "SELECT * FROM readings QUALIFY row_number() OVER (PARTITION BY machine_id, timestamp ORDER BY _source_line) = 1",
)
block(
    "ranged",
    "SELECT machine_id, timestamp, _source_line, "
    + ", ".join(
        f"CASE WHEN {s} BETWEEN {v.min} AND {v.max} THEN {s} END AS {s}" for s, v in P.sensors.items()
    )
    + " FROM deduped",
)
block(
    "repeats",
    "SELECT *, "
    + each(
        f"coalesce(lag(timestamp) OVER w + INTERVAL {STEP_H} HOUR = timestamp AND lag({{x}}) OVER w = {{x}}, false)"
        " AS rep_{x}"
    )
    + " FROM ranged WINDOW w AS (PARTITION BY machine_id ORDER BY timestamp)",
)
block(
    "run_ids",
    "SELECT *, "
    + each("sum(CASE WHEN rep_{x} THEN 0 ELSE 1 END) OVER w AS run_{x}")
    + " FROM repeats WINDOW w AS (PARTITION BY machine_id ORDER BY timestamp)",
)
block(
    "stuck_marks",
    "SELECT *, "
    + each(
        f"(rep_{{x}} AND count(*) OVER (PARTITION BY machine_id, run_{{x}}) >= {P.stuck_min_run}) AS stuck_{{x}}"
    )
    + " FROM run_ids",
)
block(
    "unstuck",
    "SELECT machine_id, timestamp, _source_line, "
    + each("CASE WHEN NOT stuck_{x} THEN {x} END AS {x}")
    + " FROM stuck_marks",
)
block(
    "gridded",
    f"""SELECT g.machine_id, g.timestamp, {each('u.{x}')}, u._source_line
FROM (SELECT machine_id, unnest(generate_series(min(timestamp), max(timestamp), INTERVAL {STEP_H} HOUR)) AS timestamp
      FROM unstuck GROUP BY machine_id) AS g
LEFT JOIN unstuck AS u ON u.machine_id = g.machine_id AND u.timestamp = g.timestamp""",
)
block(
    "gap_ids",
    "SELECT *, "
    + each("sum(CASE WHEN {x} IS NOT NULL THEN 1 ELSE 0 END) OVER w AS gap_{x}")
    + " FROM gridded WINDOW w AS (PARTITION BY machine_id ORDER BY timestamp)",
)
_half = P.fill_window // 2
block(
    "gap_facts",
    "SELECT *, "
    + each(
        "sum(CASE WHEN {x} IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY machine_id, gap_{x}) AS len_{x}, "
        "max(CASE WHEN {x} IS NOT NULL THEN timestamp END) OVER (PARTITION BY machine_id) AS last_{x}, "
        "avg({x}) OVER c AS avg_{x}, count({x}) OVER c AS n_{x}"
    )
    + f" FROM gap_ids WINDOW c AS (PARTITION BY machine_id ORDER BY timestamp "
    f"ROWS BETWEEN {_half} PRECEDING AND {_half} FOLLOWING)",
)
block(
    "silver",
    "SELECT machine_id, timestamp, "
    + each("CASE WHEN fill_{x} THEN avg_{x} ELSE {x} END AS {x}")
    + ", "
    + each(
        "CASE WHEN fill_{x} THEN 'filled' WHEN {x} IS NULL THEN 'missing' ELSE 'ok' END AS {x}_quality"
    )
    + ", _source_line FROM (SELECT *, "
    + each(
        f"({{x}} IS NULL AND gap_{{x}} > 0 AND coalesce(timestamp < last_{{x}}, false) "
        f"AND len_{{x}} <= {P.max_fill} AND n_{{x}} >= {max(P.fill_window // 2, 1)}) AS fill_{{x}}"
    )
    + " FROM gap_facts)",
)


def _frames() -> str:
    parts = []
    for s in SENSORS:
        for w in P.windows:
            need = max(2, w // 2)
            parts.append(f"CASE WHEN count({s}) OVER w{w} >= {need} THEN avg({s}) OVER w{w} END AS {s}_m{w}")
            parts.append(
                f"CASE WHEN count({s}) OVER w{w} >= {need} THEN stddev_samp({s}) OVER w{w} END AS {s}_s{w}"
            )
        for q in ("filled", "missing"):
            parts.append(f"avg(CAST({s}_quality = '{q}' AS INTEGER)) OVER w{W} AS {s}_{q}")
    return ", ".join(parts)


def _features() -> str:
    parts = []
    for s in SENSORS:
        for w in P.windows:
            parts.append(f"CAST({s}_m{w} AS FLOAT) AS {s}_mean_{w}{U}")
            parts.append(f"CAST({s}_s{w} AS FLOAT) AS {s}_std_{w}{U}")
        parts.append(f"CAST({s}_m{P.shortest} - {s}_m{W} AS FLOAT) AS {s}_trend")
        for q in ("filled", "missing"):
            parts.append(f"CAST({s}_{q} AS FLOAT) AS {s}_{q}_share_{W}{U}")
    return ", ".join(parts)


_windows = ", ".join(
    f"w{w} AS (PARTITION BY machine_id ORDER BY timestamp ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
    for w in P.windows
)
block(
    "sensor_features_e",
    f"""SELECT machine_id, timestamp, {_features()} FROM (
  SELECT machine_id, timestamp, {_frames()},
         min(timestamp) OVER (PARTITION BY machine_id) AS first_at FROM silver WINDOW {_windows})
WHERE timestamp >= first_at + INTERVAL {(W - 1) * STEP_H} HOUR
  AND ((epoch_us(timestamp) - (SELECT min(epoch_us(timestamp)) FROM silver)) // {SLOT}) % {P.feature_step} = 0""",
)
block("spine", "SELECT machine_id, timestamp FROM sensor_features_e")


def ceil_slot(c: str) -> str:
    return f"make_timestamp(((epoch_us({c}) + {SLOT} - 1) // {SLOT}) * {SLOT})"


block(
    "event_counts_e",
    f"""SELECT s.machine_id, s.timestamp, {each("CAST(count(*) FILTER (WHERE e.error_id = '{x}') AS INTEGER) AS {x}_count_" + f"{W}{U}", ERRORS)},
       CAST(count(e.error_id) AS INTEGER) AS errors_total_{W}{U}
FROM spine AS s LEFT JOIN (SELECT machine_id, {ceil_slot('timestamp')} AS at, error_id FROM errors_e) AS e
  ON e.machine_id = s.machine_id AND e.at <= s.timestamp AND e.at > s.timestamp - INTERVAL {W * STEP_H} HOUR
GROUP BY s.machine_id, s.timestamp""",
)
block(
    "replaced_e",
    f"""SELECT s.machine_id, s.timestamp, {each("CAST((epoch_us(s.timestamp) - max(epoch_us(m.at)) FILTER (WHERE m.component = '{x}')) / 3600000000.0 AS FLOAT) AS hours_since_{x}_replaced", COMPS)}
FROM spine AS s LEFT JOIN (SELECT machine_id, {ceil_slot('timestamp')} AS at, component FROM maintenance_e) AS m
  ON m.machine_id = s.machine_id AND m.at <= s.timestamp GROUP BY s.machine_id, s.timestamp""",
)
block(
    "event_features_e",
    f"""SELECT c.machine_id, c.timestamp, {each('c.{x}_count_' + f'{W}{U}', ERRORS)}, c.errors_total_{W}{U},
       {each('r.hours_since_{x}_replaced', COMPS)}, m.model, m.age, m.plant_id, m.line_id
FROM event_counts_e AS c JOIN replaced_e AS r USING (machine_id, timestamp) LEFT JOIN machines_e AS m USING (machine_id)""",
)
block(
    "failure_times",
    "SELECT machine_id, timestamp AS failed_at, string_agg(DISTINCT component, '+' ORDER BY component) AS comps "
    "FROM failures_e GROUP BY machine_id, timestamp",
)
block(
    "labels_e",
    f"""SELECT machine_id, timestamp,
       CAST((epoch_us(next_at) - epoch_us(timestamp)) / 3600000000.0 AS FLOAT) AS hours_to_failure,
       CAST(coalesce(next_at <= timestamp + INTERVAL {H * STEP_H} HOUR, false) AS TINYINT) AS {P.target},
       {each(f"CAST({{x}}_n > 0 AS TINYINT) AS {{x}}_fails_within_{H}{U}", COMPS)},
       CASE WHEN next_at <= timestamp + INTERVAL {H * STEP_H} HOUR THEN
            (SELECT f.comps FROM failure_times AS f WHERE f.machine_id = q.machine_id AND f.failed_at = q.next_at)
            ELSE 'none' END AS failed_component,
       next_at AS next_failure_at
FROM (SELECT s.machine_id, s.timestamp, min(f.timestamp) AS next_at,
             {each(f"count(*) FILTER (WHERE f.component = '{{x}}' AND f.timestamp <= s.timestamp + INTERVAL {H * STEP_H} HOUR) AS {{x}}_n", COMPS)}
      FROM spine AS s LEFT JOIN failures_e AS f ON f.machine_id = s.machine_id AND f.timestamp > s.timestamp
      WHERE s.timestamp + INTERVAL {H * STEP_H} HOUR <= (SELECT max(timestamp) FROM silver)
      GROUP BY s.machine_id, s.timestamp) AS q""",
)
TRAIN_END = f"TIMESTAMP '{P.train_end}'"
VAL_START = f"TIMESTAMP '{P.validation_start}'"
block(
    "dataset_e",
    f"""SELECT * FROM (SELECT s.*, e.* EXCLUDE (machine_id, timestamp), l.* EXCLUDE (machine_id, timestamp),
  CASE WHEN s.timestamp + INTERVAL {H * STEP_H} HOUR < {TRAIN_END} THEN 'train'
       WHEN s.timestamp >= {TRAIN_END} THEN 'test' END AS split
FROM sensor_features_e AS s JOIN event_features_e AS e USING (machine_id, timestamp)
JOIN labels_e AS l USING (machine_id, timestamp)) WHERE split IS NOT NULL""",
)
block(
    "parts_e",
    f"""SELECT *, 'fit' AS part FROM dataset_e WHERE split = 'train' AND timestamp + INTERVAL {H * STEP_H} HOUR < {VAL_START}
UNION ALL SELECT *, 'validation' FROM dataset_e WHERE split = 'train' AND timestamp >= {VAL_START}
UNION ALL SELECT *, 'development' FROM dataset_e WHERE split = 'train'
UNION ALL SELECT *, 'test' FROM dataset_e WHERE split = 'test'""",
)

# ---------------------------------------------------------------- anomaly score and predictions

INPUTS = [
    f"{s}_{stat}" for s in SENSORS for stat in [*(f"{m}_{w}{U}" for w in P.windows for m in ("mean", "std")), "trend"]
]
HEALTHY = f"({P.target} = 0 AND (hours_to_failure IS NULL OR hours_to_failure > 168))"
block("healthy_fit", f"SELECT * FROM parts_e WHERE part = 'fit' AND {HEALTHY}")
block(
    "medians_e",
    "SELECT " + each("quantile_cont(CAST({x} AS DOUBLE), 0.5) AS {x}__median", INPUTS) + " FROM healthy_fit",
)
block(
    "profile_e",
    "SELECT "
    + each(
        "avg(coalesce(CAST(f.{x} AS DOUBLE), m.{x}__median)) AS {x}__mean, "
        "stddev_pop(coalesce(CAST(f.{x} AS DOUBLE), m.{x}__median)) AS {x}__std, any_value(m.{x}__median) AS {x}__median",
        INPUTS,
    )
    + " FROM healthy_fit AS f, medians_e AS m",
)
_square = "pow((coalesce(CAST(s.{x} AS DOUBLE), p.{x}__median) - p.{x}__mean) / CASE WHEN p.{x}__std > 0 THEN p.{x}__std ELSE 1.0 END, 2)"
ANOMALY = "(" + each(_square, INPUTS, " + ") + f") / {float(len(INPUTS))}::DOUBLE"
block("anomaly_e", f"SELECT s.machine_id, s.timestamp, {ANOMALY} AS anomaly_score FROM sensor_features_e AS s, profile_e AS p")
block(
    "anomaly_threshold_e",
    f"SELECT quantile_cont(a.anomaly_score, 0.99) AS anomaly_threshold FROM anomaly_e AS a "
    f"JOIN (SELECT * FROM parts_e WHERE part = 'validation' AND {HEALTHY}) USING (machine_id, timestamp)",
)
block(
    "shares_e",
    f"""SELECT machine_id, timestamp, {each("CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE {x}_n / CAST(n AS DOUBLE) END AS {x}_risk", COMPS)}
FROM (SELECT s.machine_id, s.timestamp, count(f.component) AS n,
             {each("count(*) FILTER (WHERE f.component = '{x}') AS {x}_n", COMPS)}
      FROM spine AS s LEFT JOIN failures_e AS f ON f.machine_id = s.machine_id AND f.timestamp <= s.timestamp
      GROUP BY s.machine_id, s.timestamp)""",
)
RISK = f"least(1.0::DOUBLE, errors_total_{W}{U} / 10.0::DOUBLE)"
_best = "greatest(" + each("{x}_risk", COMPS) + ")"
block(
    "predictions_e",
    f"""SELECT machine_id, timestamp, {RISK} AS failure_risk, {RISK} >= 0.5 AS alert,
       CASE {each("WHEN {x}_risk = " + _best + " THEN '{x}'", COMPS, " ")} END AS predicted_component,
       {each("{x}_risk", COMPS)}, anomaly_score, anomaly_score >= anomaly_threshold AS anomaly_flag,
       CASE WHEN {RISK} >= 0.5 THEN 'errors raised ' || CAST(errors_total_{W}{U} AS VARCHAR) || ' times' END AS reason_1,
       CAST(NULL AS VARCHAR) AS reason_2, CAST(NULL AS VARCHAR) AS reason_3,
       timestamp >= {TRAIN_END} AS out_of_sample, 'rule' AS failure_model_version,
       'rule' AS component_model_version, 'rule' AS anomaly_model_version
FROM event_features_e JOIN anomaly_e USING (machine_id, timestamp) JOIN shares_e USING (machine_id, timestamp),
     anomaly_threshold_e""",
)


# ---------------------------------------------------------------- star schema of either world


def star_blocks(x: str, telemetry: str) -> None:
    """KPI and star blocks over failures_<x>, maintenance_<x>, machines_<x>."""
    block(
        f"period_{x}",
        f"SELECT min(timestamp) AS period_start, date_trunc('day', max(timestamp)) AS period_end FROM {telemetry}",
    )
    inside = "timestamp >= period_start AND timestamp < period_end"
    block(
        f"failure_ev_{x}",
        f"""SELECT machine_id, timestamp, count(*) AS components, max(unplanned_downtime_hours) AS downtime_h,
       sum(unplanned_failure_cost) AS cost
FROM failures_{x} JOIN costs USING (component), period_{x} WHERE {inside} GROUP BY machine_id, timestamp""",
    )
    block(
        f"planned_ev_{x}",
        f"""SELECT m.machine_id, m.timestamp, count(*) AS components, max(planned_downtime_hours) AS downtime_h,
       sum(planned_maintenance_cost) AS cost
FROM maintenance_{x} AS m JOIN costs USING (component), period_{x}
WHERE m.timestamp >= period_start AND m.timestamp < period_end
  AND NOT EXISTS (SELECT 1 FROM failures_{x} AS f WHERE f.machine_id = m.machine_id
                  AND f.timestamp = m.timestamp AND f.component = m.component)
GROUP BY m.machine_id, m.timestamp""",
    )
    block(
        f"months_{x}",
        f"""SELECT strftime(h, '%Y-%m') AS month, CAST(count(*) AS DOUBLE) AS period_hours
FROM (SELECT unnest(generate_series(period_start, period_end - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS h FROM period_{x})
GROUP BY 1""",
    )
    block(
        f"monthly_{x}",
        f"""SELECT *, 1 - downtime_h / nullif(period_hours, 0) AS availability,
       (period_hours - downtime_h) / nullif(failures, 0) AS mtbf_h, unplanned_downtime_h / nullif(failures, 0) AS mttr_h
FROM (SELECT m.machine_id, m.model, m.plant_id, m.line_id, t.month, t.period_hours,
       CAST(coalesce(f.n, 0) AS BIGINT) AS failures, CAST(coalesce(f.c, 0) AS BIGINT) AS components_failed,
       CAST(coalesce(p.n, 0) AS BIGINT) AS planned_maintenances,
       coalesce(f.d, 0)::DOUBLE AS unplanned_downtime_h, coalesce(p.d, 0)::DOUBLE AS planned_downtime_h,
       coalesce(f.d, 0)::DOUBLE + coalesce(p.d, 0)::DOUBLE AS downtime_h,
       coalesce(f.cost, 0)::DOUBLE AS failure_cost, coalesce(p.cost, 0)::DOUBLE AS maintenance_cost,
       coalesce(f.cost, 0)::DOUBLE + coalesce(p.cost, 0)::DOUBLE AS total_cost
FROM machines_{x} AS m CROSS JOIN months_{x} AS t
LEFT JOIN (SELECT machine_id, strftime(timestamp, '%Y-%m') AS month, count(*) AS n, sum(components) AS c,
                  sum(downtime_h) AS d, sum(cost) AS cost FROM failure_ev_{x} GROUP BY ALL) AS f USING (machine_id, month)
LEFT JOIN (SELECT machine_id, strftime(timestamp, '%Y-%m') AS month, count(*) AS n,
                  sum(downtime_h) AS d, sum(cost) AS cost FROM planned_ev_{x} GROUP BY ALL) AS p USING (machine_id, month))""",
    )
    block(
        f"dim_machine_{x}",
        f"SELECT machine_id, model, age, plant_id, plant_name, city, line_id FROM machines_{x}",
    )
    day = "year({t}) * 10000 + month({t}) * 100 + day({t})"
    # Each part of a machine at a time, failed, worked on or both, with how many parts failed then.
    block(
        f"touched_{x}",
        f"""SELECT machine_id, timestamp, component, bool_or(failed) AS failed, bool_or(NOT failed) AS worked,
       CAST({day.format(t="timestamp")} AS INTEGER) AS date_key
FROM (SELECT machine_id, timestamp, component, true AS failed FROM failures_{x}
      UNION ALL SELECT machine_id, timestamp, component, false FROM maintenance_{x}) GROUP BY ALL""",
    )
    block(
        f"fact_failure_{x}",
        f"""SELECT machine_id, date_key, timestamp, component, e.n AS components_in_event,
       unplanned_downtime_hours AS downtime_hours, unplanned_failure_cost AS failure_cost
FROM touched_{x} JOIN (SELECT machine_id, timestamp, count(*) AS n FROM failures_{x} GROUP BY ALL) AS e USING (machine_id, timestamp)
JOIN costs USING (component) WHERE failed""",
    )
    block(
        f"fact_maintenance_{x}",
        f"""SELECT machine_id, date_key, timestamp, component, if(failed, 'failure_repair', 'planned') AS maintenance_type,
       planned_downtime_hours * CAST(NOT failed AS INTEGER)::DOUBLE AS downtime_hours,
       planned_maintenance_cost * CAST(NOT failed AS INTEGER)::DOUBLE AS maintenance_cost
FROM touched_{x} JOIN costs USING (component) WHERE worked""",
    )
    block(
        f"fact_month_{x}",
        f"""SELECT CAST(split_part(month, '-', 1) AS INTEGER) * 10000 + CAST(split_part(month, '-', 2) AS INTEGER) * 100 + 1 AS month_date_key,
       * EXCLUDE (month, model, plant_id, line_id), month AS year_month FROM monthly_{x}""",
    )
    block(
        f"dim_date_{x}",
        f"""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date, CAST(year(d) AS INTEGER) AS year,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
       strftime(d, '%Y-%m') AS year_month, CAST(weekofyear(d) AS INTEGER) AS iso_week,
       CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
       isodow(d) >= 6 AS is_weekend
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT date_trunc('day', min(t)) AS lo, date_trunc('day', max(t)) AS hi FROM all_times_{x}))""",
    )


star_blocks("e", "silver")
block(
    "all_times_e",
    "SELECT timestamp AS t FROM silver UNION ALL SELECT timestamp FROM errors_e UNION ALL "
    "SELECT timestamp FROM maintenance_e UNION ALL SELECT timestamp FROM failures_e",
)
block(
    "fact_reading_e",
    " UNION ALL ".join(
        f"SELECT machine_id, CAST(strftime(timestamp, '%Y%m%d') AS INTEGER) AS date_key, timestamp, '{s}' AS sensor, "
        f"{s} AS value, {s}_quality AS quality FROM silver"
        for s in SENSORS
    ),
)
block(
    "fact_error_e",
    "SELECT machine_id, CAST(strftime(timestamp, '%Y%m%d') AS INTEGER) AS date_key, timestamp, error_id FROM errors_e",
)
block(
    "fact_prediction_e",
    "SELECT machine_id, CAST(strftime(timestamp, '%Y%m%d') AS INTEGER) AS date_key, timestamp, "
    "* EXCLUDE (machine_id, timestamp) FROM predictions_e",
)

# ---------------------------------------------------------------- supply world

block(
    "lines_l",
    "SELECT l_suppkey AS machine_id, l_shipdate AS timestamp, 'comp' || CAST(l_partkey % 4 + 1 AS VARCHAR) AS component, "
    "l_returnflag, l_orderkey % 3 = 0 AS third FROM lineitem",
)
block("failures_l", "SELECT DISTINCT timestamp, machine_id, component FROM lines_l WHERE l_returnflag = 'R'")
block(
    "maintenance_l",
    "SELECT DISTINCT timestamp, machine_id, component FROM lines_l "
    "WHERE l_returnflag = 'A' OR (l_returnflag = 'R' AND third)",
)
block(
    "machines_l",
    """SELECT s_suppkey AS machine_id, 'model' || CAST(s_suppkey % 4 + 1 AS VARCHAR) AS model, s_suppkey % 21 AS age,
       'P' || CAST(r_regionkey AS VARCHAR) AS plant_id, r_name AS plant_name, r_name AS city,
       'L' || CAST(n_nationkey AS VARCHAR) AS line_id
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
block("all_times_l", "SELECT timestamp AS t FROM lines_l")
star_blocks("l", "lines_l")


def rounded(columns: list[str], source: str, plain: list[str]) -> str:
    """SELECT with plain columns as they are and the rest rounded to six decimals."""
    cols = [*plain, *[f"{r6(f'CAST({c} AS DOUBLE)')} AS {c}" for c in columns]]
    return f"SELECT {', '.join(cols)} FROM {source}"
