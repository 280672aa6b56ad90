"""Queries of the contracts, typing rules and landing tables.

The driver tables are typed, so their text form is derived from them with deterministic
defects: blanks, padded and malformed ids, two timestamp styles, unknown codes, copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.operators import tables as T
from fleetspark.params import ERROR_TYPES
from fleetspark.plans import kpis, star
from fleetspark.sources.contracts import TableContract, check_table, summary
from fleetspark.suite.blocks import P, SENSORS, each
from fleetspark.suite.registry import block, query
from fleetspark.suite.worlds import event_world

_iso_sql = "strftime(timestamp, '%Y-%m-%d %H:%M:%S')"
block(
    "raw_telemetry",
    f"""SELECT CASE WHEN event_id % 17 = 0 THEN ' ' WHEN event_id % 19 = 0 THEN 'yesterday' WHEN event_id % 23 = 0 THEN '2015'
       WHEN event_id % 5 = 0 THEN strftime(timestamp, '%-m/%-d/%Y %-I:%M:%S %p') ELSE {_iso_sql} END AS datetime,
  CASE WHEN event_id % 29 = 0 THEN 'M' || machine_id WHEN event_id % 31 = 0 THEN machine_id || '.5'
       WHEN event_id % 37 = 0 THEN '-' || machine_id WHEN event_id % 3 = 0 THEN ' ' || machine_id || ' ' ELSE CAST(machine_id AS VARCHAR) END AS "machineID",
  CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 13 = 0 THEN 'NaN' ELSE CAST(k AS VARCHAR) || '.25' END AS volt,
  CASE WHEN event_id % 7 = 0 THEN k || 'd' ELSE CAST(k AS VARCHAR) END AS rotate,
  CASE WHEN k % 10 = 0 THEN '1e' || (k // 10) ELSE '-' || k END AS pressure, CASE WHEN k % 5 = 0 THEN '  ' ELSE '+' || k END AS vibration,
  event_id AS _source_line FROM ev""",
)


def raw_telemetry(w) -> DataFrame:
    e, k, m = F.col("event_id"), F.col("k"), F.col("machine_id").cast("string")
    ks = k.cast("string")
    iso = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    return w.events.select(
        F.when(e % 17 == 0, " ")
        .when(e % 19 == 0, "yesterday")
        .when(e % 23 == 0, "2015")
        .when(e % 5 == 0, F.date_format("timestamp", "M/d/yyyy h:mm:ss a"))
        .otherwise(iso)
        .alias("datetime"),
        F.when(e % 29 == 0, F.concat(F.lit("M"), m))
        .when(e % 31 == 0, F.concat(m, F.lit(".5")))
        .when(e % 37 == 0, F.concat(F.lit("-"), m))
        .when(e % 3 == 0, F.concat(F.lit(" "), m, F.lit(" ")))
        .otherwise(m)
        .alias("machineID"),
        F.when(e % 11 == 0, "").when(e % 13 == 0, "NaN").otherwise(F.concat(ks, F.lit(".25"))).alias("volt"),
        F.when(e % 7 == 0, F.concat(ks, F.lit("d"))).otherwise(ks).alias("rotate"),
        F.when(k % 10 == 0, F.concat(F.lit("1e"), F.floor(k / 10).cast("string")))
        .otherwise(F.concat(F.lit("-"), ks))
        .alias("pressure"),
        F.when(k % 5 == 0, "  ").otherwise(F.concat(F.lit("+"), ks)).alias("vibration"),
        e.alias("_source_line"),
    )


def sql_number(c: str) -> str:
    t = f"trim({c})"
    return f"CASE WHEN regexp_full_match({t}, '[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST({t} AS DOUBLE) END"


def sql_integer(c: str) -> str:
    n = sql_number(c)
    return f"CASE WHEN ({n}) = round({n}) THEN CAST(({n}) AS BIGINT) END"


def sql_time(c: str) -> str:
    t = f"trim({c})"
    return (
        f"CASE WHEN regexp_full_match({t}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([T ].*)?') THEN TRY_CAST({t} AS TIMESTAMP) "
        f"WHEN regexp_full_match({t}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}} .*') THEN try_strptime({t}, '%m/%d/%Y %I:%M:%S %p') END"
    )


_id_sql = f"CASE WHEN ({sql_integer('\"machineID\"')}) > 0 THEN ({sql_integer('\"machineID\"')}) END"
block(
    "typed_telemetry",
    f"""SELECT {sql_time('datetime')} AS timestamp, {_id_sql} AS machine_id, {each(sql_number('r.{x}') + ' AS {x}')},
    datetime, "machineID", {each('r.{x} AS {x}_text')}, _source_line FROM raw_telemetry AS r""",
)


@query(
    "c9_standardise",
    f"SELECT timestamp, machine_id, {each('{x}')}, _source_line FROM typed_telemetry WHERE timestamp IS NOT NULL AND machine_id IS NOT NULL",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return T.standardise(raw_telemetry(w), w.p)


def _counter(name: str, column: str | None, n: str) -> str:
    col = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return f"SELECT '{name}' AS counter, {col} AS column_name, count(*) FILTER (WHERE {n}) AS n FROM typed_telemetry"


_texts = {"timestamp": "datetime", "machine_id": '"machineID"', **{s: f"{s}_text" for s in SENSORS}}
_typing = [
    _counter("rows_in", None, "true"),
    _counter("rows_dropped_no_key", None, "timestamp IS NULL OR machine_id IS NULL"),
    _counter("rows_out", None, "timestamp IS NOT NULL AND machine_id IS NOT NULL"),
]
for _n, _src in _texts.items():
    _typing.append(_counter("empty", _n, f"trim({_src}) = ''"))
    _typing.append(_counter("unparseable", _n, f"{_n} IS NULL AND trim({_src}) <> ''"))


@query("c6_typing_counts", " UNION ALL ".join(_typing))
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return T.typing_counts(raw_telemetry(w), w.p)


# ---------------------------------------------------------------- event and master tables

block(
    "raw_errors",
    f"""SELECT CASE WHEN event_id % 41 = 0 THEN 'n/a' ELSE {_iso_sql} END AS datetime,
  CASE WHEN event_id % 43 = 0 THEN '999999' ELSE CAST(machine_id AS VARCHAR) END AS "machineID",
  CASE WHEN event_id % 47 = 0 THEN 'error9' ELSE ' error' || (event_id % 5 + 1) END AS "errorID", event_id AS _source_line FROM ev
UNION ALL SELECT {_iso_sql}, CAST(machine_id AS VARCHAR), 'error' || (event_id % 5 + 1), event_id + 1000000000 FROM ev WHERE event_id % 10 = 0""",
)


def raw_errors(w) -> DataFrame:
    e = F.col("event_id")
    iso = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    code = F.concat(F.lit("error"), (e % 5 + 1).cast("string"))
    m = F.col("machine_id").cast("string")
    first = w.events.select(
        F.when(e % 41 == 0, "n/a").otherwise(iso).alias("datetime"),
        F.when(e % 43 == 0, "999999").otherwise(m).alias("machineID"),
        F.when(e % 47 == 0, "error9").otherwise(F.concat(F.lit(" "), code)).alias("errorID"),
        e.alias("_source_line"),
    )
    copies = w.events.where(e % 10 == 0).select(
        iso.alias("datetime"), m.alias("machineID"), code.alias("errorID"), (e + 1_000_000_000).alias("_source_line")
    )
    return first.unionByName(copies)


block(
    "judged_errors",
    f"""SELECT *, CASE WHEN timestamp IS NULL THEN 'bad_timestamp' WHEN machine_id NOT IN (SELECT machine_id FROM machines_e) THEN 'unknown_machine'
  WHEN error_id NOT IN ('error1', 'error2', 'error3', 'error4', 'error5') THEN 'unknown_value' END AS reason
FROM (SELECT {sql_time('datetime')} AS timestamp, {sql_integer('"machineID"')} AS machine_id, trim("errorID") AS error_id, _source_line FROM raw_errors)""",
)
block(
    "valid_errors",
    "SELECT *, row_number() OVER (PARTITION BY timestamp, machine_id, error_id ORDER BY _source_line) AS rn FROM judged_errors WHERE reason IS NULL",
)


@query("c12_build_events", "SELECT timestamp, machine_id, error_id, _source_line FROM valid_errors WHERE rn = 1")
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return T.build_events(raw_errors(w), w.machines, "errorID", "error_id", ERROR_TYPES)


@query(
    "c10_drop_reasons",
    """SELECT reason, count(*) AS n FROM judged_errors WHERE reason IS NOT NULL GROUP BY 1
    UNION ALL SELECT 'duplicate', count(*) FROM valid_errors WHERE rn > 1""",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    judged = T.judge_events(raw_errors(w), w.machines, "errorID", "error_id", ERROR_TYPES)
    return T.dropped(judged, ["timestamp", "machine_id", "error_id"])


block(
    "raw_machines",
    """SELECT CASE WHEN c_custkey % 31 = 0 THEN 'M' || c_custkey ELSE ' ' || c_custkey END AS "machineID",
  CASE WHEN c_custkey % 29 = 0 THEN 'model9' ELSE 'model' || (c_custkey % 4 + 1) END AS model,
  CASE WHEN c_custkey % 37 = 0 THEN '-1' WHEN c_custkey % 41 = 0 THEN '' ELSE CAST(c_custkey % 21 AS VARCHAR) END AS age, c_custkey + 2 AS _source_line FROM customer
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'model1', '5', c_custkey + 1000000000 FROM customer WHERE c_custkey % 5 = 0""",
)
block(
    "raw_location",
    """SELECT CAST(c_custkey AS VARCHAR) AS "machineID", 'P' || n_regionkey AS plant_id, ' ' || n_name AS plant_name, n_name AS city,
  'L' || n_nationkey AS line_id, c_custkey + 2 AS _source_line FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 7 <> 0""",
)


def raw_machines(w) -> DataFrame:
    c = F.col("c_custkey")
    customers = w.table("customer")
    text = c.cast("string")
    first = customers.select(
        F.when(c % 31 == 0, F.concat(F.lit("M"), text)).otherwise(F.concat(F.lit(" "), text)).alias("machineID"),
        F.when(c % 29 == 0, "model9").otherwise(F.concat(F.lit("model"), (c % 4 + 1).cast("string"))).alias("model"),
        F.when(c % 37 == 0, "-1").when(c % 41 == 0, "").otherwise((c % 21).cast("string")).alias("age"),
        (c + 2).alias("_source_line"),
    )
    copies = customers.where(c % 5 == 0).select(
        text.alias("machineID"), F.lit("model1").alias("model"), F.lit("5").alias("age"), (c + 1_000_000_000).alias("_source_line")
    )
    return first.unionByName(copies)


def raw_location(w) -> DataFrame:
    c = F.col("c_custkey")
    return (
        w.table("customer")
        .join(w.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .where(c % 7 != 0)
        .select(
            c.cast("string").alias("machineID"),
            F.concat(F.lit("P"), F.col("n_regionkey").cast("string")).alias("plant_id"),
            F.concat(F.lit(" "), F.col("n_name")).alias("plant_name"),
            F.col("n_name").alias("city"),
            F.concat(F.lit("L"), F.col("n_nationkey").cast("string")).alias("line_id"),
            (c + 2).alias("_source_line"),
        )
    )


block(
    "valid_machines",
    f"""SELECT machine_id, model, age, _source_line FROM (
  SELECT {sql_integer('"machineID"')} AS machine_id, trim(model) AS model, {sql_integer('age')} AS age, _source_line FROM raw_machines)
WHERE machine_id > 0 AND model IN ('model1', 'model2', 'model3', 'model4') AND age >= 0
QUALIFY row_number() OVER (PARTITION BY machine_id ORDER BY _source_line) = 1""",
)


@query(
    "c11_build_machines",
    """SELECT m.machine_id, m.model, m.age, l.plant_id, trim(l.plant_name) AS plant_name, l.city, l.line_id,
    l.line_id IS NULL AS no_location, m._source_line FROM valid_machines AS m LEFT JOIN raw_location AS l ON CAST(l."machineID" AS BIGINT) = m.machine_id""",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return T.build_machines(raw_machines(w), raw_location(w))




def _part_costs(w) -> DataFrame:
    return (
        w.table("part")
        .groupBy(F.concat(F.lit("comp"), (F.col("p_partkey") % 4 + 1).cast("string")).alias("component"))
        .agg(
            F.avg("p_retailprice").alias("repair_cost"),
            F.max("p_size").cast("double").alias("unplanned_downtime_hours"),
            F.min("p_size").cast("double").alias("planned_downtime_hours"),
        )
    )


_rate = "50000.0::DOUBLE"


@query(
    "a12_component_costs",
    f"""SELECT component, round(c, 4) AS repair_cost, u AS unplanned_downtime_hours, d AS planned_downtime_hours,
    round(c * 1.5::DOUBLE, 4) AS unplanned_repair_cost, {_rate} AS downtime_cost_per_hour, round(c * 1.5::DOUBLE + u * {_rate}, 4) AS unplanned_failure_cost,
    round(c + d * {_rate}, 4) AS planned_maintenance_cost, round(c * 1.5::DOUBLE + u * {_rate} - (c + d * {_rate}), 4) AS saving_if_prevented, 'INR' AS currency
    FROM (SELECT 'comp' || CAST(p_partkey % 4 + 1 AS VARCHAR) AS component, avg(p_retailprice) AS c, CAST(max(p_size) AS DOUBLE) AS u,
          CAST(min(p_size) AS DOUBLE) AS d FROM part GROUP BY 1)""",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    out = kpis.derive_costs(_part_costs(w), w.p)
    money = ["repair_cost", "unplanned_repair_cost", "unplanned_failure_cost", "planned_maintenance_cost", "saving_if_prevented"]
    return out.withColumns({c: F.round(c, 4) for c in money})


@query(
    "c13_component_costs",
    """SELECT component, COUNT(*) AS n, 'kept' AS outcome FROM (SELECT DISTINCT p_brand AS component FROM part WHERE p_size % 10 <> 0) GROUP BY 1
    UNION ALL SELECT 'bad_value', count(*), 'dropped' FROM part WHERE p_size % 10 = 0
    UNION ALL SELECT 'duplicate', count(*) - count(DISTINCT p_brand), 'dropped' FROM part WHERE p_size % 10 <> 0""",
)
def _(spark, sf_dir):
    """Part rows as a dirty cost sheet: every tenth size is negative, brands repeat."""
    w = event_world(spark, sf_dir)
    value = F.when(F.col("p_size") % 10 == 0, F.concat(F.lit("-"), F.col("p_retailprice").cast("string"))).otherwise(
        F.col("p_retailprice").cast("string")
    )
    sheet = w.table("part").select(
        F.col("p_brand").alias("component"),
        *[value.alias(c) for c in T.COST_COLUMNS],
        F.lit("INR").alias("currency"),
        F.col("p_partkey").alias("_source_line"),
    )
    judged = T.judge_costs(sheet)
    good = T.kept(judged, ["component"]).groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.lit("kept").alias("outcome"))
    bad = T.dropped(judged, ["component"]).select(F.col("reason").alias("component"), "n", F.lit("dropped").alias("outcome"))
    return good.unionByName(bad)


# ---------------------------------------------------------------- contracts

CONTRACT = TableContract(
    ("datetime", "machineID", *SENSORS),
    100,
    5_000_000,
    date_column="datetime",
    min_date="2024-01-01",
    max_date="2024-01-15",
    numeric_columns=tuple(SENSORS),
    unique_columns=("datetime",),
    machine_count=150,
)
CONTRACT_CHECKS = [
    "SELECT 'telemetry' AS table_name, 'columns' AS check_name, true AS passed, 'all 6 present' AS detail",
    "SELECT 'telemetry', 'row_count', count(*) BETWEEN 100 AND 5000000, CAST(count(*) AS VARCHAR) FROM raw_telemetry",
    "SELECT 'telemetry', 'no_nulls', true, '0'",
    f"SELECT 'telemetry', 'machine_id_valid', count(*) = 0, CAST(count(*) AS VARCHAR) FROM (SELECT {sql_number('\"machineID\"')} AS i FROM raw_telemetry) WHERE i IS NULL OR i <= 0",
    "SELECT 'telemetry', 'dates_parse', count(*) = 0, CAST(count(*) AS VARCHAR) FROM typed_telemetry WHERE timestamp IS NULL",
    "SELECT 'telemetry', 'date_range', min(timestamp) >= TIMESTAMP '2024-01-01' AND max(timestamp) <= TIMESTAMP '2024-01-15', "
    "strftime(min(timestamp), '%Y-%m-%d') || ' to ' || strftime(max(timestamp), '%Y-%m-%d') FROM typed_telemetry",
    f"SELECT 'telemetry', 'machine_count', count(DISTINCT i) = 150, CAST(count(DISTINCT i) AS VARCHAR) FROM (SELECT {sql_number('\"machineID\"')} AS i FROM raw_telemetry)",
    "SELECT 'telemetry', 'unique:datetime', count(*) = count(DISTINCT datetime), CAST(count(*) - count(DISTINCT datetime) AS VARCHAR) FROM raw_telemetry",
    *[
        f"SELECT 'telemetry', 'numeric:{s}', count(*) = 0, CAST(count(*) AS VARCHAR) FROM typed_telemetry WHERE {s} IS NULL"
        for s in SENSORS
    ],
]


@query("b12_contract_telemetry", " UNION ALL ".join(CONTRACT_CHECKS))
def _(spark, sf_dir):
    return check_table("telemetry", raw_telemetry(event_world(spark, sf_dir)), CONTRACT)


@query(
    "b10_contract_errors",
    """SELECT 'errors' AS table_name, 'columns' AS check_name, true AS passed, 'all 3 present' AS detail
    UNION ALL SELECT 'errors', 'row_count', count(*) BETWEEN 1 AND 10, CAST(count(*) AS VARCHAR) FROM raw_errors
    UNION ALL SELECT 'errors', 'no_nulls', true, '0' UNION ALL SELECT 'errors', 'machine_id_valid', count(*) = 0, CAST(count(*) AS VARCHAR) FROM raw_errors WHERE CAST("machineID" AS BIGINT) <= 0
    UNION ALL SELECT 'errors', 'allowed_values:errorID', count(*) = 0,
      coalesce(string_agg(v, ', ' ORDER BY v) FILTER (WHERE place <= 5), '') || CASE WHEN count(*) > 5 THEN ' and ' || (count(*) - 5) || ' more' ELSE '' END
      FROM (SELECT v, row_number() OVER (ORDER BY v) AS place FROM (
        SELECT DISTINCT "errorID" AS v FROM raw_errors WHERE "errorID" NOT IN ('error1', 'error2', 'error3', 'error4', 'error5')))""",
)
def _(spark, sf_dir):
    contract = TableContract(("datetime", "machineID", "errorID"), 1, 10, categories={"errorID": ERROR_TYPES})
    return check_table("errors", raw_errors(event_world(spark, sf_dir)), contract)


@query(
    "b12_contract_summary",
    "SELECT bool_and(passed) AS passed, count(*) AS checks_run, count(*) FILTER (WHERE NOT passed) AS checks_failed FROM ("
    + " UNION ALL ".join(CONTRACT_CHECKS)
    + ")",
)
def _(spark, sf_dir):
    return summary(check_table("telemetry", raw_telemetry(event_world(spark, sf_dir)), CONTRACT))


# ---------------------------------------------------------------- sources


@query(
    "a11_calendar",
    "SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT date_trunc('day', least(min(l_shipdate), (SELECT min(o_orderdate) FROM orders))) AS lo, "
    "date_trunc('day', greatest(max(l_shipdate), (SELECT max(o_orderdate) FROM orders))) AS hi FROM lineitem)",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    ship = w.table("lineitem").select(F.col("l_shipdate").cast("timestamp_ntz").alias("timestamp"))
    orders = w.table("orders").select(F.col("o_orderdate").cast("timestamp_ntz").alias("timestamp"))
    return star.calendar([ship, orders])


_LINES = [{"plant_id": p, "plant_name": p, "city": p, "line_id": f"{p}-L{i}"} for p, n in (("NORTH", 3), ("SOUTH", 2)) for i in range(1, n + 1)]


@query(
    "a13_even_assignment",
    """SELECT count(*) AS n_lines, CAST(max(n) - min(n) <= 1 AS BOOLEAN) AS even, CAST(sum(n) AS BIGINT) AS machines
    FROM (SELECT count(*) AS n FROM (SELECT row_number() OVER (ORDER BY c_custkey) % 5 AS g FROM customer) GROUP BY g)""",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    placed = T.assign_evenly(w.table("customer").select(F.col("c_custkey").alias("machine_id")), _LINES)
    sizes = placed.groupBy("line_id").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count(F.lit(1)).alias("n_lines"), (F.max("n") - F.min("n") <= 1).alias("even"), F.sum("n").alias("machines")
    )


@query(
    "k10_dim_sensor",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{s}' AS sensor, {v.min}::DOUBLE AS min_valid, {v.max}::DOUBLE AS max_valid, count({s}) AS n_ok FROM silver WHERE {s}_quality = 'ok'"
        for s, v in P.sensors.items()
    )
    + ")",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    seen = w.fact_sensor_reading.where("quality = 'ok'").groupBy("sensor").agg(F.count(F.lit(1)).alias("n_ok"))
    return w.dim_sensor.join(seen, "sensor")


@query(
    "k11_dim_error_type",
    "SELECT error_id, CAST(regexp_extract(error_id, '[0-9]+') AS INTEGER) AS error_number, count(*) AS n FROM fact_error_e GROUP BY 1",
)
def _(spark, sf_dir):
    w = event_world(spark, sf_dir)
    return w.dim_error_type.join(w.fact_error.groupBy("error_id").agg(F.count(F.lit(1)).alias("n")), "error_id")
