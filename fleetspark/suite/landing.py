"""Queries of the landing layer: the text tables are written as files, landed and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.functions.staging import shared_dir
from fleetspark.operators import cleaning
from fleetspark.operators import tables as T
from fleetspark.plans import star
from fleetspark.sources import landing as L
from fleetspark.sources.contracts import CHECK_SCHEMA, TableContract, check_table, validate_files
from fleetspark.suite.blocks import SENSORS, each
from fleetspark.suite.ingest import CONTRACT, CONTRACT_CHECKS, raw_errors, raw_location, raw_machines, raw_telemetry
from fleetspark.suite.registry import block, query
from fleetspark.suite.worlds import event_world

#: Files that each source table is written as.
FILES = 3
TEXTS = {"telemetry": ("datetime", "machineID", *SENSORS), "errors": ("datetime", "machineID", "errorID")}


class Landed:
    """Source files of one world, a root, and what two batches over them did.

    The first batch loads everything; then the error table gets one more file, with the errors of
    every other machine once again, and the second batch runs.
    """

    def __init__(self, w):
        self.w, self.spark = w, w.spark
        folder = f"{shared_dir(w.spark)}/landing-{uuid.uuid4().hex}"
        self.root = f"{folder}/bronze"
        self.tables = {"telemetry": raw_telemetry(w), "errors": raw_errors(w)}
        self.sources = {name: f"{folder}/raw/{name}" for name in TEXTS}
        for name, df in self.tables.items():
            self._write(df, name, "overwrite", FILES)
        self.batches = [L.ingest_all(self.spark, self.sources, self.root)]
        self.first = L.landed(self.spark, "errors", self.root)
        again = self.tables["errors"].where(F.col("_source_line") < 1_000_000_000).where("_source_line % 2 = 0")
        self._write(again, "errors", "append", 1)
        self.batches.append(L.ingest_all(self.spark, self.sources, self.root))

    def _write(self, df: DataFrame, name: str, mode: str, files: int) -> None:
        """Files in the order of the lines; their names follow it."""
        dealt = df.repartitionByRange(files, "_source_line").sortWithinPartitions("_source_line").select(*TEXTS[name])
        dealt.write.mode(mode).option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(self.sources[name])

    def landed(self, name: str) -> DataFrame:
        return L.landed(self.spark, name, self.root)


_landed: dict = {}


def landed(spark, sf_dir) -> Landed:
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _landed:
        _landed[key] = Landed(event_world(spark, sf_dir))
    return _landed[key]


block(
    "landed_errors",
    'SELECT datetime, "machineID", "errorID" FROM raw_errors UNION ALL SELECT datetime, "machineID", "errorID" FROM raw_errors WHERE _source_line < 1000000000 AND _source_line % 2 = 0',
)


@query("a1_text_scan", f'SELECT datetime, "machineID", {each("{x}")} FROM raw_telemetry')
def _(spark, sf_dir):
    """Every cell as it was written, blanks and padding included."""
    return landed(spark, sf_dir).landed("telemetry").select(*TEXTS["telemetry"])


@query(
    "a2_lineage",
    f'SELECT row_number() OVER (ORDER BY _source_line) AS place, datetime, "machineID", {each("{x}")}, true AS after_header FROM raw_telemetry',
)
def _(spark, sf_dir):
    """The place of each row in all files: its line, and the rows of the files before its own."""
    df = landed(spark, sf_dir).landed("telemetry")
    files = df.groupBy("_source_file").agg(F.count("*").alias("n"))
    before = files.alias("f").join(files.alias("e"), F.col("e._source_file") < F.col("f._source_file"), "left")
    before = before.groupBy(F.col("f._source_file").alias("_source_file")).agg(F.coalesce(F.sum("e.n"), F.lit(0)).alias("before"))
    placed = df.join(F.broadcast(before), "_source_file")  # one row for each file
    place = F.col("before") + F.col("_source_line") - 1
    return placed.select(place.alias("place"), *TEXTS["telemetry"], (F.col("_source_line") >= 2).alias("after_header"))


@query(
    "a3_ingested_rows",
    "SELECT 'telemetry' AS table_name, 3 AS files, count(*) AS row_count FROM raw_telemetry UNION ALL SELECT 'errors', 4, count(*) FROM landed_errors",
)
def _(spark, sf_dir):
    """Rows and files of each table in force, from the ledger, next to the rows of the table itself."""
    w = landed(spark, sf_dir)
    ledger = L.latest_entries(L.read_ledger(spark, w.root)).groupBy("table_name").agg(
        F.count("*").cast("int").alias("files"), F.sum("row_count").alias("in_ledger")
    )
    own = [w.landed(n).agg(F.count("*").alias("row_count")).withColumn("table_name", F.lit(n)) for n in TEXTS]
    return ledger.join(own[0].unionByName(own[1]), "table_name").where("in_ledger = row_count").select("table_name", "files", "row_count")


@query(
    "a4_batches",
    """SELECT 1 AS batch, 'telemetry' AS table_name, 'loaded' AS status, count(*) AS row_count FROM raw_telemetry
    UNION ALL SELECT 1, 'errors', 'loaded', count(*) FROM raw_errors UNION ALL SELECT 2, 'telemetry', 'skipped', count(*) FROM raw_telemetry
    UNION ALL SELECT 2, 'errors', 'loaded', count(*) FROM landed_errors""",
)
def _(spark, sf_dir):
    """What each batch did with each table, and the rows in force behind it."""
    w = landed(spark, sf_dir)
    status = spark.createDataFrame(
        [(i, t, s) for i, batch in enumerate(w.batches, 1) for t, s in batch.items()], "batch int, table_name string, status string"
    )
    rows = [(w.landed("telemetry"), "telemetry", (1, 2)), (w.first, "errors", (1,)), (w.landed("errors"), "errors", (2,))]
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.explode(F.array(*[F.lit(b) for b in batches])).alias("batch"), F.lit(t).alias("table_name"), "row_count")
        for df, t, batches in rows
    ]
    return status.join(counts[0].unionByName(counts[1]).unionByName(counts[2]), ["batch", "table_name"])


@query(
    "a5_reconciled",
    "SELECT 'telemetry' AS table_name, count(*) AS lines, count(*) AS rows_read FROM raw_telemetry UNION ALL SELECT 'errors', count(*), count(*) FROM landed_errors",
)
def _(spark, sf_dir):
    w = landed(spark, sf_dir)
    rows = [(t, L.data_lines(spark, path), L.read_text_table(spark, path).count()) for t, path in w.sources.items()]
    return spark.createDataFrame(rows, "table_name string, lines bigint, rows_read bigint")


@query(
    "a6_versions",
    """SELECT 'former' AS version, trim("errorID") AS code, count(*) AS row_count FROM raw_errors GROUP BY ALL
    UNION ALL SELECT 'in force', trim("errorID"), count(*) FROM landed_errors GROUP BY ALL""",
)
def _(spark, sf_dir):
    """A reader that was there before the second batch still reads the former version whole."""
    w = landed(spark, sf_dir)
    both = w.first.select(F.lit("former").alias("version"), "errorID").unionByName(w.landed("errors").select(F.lit("in force").alias("version"), "errorID"))
    return both.groupBy("version", F.trim("errorID").alias("code")).agg(F.count("*").alias("row_count"))


_empty = lambda t, columns, source: " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE "{c}" = '') AS empty_cells, count(*) AS row_count,
    true AS readable, true AS single_batch, true AS rows_match_log, true AS columns_match, false AS stale FROM {source}"""
    for c in columns
)


@query("l1_landing", f"{_empty('telemetry', TEXTS['telemetry'], 'raw_telemetry')} UNION ALL {_empty('errors', TEXTS['errors'], 'landed_errors')}")
def _(spark, sf_dir):
    w = landed(spark, sf_dir)
    checked = L.check_landing(spark, w.sources, w.root)
    return checked.select(
        "table_name", F.explode("empty_cells").alias("column_name", "empty_cells"), "row_count", "readable", "single_batch", "rows_match_log",
        "columns_match", "stale",
    )


# ---------------------------------------------------------------- readers and sinks


@query("a14_truth", f"SELECT machine_id, timestamp, {each('{x}')} FROM deduped")
def _(spark, sf_dir):
    """A typed reference series, through a text file and back."""
    w = event_world(spark, sf_dir)
    path = f"{shared_dir(spark)}/truth-{uuid.uuid4().hex}"
    series = cleaning.deduplicate(w.readings, w.p).select(F.col("timestamp").alias("datetime"), F.col("machine_id").alias("machineID"), *SENSORS)
    L.export_csv(series.withColumn("datetime", F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")), path)
    return L.read_truth(spark, path, list(w.p.sensors)).select(*w.p.keys, *SENSORS)


@query("a15_export_csv", 'SELECT datetime, "machineID", "errorID" FROM landed_errors')
def _(spark, sf_dir):
    w = landed(spark, sf_dir)
    path = f"{shared_dir(spark)}/export-{uuid.uuid4().hex}"
    L.export_csv(w.landed("errors").select(*TEXTS["errors"]), path)
    return L.with_lineage(L.read_text_table(spark, path), "export").select(*TEXTS["errors"])


@query(
    "c22_build_tables",
    """SELECT 'machines' AS table_name, count(DISTINCT machine_id) AS row_count FROM valid_machines
    UNION ALL SELECT 'errors', count(*) FROM (SELECT DISTINCT timestamp, machine_id, error_id FROM judged_errors
      WHERE timestamp IS NOT NULL AND machine_id IN (SELECT machine_id FROM valid_machines) AND error_id IN ('error1', 'error2', 'error3', 'error4', 'error5'))""",
)
def _(spark, sf_dir):
    """All tables beside the telemetry in one call; machines and errors by their rows."""
    w = event_world(spark, sf_dir)
    nothing = spark.createDataFrame([], "datetime string, machineID string, comp string, failure string, _source_line bigint")
    raw = {"machines": raw_machines(w), "machine_location": raw_location(w), "errors": raw_errors(w), "maintenance": nothing, "failures": nothing}
    raw["component_costs"] = spark.createDataFrame([], "component string, " + ", ".join(f"{c} string" for c in T.COST_COLUMNS) + ", currency string, _source_line bigint")
    made = T.build_tables(raw, w.p)
    counted = [df.agg(F.count("*").alias("row_count")).withColumn("table_name", F.lit(n)) for n, df in made.items() if n in ("machines", "errors")]
    return counted[0].unionByName(counted[1])


@query("a16_report", " UNION ALL ".join(CONTRACT_CHECKS))
def _(spark, sf_dir):
    """The checks of a table as a JSON report, and read again."""
    path = f"{shared_dir(spark)}/report-{uuid.uuid4().hex}"
    L.write_report(check_table("telemetry", raw_telemetry(event_world(spark, sf_dir)), CONTRACT), path)
    return spark.read.schema(CHECK_SCHEMA).json(path)


@query(
    "b1_files",
    """SELECT 'errors' AS table_name, 'file_exists' AS check_name, true AS passed, NULL AS detail UNION ALL SELECT 'gone', 'file_exists', false, NULL
    UNION ALL SELECT 'errors', 'row_count', count(*) BETWEEN 1 AND 1000, CAST(count(*) AS VARCHAR) FROM landed_errors
    UNION ALL SELECT 'errors', 'unique:machineID', count(*) = count(DISTINCT "machineID"), CAST(count(*) - count(DISTINCT "machineID") AS VARCHAR) FROM landed_errors""",
)
def _(spark, sf_dir):
    """A missing file is one failed check, and nothing else of its table is looked at."""
    w = landed(spark, sf_dir)
    contract = TableContract(TEXTS["errors"], 1, 1000, unique_columns=("machineID",))
    paths = {"errors": w.sources["errors"], "gone": f"{w.root}/none.csv"}
    checks = validate_files(spark, paths, dict.fromkeys(paths, contract))
    detail = F.when(F.col("check_name") != "file_exists", F.col("detail"))
    return checks.where(F.col("check_name").isin("file_exists", "row_count", "unique:machineID")).select("table_name", "check_name", "passed", detail.alias("detail"))


@query(
    "a8_source_views",
    """SELECT trim("errorID") AS code, count(*) AS row_count, count(DISTINCT e."machineID") AS machines, 0::BIGINT AS predictions FROM landed_errors AS e
    WHERE datetime <> 'n/a' GROUP BY ALL""",
)
def _(spark, sf_dir):
    """SQL over the landed sources by name; predictions that nobody has made yet are an empty, typed source."""
    w = landed(spark, sf_dir)
    star.register_views({"src_errors": w.landed("errors"), "src_predictions": star.no_predictions(spark)})
    return spark.sql(
        """SELECT trim(errorID) AS code, count(*) AS row_count, count(DISTINCT machineID) AS machines,
        (SELECT count(*) FROM src_predictions WHERE alert AND failure_risk > 0.5) AS predictions FROM src_errors WHERE datetime <> 'n/a' GROUP BY 1"""
    )
