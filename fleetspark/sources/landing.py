"""Landing layer: text as received, with lineage, reconciled and written as Parquet.

Each load of a table is a folder of its own, ``root/table/<version>``, that nothing changes later. The
ledger names the version: its newest entries for a table are the pointer that readers follow, and
adding them is the one step that publishes a load. A crash before it leaves the former version in
force, one after it the new version; folders that no entry of the last ``KEPT`` loads names are
deleted by the next load, so that readers of the former version can finish. One process at a time loads
into a root.
"""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetspark.functions.staging import stage
from fleetspark.functions.typing import n_if

LINEAGE = ("_source_file", "_source_line", "_source_order", "_ingested_at", "_batch_id")
#: Loads of a table whose files stay, the one in force included.
KEPT = 2
#: Rows that one file may have at most for ``_source_order`` to keep files apart.
FILE_ROWS = 1 << 40
LEDGER_SCHEMA = (
    "table_name string, source_file string, fingerprint string, length bigint, row_count bigint, "
    "source_columns array<string>, batch_id string, ingested_at timestamp, version string"
)

class LandingError(ValueError):
    pass


def new_batch_id(now: datetime | None = None) -> str:
    now = now or datetime.now(UTC)
    return f"{now:%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:6]}"


def read_text_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV with every column as text. Empty cells stay empty text, nothing becomes NULL."""
    header = spark.read.option("header", True).option("inferSchema", False).csv(path)
    reserved = [c for c in header.columns if c.startswith("_")]
    if reserved:
        raise LandingError(f"{path}: source column names must not start with '_': {reserved}")
    return header


def _numbered(df: DataFrame) -> DataFrame:
    """``df``, straight from a file scan, with ``_path``, ``_line`` (the row's place in its file from 0) and ``_order``.

    ``_order`` puts the rows of all files in one order: by file, then by line.

    A place is the row's position in its file split plus the rows of the earlier splits of that
    file. The offsets are one row per split and are written, so that the join knows their real
    size: broadcast below the configured threshold, shuffled above it.
    """
    rows = df.select(
        *df.columns,
        F.col("_metadata.file_name").alias("_source_file"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_row"),
    )
    earlier = Window.partitionBy("_path").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_path", "_split")
        .agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .select("_path", "_split", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    # One row for each file.
    files = offsets.select("_path").distinct().withColumn("_file", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_path")))
    offsets = stage(offsets.join(files, "_path"), "split_offsets")
    line = (F.col("_row") - F.col("_first") + F.col("_before")).cast("bigint")
    order = F.col("_file").cast("bigint") * FILE_ROWS + line
    placed = rows.join(offsets, ["_path", "_split"])
    return placed.select(*df.columns, "_source_file", "_path", line.alias("_line"), order.alias("_order"))


def with_lineage(df: DataFrame, batch_id: str, ingested_at: datetime | None = None) -> DataFrame:
    """Add source file, line number (the header is line 1), load time and batch."""
    return _numbered(df).select(
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in df.columns],
        "_source_file",
        (F.col("_line") + 2).alias("_source_line"),
        (F.col("_order") + 2).alias("_source_order"),
        (F.lit(ingested_at).cast("timestamp") if ingested_at else F.current_timestamp()).alias("_ingested_at"),
        F.lit(batch_id).alias("_batch_id"),
    )


def data_lines(spark: SparkSession, path: str) -> int:
    """Non-blank physical lines without the headers, counted independently of the CSV reader."""
    lines = spark.read.text(path)
    row = lines.agg(
        n_if(F.trim("value") != "").alias("n"), F.countDistinct("_metadata.file_path").alias("files")
    ).first()
    return max(row["n"] - row["files"], 0)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Zstandard Parquet; the output committer publishes complete files only."""
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def load_version(spark: SparkSession, source: str, table: str, root: str, batch_id: str) -> tuple[str, int]:
    """Write one source as a new version of ``table`` and reconcile lines, rows read and rows written.

    Nothing is published yet; a version that does not reconcile is deleted.
    """
    landed = with_lineage(read_text_table(spark, source), batch_id)
    version = f"{batch_id}-{uuid.uuid4().hex[:8]}"
    write_parquet(landed, f"{root}/{table}/{version}")
    written = spark.read.parquet(f"{root}/{table}/{version}")
    n_lines, n_read, n_written = data_lines(spark, source), read_text_table(spark, source).count(), written.count()
    if not n_lines == n_read == n_written:
        _delete(spark, f"{root}/{table}/{version}")
        raise LandingError(
            f"{table}: row count mismatch (lines {n_lines}, read {n_read}, written {n_written})"
        )
    return version, n_written


def publish(spark: SparkSession, table: str, version: str, root: str, batch_id: str, columns: list[str], prints: DataFrame) -> None:
    """Enter a loaded version into the ledger, with the rows of each file: from now on it is the table."""
    counts = spark.read.parquet(f"{root}/{table}/{version}").groupBy(F.col("_source_file").alias("source_file")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    entries = prints.where(F.col("table_name") == table).join(counts, "source_file", "left").select(
        "table_name", "source_file", "fingerprint", "length", F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
        F.array(*[F.lit(c) for c in columns]).cast("array<string>").alias("source_columns"),
        F.lit(batch_id).alias("batch_id"), F.current_timestamp().alias("ingested_at"), F.lit(version).alias("version"),
    )
    write_parquet(entries.coalesce(1), f"{root}/_ledger", mode="append")


def ingest_table(
    spark: SparkSession, source: str, table: str, root: str, batch_id: str | None = None
) -> int:
    """Land one source, reconcile it and make it the table in force; the number of rows."""
    batch_id = batch_id or new_batch_id()
    version, n = load_version(spark, source, table, root, batch_id)
    publish(spark, table, version, root, batch_id, read_text_table(spark, source).columns, fingerprints(spark, {table: source}))
    sweep(spark, table, root)
    return n


def versions(spark: SparkSession, table: str, root: str) -> list[str]:
    """The published versions of a table, newest first: one name for each load."""
    loads = read_ledger(spark, root).where(F.col("table_name") == table).groupBy("version").agg(F.max("ingested_at").alias("at"))
    return [r["version"] for r in loads.orderBy(F.desc("at"), F.desc("version")).collect()]


def landed(spark: SparkSession, table: str, root: str) -> DataFrame:
    """The table in force."""
    known = versions(spark, table, root)
    if not known:
        raise LandingError(f"{table} was never loaded")
    return spark.read.parquet(f"{root}/{table}/{known[0]}")


def sweep(spark: SparkSession, table: str, root: str) -> None:
    """Delete versions that neither the last ``KEPT`` loads nor readers can use any more."""
    keep = set(versions(spark, table, root)[:KEPT])
    system, at = _file_system(spark, f"{root}/{table}")
    for status in system.listStatus(at):
        if status.getPath().getName() not in keep:
            system.delete(status.getPath(), True)


def fingerprints(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(table_name, source_file, length, fingerprint) of every source file.

    Two 64-bit hashes of line and line number, each combined over all lines by exclusive or: the same
    for every size and split of a file, and another one if lines change places.
    """
    out = None
    for table, path in paths.items():
        files = spark.read.format("binaryFile").load(path).select("path", "length")
        lines = _numbered(spark.read.text(path))
        sums = lines.groupBy("_path").agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("_line", "value")).alias("a"), F.bit_xor(F.xxhash64("value", "_line")).alias("b")
        )
        sums = sums.select(F.col("_path").alias("path"), F.sha2(F.concat_ws("-", "n", "a", "b"), 256).alias("fingerprint"))
        part = files.join(sums, "path", "left").select(
            F.lit(table).alias("table_name"),
            F.element_at(F.split("path", "/"), -1).alias("source_file"),
            "length",
            F.coalesce("fingerprint", F.sha2(F.lit("0"), 256)).alias("fingerprint"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    if _exists(spark, f"{root}/_ledger"):
        return spark.read.schema(LEDGER_SCHEMA).parquet(f"{root}/_ledger")
    return spark.createDataFrame([], LEDGER_SCHEMA)


def latest_entries(ledger: DataFrame) -> DataFrame:
    """The files of each table's latest load; files that were there before and are gone are not among them."""
    last = ledger.groupBy("table_name").agg(F.max(F.struct("ingested_at", "version"))["version"].alias("version"))
    return ledger.join(last, ["table_name", "version"])


def history(ledger: DataFrame, n: int | None = None) -> DataFrame:
    """The batches, newest first; all of them unless ``n`` says how many."""
    batches = ledger.groupBy("batch_id").agg(
        F.max("ingested_at").alias("ingested_at"),
        F.count_distinct("table_name").alias("tables"),
        F.count(F.lit(1)).alias("files"),
        F.sum("row_count").alias("row_count"),
    )
    batches = batches.orderBy(F.desc("ingested_at"))
    return batches if n is None else batches.limit(n)


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _delete(spark: SparkSession, path: str) -> None:
    system, at = _file_system(spark, path)
    system.delete(at, True)


def _exists(spark: SparkSession, path: str) -> bool:
    system, at = _file_system(spark, path)
    return system.exists(at)


def ingest_all(spark: SparkSession, sources: dict[str, str], root: str, force: bool = False) -> dict[str, str]:
    """One batch over all registered sources: ``loaded`` or ``skipped`` per table.

    Fails before loading anything if a source is missing; a table whose files are those of its
    last load, by name and fingerprint, and whose output exists is skipped. Each table is entered
    into the ledger as soon as it is loaded, with the rows of each file.
    """
    missing = [t for t, path in sources.items() if not _exists(spark, path)]
    if missing:
        raise FileNotFoundError(f"sources missing: {missing}")
    prints = stage(fingerprints(spark, sources), "fingerprints")
    changed = _changed(prints, latest_entries(read_ledger(spark, root)))
    batch_id = new_batch_id()
    result = {}
    for table, path in sources.items():
        if not force and table not in changed and _in_force(spark, table, root):
            result[table] = "skipped"
            continue
        version, _ = load_version(spark, path, table, root, batch_id)
        publish(spark, table, version, root, batch_id, read_text_table(spark, path).columns, prints)
        sweep(spark, table, root)
        result[table] = "loaded"
    return result


def _in_force(spark: SparkSession, table: str, root: str) -> bool:
    known = versions(spark, table, root)
    return bool(known) and _exists(spark, f"{root}/{table}/{known[0]}")


def _changed(prints: DataFrame, known: DataFrame) -> set[str]:
    """Tables with a file that is new, other than before or gone: at most one name for each table."""
    key = ["table_name", "source_file", "fingerprint"]
    new, gone = prints.join(known, key, "left_anti"), known.join(prints, key, "left_anti")
    return {r["table_name"] for r in new.select("table_name").union(gone.select("table_name")).distinct().collect()}


def check_landing(spark: SparkSession, sources: dict[str, str], root: str) -> DataFrame:
    """One row per table: exists, readable, rows and columns as in the ledger, one batch, stale source.

    ``empty_cells`` counts the empty cells of each source column. A table that cannot be read is a failed row.
    """
    schema = (
        "table_name string, exists boolean, readable boolean, row_count bigint, single_batch boolean, rows_match_log boolean, "
        "columns_match boolean, stale boolean, empty_cells map<string, bigint>"
    )
    known = latest_entries(read_ledger(spark, root))
    entries = known.groupBy("table_name").agg(F.sum("row_count").alias("row_count"), F.first("source_columns").alias("source_columns"))
    # One row for each table; the files themselves are compared in Spark.
    ledger = {r["table_name"]: r for r in entries.collect()}
    present = {t: s for t, s in sources.items() if _exists(spark, s)}
    stale = _changed(fingerprints(spark, present), known.where(F.col("table_name").isin(*present))) if present else set()
    rows = []
    for table in sources:
        if not _in_force(spark, table, root):
            rows.append((table, False, *[None] * 7))
            continue
        try:
            df = landed(spark, table, root)
            text = [c for c in df.columns if c not in LINEAGE]
            empties = [n_if(F.col(c) == "").alias(f"e{i}") for i, c in enumerate(text)]
            got = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("_batch_id").alias("b"), *empties).first()
        except (PySparkException, Py4JJavaError):
            rows.append((table, True, False, *[None] * 6))
            continue
        entry = ledger[table]
        rows.append(
            (
                table,
                True,
                True,
                got["n"],
                got["b"] == 1,
                entry["row_count"] == got["n"],
                list(df.columns) == [*entry["source_columns"], *LINEAGE],
                table not in present or table in stale,
                {c: got[f"e{i}"] for i, c in enumerate(text)},
            )
        )
    return spark.createDataFrame(rows, schema)


def read_truth(spark: SparkSession, path: str, sensors: list[str]) -> DataFrame:
    """Clean reference series as a typed CSV."""
    schema = "datetime timestamp_ntz, machineID bigint, " + ", ".join(f"{s} double" for s in sensors)
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.withColumnsRenamed({"datetime": "timestamp", "machineID": "machine_id"})


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def write_report(checks: DataFrame, path: str) -> None:
    """Checks as JSON lines, with ``passed`` on every row."""
    checks.write.mode("overwrite").json(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
