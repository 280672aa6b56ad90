"""Cut a long lineage by writing a layer table to shared storage and reading it back.

Layers feed many branches: written once as Parquet, each branch is a pruned scan, and a lost
executor only repeats the scan. The folder is the one the cluster names in
``spark.checkpoint.dir``; only a local session without that setting gets a temporary one.
"""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_dirs:
        folder = tempfile.mkdtemp(prefix="spark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_dirs[context.applicationId] = folder
    return _local_dirs[context.applicationId]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table of its own and return the table."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/layers/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._staged_at = path  # for release()
    return table


@contextmanager
def shared_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """The name of a folder that all tasks can reach while a job runs; it is deleted afterwards."""
    path = f"{shared_dir(spark)}/layers/{name}-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def release(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more, and shuffle files of finished queries.

    Spark deletes those files when the driver collects garbage, which a large driver seldom does
    by itself: it is asked to here. A table that was not staged is left alone.
    """
    for table in tables:
        context = table.sparkSession.sparkContext
        path = getattr(table, "_staged_at", None)
        if path is not None:
            _delete(table.sparkSession, path)
    if tables:
        gc.collect()
        context._jvm.System.gc()
