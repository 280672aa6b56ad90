"""Python stages of the operators: the package travels with the application.

Executors of a cluster need not have the package installed: once per application it is packed and
given to Spark, which hands it to every Python worker, also to those of executors that join later.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    folder = os.path.realpath(tempfile.mkdtemp(prefix="spark-"))  # the driver serves it until the application ends
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    copy = shutil.copytree(package, os.path.join(folder, "all", package.name), ignore=shutil.ignore_patterns("__pycache__"))
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, package.name), "zip", os.path.dirname(copy)))
    _shipped.add(application)


def map_batches(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str
) -> DataFrame:
    """``df.mapInArrow(run, schema)`` with the package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
