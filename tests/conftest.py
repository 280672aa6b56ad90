from __future__ import annotations

import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

T0 = datetime(2015, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("fleetspark-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def p():
    from fleetspark import FleetParams

    return FleetParams(chunk_steps=10)


@pytest.fixture(scope="session")
def frames(spark):
    """Small frames by kind; hours are counted from T0."""

    class Frames:
        def at(self, hour: float) -> datetime:
            return T0 + timedelta(hours=hour)

        def series(self, values, machine=1, start=0):
            """Same value for every sensor, one row per hour; a dict gives explicit hours."""
            items = values.items() if isinstance(values, dict) else enumerate(values, start)
            return [(machine, self.at(h), i + 2, *[v] * 4) for i, (h, v) in enumerate(items)]

        def readings(self, rows):
            return spark.createDataFrame(
                rows,
                "machine_id bigint, timestamp timestamp_ntz, _source_line bigint, volt double, rotate double, "
                "pressure double, vibration double",
            )

        def events(self, rows, name="component"):
            rows = [(m, self.at(h), v) for m, h, v in rows]
            return spark.createDataFrame(rows, f"machine_id bigint, timestamp timestamp_ntz, {name} string")

        def spine(self, hours, machine=1):
            return spark.createDataFrame(
                [(machine, self.at(h)) for h in hours], "machine_id bigint, timestamp timestamp_ntz"
            )

        def column(self, df, name, order="timestamp"):
            return [r[name] for r in df.orderBy(order).collect()]

    return Frames()
