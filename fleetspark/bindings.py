"""Driver tables as inputs of the generic operators.

``EventFleet``: a user of the ``events`` stream is a machine, time runs in 12-hour slots.
``SupplyFleet``: a supplier is a machine, shipped lines are its failures and maintenance.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.functions.times import floor_us, from_micros, micros, pin_utc
from fleetspark.params import HOUR_US, FleetParams, Limit

EVENT_PARAMS = FleetParams(
    step_us=12 * HOUR_US,
    unit="s",
    chunk_steps=16,
    sensors={
        "volt": Limit(0.0, 150.0),
        "rotate": Limit(5.0, 100.0),
        "pressure": Limit(0.0, 1000.0),
        "vibration": Limit(0.0, 100.0),
    },
    stuck_min_run=3,
    max_fill=3,
    fill_window=8,
    windows=(3, 8),
    feature_step=3,
    horizon=4,
    train_end=datetime(2024, 1, 22),
    validation_start=datetime(2024, 1, 15),
)

# Event types in alphabetical order give error1 to error5.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


class EventFleet:
    def __init__(self, spark: SparkSession, sf_dir: str, params: FleetParams = EVENT_PARAMS):
        self.spark, self.dir, self.p = pin_utc(spark), sf_dir, params

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        return self.table("events").select(
            "event_id",
            F.col("ts").cast("timestamp_ntz").alias("timestamp"),
            F.col("user_id").alias("machine_id"),
            "event_type",
            "value",
            k.alias("k"),
        )

    @cached_property
    def readings(self) -> DataFrame:
        k = F.col("k").cast("double")
        return self.events.select(
            "machine_id",
            from_micros(floor_us(micros("timestamp"), self.p.step_us)).alias("timestamp"),
            F.col("event_id").alias("_source_line"),
            F.col("value").alias("volt"),
            k.alias("rotate"),
            (F.floor(F.col("value") / 25) * 25).cast("double").alias("pressure"),
            F.when(F.col("k") % 5 != 0, k).alias("vibration"),
        )

    @cached_property
    def errors(self) -> DataFrame:
        codes = {t: f"error{i}" for i, t in enumerate(EVENT_TYPES, 1)}
        code = F.lit(None).cast("string")
        for t, e in codes.items():
            code = F.when(F.col("event_type") == t, e).otherwise(code)
        return self.events.select("timestamp", "machine_id", code.alias("error_id"))

    def _component(self):
        return F.concat(F.lit("comp"), (F.col("k") % 4 + 1).cast("string")).alias("component")

    @cached_property
    def failures(self) -> DataFrame:
        return self.events.where((F.col("event_type") == "error") & (F.col("k") < 50)).select(
            "timestamp", "machine_id", self._component()
        )

    @cached_property
    def maintenance(self) -> DataFrame:
        repair = (F.col("event_type") == "error") & (F.col("k") < 50) & (F.col("k") % 2 == 0)
        return self.events.where((F.col("event_type") == "purchase") | repair).select(
            "timestamp", "machine_id", self._component()
        )

    @cached_property
    def machines(self) -> DataFrame:
        users = self.events.select("machine_id").distinct()
        place = (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )
        return users.join(place, F.col("machine_id") == F.col("c_custkey"), "left").select(
            "machine_id",
            F.concat(F.lit("model"), (F.col("machine_id") % 4 + 1).cast("string")).alias("model"),
            (F.col("machine_id") % 21).alias("age"),
            F.concat(F.lit("P"), F.col("r_regionkey").cast("string")).alias("plant_id"),
            F.col("r_name").alias("plant_name"),
            F.col("r_name").alias("city"),
            F.concat(F.lit("L"), F.col("n_nationkey").cast("string")).alias("line_id"),
        )


class SupplyFleet:
    def __init__(self, spark: SparkSession, sf_dir: str, params: FleetParams | None = None):
        self.spark, self.dir, self.p = pin_utc(spark), sf_dir, params or FleetParams()

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def lines(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_suppkey").alias("machine_id"),
            F.col("l_shipdate").cast("timestamp_ntz").alias("timestamp"),
            F.concat(F.lit("comp"), (F.col("l_partkey") % 4 + 1).cast("string")).alias("component"),
            "l_returnflag",
            (F.col("l_orderkey") % 3 == 0).alias("_third"),
        )

    def _records(self, kept) -> DataFrame:
        return self.lines.where(kept).select("timestamp", "machine_id", "component").distinct()

    @cached_property
    def failures(self) -> DataFrame:
        return self._records(F.col("l_returnflag") == "R")

    @cached_property
    def maintenance(self) -> DataFrame:
        return self._records(
            (F.col("l_returnflag") == "A") | ((F.col("l_returnflag") == "R") & F.col("_third"))
        )

    @cached_property
    def machines(self) -> DataFrame:
        return (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("s_suppkey").alias("machine_id"),
                F.concat(F.lit("model"), (F.col("s_suppkey") % 4 + 1).cast("string")).alias("model"),
                (F.col("s_suppkey") % 21).alias("age"),
                F.concat(F.lit("P"), F.col("r_regionkey").cast("string")).alias("plant_id"),
                F.col("r_name").alias("plant_name"),
                F.col("r_name").alias("city"),
                F.concat(F.lit("L"), F.col("n_nationkey").cast("string")).alias("line_id"),
            )
        )

    @cached_property
    def period(self) -> DataFrame:
        from fleetspark.plans.kpis import observed_period

        return observed_period(self.lines.select("timestamp"))
