"""Star schema: five dimensions and six facts, each one projection over the layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetspark.functions.times import calendar_parts, date_key
from fleetspark.params import FleetParams

PREDICTION_SCHEMA = (
    "machine_id bigint, timestamp timestamp_ntz, failure_risk double, alert boolean, "
    "predicted_component string, comp1_risk double, comp2_risk double, comp3_risk double, "
    "comp4_risk double, anomaly_score double, anomaly_flag boolean, reason_1 string, "
    "reason_2 string, reason_3 string, out_of_sample boolean, failure_model_version string, "
    "component_model_version string, anomaly_model_version string"
)


def dim_machine(machines: DataFrame) -> DataFrame:
    return machines.select("machine_id", "model", "age", "plant_id", "plant_name", "city", "line_id")


def dim_component(costs: DataFrame) -> DataFrame:
    return costs.select(
        "component",
        "repair_cost",
        "unplanned_repair_cost",
        "unplanned_downtime_hours",
        "planned_downtime_hours",
        "downtime_cost_per_hour",
        "unplanned_failure_cost",
        "planned_maintenance_cost",
        "saving_if_prevented",
        "currency",
    )


def dim_sensor(spark: SparkSession, p: FleetParams) -> DataFrame:
    rows = [(s, float(v.min), float(v.max)) for s, v in p.sensors.items()]
    return spark.createDataFrame(rows, "sensor string, min_valid double, max_valid double")


def dim_error_type(spark: SparkSession, p: FleetParams) -> DataFrame:
    codes = spark.createDataFrame([(e,) for e in p.error_types], "error_id string")
    number = F.regexp_extract("error_id", "[0-9]+", 0).cast("int")
    return codes.select("error_id", number.alias("error_number"))


def calendar(times: list[DataFrame], time: str = "timestamp") -> DataFrame:
    """Every day between the first and the last time of all given frames."""
    bounds = reduce(
        DataFrame.unionByName,
        [df.agg(F.min(time).alias("lo"), F.max(time).alias("hi")) for df in times],
    ).agg(F.min("lo").cast("date").alias("lo"), F.max("hi").cast("date").alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day"))


def dim_date(times: list[DataFrame], time: str = "timestamp") -> DataFrame:
    return calendar(times, time).select(*[c.alias(n) for n, c in calendar_parts("day").items()])


def fact_sensor_reading(silver: DataFrame, p: FleetParams) -> DataFrame:
    """One row per machine, step and sensor; missing readings stay. A single scan feeds all
    sensors."""
    stacked = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(s).alias("sensor"), F.col(s).alias("value"), F.col(f"{s}_quality").alias("quality")
                )
                for s in p.sensors
            ]
        )
    )
    return silver.select(p.entity, date_key(p.time).alias("date_key"), p.time, stacked)


def fact_failure(failures: DataFrame, costs: DataFrame) -> DataFrame:
    together = Window.partitionBy("machine_id", "timestamp")
    priced = failures.withColumn("components_in_event", F.count(F.lit(1)).over(together))
    return priced.join(
        costs.select("component", "unplanned_downtime_hours", "unplanned_failure_cost"), "component"
    ).select(
        "machine_id",
        date_key("timestamp").alias("date_key"),
        "timestamp",
        "component",
        "components_in_event",
        F.col("unplanned_downtime_hours").alias("downtime_hours"),
        F.col("unplanned_failure_cost").alias("failure_cost"),
    )


def fact_maintenance(maintenance: DataFrame, failures: DataFrame, costs: DataFrame) -> DataFrame:
    """A replacement at a failure's machine, time and component is its repair and costs nothing
    extra. All failures count here, also those outside the KPI period."""
    keys = ["machine_id", "timestamp", "component"]
    repairs = failures.select(*keys).distinct().withColumn("_repair", F.lit(True))
    planned = F.col("_repair").isNull()
    return (
        maintenance.select(*keys)
        .join(repairs, keys, "left")
        .join(costs.select("component", "planned_downtime_hours", "planned_maintenance_cost"), "component")
        .select(
            "machine_id",
            date_key("timestamp").alias("date_key"),
            "timestamp",
            "component",
            F.when(planned, "planned").otherwise("failure_repair").alias("maintenance_type"),
            F.when(planned, F.col("planned_downtime_hours")).otherwise(0.0).alias("downtime_hours"),
            F.when(planned, F.col("planned_maintenance_cost")).otherwise(0.0).alias("maintenance_cost"),
        )
    )


def fact_error(errors: DataFrame) -> DataFrame:
    return errors.select("machine_id", date_key("timestamp").alias("date_key"), "timestamp", "error_id")


def fact_machine_month(monthly: DataFrame) -> DataFrame:
    first_day = F.concat(F.replace("month", F.lit("-"), F.lit("")), F.lit("01")).cast("int")
    rest = [c for c in monthly.columns if c not in ("machine_id", "month", "model", "plant_id", "line_id")]
    return monthly.select(
        "machine_id", first_day.alias("month_date_key"), F.col("month").alias("year_month"), *rest
    )


def no_predictions(spark: SparkSession) -> DataFrame:
    """Typed and empty, for a warehouse whose models are not trained yet."""
    return spark.createDataFrame([], PREDICTION_SCHEMA)


def fact_prediction(predictions: DataFrame) -> DataFrame:
    columns = [c for c in predictions.columns if c not in ("machine_id", "timestamp")]
    return predictions.select("machine_id", date_key("timestamp").alias("date_key"), "timestamp", *columns)


def register_views(tables: dict[str, DataFrame]) -> None:
    """Expose frames to SQL by name; a missing source is named in the error."""
    for name, df in tables.items():
        if df is None:
            raise ValueError(f"source {name} is missing: build its layer first")
        df.createOrReplaceTempView(name)
