"""Exploration: overview, description, correlation, profiles, resampling and report reading."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.functions.ordered import exact_quantiles, medians
from fleetspark.functions.times import micros, trunc
from fleetspark.functions.typing import ratio
from fleetspark.params import FleetParams


def overview(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, machines, NULL cells, repeated rows and time span of each table.

    Repeated rows are counted from one grouped pass over whole rows, machines from its keys.
    """
    parts = []
    for name, df in tables.items():
        nulls = sum((F.sum(F.col(c).isNull().cast("bigint")) for c in df.columns), F.lit(0))
        timed = "timestamp" in df.columns
        lo, hi = (F.min("timestamp"), F.max("timestamp")) if timed else (F.lit(None), F.lit(None))
        base = df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.coalesce(nulls, F.lit(0)).alias("nulls"),
            lo.cast("timestamp_ntz").alias("first_at"),
            hi.cast("timestamp_ntz").alias("last_at"),
        )
        machines = df.select("machine_id").distinct().agg(F.count("machine_id").alias("machines"))
        copies = df.groupBy(*df.columns).agg((F.count(F.lit(1)) - 1).alias("_c")).agg(
            F.coalesce(F.sum("_c"), F.lit(0)).alias("duplicate_rows")
        )
        parts.append(base.crossJoin(F.broadcast(machines)).crossJoin(F.broadcast(copies)))
    return reduce(DataFrame.unionByName, parts)


def grid_coverage(readings: DataFrame, p: FleetParams) -> DataFrame:
    """Distinct (machine, step) readings against a complete grid over the whole time span."""
    have = readings.select(*p.keys).distinct()
    one = have.agg(
        F.count(F.lit(1)).alias("actual"),
        ((F.max(micros(p.time)) - F.min(micros(p.time))) / F.lit(p.step_us) + 1).cast("bigint").alias("_steps"),
    )
    machines = readings.select(p.entity).distinct().agg(F.count(F.lit(1)).alias("_m"))
    return one.crossJoin(F.broadcast(machines)).select(
        "actual",
        (F.col("_steps") * F.col("_m")).alias("expected"),
        ratio("actual", F.col("_steps") * F.col("_m")).alias("coverage"),
    )


def describe(df: DataFrame, columns: list[str], probabilities: tuple[float, ...] = (0.001, 0.5, 0.999)) -> DataFrame:
    """Count, mean, deviation, minimum, exact percentiles and maximum, one row per column."""
    long = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns]))
    )
    base = long.groupBy("name").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    marks = exact_quantiles(long, "value", list(probabilities), ["name"])
    wide = marks.groupBy("name").agg(
        *[
            F.max(F.when(F.col("probability") == q, F.col("quantile"))).alias(f"p{str(q).replace('.', '_')}")
            for q in probabilities
        ]
    )
    return base.join(F.broadcast(wide), "name")


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pairwise correlation of rows where both values are present."""
    pairs = [(a, b) for a in columns for b in columns]
    one = df.agg(*[F.corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(a).alias("left_name"), F.lit(b).alias("right_name"), F.col(f"_{i}").alias("corr"))
                    for i, (a, b) in enumerate(pairs)
                ]
            )
        )
    )


def resample_monthly(events: DataFrame) -> DataFrame:
    """Events per calendar month, dated to its first day."""
    return events.groupBy(trunc("month", "timestamp").alias("month_start")).agg(F.count(F.lit(1)).alias("n"))


def machine_profile(df: DataFrame, columns: list[str], by: str = "machine_id") -> DataFrame:
    """Exact median and deviation of each column per group."""
    middle = medians(df, columns, [by]).withColumnsRenamed({c: f"{c}_median" for c in columns})
    return middle.join(df.groupBy(by).agg(*[F.stddev_samp(c).alias(f"{c}_std") for c in columns]), by)


def pivot_counts(df: DataFrame, rows: str, columns: str, values: list[str]) -> DataFrame:
    """Counts with one column per known value; absent pairs are zero."""
    return df.groupBy(rows).pivot(columns, values).count().fillna(0, values)


def melt(df: DataFrame, ids: list[str], values: list[str], name: str, value: str) -> DataFrame:
    return df.unpivot(ids, values, name, value)


REPORT_CHECKS = "map<string, string>"


def report_checks(reports: DataFrame, column: str = "report") -> DataFrame:
    """Flatten quality reports (JSON text) of four shapes into (layer, check_name, passed).

    A list of results, a mapping of checks, ``*_check`` entries, or one entry per table.
    """
    top = F.from_json(column, REPORT_CHECKS)
    results = F.from_json(top["results"], "array<struct<table:string, check:string, passed:boolean>>")
    named = F.from_json(top["checks"], REPORT_CHECKS)
    tables = F.from_json(top["tables"], REPORT_CHECKS)
    passed = lambda v: F.coalesce(F.get_json_object(v, "$.passed"), v).try_cast("boolean")
    entry = lambda name, ok: F.struct(name.alias("check_name"), ok.alias("passed"))
    from_list = F.transform(results, lambda r: entry(F.concat_ws(": ", r["table"], r["check"]), r["passed"]))
    from_map = F.transform(F.map_entries(named), lambda e: entry(e["key"], F.coalesce(passed(e["value"]), F.lit(False))))
    has_flag = lambda v: F.get_json_object(v, "$.passed").isNotNull()
    from_suffix = F.transform(
        F.filter(F.map_entries(top), lambda e: e["key"].endswith("_check") & has_flag(e["value"])),
        lambda e: entry(e["key"], passed(e["value"])),
    )
    from_tables = F.transform(
        F.filter(F.map_entries(tables), lambda e: has_flag(e["value"])),
        lambda e: entry(F.concat(F.lit("table "), e["key"]), passed(e["value"])),
    )
    none = F.array().cast("array<struct<check_name:string,passed:boolean>>")
    rest = F.concat(F.coalesce(from_suffix, none), F.coalesce(from_tables, none))
    checks = F.when(results.isNotNull(), from_list).when(named.isNotNull(), from_map).otherwise(rest)
    return reports.select("layer", F.inline(checks))
