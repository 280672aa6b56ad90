"""Scores without a trained model, and the label-free anomaly score."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.functions.ordered import exact_quantiles
from fleetspark.functions.staging import stage
from fleetspark.functions.times import micros, ntz
from fleetspark.operators.timejoin import count_until
from fleetspark.params import FleetParams

# Rules of the anomaly score.
HEALTHY_MARGIN_H = 168
FLAG_RATE = 0.01
MIN_LIFT = 3.0
ALERT_AT = 0.5


def never_fail() -> Column:
    return F.lit(0.0)


def error_rule(p: FleetParams, error: str = "error5") -> Column:
    """Score of the rule baseline; it alerts at one or more errors in the window."""
    return F.col(f"{error}_count_{p.longest}{p.unit}").cast("double")


def rule_risk(p: FleetParams) -> Column:
    return F.least(F.lit(1.0), F.col(f"errors_total_{p.longest}{p.unit}") / F.lit(10.0))


def anomaly_inputs(columns: list[str], p: FleetParams) -> list[str]:
    """Sensor statistics only: no errors, component age, machine data or quality shares."""
    share = f"_share_{p.longest}{p.unit}"
    return [c for c in columns if c.split("_")[0] in p.sensors and "_" in c and not c.endswith(share)
            and not c.endswith("_quality")]


def healthy(p: FleetParams) -> Column:
    far = F.col("hours_to_failure").isNull() | (F.col("hours_to_failure") > HEALTHY_MARGIN_H)
    return (F.col(p.target) == 0) & far


def anomaly_profile(train: DataFrame, inputs: list[str]) -> DataFrame:
    """One row: median, mean and population deviation of every input on healthy rows.

    Medians replace missing values before mean and deviation are taken, so they come first;
    they are exact and computed for all inputs in one distributed pass.
    """
    doubles = train.select(*[F.col(c).cast("double").alias(c) for c in inputs])
    long = doubles.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("input"), F.col(c).alias("value")) for c in inputs]))
    )
    medians = stage(
        exact_quantiles(long, "value", [0.5], ["input"])
        .groupBy()
        .agg(*[F.max(F.when(F.col("input") == c, F.col("quantile"))).alias(f"{c}__median") for c in inputs]),
        "anomaly_medians",
    )
    imputed = doubles.crossJoin(F.broadcast(medians)).select(
        *[F.coalesce(F.col(c), F.col(f"{c}__median")).alias(c) for c in inputs]
    )
    moments = imputed.agg(
        *[F.avg(c).alias(f"{c}__mean") for c in inputs], *[F.stddev_pop(c).alias(f"{c}__std") for c in inputs]
    )
    return medians.crossJoin(F.broadcast(moments))


def anomaly_score(rows: DataFrame, profile: DataFrame, inputs: list[str]) -> DataFrame:
    """Add ``anomaly_score``: mean squared standardised distance from the healthy profile."""
    squares = []
    for c in inputs:
        value = F.coalesce(F.col(c).cast("double"), F.col(f"{c}__median"))
        z = (value - F.col(f"{c}__mean")) / F.when(F.col(f"{c}__std") > 0, F.col(f"{c}__std")).otherwise(1.0)
        squares.append(z * z)
    score = reduce(lambda a, b: a + b, squares) / F.lit(float(len(inputs)))
    drop = [f"{c}__{m}" for c in inputs for m in ("median", "mean", "std")]
    return rows.crossJoin(F.broadcast(profile)).withColumn("anomaly_score", score).drop(*drop)


def anomaly_threshold(scored_validation: DataFrame) -> DataFrame:
    """One row: the score that ``FLAG_RATE`` of the healthy validation rows exceed."""
    return exact_quantiles(scored_validation, "anomaly_score", [1 - FLAG_RATE]).select(
        F.col("quantile").alias("anomaly_threshold")
    )


def anomaly_model(dataset: DataFrame, p: FleetParams) -> tuple[DataFrame, DataFrame, list[str]]:
    """(profile row, threshold row, inputs) from healthy fit and healthy validation rows.

    The fitted rows are written, as any trained model is: scoring then reads one small row
    instead of dragging the training plan along.
    """
    inputs = anomaly_inputs(dataset.columns, p)
    t, v = micros(p.time), micros(ntz(p.validation_start))
    train = F.col("split") == "train"
    fit = dataset.where(healthy(p) & train & (t + p.horizon_us < v))
    validation = dataset.where(healthy(p) & train & (t >= v))
    profile = stage(anomaly_profile(fit, inputs), "anomaly_profile")
    threshold = stage(anomaly_threshold(anomaly_score(validation, profile, inputs)), "anomaly_threshold")
    return profile, threshold, inputs


def component_shares(rows: DataFrame, failures: DataFrame, p: FleetParams) -> DataFrame:
    """``<comp>_risk``: share of the component among the machine's failures so far."""
    kinds = {f"_k_{c}": F.col("component") == c for c in p.components}
    counted = count_until(rows, failures, p, kinds)
    total = reduce(lambda a, b: a + b, [F.col(k) for k in kinds])
    shares = {
        f"{c}_risk": F.coalesce(F.try_divide(F.col(f"_k_{c}").cast("double"), total.cast("double")), F.lit(0.0))
        for c in p.components
    }
    return counted.withColumns(shares).drop(*kinds)


def top_component(p: FleetParams) -> Column:
    """Component with the highest risk; the first one wins a tie."""
    best = F.greatest(*[F.col(f"{c}_risk") for c in p.components])
    out = F.lit(None).cast("string")
    for c in reversed(list(p.components)):
        out = F.when(F.col(f"{c}_risk") == best, F.lit(c)).otherwise(out)
    return out


def rule_predictions(
    rows: DataFrame, model: tuple[DataFrame, DataFrame, list[str]], failures: DataFrame, p: FleetParams
) -> DataFrame:
    """Predictions of the rule: error risk, component shares and the anomaly score."""
    profile, threshold, inputs = model
    total = f"errors_total_{p.longest}{p.unit}"
    keep = rows.select(*p.keys, total, *inputs)
    shared = component_shares(keep, failures, p)
    scored = anomaly_score(shared, profile, inputs).crossJoin(F.broadcast(threshold))
    risk = rule_risk(p)
    text = F.concat(F.lit("errors raised "), F.col(total).cast("string"), F.lit(" times"))
    return scored.select(
        *p.keys,
        risk.alias("failure_risk"),
        (risk >= ALERT_AT).alias("alert"),
        top_component(p).alias("predicted_component"),
        *[F.col(f"{c}_risk") for c in p.components],
        "anomaly_score",
        (F.col("anomaly_score") >= F.col("anomaly_threshold")).alias("anomaly_flag"),
        F.when(risk >= ALERT_AT, text).alias("reason_1"),
        F.lit(None).cast("string").alias("reason_2"),
        F.lit(None).cast("string").alias("reason_3"),
        (micros(p.time) >= micros(ntz(p.train_end))).alias("out_of_sample"),
        F.lit("rule").alias("failure_model_version"),
        F.lit("rule").alias("component_model_version"),
        F.lit("rule").alias("anomaly_model_version"),
    )
