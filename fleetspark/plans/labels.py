"""Forward-looking labels and the dataset models are trained on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.functions.times import from_micros, micros, ntz
from fleetspark.operators.chunks import own_chunk, with_us
from fleetspark.operators.timejoin import by_step, following, union_with_carry
from fleetspark.params import HOUR_US, FleetParams

NO_FAILURE = "none"


def data_end(telemetry: DataFrame, p: FleetParams) -> DataFrame:
    return telemetry.agg(F.max(micros(p.time)).alias("_end"))


def labels(spine: DataFrame, failures: DataFrame, end: DataFrame, p: FleetParams) -> DataFrame:
    """What happens in ``(t, t + horizon]`` after each spine row.

    Rows whose horizon passes the end of the data are dropped. Failures keep their exact time
    (features round theirs up). One shuffle: the next failure of any kind and of each component
    come from a running frame over later rows plus one carry row per chunk.
    ``next_failure_at`` is kept so that events can be identified without float hours.
    """
    h = p.horizon_us
    spine = with_us(spine.select(*p.keys), p.time).crossJoin(F.broadcast(end))
    spine = spine.where(F.col("_us") + h <= F.col("_end")).drop("_end")
    spine = own_chunk(spine, "_us", p.chunk_us).withColumn("_spine", F.lit(True))
    names = F.concat_ws("+", *[F.when(F.col(f"_is_{c}"), F.lit(c)) for c in sorted(p.components)])
    events = (
        with_us(failures, p.time)
        .groupBy(p.entity, "_us")
        .agg(*[F.max(F.col("component") == c).alias(f"_is_{c}") for c in p.components])
        .select(
            p.entity,
            "_us",
            F.struct(F.col("_us").alias("at"), names.alias("components")).alias("_next"),
            *[F.when(F.col(f"_is_{c}"), F.col("_us")).alias(f"_next_{c}") for c in p.components],
        )
    )
    columns = {"_next": "min"} | {f"_next_{c}": "min" for c in p.components}
    rows = union_with_carry(spine, events, p, columns, backward=False)
    w = following(p)
    rows = rows.withColumns(
        {"_first": F.min("_next").over(w)} | {f"_at_{c}": F.min(f"_next_{c}").over(w) for c in p.components}
    ).where("_spine")
    soon = lambda c: F.coalesce(c <= F.col("_us") + h, F.lit(False))
    at = F.col("_first.at")
    return rows.select(
        *p.keys,
        ((at - F.col("_us")) / F.lit(HOUR_US)).cast("float").alias("hours_to_failure"),
        soon(at).cast("tinyint").alias(p.target),
        *[soon(F.col(f"_at_{c}")).cast("tinyint").alias(p.component_target(c)) for c in p.components],
        F.when(soon(at), F.col("_first.components")).otherwise(NO_FAILURE).alias("failed_component"),
        from_micros(at).alias("next_failure_at"),
    )


def assert_unique(df: DataFrame, p: FleetParams, what: str) -> None:
    """Cardinality check of a one-to-one join; one grouped pass, first duplicate only."""
    if df.groupBy(*p.keys).count().where("count > 1").limit(1).count():
        raise ValueError(f"{what}: more than one row for the same {p.entity} and {p.time}")


def ml_dataset(
    sensor: DataFrame, events: DataFrame, label_rows: DataFrame, p: FleetParams, validate: bool = False
) -> DataFrame:
    """Features and labels with ``split``: train ends a full horizon before test starts."""
    if validate:
        for name, df in (("sensor features", sensor), ("event features", events), ("labels", label_rows)):
            assert_unique(df, p, name)
    return with_split(by_step(by_step(sensor, events, p.keys), label_rows, p.keys), p)


def with_split(rows: DataFrame, p: FleetParams) -> DataFrame:
    """Rows of train and test with their ``split``; the gap between them goes."""
    return rows.withColumn("split", split_of(p)).where(F.col("split").isNotNull())


def split_of(p: FleetParams):
    """train, test, or NULL for the gap rows whose labels would look into the test period."""
    t, at = micros(p.time), micros(ntz(p.train_end))
    return F.when(t + p.horizon_us < at, "train").when(t >= at, "test")


def feature_columns(columns: list[str], p: FleetParams) -> list[str]:
    """Model inputs by name; anything that smells of a label is refused."""
    needed = [*p.keys, *p.label_columns, "split"]
    missing = [c for c in needed if c not in columns]
    if missing:
        raise ValueError(f"dataset lacks columns: {missing}")
    skip = {*needed, *p.exclude_features, "next_failure_at", "part"}
    features = [c for c in columns if c not in skip]
    leaks = [c for c in features if "fail" in c.lower()]
    if leaks:
        raise ValueError(f"label-like columns must not be features: {leaks}")
    return features


def model_parts(dataset: DataFrame, p: FleetParams) -> DataFrame:
    """Rows tagged with every part they belong to: fit, validation, development, test."""
    t, v = micros(p.time), micros(ntz(p.validation_start))
    train = F.col("split") == "train"
    parts = F.array_compact(
        F.array(
            F.when(train & (t + p.horizon_us < v), "fit"),
            F.when(train & (t >= v), "validation"),
            F.when(train, "development"),
            F.when(F.col("split") == "test", "test"),
        )
    )
    return dataset.withColumn("part", F.explode(parts))


def parts_summary(parts: DataFrame, p: FleetParams) -> DataFrame:
    return parts.groupBy("part").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col(p.target).cast("bigint")).alias("positives"),
        F.avg(F.col(p.target).cast("double")).alias("positive_rate"),
        F.min(p.time).alias("first_at"),
        F.max(p.time).alias("last_at"),
    )


def check_parts(summary: DataFrame) -> None:
    """Refuse empty parts and overlapping train and test times (at most four rows to read)."""
    rows = {r["part"]: r for r in summary.collect()}
    for part in ("fit", "validation", "development", "test"):
        if part not in rows:
            raise ValueError(f"no {part} rows: check the split dates")
    if rows["development"]["last_at"] >= rows["test"]["first_at"]:
        raise ValueError("train rows must all come before test rows")
