"""The two bound fleets with every derived layer.

Layers that feed several branches are written once per session and source folder, as a
warehouse does, and every query reads them; the rest stays lazy.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from fleetspark.bindings import EventFleet, SupplyFleet
from fleetspark.functions.staging import stage
from fleetspark.operators import cleaning
from fleetspark.operators.timejoin import by_step
from fleetspark.plans import features, kpis, labels, scoring, star


class _Star:
    """Star schema shared by both worlds; missing sources raise AttributeError."""

    @cached_property
    def costs(self) -> DataFrame:
        return kpis.component_costs(self.spark, self.p)

    @cached_property
    def kpi_tables(self) -> dict[str, DataFrame]:
        return kpis.kpi_tables(self.failures, self.maintenance, self.machines, self.costs, self.period)

    @cached_property
    def dim_machine(self) -> DataFrame:
        return star.dim_machine(self.machines)

    @cached_property
    def dim_component(self) -> DataFrame:
        return star.dim_component(self.costs)

    @cached_property
    def fact_failure(self) -> DataFrame:
        return star.fact_failure(self.failures, self.costs)

    @cached_property
    def fact_maintenance(self) -> DataFrame:
        return star.fact_maintenance(self.maintenance, self.failures, self.costs)

    @cached_property
    def fact_machine_month(self) -> DataFrame:
        return stage(star.fact_machine_month(self.kpi_tables["kpi_machine_monthly"]), "fact_machine_month")


class EventWorld(_Star, EventFleet):
    @cached_property
    def silver(self) -> DataFrame:
        return stage(cleaning.clean(self.readings, self.p), "silver")

    @cached_property
    def period(self) -> DataFrame:
        """First and last reading survive cleaning, so the period needs only the raw times."""
        return kpis.observed_period(self.readings)

    @cached_property
    def data_end(self) -> DataFrame:
        return labels.data_end(self.readings, self.p)

    @cached_property
    def sensor_features(self) -> DataFrame:
        return stage(features.sensor_features(self.silver, self.p), "sensor_features")

    @cached_property
    def spine(self) -> DataFrame:
        bounds = stage(cleaning.grid_bounds(self.readings, self.p), "grid_bounds")
        return features.feature_rows(bounds, self.p)

    @cached_property
    def event_features(self) -> DataFrame:
        rows = features.event_features(self.spine, self.errors, self.maintenance, self.machines, self.p)
        return stage(rows, "event_features")

    @cached_property
    def labels(self) -> DataFrame:
        return labels.labels(
            self.spine, self.failures, self.data_end, self.p
        )

    @cached_property
    def outcomes(self) -> DataFrame:
        """The dataset without its sensor features: all that a rule on events is judged by."""
        rows = by_step(self.event_features, self.labels, self.p.keys)
        return stage(labels.with_split(rows, self.p), "outcomes")

    @cached_property
    def ml_dataset(self) -> DataFrame:
        return stage(by_step(self.sensor_features, self.outcomes, self.p.keys), "ml_dataset")

    @cached_property
    def parts(self) -> DataFrame:
        return labels.model_parts(self.ml_dataset, self.p)

    @cached_property
    def outcome_parts(self) -> DataFrame:
        return labels.model_parts(self.outcomes, self.p)

    @cached_property
    def scored(self) -> DataFrame:
        """The dataset without sensor features and with the rule risk as ``score`` (risk of a failure, 0 to 1)."""
        return self.outcomes.withColumn("score", scoring.rule_risk(self.p))

    @cached_property
    def anomaly_model(self) -> tuple[DataFrame, DataFrame, list[str]]:
        return scoring.anomaly_model(self.ml_dataset, self.p)

    @cached_property
    def predictions(self) -> DataFrame:
        rows = by_step(self.sensor_features, self.event_features, self.p.keys)
        return stage(scoring.rule_predictions(rows, self.anomaly_model, self.failures, self.p), "predictions")

    @cached_property
    def fact_sensor_reading(self) -> DataFrame:
        return star.fact_sensor_reading(self.silver, self.p)

    @cached_property
    def fact_error(self) -> DataFrame:
        return star.fact_error(self.errors)

    @cached_property
    def fact_prediction(self) -> DataFrame:
        return star.fact_prediction(self.predictions)

    @cached_property
    def dim_date(self) -> DataFrame:
        times = [df.select("timestamp") for df in (self.readings, self.errors, self.maintenance, self.failures)]
        return star.dim_date(times)

    @cached_property
    def dim_sensor(self) -> DataFrame:
        return star.dim_sensor(self.spark, self.p)

    @cached_property
    def dim_error_type(self) -> DataFrame:
        return star.dim_error_type(self.spark, self.p)


class SupplyWorld(_Star, SupplyFleet):
    @cached_property
    def used_components(self) -> DataFrame:
        """Components that are replaced in the data at all."""
        return self.dim_component.join(self.maintenance.select("component").distinct(), "component", "left_semi")

    @cached_property
    def dim_date(self) -> DataFrame:
        return star.dim_date([self.lines.select("timestamp")])


_worlds: dict[tuple, EventWorld | SupplyWorld] = {}


def _shared(kind: type, spark: SparkSession, sf_dir: str):
    key = (kind, spark.sparkContext.applicationId, sf_dir)
    if key not in _worlds:
        _worlds[key] = kind(spark, sf_dir)
    return _worlds[key]


def event_world(spark: SparkSession, sf_dir: str) -> EventWorld:
    return _shared(EventWorld, spark, sf_dir)


def supply_world(spark: SparkSession, sf_dir: str) -> SupplyWorld:
    return _shared(SupplyWorld, spark, sf_dir)
