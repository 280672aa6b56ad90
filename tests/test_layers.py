"""Layers that several queries read are written once; the queries do not go back to the events."""

import pytest

from fleetspark.plans import labels
from fleetspark.suite import worlds
from fleetspark.suite.catalog import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["n6_warning_signatures", "l16_reproducible"])
def test_written_layers_are_read(spark, name):
    files = QUERIES[name](spark, SMALL).inputFiles()
    assert files and not [f for f in files if "events.parquet" in f]


@pytest.mark.parametrize("name", ["m22_pr_points", "l19_beats_baseline"])
def test_a_rule_on_events_is_judged_without_cleaned_sensors(spark, monkeypatch, name):
    monkeypatch.setattr(worlds, "_worlds", {})
    assert QUERIES[name](spark, SMALL).count()
    assert not {"silver", "sensor_features", "ml_dataset"} & set(vars(worlds.event_world(spark, SMALL)))


def test_the_dataset_is_that_of_all_three_layers(spark):
    w = worlds.event_world(spark, SMALL)
    expected = labels.ml_dataset(w.sensor_features, w.event_features, w.labels, w.p)
    assert w.ml_dataset.columns == expected.columns and w.ml_dataset.count() == expected.count() > 0
    assert w.ml_dataset.exceptAll(expected).isEmpty()


def test_no_layer_is_broadcast(spark, monkeypatch):
    """Behind l8, l10, l11, l15 and k41: however small the files of a layer are, it is not sent to the driver."""
    written, w, made = worlds.event_world(spark, SMALL), worlds.EventWorld(spark, SMALL), {}
    for layer in ("sensor_features", "event_features", "labels", "outcomes", "anomaly_model"):
        vars(w)[layer] = getattr(written, layer)
    monkeypatch.setattr(worlds, "stage", lambda df, layer: made.setdefault(layer, df))
    assert w.predictions is made["predictions"] and w.ml_dataset is made["ml_dataset"]
    vars(w).pop("outcomes")
    assert w.outcomes is made["outcomes"]
    for layer, df in made.items():
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin [machine_id" in plan and "BroadcastHashJoin [machine_id" not in plan, (layer, plan)
