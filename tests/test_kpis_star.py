from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fleetspark.plans import checks, insights, kpis, questions, star, views


@pytest.fixture(scope="module")
def world(spark, frames, p):
    machines = spark.createDataFrame(
        [(1, "model1", 3, "P1", "Pune", "Pune", "L1"), (2, "model2", 12, "P2", "Chennai", "Chennai", "L2")],
        "machine_id bigint, model string, age bigint, plant_id string, plant_name string, city string, line_id string",
    )
    base = spark.createDataFrame(
        [("comp1", 10.0, 8.0, 2.0), ("comp2", 20.0, 12.0, 3.0)],
        "component string, repair_cost double, unplanned_downtime_hours double, planned_downtime_hours double",
    )
    costs = kpis.derive_costs(base, p).withColumns(
        {
            "unplanned_failure_cost": F.when(F.col("component") == "comp1", 100.0).otherwise(200.0),
            "planned_maintenance_cost": F.when(F.col("component") == "comp1", 10.0).otherwise(20.0),
            "saving_if_prevented": F.when(F.col("component") == "comp1", 90.0).otherwise(180.0),
        }
    )
    failures = frames.events([(1, 30, "comp1"), (1, 30, "comp2"), (2, 100, "comp1"), (1, 5000, "comp1")])
    maintenance = frames.events([(1, 30, "comp1"), (1, 50, "comp2"), (2, 800, "comp1"), (2, -5, "comp1")])
    readings = frames.readings(frames.series({0: 1.0, 1000: 2.0}))
    period = kpis.observed_period(readings)
    return {"machines": machines, "costs": costs, "failures": failures, "maintenance": maintenance, "period": period}


def tables_of(w):
    return kpis.kpi_tables(w["failures"], w["maintenance"], w["machines"], w["costs"], w["period"])


def test_components_failing_together_are_one_event(world):
    rows = kpis.failure_events(world["failures"], world["costs"], world["period"]).orderBy("machine_id").collect()
    assert [(r["machine_id"], r["components"], r["downtime_h"], r["cost"]) for r in rows] == [(1, 2, 12.0, 300.0), (2, 1, 8.0, 100.0)]


def test_repairs_are_not_planned_maintenance(world):
    rows = kpis.planned_events(world["failures"], world["maintenance"], world["costs"], world["period"]).collect()
    assert sorted((r["machine_id"], r["cost"]) for r in rows) == [(1, 20.0), (2, 10.0)]
    c = kpis.classification_counts(world["failures"], world["maintenance"], world["costs"], world["period"]).first()
    assert c.asDict() == {
        "failure_events": 2, "component_failures": 3, "planned_events": 2, "repair_records_excluded": 1, "outside_period_excluded": 2,
    }


def test_unknown_component_is_an_error(world, frames):
    with pytest.raises(Exception, match="no cost data for component comp9"):
        kpis.failure_events(frames.events([(1, 30, "comp9")]), world["costs"], world["period"]).collect()


def test_months_are_dense_and_ratios_are_from_sums(world):
    t = tables_of(world)
    monthly = t["kpi_machine_monthly"].orderBy("machine_id", "month").collect()
    assert [(r["machine_id"], r["month"], r["period_hours"]) for r in monthly] == [
        (1, "2015-01", 744.0), (1, "2015-02", 240.0), (2, "2015-01", 744.0), (2, "2015-02", 240.0),
    ]
    first = monthly[0]
    assert first["downtime_h"] == 15.0 and first["availability"] == pytest.approx(1 - 15 / 744)
    assert monthly[1]["mtbf_h"] is None
    plant = t["kpi_plant_monthly"].where("plant_id = 'P1' AND month = '2015-01'").first()
    assert plant["mtbf_h"] == pytest.approx((744 - 15) / 1)


def star_of(w, p, frames, spark):
    month = star.fact_machine_month(tables_of(w)["kpi_machine_monthly"])
    return {
        "dim_machine": star.dim_machine(w["machines"]),
        "dim_component": star.dim_component(w["costs"]),
        "dim_date": star.dim_date([w["failures"], w["maintenance"]]),
        "fact_failure": star.fact_failure(w["failures"], w["costs"]),
        "fact_maintenance": star.fact_maintenance(w["maintenance"], w["failures"], w["costs"]),
        "fact_machine_month": month,
    }


def failed(df):
    return {r["subject"] for r in df.collect() if not r["passed"]}


def test_warehouse_checks_pass_and_catch_corruption(world, p, frames, spark):
    good = star_of(world, p, frames, spark)
    assert not failed(checks.unique_keys(good)) and not failed(checks.references(good)) and not failed(checks.date_keys(good))
    twice = good | {"fact_failure": good["fact_failure"].unionByName(good["fact_failure"])}
    assert failed(checks.unique_keys(twice)) == {"fact_failure"}
    orphan = good | {"fact_failure": good["fact_failure"].withColumn("machine_id", F.lit(77).cast("bigint"))}
    assert failed(checks.references(orphan)) == {"fact_failure.machine_id -> dim_machine"}
    shifted = good | {"fact_failure": good["fact_failure"].withColumn("date_key", F.col("date_key") + 1)}
    assert failed(checks.date_keys(shifted)) == {"fact_failure"}
    holes = good | {"dim_date": good["dim_date"].where("date <> DATE '2015-01-02'")}
    assert "missing_days" in failed(checks.date_keys(holes))


def test_links_share_one_scan_and_count_their_own_orphans(spark):
    dim = spark.createDataFrame([(1,), (2,), (2,)], "machine_id long")
    days = spark.createDataFrame([(20150101,)], "date_key int")
    parts = spark.createDataFrame([("comp1",)], "component string")
    rows = [(1, 20150101, "comp1"), (None, 20150101, "comp1"), (3, 20150102, None), (2, 20150101, "1"), (3, 20150101, "comp1")]
    fact = spark.createDataFrame(rows, "machine_id long, date_key int, component string")
    tables = {"dim_machine": dim, "dim_date": days, "dim_component": parts, "fact_failure": fact, "fact_maintenance": fact.limit(0)}
    out = checks.references(tables)
    got = {r["subject"]: (r["passed"], r["actual"]) for r in out.collect()}
    assert got == {
        "fact_failure.machine_id -> dim_machine": (False, 3.0), "fact_failure.date_key -> dim_date": (False, 1.0),
        "fact_failure.component -> dim_component": (False, 2.0), "fact_maintenance.machine_id -> dim_machine": (True, 0.0),
        "fact_maintenance.date_key -> dim_date": (True, 0.0), "fact_maintenance.component -> dim_component": (True, 0.0),
    }
    # A table read from files is scanned once, however many links it has.
    read = spark.range(10).select(F.col("id").alias("machine_id"), F.lit(20150101).alias("date_key"), F.lit("comp1").alias("component"))
    plan = checks.references(tables | {"fact_failure": read})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 10") == 1


def test_silver_reconciliation_of_all_sensors_in_one_pass(frames, spark, p):
    wide = [(1, h, *[v] * 4, *[q] * 4) for h, (v, q) in enumerate([(1.5, "ok"), (2.5, "filled"), (None, "missing")])]
    kinds = ", ".join([*[f"{s} double" for s in p.sensors], *[f"{s}_quality string" for s in p.sensors]])
    silver = spark.createDataFrame(wide, f"machine_id long, hour int, {kinds}")
    long = [(r[0], s, r[2], r[6]) for r in wide for s in p.sensors]
    reading = spark.createDataFrame(long, "machine_id long, sensor string, value double, quality string")
    one = spark.range(1)
    events = {n: one for n in ("failures", "maintenance", "errors", "machines")}
    facts = {n: one for n in ("fact_failure", "fact_maintenance", "fact_error", "dim_machine")}
    out = checks.silver_reconciliation(silver, events, facts | {"fact_sensor_reading": reading}, p).collect()
    assert len(out) == 6 * len(p.sensors) + 4 and all(r["passed"] for r in out)
    assert {r["subject"]: r["actual"] for r in out}["volt.sum"] == 4.0
    lost = reading.where("NOT (sensor = 'volt' AND quality = 'filled')").withColumn(
        "quality", F.when((F.col("sensor") == "rotate") & (F.col("quality") == "ok"), "filled").otherwise(F.col("quality"))
    )
    bad = failed(checks.silver_reconciliation(silver, events, facts | {"fact_sensor_reading": lost}, p))
    assert bad == {"volt.row_count", "volt.values", "volt.sum", "volt.filled", "rotate.ok", "rotate.filled"}


def test_reconciliation_catches_one_changed_total(world, p, frames, spark):
    t, good = tables_of(world), star_of(world, p, frames, spark)
    assert not failed(checks.gold_reconciliation(t["kpi_machine_monthly"], good, world["period"]))
    assert not failed(checks.kpi_reconciliation(t, world["failures"], world["period"]))
    wrong = good | {"fact_machine_month": good["fact_machine_month"].withColumn("total_cost", F.col("total_cost") + 1)}
    assert failed(checks.gold_reconciliation(t["kpi_machine_monthly"], wrong, world["period"])) == {"total_cost"}
    lost = world["failures"].where("machine_id = 1")
    assert "failures" in failed(checks.kpi_reconciliation(t, lost, world["period"]))


def test_views_agree_with_the_facts(world, p, frames, spark):
    s = star_of(world, p, frames, spark)
    shown = {
        "fleet": views.fleet_monthly(s["fact_machine_month"]),
        "lines": views.line_performance(s["fact_machine_month"], s["dim_machine"]),
    }
    assert not failed(checks.view_checks(shown, s["fact_machine_month"]))
    assert failed(checks.view_checks({"none": shown["fleet"].limit(0)}, s["fact_machine_month"]))
    comp = {r["component"]: r for r in views.component_reliability(s["dim_component"], s["fact_failure"], s["fact_maintenance"], world["period"]).collect()}
    assert comp["comp1"]["failures"] == 2 and comp["comp1"]["in_multi_component_events"] == 1
    assert comp["comp1"]["planned_replacements"] == 1 and comp["comp1"]["unplanned_share"] == pytest.approx(2 / 3)
    assert comp["comp1"]["mean_days_between_failures"] is None


def test_sql_over_registered_views(world, p, frames, spark):
    star.register_views(star_of(world, p, frames, spark))
    got = spark.sql("SELECT count(*) AS n FROM fact_failure WHERE (:m IS NULL OR machine_id = :m)", args={"m": 1}).first()["n"]
    assert got == 3
    with pytest.raises(ValueError, match="source x is missing"):
        star.register_views({"x": None})
    assert star.no_predictions(spark).count() == 0


def test_scenario_by_hand(world, p, frames, spark):
    s = star_of(world, p, frames, spark)
    year = insights.base_year(s["fact_failure"], s["dim_component"], s["fact_machine_month"], world["period"])
    y = year.first()
    assert (y["events"], y["saving_if_caught"], y["downtime_avoided_h"]) == (2, 90.0 + 180.0 + 90.0, 9.0 + 6.0)
    years = 984 / 8760
    assert y["years"] == pytest.approx(years)
    comps = insights.component_failures(s["fact_failure"], s["dim_component"], world["period"])
    table = insights.scenario_table(spark, {"half": __import__("fleetspark").Scenario(0.5, 1.0)})
    r = insights.scenario_results(table, year, comps, p, alarm_cost=10.0, program_cost=100.0).first()
    assert r["failures_caught"] == pytest.approx(0.5 * 2 / years)
    assert r["net_saving"] == pytest.approx(0.5 * 360 / years - 0.5 * 2 / years * 10 - 100)
    assert r["technician_hours_per_week"] == pytest.approx((2 / years * 2 + 0.5 * (2 * 2 + 1 * 3) / years) / 52)
    assert insights.break_even(year, 1.0, 10.0, 1e9).first()[0] is None
    assert insights.break_even(year, 1.0, 1000.0, 1.0).first()[0] is None
    even = insights.break_even(year, 1.0, 10.0, 100.0).first()[0]
    assert even == pytest.approx(100 / ((360 - 20) / years))


def test_signature_counts_an_input_once_per_alert(spark):
    rows = [("comp1", "error1 raised", "error1 again", None), ("comp1", "voltage high", None, None), ("comp1", "error1 raised", "comp2 last", "errors (all")]
    df = spark.createDataFrame(rows, "predicted_component string, reason_1 string, reason_2 string, reason_3 string")
    got = {r["signal"]: r["share_of_alerts"] for r in insights.warning_signatures(df, top=4).collect()}
    assert got == {"error1": pytest.approx(2 / 3), "comp2 age": pytest.approx(1 / 3), "errors (all types)": pytest.approx(1 / 3), "voltage": pytest.approx(1 / 3)}


def test_long_windows_become_daily_means(frames, p, spark):
    from fleetspark.operators import cleaning

    silver = cleaning.clean(frames.readings(frames.series([float(i) for i in range(48)])), p)
    fact = star.fact_sensor_reading(silver, p)
    short = questions.machine_sensors(fact, 1, frames.at(0), frames.at(10))
    long = questions.machine_sensors(fact, 1, frames.at(0), frames.at(24 * 20))
    assert short.count() == 44 and long.count() == 8
    assert {r["quality"] for r in long.collect()} == {"daily mean"}
