from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from fleetspark.operators.tables import kept
from fleetspark.plans.explore import report_checks
from fleetspark.sources import landing as L
from fleetspark.sources.contracts import TableContract, check_table, summary, validate_files


@pytest.fixture()
def source(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "machines.csv").write_text("machineID,model,age\n1,model1,5\n2,,NA\n3,model2,\n")
    (folder / "errors.csv").write_text("datetime,machineID,errorID\n2015-01-01 06:00:00,1,error1\n")
    return folder


def test_text_lands_unchanged_with_lineage(spark, source, tmp_path):
    root = str(tmp_path / "bronze")
    assert L.ingest_table(spark, str(source / "machines.csv"), "machines", root, "b1") == 3
    rows = L.landed(spark, "machines", root).orderBy("_source_line").collect()
    assert [(r["machineID"], r["model"], r["age"], r["_source_line"]) for r in rows] == [
        ("1", "model1", "5", 2), ("2", "", "NA", 3), ("3", "model2", "", 4),
    ]
    assert {(r["_source_file"], r["_batch_id"]) for r in rows} == {("machines.csv", "b1")}


def test_line_numbers_survive_file_splits(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text("id,text\n" + "".join(f"{i},{'x' * 50}\n" for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = L.with_lineage(L.read_text_table(spark, str(path)), "b")
        bad = df.where("CAST(id AS BIGINT) + 2 <> _source_line").count()
        assert df.count() == 3000 and bad == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_reserved_names_are_refused(spark, tmp_path):
    (tmp_path / "x.csv").write_text("_id,a\n1,2\n")
    with pytest.raises(L.LandingError, match="must not start"):
        L.read_text_table(spark, str(tmp_path / "x.csv"))


def test_unchanged_files_are_skipped(spark, source, tmp_path):
    root = str(tmp_path / "bronze")
    sources = {"machines": str(source / "machines.csv"), "errors": str(source / "errors.csv")}
    assert set(L.ingest_all(spark, sources, root).values()) == {"loaded"}
    assert set(L.ingest_all(spark, sources, root).values()) == {"skipped"}
    (source / "errors.csv").write_text("datetime,machineID,errorID\n2015-01-01 06:00:00,2,error1\n")
    stale = {r["table_name"]: r["stale"] for r in L.check_landing(spark, sources, root).collect()}
    assert stale == {"machines": False, "errors": True}
    assert L.ingest_all(spark, sources, root) == {"machines": "skipped", "errors": "loaded"}
    assert L.ingest_all(spark, sources, root, force=True) == {"machines": "loaded", "errors": "loaded"}
    for r in L.check_landing(spark, sources, root).collect():
        assert r["exists"] and r["single_batch"] and r["rows_match_log"] and r["columns_match"] and not r["stale"]
    assert L.history(L.read_ledger(spark, root)).count() == 3


def test_swapped_lines_change_the_fingerprint_and_splits_do_not(spark, tmp_path):
    lines = [f"{i},{'x' * 40}" for i in range(2000)]
    (tmp_path / "a.csv").write_text("\n".join(["id,text", *lines]))
    one = L.fingerprints(spark, {"t": str(tmp_path / "a.csv")}).first()["fingerprint"]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        assert L.fingerprints(spark, {"t": str(tmp_path / "a.csv")}).first()["fingerprint"] == one
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    lines[3], lines[9] = lines[9], lines[3]
    (tmp_path / "a.csv").write_text("\n".join(["id,text", *lines]))
    assert L.fingerprints(spark, {"t": str(tmp_path / "a.csv")}).first()["fingerprint"] != one


def test_several_files_and_a_removed_one(spark, tmp_path):
    root, folder = str(tmp_path / "bronze"), tmp_path / "parts"
    folder.mkdir()
    for name in "ab":
        (folder / f"{name}.csv").write_text("id\n1\n2\n3\n")
    sources = {"t": str(folder)}
    assert L.ingest_all(spark, sources, root) == {"t": "loaded"}
    batch = L.history(L.read_ledger(spark, root)).first()
    assert (batch["tables"], batch["files"], batch["row_count"]) == (1, 2, 6)
    assert not L.check_landing(spark, sources, root).first()["stale"]
    (folder / "b.csv").unlink()
    assert L.check_landing(spark, sources, root).first()["stale"]
    assert L.ingest_all(spark, sources, root) == {"t": "loaded"} and L.landed(spark, "t", root).count() == 3


def test_keep_first_follows_files_then_lines(spark, tmp_path):
    (tmp_path / "parts").mkdir()
    for name, values in (("a", "1,late\n2,first"), ("b", "2,second\n1,later")):
        (tmp_path / "parts" / f"{name}.csv").write_text(f"machineID,model\n{values}\n")
    L.ingest_table(spark, str(tmp_path / "parts"), "t", str(tmp_path / "bronze"))
    df = L.landed(spark, "t", str(tmp_path / "bronze"))
    lines = [(r["_source_file"], r["_source_line"]) for r in df.orderBy("_source_order").collect()]
    assert lines == [("a.csv", 2), ("a.csv", 3), ("b.csv", 2), ("b.csv", 3)]
    first = kept(df.withColumn("reason", F.lit(None).cast("string")), ["machineID"])
    assert {(r["machineID"], r["model"]) for r in first.collect()} == {("1", "late"), ("2", "first")}


@pytest.mark.parametrize("crash", ["load_version", "write_parquet", "publish", "sweep"])
def test_a_crash_between_any_two_steps_leaves_a_readable_table(spark, source, tmp_path, monkeypatch, crash):
    root, path = str(tmp_path / "bronze"), source / "errors.csv"
    sources = {"errors": str(path)}
    L.ingest_all(spark, sources, root)
    path.write_text("datetime,machineID,errorID\n2015-01-01 06:00:00,1,error1\n2015-01-01 07:00:00,1,error2\n")
    whole = getattr(L, crash)

    def dies(*args, **kwargs):
        if crash == "write_parquet" and "_ledger" not in args[1]:
            return whole(*args, **kwargs)  # dies while it enters the version into the ledger
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(L, crash, dies)
        with pytest.raises(RuntimeError):
            L.ingest_all(spark, sources, root)
    assert L.landed(spark, "errors", root).count() == (2 if crash == "sweep" else 1)
    L.ingest_all(spark, sources, root)
    assert L.landed(spark, "errors", root).count() == 2
    assert len([f for f in (tmp_path / "bronze" / "errors").iterdir() if not f.name.startswith(".")]) == 2


def test_former_readers_finish_and_damage_is_a_failed_row(spark, source, tmp_path):
    root, sources = str(tmp_path / "bronze"), {"errors": str(source / "errors.csv"), "machines": str(source / "machines.csv")}
    L.ingest_all(spark, sources, root)
    former = L.landed(spark, "errors", root)
    L.ingest_all(spark, sources, root, force=True)
    assert former.count() == 1 and len(L.versions(spark, "errors", root)) == 2
    for f in (tmp_path / "bronze" / "errors" / L.versions(spark, "errors", root)[0]).glob("*.parquet"):
        f.write_bytes(b"damaged")
    got = {r["table_name"]: r for r in L.check_landing(spark, {**sources, "none": "/nowhere"}, root).collect()}
    assert (got["errors"]["exists"], got["errors"]["readable"], got["none"]["exists"]) == (True, False, False)
    assert got["machines"]["empty_cells"] == {"machineID": 0, "model": 1, "age": 1}


def test_a_refused_table_keeps_the_entries_before_it(spark, source, tmp_path):
    root = str(tmp_path / "bronze")
    (source / "bad.csv").write_text("_id\n1\n")
    sources = {"machines": str(source / "machines.csv"), "bad": str(source / "bad.csv")}
    with pytest.raises(L.LandingError):
        L.ingest_all(spark, sources, root)
    assert [r["table_name"] for r in L.read_ledger(spark, root).collect()] == ["machines"]


def test_missing_source_loads_nothing(spark, source, tmp_path):
    root = str(tmp_path / "bronze")
    with pytest.raises(FileNotFoundError, match="errors2"):
        L.ingest_all(spark, {"machines": str(source / "machines.csv"), "errors2": str(source / "none.csv")}, root)
    assert not (tmp_path / "bronze").exists()


CONTRACT = TableContract(
    ("machineID", "model", "age"), 1, 3, numeric_columns=("age",), categories={"model": ("model1",)}, unique_columns=("machineID",), machine_count=2
)


def results(df):
    return {r["check_name"]: r["passed"] for r in df.collect()}


def test_contract_on_good_and_broken_rows(spark):
    schema = "machineID string, model string, age string"
    good = check_table("machines", spark.createDataFrame([("1", "model1", "5"), ("2", "model1", "6")], schema), CONTRACT)
    assert all(results(good).values()) and summary(good).first()["passed"]
    bad = spark.createDataFrame([("1", "model7", "old"), ("1", None, "6"), ("M", "model1", "7"), ("-2", "model1", "7")], schema)
    got = results(check_table("machines", bad, CONTRACT))
    assert {n for n, ok in got.items() if not ok} == {
        "row_count", "no_nulls", "machine_id_valid", "numeric:age", "allowed_values:model", "unique:machineID",
    }
    assert results(check_table("machines", bad.drop("age"), CONTRACT)) == {"columns": False}


def test_missing_file_is_one_failed_check(spark, source):
    got = validate_files(spark, {"a": str(source / "machines.csv"), "b": str(source / "no.csv")}, {"a": CONTRACT, "b": CONTRACT})
    rows = {(r["table_name"], r["check_name"]): r["passed"] for r in got.collect()}
    assert rows[("a", "file_exists")] and not rows[("b", "file_exists")]
    assert [k for k in rows if k[0] == "b"] == [("b", "file_exists")]


def test_report_shapes(spark):
    reports = [
        ("raw", {"passed": False, "results": [{"table": "errors", "check": "rows", "passed": False}]}),
        ("gold", {"checks": {"labels": {"passed": True}, "other": {"rows": 1}}}),
        ("silver", {"passed": True, "manifest_check": {"passed": True}, "truth_check": {"status": "skipped"}}),
        ("bronze", {"tables": {"errors": {"passed": True, "rows": 3}}}),
    ]
    df = spark.createDataFrame([(n, json.dumps(r)) for n, r in reports], "layer string, report string")
    got = {(r["layer"], r["check_name"]): r["passed"] for r in report_checks(df).collect()}
    assert got == {
        ("raw", "errors: rows"): False, ("gold", "labels"): True, ("gold", "other"): False,
        ("silver", "manifest_check"): True, ("bronze", "table errors"): True,
    }
