from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()


def test_every_statement_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() == 4 and "ok_pct" in df.columns


@pytest.mark.parametrize("name", ["d7_clean", "k3_labels", "k7_kpi_line_monthly", "k30_sensors_before_failure", "m6_evaluate", "c10_drop_reasons"])
def test_engine_and_sql_agree(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{SF}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    df = entry.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    key = lambda row: tuple("" if v is None else str(v) for v in row)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    plain = lambda row: tuple(str(v) if hasattr(v, "isoformat") else v for v in row)
    for a, b in zip(sorted(got, key=key), sorted(expected, key=key), strict=True):
        assert plain(a) == pytest.approx(plain(b))
