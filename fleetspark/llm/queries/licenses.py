"""op3: license scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm.license_rules import duckdb_sql, with_licenses
from fleetspark.llm.registry import query, table


@query("op3_license_scan", duckdb_sql())
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("license_sentences").cast("long").alias("n_known"),
        F.concat_ws("", F.transform("licenses", lambda name: F.concat(F.lit("["), name, F.lit("]")))).alias("licenses"),
        F.concat_ws(",", "unmatched").alias("unmatched"),
    )
