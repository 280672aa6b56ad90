"""op7: URL filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetspark.llm.registry import query, table
from fleetspark.llm.url_filter import judged

RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@query("op7_url_filter")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages").select("page_id", "url"), RULES).select(
        "page_id", "host", "path", "rule", "verdict", "score"
    )
