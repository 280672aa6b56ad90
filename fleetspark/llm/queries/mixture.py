"""op2: mixing sources to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm.mixing import schedule
from fleetspark.llm.registry import query, table


@query("op2_mixture")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return schedule(docs).select(F.col("id").alias("doc_id"), "source", "n_words", "weight", "pass", "block", "order")
