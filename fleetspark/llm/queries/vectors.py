"""op9: near-duplicate embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm.registry import query, table
from fleetspark.llm.vector_graph import near_duplicates

COSINE = 0.93


@query("op9_vector_graph")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "embeddings"), COSINE)
    return found.select(
        F.col("id").alias("vec_id"), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept")
    )
