"""op4: similarity join of word shingles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm.registry import query, table
from fleetspark.llm.shingle_join import similar_components

WIDTH = 3
PERCENT = 90


@query("op4_ngram_jaccard")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similar_components(table(spark, sf_dir, "documents"), percent=PERCENT, width=WIDTH)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
