"""op1: quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.functions.staging import stage
from fleetspark.llm.quality_rules import Rule, base_failed, decide, features, learn, with_statistics
from fleetspark.llm.registry import query, table


def rules(statistics: DataFrame, labels: DataFrame) -> list[Rule]:
    """The decision list for labelled documents that pass the fixed rules."""
    labels = labels.select("doc_id", (F.col("quality") == 0).alias("bad"))
    return learn(statistics.where(~base_failed()).join(labels, "doc_id"), "doc_id", F.col("bad"))


@query("op1_quality_rules")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = stage(with_statistics(docs).drop("text"), "statistics")
    rejected = decide(rules(measured, table(spark, sf_dir, "labels")), features())
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & rejected.isNull()).alias("kept"),
        F.when(~base_failed(), rejected).alias("rule"),
    )
