"""op5: toxicity scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm.registry import query, table
from fleetspark.llm.toxicity import Model, train, with_scores

#: Documents whose crc32 leaves this remainder are held out: nothing is learned from them.
FOLDS, HELD_OUT = 5, 0


def held_out(key: str = "doc_id"):
    return F.crc32(F.col(key).cast("string")) % FOLDS == HELD_OUT


def model(docs: DataFrame, labels: DataFrame) -> Model:
    """The classifier learned from the documents and labels that are not held out."""
    own = docs.where(~held_out()).select(F.col("doc_id").alias("id"), "text")
    labels = labels.where(~held_out() & F.col("toxic").isNotNull()).select(F.col("doc_id").alias("id"), "toxic")
    return train(own, labels.where("toxic = 1").select("id"), labels.select("id"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = with_scores(docs, model(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
