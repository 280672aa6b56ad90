"""A training-data pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows of its predecessor and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``docs``. Null and empty texts go in the first stage, as texts of too few
words; tables without rows pass through.

SQL cannot express the learned stages, so there is no SQL of the result; tests hold it against
plain Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.functions.staging import stage
from fleetspark.llm.mixing import mixed
from fleetspark.llm.quality_rules import passing, with_statistics
from fleetspark.llm.queries import bpe, quality, toxic
from fleetspark.llm.registry import table
from fleetspark.llm.shingle_join import similar_components
from fleetspark.llm.toxicity import with_scores

#: Near copies share this share of their five-word shingles.
WIDTH, PERCENT = 5, 80


#: Columns that stages read; all others only pass through.
READ = ("doc_id", "text", "source")


def _plain(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns that no stage reads under names that no stage adds."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in READ else f"_{i}") for i, c in enumerate(docs.columns)])


def _named(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    return df.select(*[F.col(c if c in READ else f"_{i}").alias(c) for i, c in enumerate(docs.columns)])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no fixed or learned rule rejects."""
    measured = stage(with_statistics(docs.select("doc_id", "text")).drop("text"), "statistics")
    rules = quality.rules(measured, table(spark, sf_dir, "labels"))
    return _named(passing(_plain(docs), rules), docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of being toxic is below one half."""
    model = toxic.model(docs, table(spark, sf_dir, "labels"))
    return _named(with_scores(_plain(docs), model).where("score < 0.5"), docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each group of near copies; rows without an id stay."""
    groups = similar_components(docs, percent=PERCENT, width=WIDTH)
    copies = groups.where("component_id <> id").select(F.col("id").alias("doc_id")).distinct()
    return _named(_plain(docs).join(copies, "doc_id", "left_anti"), docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source is passed at the target weights; none is lost."""
    return _named(mixed(_plain(docs)), docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes."""
    return bpe.digest(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity),
    ("n-gram Jaccard join", ngram_jaccard),
    ("mixing sources to target weights", mixture),
    ("byte-level BPE encoding and decoding", byte_bpe),
]

#: The learned stages cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
