"""op10: token counts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm.registry import query, table
from fleetspark.llm.token_counts import with_token_counts

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = with_token_counts(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > LIMIT).alias("over_limit"),
    )
