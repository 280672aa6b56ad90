"""op6: byte-level BPE there and back."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm.bpe_transducer import encode_decode
from fleetspark.llm.registry import query, table

RANKS = "byte_bpe_multi_50k.tiktoken"


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded bytes of every row of ``docs``."""
    coded = encode_decode(docs.select("doc_id", "text"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op6_byte_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))
