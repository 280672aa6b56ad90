"""op12: token ids in flat binary files, and back."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fleetspark.functions.staging import shared_dir
from fleetspark.llm.registry import query, table
from fleetspark.llm.token_files import read_token_files, write_token_files

TOKENIZER = "word_bpe_49k.json"
END = 1


@query("op12_token_files")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(TOKENIZER), END)
    return read_token_files(spark, folder)
