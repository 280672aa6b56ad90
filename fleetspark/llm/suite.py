"""Importing this module registers every query of the subpackage."""

import corpus_pipeline
from fleetspark.llm.queries import (  # noqa: F401
    bpe,
    conversations,
    counts,
    html,
    licenses,
    mixture,
    quality,
    runs,
    shingles,
    token_ids,
    toxic,
    urls,
    vectors,
)
from fleetspark.llm.registry import ORACLES, QUERIES, query

query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)

__all__ = ["ORACLES", "QUERIES"]
