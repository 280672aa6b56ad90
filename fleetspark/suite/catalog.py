"""Importing this module registers every query."""

from fleetspark.suite import (  # noqa: F401
    blocks,
    checking,
    ingest,
    judging,
    landing,
    layers,
    learning,
    operators,
    warehouse,
)
from fleetspark.suite.registry import ORACLES, QUERIES, with_blocks

__all__ = ["ORACLES", "QUERIES", "with_blocks"]
