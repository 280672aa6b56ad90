from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """A maker of document tables from texts, with ids from 0 and a clashing extra column."""

    def make(texts, start=0):
        rows = [(start + i, t, "x") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")

    return make
