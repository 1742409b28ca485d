from __future__ import annotations

import pytest

from benelake.llm.tables import importable

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(autouse=True)
def workers(spark):
    importable(spark)


@pytest.fixture
def docs(spark):
    """A table of documents from (doc_id, text) or longer rows."""

    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame([tuple(r) for r in rows], schema)

    return make
