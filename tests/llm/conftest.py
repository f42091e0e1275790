from __future__ import annotations

import pytest


@pytest.fixture()
def documents(spark):
    """A documents table from (doc_id, text) or longer tuples."""

    def make(rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
        width = len(schema.split(","))
        full = [tuple(r) + (None,) * (width - len(r)) for r in rows]
        return spark.createDataFrame(full, schema)

    return make
