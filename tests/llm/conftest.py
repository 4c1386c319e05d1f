from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (id, text) pairs, with extra columns whose names clash with inner ones."""

    def make(rows, lang="en", source="s"):
        full = [(i, t, lang, source, None if t is None else len(t), "x", "y", 1) for i, t in rows]
        schema = f"{DOCS}, _id string, key string, _text long"
        return spark.createDataFrame(full, schema)

    return make
