from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, start string, spans int"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text[, source]) as a table with columns whose names clash with results."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or ""), "x", 1) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make
