from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, id string, bucket int, size int"


@pytest.fixture(scope="session")
def documents(spark):
    """Make a documents frame from (doc_id, text, lang, source) rows, with columns whose names may clash."""

    def make(rows):
        full = [(*r, *[None] * (4 - len(r)), len(r[1] or ""), False, "x", 1, 2) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


