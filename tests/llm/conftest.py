from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, t_row string, words string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with extra columns whose names the operators use inside."""
    def make(*rows, parts: int = 3):
        full = [(i, t, "en", "s", None if t is None else len(t), "x", "y") for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return make
