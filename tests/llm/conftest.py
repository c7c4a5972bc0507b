from __future__ import annotations

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def vocabulary():
    from coursegrain.llm.queries import byte_bpe

    return byte_bpe()


@pytest.fixture
def docs(spark):
    """Documents from ``(doc_id, text)`` with the other columns filled in, and one
    whose name clashes with names used inside."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, _text string, id long, length int"
        full = [(i, t, "en", "src0", len(t or ""), "x", -1, 7) for i, t in rows]
        return spark.createDataFrame(full, schema)

    return make
