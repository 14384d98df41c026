import os

import pytest

from panelyard.llm.frames import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def docs(spark):
    """Builds a documents table from (doc_id, text) pairs or (doc_id, text, lang, source) rows."""
    def build(rows):
        full = [tuple(r) + ("en", "src0")[len(r) - 2:] if len(r) < 4 else tuple(r) for r in rows]
        full = [r + (None if r[1] is None else len(r[1]),) for r in full]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long")
    return build


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
