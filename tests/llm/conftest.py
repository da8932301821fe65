from __future__ import annotations

from pathlib import Path

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    """Python workers find the package wherever the tests are started."""
    spark.sparkContext.environment["PYTHONPATH"] = str(Path(__file__).resolve().parents[2])


@pytest.fixture
def documents(spark):
    def make(rows):
        """Rows of (doc_id, text) and, where given, (lang, source)."""
        full = [(r[0], r[1], *(r[2:] or ("en", "src0")), None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)
    return make
