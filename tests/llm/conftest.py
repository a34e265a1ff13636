from __future__ import annotations

import pytest

from cartmill.llm import common

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def importable(spark):
    common.importable(spark)


@pytest.fixture
def docs(spark):
    """Build a documents table from (doc_id, text) pairs, with a column whose name clashes but for its case."""

    def build(rows):
        data = [(i, t, "en", "s", len(t or ""), "extra") for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, fp string"
        return spark.createDataFrame(data, schema)

    return build
