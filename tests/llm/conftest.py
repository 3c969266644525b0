"""Helpers of the tests of this package."""

from __future__ import annotations

import pytest

from premia.llm.arrays import prepare


@pytest.fixture(scope="session")
def llm_spark(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def docs_of(llm_spark):
    """A documents table of (doc_id, text) pairs, with the other columns filled in."""

    def build(pairs, source="s"):
        rows = [(i, t, "en", source if isinstance(source, str) else source[n], len(t or "")) for n, (i, t) in enumerate(pairs)]
        return llm_spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    return build
