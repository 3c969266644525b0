"""Registered queries of this package against their oracle SQL, or for their columns where SQL has none."""

from __future__ import annotations

import pytest
from check_queries import duck
from check_queries import canonical as rows_of

from premia.llm.queries import ORACLES, QUERIES

COLUMNS = {
    "op1_quality": ["doc_id", "source", "lang", "evidence", "site_prior", "section_posterior", "quality", "kept"],
    "op6_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op7_repeats": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op8_token_counts": ["doc_id", "n_tokens"],
    "op10_simhash": ["doc_id", "fingerprint", "component_id"],
}


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) | set(COLUMNS) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(llm_spark, small, name):
    ours = QUERIES[name](llm_spark, small).toPandas()
    theirs = duck(small).execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows_of(ours) == rows_of(theirs)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_whole_table(llm_spark, small, name):
    rows = QUERIES[name](llm_spark, small)
    assert rows.columns == COLUMNS[name]
    assert rows.count() == llm_spark.read.parquet(f"{small}/documents.parquet").count()
