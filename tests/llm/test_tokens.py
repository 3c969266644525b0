"""Token counts against direct encoding, with documents across block edges."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from premia.llm.tokens import END, HEADER, VOCABULARY, _encoding, count_tokens, header, read_vocabulary, search_block, token_counts, write_tokens


def cases():
    random.seed(6)
    pairs = [(i, " ".join(random.choice(["token", "été", "12", "<|endoftext|>", "\n", "x"]) for _ in range(random.randrange(80)))) for i in range(60)]
    return pairs + [(None, "no id"), (None, None), (70, ""), (70, None), (71, "same"), (71, "same"), (-5, "negative"), (2**62, "large"), (72, "long " * 30_000), (73, "y" * 50_000)]


@pytest.mark.parametrize("block_bytes", [1 << 18, 2, 10, 14])
def test_equals_direct_encoding(llm_spark, tmp_path, block_bytes):
    vocabulary = read_vocabulary(VOCABULARY)
    pairs = cases() if block_bytes > 10 else [p for p in cases() if len(p[1] or "") < 400]
    docs = llm_spark.createDataFrame(pairs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("n_tokens", "path", "block")})
    write_tokens(docs.coalesce(2), str(tmp_path / "t"), vocabulary)
    encode = _encoding(vocabulary).encode_ordinary
    expected = sorted(((i, len(encode(t or ""))) for i, t in pairs), key=str)
    assert sorted(map(tuple, count_tokens(llm_spark, str(tmp_path / "t"), block_bytes).collect()), key=str) == expected


def test_files_are_flat(llm_spark, tmp_path):
    vocabulary = read_vocabulary(VOCABULARY)
    write_tokens(llm_spark.createDataFrame([(9, "a b"), (8, "c")], "doc_id long, text string").coalesce(1), str(tmp_path / "t"), vocabulary)
    words = np.frombuffer(next((tmp_path / "t").glob("part-*")).read_bytes(), "<u2").tolist()
    encode = _encoding(vocabulary).encode_ordinary
    assert words == header(9) + encode("a b") + [END] + header(8) + encode("c") + [END]


def test_block_without_separator():
    found = search_block(np.arange(20, dtype=np.uint16))
    assert (found["seps"], found["head"], found["tail"], found["inner"]) == (0, 20, 0, []) and len(found["head_words"]) == HEADER


def test_empty_table(llm_spark, tmp_path):
    docs = llm_spark.createDataFrame([], "doc_id long, text string")
    assert token_counts(docs, str(tmp_path / "t"), read_vocabulary(VOCABULARY)).count() == 0
