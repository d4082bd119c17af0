"""Token counts against the tokeniser itself, text by text."""

from __future__ import annotations

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallylog.llm.queries import QUERIES
from tallylog.llm.token_counts import token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " \t\r\n\x0b\x0c", "Don't STOP, it's 1234!! we'll've", "a<|endoftext|>B <|startoftext|><|EndOfText|> <| endoftext|>",
    "J̌ J̌ab H̱ T̈ W̊ Y̊ éÉ", "café STRASSE Straße İstanbul ǅ", "́ a ́b c d\u0085e​f﻿g",
    "你好世界 ΑΒΣ 가가 \U0001f600\U0001f468‍\U0001f469", "\x00\x01\x7f a\x1fb c\x1cd", "'sa ''s 'til ' '' 's's 're9", "x" * 30_000, "word " * 20_000,
    "½²Ⅷ ٣٤ ﬁ ẞ", "https://a.bc/d?e=f&g=h#i_j-k",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def expected(tokenizer, key, text):
    n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
    return key, len((text or "").encode()), n, n > 2048


@pytest.mark.parametrize("block_bytes", [1, 200, 1 << 23])
def test_counts_equal_the_library(spark, tokenizer, block_bytes):
    rows = [(k, text, "x", "y") for k, text in enumerate(TEXTS)] + [(None, "no key", "", ""), (3, TEXTS[3], "", ""), (3, "other", "", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, block string, tokens string").repartition(3)
    found = token_counts(docs, PATH, block_bytes=block_bytes)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted((expected(tokenizer, k, t) for k, t, _, _ in rows), key=repr)


def test_empty_table(spark):
    assert token_counts(spark.createDataFrame([], "doc_id string, text string"), PATH).collect() == []


def test_query_over_a_whole_table(spark, tokenizer):
    folder = "/root/testdata/sf0.01"
    found = sorted(map(tuple, QUERIES["op12_token_counts"](spark, folder).collect()))
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert found == sorted(expected(tokenizer, d.doc_id, d.text) for d in docs)
