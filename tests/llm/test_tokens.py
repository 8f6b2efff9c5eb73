from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obslake.llm import tokens
from obslake.llm.queries import op9_token_counts
from tests.conftest import SMALL

ODD = st.text(alphabet=st.one_of(st.sampled_from(" \t\n\r\x0b\x1c\x85\xa0 　<|>'sdvtT0123abcABÉéßΣσİıﬁ́­\x00😀"), st.characters(codec="utf-8")), max_size=60)
SPECIAL = st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", " ", "the", "The's", "don't", "\n", "12"]), max_size=12)


@pytest.fixture(scope="module")
def tokenizer():
    return tokens._load(tokens._path(tokens.VOCABULARY))


@pytest.fixture(scope="module")
def counts(tokenizer):
    return tokens.WordCounts(tokenizer, tokens.whole_tokens())


def count(tokenizer, text):
    return len(tokenizer.encode(text, add_special_tokens=False).ids)


@settings(max_examples=500, deadline=None)
@given(text=ODD)
def test_any_text_counts_as_the_tokenizer_counts(tokenizer, counts, text):
    assert counts.of(text) == count(tokenizer, text)


@settings(max_examples=200, deadline=None)
@given(parts=SPECIAL)
def test_special_strings_count_as_the_tokenizer_counts(tokenizer, counts, parts):
    assert counts.of("".join(parts)) == count(tokenizer, "".join(parts))


def test_whole_tokens_are_proved(tokenizer):
    whole = tokens.whole_tokens()
    assert len(whole) > 20_000 and "the" in whole
    assert all(count(tokenizer, w) == 1 for w in list(whole)[:2000])


def test_a_full_memory_starts_anew(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "WORDS_REMEMBERED", 10)
    few = tokens.WordCounts(tokenizer, tokens.whole_tokens())
    text = " ".join(f"word{k}x" for k in range(200))
    assert few.of(text) == count(tokenizer, text) and len(few) <= 10


def test_query_and_awkward_rows(spark, tokenizer, awkward, nothing):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in op9_token_counts(spark, SMALL).collect():
        want = count(tokenizer, docs[r.doc_id] or "")
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (want, len((docs[r.doc_id] or "").encode()), want > 2048)
    for r in awkward.withColumn("n", tokens.token_count(spark, F.col("text"))).collect():
        assert r.n == count(tokenizer, r.text or "")
    assert nothing.withColumn("n", tokens.token_count(spark, F.col("text"))).collect() == []
