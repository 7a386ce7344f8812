import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer
from tokenizers.models import Unigram

from folioframe.llm import token_counts as T

PATH = public_tokenizers.path("piece_bpe_32k.model")


def library(vocabulary):
    return Tokenizer(Unigram([("<unk>", min((s for _, s in vocabulary), default=0.0)), *vocabulary], unk_id=0))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("abcé▁", min_size=1, max_size=4), st.integers(-6, 0)), max_size=14, unique_by=lambda x: x[0]), st.text("abcdé▁", max_size=14))
def test_ties_as_the_library(vocabulary, text):
    vocabulary = [(p, float(s)) for p, s in vocabulary]
    assert T.Counter(vocabulary).pieces(text) == len(library(vocabulary).encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def real():
    vocabulary = T.load_vocabulary(PATH)
    return T.Counter(vocabulary), library(vocabulary)


def test_real_vocabulary(spark, small, real):
    counter, exact = real
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in T.count_tokens(docs, PATH, cache_words=50).collect()}
    for doc, text in docs.select("doc_id", "text").limit(60).collect():
        words = text.encode().split()
        assert got[doc] == sum(len(exact.encode("▁" + w.decode(), add_special_tokens=False).ids) for w in words)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=30))
def test_any_text(text):
    vocabulary = T.load_vocabulary(PATH)[:2000]
    text = text.encode("utf-8", "replace").decode()
    assert T.Counter(vocabulary).pieces(text) == len(library(vocabulary).encode(text, add_special_tokens=False).ids)


def test_edges(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (None, "word"), (5, "word"), (5, "word")], "doc_id long, text string").selectExpr("*", "1 AS n_tokens")
    got = [(r.doc_id, r.n_tokens) for r in T.count_tokens(df, PATH).collect()]
    assert got[:3] == [(1, 0), (2, 0), (3, 0)] and len({n for _, n in got[3:]}) == 1
    assert T.count_tokens(df.limit(0), PATH).count() == 0
