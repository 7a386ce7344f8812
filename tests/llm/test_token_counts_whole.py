import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer
from tokenizers.models import Unigram

from folioframe.llm import queries
from folioframe.llm import token_counts as T

PATH = public_tokenizers.path("piece_bpe_32k.model")
ETHIOPIC = "\u1230\u120b\u121d" * 2


def library(vocabulary):
    pieces = [(f"<0x{i:02X}>", 0.0) for i in range(256)]
    return Tokenizer(Unigram([("<unk>", min((s for _, s in vocabulary), default=0.0)), *pieces, *vocabulary], unk_id=0, byte_fallback=True))


def expected(exact, text):
    return len(exact.encode("▁" + text.replace(" ", "▁"), add_special_tokens=False).ids) if text else 0


@pytest.fixture(scope="module")
def real():
    vocabulary = T.load_vocabulary(PATH)
    return T.Counter(vocabulary, 50, byte_fallback=True), library(vocabulary)


def test_query_on_whole_texts(spark, small, real):
    got = {r.doc_id: r.n_tokens for r in queries.op8_token_counts(spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert any("\n" in t for _, t in docs) and len(got) == len(docs)
    assert all(got[doc] == expected(real[1], text) for doc, text in docs)


def test_line_breaks_blanks_and_bytes(spark):
    texts = ["a\n\n b   " + ETHIOPIC, "\n", "   ", "a  b ", "\ta\r\n", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in T.count_tokens(df, PATH, whole=True).collect()}
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert [got[i] for i in range(len(texts))] == [len(sp.encode(t or "")) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=30), st.text("ab \n\t\r▁é\u1230梦;{", max_size=30)))
def test_any_whole_text(real, text):
    text = text.encode("utf-8", "replace").decode()
    assert real[0].count_whole(text.encode()) == expected(real[1], text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("ab\n▁", min_size=1, max_size=4), st.integers(-6, 0)), max_size=14, unique_by=lambda x: x[0]), st.text("abé \n▁", max_size=14))
def test_pieces_across_chunks(vocabulary, text):
    vocabulary = [(p, float(s)) for p, s in vocabulary]
    assert T.Counter(vocabulary, byte_fallback=True).count_whole(text.encode()) == expected(library(vocabulary), text)
