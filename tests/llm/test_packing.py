import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from folioframe.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY, ENCODE = Tokenizer.from_file(PATH), packing.load_encoder(PATH)


@pytest.fixture(scope="module")
def exact():
    t = Tokenizer.from_file(PATH)
    return lambda x: t.encode(x, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text())
def test_ids_equal_the_library(text):
    text = text.encode("utf-8", "replace").decode()
    assert ENCODE(text) == LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["<|endoftext|> x", "a<|endoftext|><|endoftext|>\n b", " " * 25_000 + "x" + "\n" * 30_000, "I'll they're DON'T  \n\n x", "   ", "日本語 ñandú 12345"])
def test_special_texts(exact, text):
    assert packing.load_encoder(PATH)(text) == exact(text)


def check(docs, rows, exact):
    ids = {d: [*exact(t or ""), 0] for d, t in docs}
    seen, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.doc_tokens == len(ids[r.doc_id])
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        seen[r.doc_id].append((r.start, r.length))
        windows[r.sequence_id].append((r.offset, r.length))
    for d, parts in seen.items():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == len(ids[d])
    assert set(seen) == set(ids)
    for parts in windows.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024 and at & (at - 1) == 0


def test_pack(spark, small, exact):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    rows = packing.pack(spark.read.parquet(f"{small}/documents.parquet"), PATH).collect()
    check(docs, rows, exact)
    full_groups(rows)


def full_groups(rows):
    """All step groups of a task but one hold the same number of tokens."""
    groups = defaultdict(set)
    for r in rows:
        groups[r.step_group].add((r.sequence_id, r.tier))
    short = [k >> 36 for k, g in groups.items() if sum(t for _, t in g) != packing.STEP_TOKENS]
    assert len(short) == len(set(short))
    assert all(sum(t for _, t in g) <= packing.STEP_TOKENS for g in groups.values())


def test_groups_of_several_tasks(spark, small):
    full_groups(packing.pack(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(4), PATH).collect())


@pytest.mark.parametrize("blank", [" ", "\n"])
def test_long_blank_runs(spark, blank):
    docs = [(1, "a" + blank * 2_000_000 + "b"), (2, "c")]
    rows = packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), PATH).collect()
    t = Tokenizer.from_file(PATH)
    check(docs, rows, lambda x: t.encode(x, add_special_tokens=False).ids)


def test_edges(spark, exact):
    docs = [(1, None), (2, ""), (3, "word " * 30_000), (4, "a"), (5, "a")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS tier", "'x' AS length")
    check(docs, packing.pack(df, PATH, buffer=2).collect(), exact)
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
    assert [r.doc_id for r in packing.pack(spark.createDataFrame([(None, "x")], "doc_id long, text string"), PATH).collect()] == [None]
    with pytest.raises(ValueError):
        packing.pack(df, PATH, tiers=(1000, 10))
