import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioframe.llm import ngram_join as N
from folioframe.llm.textsets import shingles, word_hashes


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def brute(docs):
    sets = {d: shingle_set(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    for d, s in sets.items():
        for o in {o for x in s for o in where[x]}:
            both = len(s & sets[o])
            if o < d and 100 * both >= 80 * (len(s) + len(sets[o]) - both):
                a, b = sorted((find(o), find(d)))
                root[b] = a
    return {d: (len(s), find(d)) for d, s in sets.items()}


def mutated(r, words, n):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = f"m{r.randrange(10**6)}"
    return " ".join(words)


def corpus(seed, families=12, members=8):
    r = random.Random(seed)
    docs = []
    shared = [f"s{r.randrange(500)}" for _ in range(60)]
    for f in range(families):
        base = [f"w{r.randrange(5000)}" for _ in range(r.choice([4, 5, 7, 12, 30, 90, 300]))]
        if f % 3 == 0:
            base[1:1] = shared
        for _ in range(members):
            docs.append(mutated(r, base, r.choice([0, 0, 1, 1, 2, 3, len(base) // 25])))
    r.shuffle(docs)
    return [(i * 3 + 1, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed, monkeypatch):
    monkeypatch.setattr(N, "TILE", 3)
    monkeypatch.setattr(N, "GROUP_TILE", 2)
    monkeypatch.setattr(N, "FAN", 2)
    docs = corpus(seed) + [(10_000, None), (10_001, ""), (10_002, " \n"), (10_003, "A b"), (10_004, "a B"), (10_005, "b a")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS h", "1 AS n")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.components(df).collect()}
    assert got == brute(docs)


def test_sets_whose_first_hashes_agree(spark):
    docs = corpus(5, families=6)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.components(spark.createDataFrame(docs, "doc_id long, text string"), class_bits=3).collect()}
    assert got == brute(docs)


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.components(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute(docs)


def test_common_passages_and_long_texts(spark):
    """Documents that share most of their words with all others, and two very long ones that differ in a tenth."""
    r = random.Random(3)
    passage = [f"p{i}" for i in range(60)]
    docs = [(i, " ".join(passage + [f"o{r.randrange(10**6)}" for _ in range(r.choice([8, 12, 20, 40]))])) for i in range(120)]
    long = [f"l{i}" for i in range(60_000)]
    docs += [(500, " ".join(long)), (501, " ".join(long[:54_000])), (502, " ".join(long[:44_000]))]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in N.components(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute(docs)


def test_keep_one_carries_any_column(spark):
    rows = [(2, "a b c d e f g", 7, {"x": 1}), (1, "A b c d e f g", 8, None), (3, "other words", None, {"y": 2})]
    df = spark.createDataFrame(rows, "doc_id long, text string, _jid long, _kid map<string,int>").selectExpr("*", "1 AS _id", "2 AS _th", "3 AS h", "true AS first")
    got = sorted((r.doc_id, r._jid, r._kid, r.first) for r in N.keep_one(df).collect())
    assert got == [(1, 8, None, True), (3, None, {"y": 2}, True)]


def test_stars_and_forests():
    a, b = N._stars(np.array([4, 4, 2, 2, 2, 9]), np.array([5, 3, 8, 8, 1, 0]))
    assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == [(1, 8), (3, 5)]


def test_large_family(spark):
    """A group in which single pairs fail though neighbours link: the chain must hold together."""
    words = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join(words[i * 4 : i * 4 + 80])) for i in range(20)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.components(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute(docs) and len({c for _, c in got.values()}) == 1


@settings(max_examples=300, deadline=None)
@given(st.integers(4, 400), st.integers(0, 2**31), st.floats(0, 0.25))
def test_similar_sets_share_a_signature(size, seed, share):
    r = np.random.default_rng(seed)
    a = np.unique(r.integers(0, 2**64, size, dtype=np.uint64))
    drop, add = r.integers(0, int(share * len(a)) + 1, 2)
    b = np.unique(np.concatenate([r.permutation(a)[drop:], r.integers(0, 2**64, add, dtype=np.uint64)]))
    both = len(np.intersect1d(a, b))
    if 100 * both >= 80 * (len(a) + len(b) - both) and len(a) != both:
        assert np.intersect1d(N.signatures(a), N.signatures(b)).size


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 300), st.integers(1, 300), st.integers(0, 2**31))
def test_sketches_never_exceed_the_distance(n, m, seed):
    r = np.random.default_rng(seed)
    a, b = (np.unique(r.integers(0, 500, k).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for k in (n, m))
    x, y = (np.frombuffer(N.sketch(s), np.uint8) for s in (a, b))
    size = min(len(x), len(y))
    assert np.bitwise_count(N._fold(x, size) ^ N._fold(y, size)).sum() <= len(np.setxor1d(a, b))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 5)), max_size=40), st.integers(1, 6))
def test_members_over_batches(rows, size):
    import pyarrow as pa

    class Task:
        def partitionId(self):
            return 0

    N.TaskContext, kept = type("T", (), {"get": staticmethod(Task)}), N.TaskContext
    try:
        rows = sorted(rows)
        cut = [rows[i : i + size] for i in range(0, len(rows), size)]
        batches = [pa.RecordBatch.from_arrays([pa.array([r[k] for r in c], pa.int64()) for k in (0, 1)], names=["sig", "h"]) for c in cut]
        got = [tuple(r.values()) for b in N._members(iter(batches)) for r in b.to_pylist()]
    finally:
        N.TaskContext = kept
    groups = defaultdict(set)
    for s, h in rows:
        groups[s].add(h)
    by = defaultdict(set)
    for bucket, h in got:
        by[bucket].add(h)
    assert sorted(map(sorted, by.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_words():
    assert len(word_hashes(b"One two\tthree\x0bfour\x1cfive")) == 4
    assert (word_hashes("ÄB".encode()) == word_hashes("Äb".encode())).all()
    assert len(shingles(b"a b c d e f", 5)) == 2
    assert len(shingles(b"", 5)) == 0


def test_odd_rows(spark):
    rows = [(None, "a b c d e f g h"), (None, "a b c d e f g h"), (5, "a b c d e f g h"), (5, "quite other words stand here now ok"), (5, "a b c d e f g h"), (6, None), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in N.components(df).collect())
    assert got == [(0, 4, 5), (0, 4, 5), (5, 3, 5), (5, 4, 5), (5, 4, 5), (6, 0, 6), (6, 0, 6)]
    kept = sorted((r.doc_id, r.text or "") for r in N.keep_one(df).collect())
    assert kept == [(5, "a b c d e f g h"), (5, "quite other words stand here now ok"), (6, "")]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert N.components(empty).count() == 0 and N.keep_one(empty).count() == 0
