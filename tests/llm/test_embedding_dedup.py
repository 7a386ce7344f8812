import numpy as np
import pytest
from pyspark.sql import functions as F

from folioframe.llm import embedding_dedup as E


def brute(ids, vectors, cosine=0.9):
    ok = {}
    for i, v in zip(ids, vectors, strict=True):
        if v and None not in v and np.isfinite(v).all() and np.any(v):
            a = np.array(v, float)
            ok[i] = a / np.linalg.norm(a)
    root = {i: i for i in ids}
    links = dict.fromkeys(ids, 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in ok:
        for j in ok:
            if i != j and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= cosine:
                links[i] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (links[i], find(i), find(i) == i) for i in ids}


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(E, "TILE", 16)
    r = np.random.default_rng(3)
    base = r.normal(size=(150, 64))
    near = [b + r.normal(size=64) * s for b in base[:20] for s in (0.05, 0.1, 0.2, 0.3)]
    group = [base[0] + r.normal(size=64) * 0.05 for _ in range(60)]
    rows = [list(map(float, v)) for v in [*base, *near, *group, base[5], base[5], base[6] * 2]]
    rows += [None, [], [0.0] * 64, [None, *[1.0] * 63], [float("nan"), *[1.0] * 63], [float("inf"), *[1.0] * 63], [1.0, 2.0], [1.0, 2.1]]
    ids = [int(x) for x in r.permutation(len(rows)) + 5]
    df = spark.createDataFrame(list(zip(ids, rows, strict=True)), "vec_id long, embedding array<double>").withColumn("kept", F.lit("x"))
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in E.near_duplicates(df).collect()}
    want = brute(ids, rows)
    found, there = sum(n for n, *_ in got.values()), sum(n for n, *_ in want.values())
    assert set(got) == set(want) and 0.97 * there <= found <= there
    clear = [i for i, v in zip(ids, rows, strict=True) if not want[i][0]]
    assert all(got[i] == want[i] for i in clear)


def test_repeats_and_empty(spark):
    df = spark.createDataFrame([(3, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [1.0, 0.01]), (None, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = sorted((x.vec_id or 0, x.n_links, x.component_id, x.kept) for x in E.near_duplicates(df).collect())
    assert got == [(0, 0, None, True), (3, 2, 3, True), (3, 2, 3, True), (4, 2, 3, False)]
    assert E.near_duplicates(df.limit(0)).count() == 0


def test_codes_follow_the_angle():
    r = np.random.default_rng(1)
    v = r.normal(size=(500, 64))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    codes = E.Codes(v)(v)
    d = E.distances(codes, codes)[np.triu_indices(500, 1)]
    a = np.arccos(np.clip(v @ v.T, -1, 1))[np.triu_indices(500, 1)]
    assert np.corrcoef(d, a)[0, 1] > 0.7


@pytest.mark.parametrize("size", [64, 256, 768])
def test_pairs_just_above_the_threshold(spark, size):
    """Recall of pairs whose cosine lies between 0.90 and 0.92, among unrelated vectors."""
    r = np.random.default_rng(size)
    a = r.normal(size=(300, size))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    other = r.normal(size=(300, size))
    other -= (other * a).sum(axis=1, keepdims=True) * a
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cosine = r.uniform(0.901, 0.92, size=(300, 1))
    b = cosine * a + np.sqrt(1 - cosine**2) * other
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([a, b]))]
    got = {x.vec_id: x for x in E.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    found = sum(got[300 + i].component_id == i for i in range(300))
    assert found >= 0.97 * 300
    assert all(x.n_links == 0 or x.n_links == 1 for x in got.values())


def test_substrings():
    r = np.random.default_rng(4)
    codes = E.Codes(r.normal(size=(100, 12)), width=13, tables=11)
    v = r.normal(size=(50, 12))
    on = v @ codes.axes >= 0
    assert codes.words == 3 and codes.axes.shape == (12, 143)
    for t in range(11):
        assert (codes.substring(codes(v), t) == (on[:, 13 * t : 13 * t + 13] << np.arange(13)).sum(axis=1).astype(np.uint64)).all()
    assert (E.distances(codes(v), codes(v[:9])) == (on[:, None] ^ on[None, :9]).sum(axis=2)).all()


def test_comparisons_a_vector_stay_bounded():
    """Unrelated vectors that share a bucket or a neighbouring one, from 10 to 80 thousand: eight times the vectors, about the same for each."""
    r, each = np.random.default_rng(9), {}
    for n in (10_000, 80_000):
        v = r.normal(size=(n, 64))
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        codes = E.Codes(v[:4096], *E.plan(n), rounds=5)
        words, met = codes(v), 0
        for t in range(codes.tables):
            size = np.bincount(codes.substring(words, t).astype(np.int64), minlength=1 << codes.width)
            near = size + sum(size[np.arange(len(size)) ^ (1 << bit)] for bit in range(codes.width))
            met += int((size * near).sum())
        each[n] = met / n
    # Tables and bits grow with the logarithm: twice as many buckets a vector.
    assert each[80_000] < 2.5 * each[10_000] and each[80_000] < 1500


def test_plan_finds_its_share():
    for n in (100, 10_000, 10**6, 10**9):
        bits, tables = E.plan(n)
        p = np.arccos(0.9) / np.pi
        found = 1 - (1 - (1 - p) ** bits - bits * p * (1 - p) ** (bits - 1)) ** tables
        assert found >= E.SHARE and bits <= E.WIDEST and tables < 60
    assert E.plan(1000, cosine=1.0)[1] == 1
