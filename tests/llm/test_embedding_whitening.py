import math
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from folioframe.llm import embedding_whitening as E
from folioframe.llm.queries import op12_embedding_whitening

number = st.floats(-1e100, 1e100).filter(lambda x: x == 0 or abs(x) > 1e-100)


@settings(max_examples=300, deadline=None)
@given(number, number)
def test_transformations_lose_nothing(a, b):
    s, e = E.two_sum(np.array(a), np.array(b))
    assert Fraction(float(s)) + Fraction(float(e)) == Fraction(a) + Fraction(b) and float(s) == a + b
    p, e = E.two_product(np.array(a), np.array(b))
    assert Fraction(float(p)) + Fraction(float(e)) == Fraction(a) * Fraction(b) and float(p) == a * b


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-(2**52), 2**52), min_size=1, max_size=40))
def test_sums_are_exact(values):
    hi, lo = E.summed(np.array(values, float), np.zeros(len(values)))
    assert int(Fraction(float(hi)) + Fraction(float(lo))) == sum(values)


def exact(vectors):
    """Integers, their number, sums and covariance in rationals."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    y = [[n * r[i] - s[i] for i in range(d)] for r in x]
    return x, n, s, y, [[Fraction(sum(r[i] * r[j] for r in y), n**3) for j in range(d)] for i in range(d)]


def check(rows, vectors, top=32):
    """Rows of one size against rationals: deviation, axes that are eigenvectors, shares, and whitened values."""
    x, n, s, y, v = exact([vectors[k] for k in sorted(vectors)])
    d = len(s)
    matrix = np.array([[float(c) for c in r] for r in v])
    values = np.linalg.eigvalsh(matrix)[::-1][:top]
    at = {k: i for i, k in enumerate(sorted(vectors))}
    w = np.full((n, min(top, d)), np.nan)
    for r in rows:
        assert r.n == n and r.deviation == sum(c * c for c in y[at[r.vec_id]])
        assert abs(r.explained - values[r.component - 1] / np.trace(matrix)) <= 1e-9 * r.explained + 1e-12
        assert 0 <= r.identity_error <= 1e-9
        w[at[r.vec_id], r.component - 1] = np.nan if r.whitened is None else r.whitened
    assert len(rows) == n * min(top, d)
    centred = np.array([[float(Fraction(c, n)) for c in r] for r in y])
    assert np.abs(w.T @ w / n - np.eye(w.shape[1])).max() < 1e-9
    # x - S/n projected on unit vectors: the columns' axes follow from the whitened values themselves.
    axes = centred.T @ w / n / np.sqrt(values)
    assert np.abs(np.linalg.norm(axes, axis=0) - 1).max() < 1e-9
    assert np.abs(matrix @ axes - axes * values).max() < 1e-9 * values[0]


def test_table_against_rationals(spark, small):
    got = op12_embedding_whitening(spark, small).collect()
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()}
    check(got, vectors)


def test_hostile_scale(spark):
    """Spread of some units beside a mean of millions: plain sums of squares would keep few digits."""
    r = np.random.default_rng(3)
    vectors = {i: [float(np.float32(1e6 + c)) for c in r.normal(0, 0.5, 5)] for i in range(300)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>").repartition(7)
    check(E.whiten(df).collect(), vectors)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(1, None), (2, [1.0, nan]), (3, [1.0, None]), (4, [inf, 1.0]), (5, []), (6, [1e300, 0.0])]
    kind = "vec_id long, embedding array<double>, size int, v array<int>, n string"
    frame = lambda rows: spark.createDataFrame([(*x, 9, [1], "n") for x in rows], kind)
    assert E.whiten(frame(odd)).count() == 0 == E.whiten(frame([])).count()
    r = np.random.default_rng(1)
    flat = {i: [float(c), 2.0, float(d)] for i, (c, d) in enumerate(r.normal(0, 3, (40, 2)))}
    other = [(100, [5.0]), (101, [5.0]), (None, [5.0])]  # a size of its own, without variance, with a repeated row and a null id
    got = E.whiten(frame(odd + list(flat.items()) + other)).collect()
    one = [x for x in got if x.vec_id is None or x.vec_id >= 100]
    assert len(one) == 3 and all(x.whitened is None and x.deviation == 0 and x.n == 3 and x.explained is None and x.identity_error == 0 for x in one)
    rest = [x for x in got if x.vec_id is not None and x.vec_id < 100]
    assert len(rest) == 120 and all((x.whitened is None) == (x.component == 3) for x in rest)
    alone = E.whiten(frame([(7, [0.25, -0.5])])).collect()
    assert [(x.component, x.n, x.deviation, x.whitened) for x in sorted(alone, key=lambda x: x.component)] == [(1, 1, 0, None), (2, 1, 0, None)]


def test_deviation_beyond_64_bits():
    m = E.Whitening(E.Mean(10**6, [Fraction(10**12)]), np.eye(1), np.ones(1), 1.0)
    assert m.deviations(np.array([[2e6], [1e6 + 1], [2.0**40]])) == [10**24 if 10**24 < 2**63 else None, 10**12, None]
