import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from folioframe.llm import quality_classifier as C
from folioframe.llm.queries import op10_quality_classifier


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 2**31), st.integers(1, 30))
def test_sum_of_squares_identity(seed, n):
    r = np.random.default_rng(seed)
    m = C.Model(0.3, r.normal(size=64), r.normal(size=(64, 5)), 5)
    idx, x = r.choice(64, n, replace=False), r.normal(size=n)
    pairs = sum(m.factors[idx[i]] @ m.factors[idx[j]] * x[i] * x[j] for i in range(n) for j in range(i))
    assert np.isclose(m.logit(idx, x), 0.3 + m.linear[idx] @ x + pairs)


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    got = op10_quality_classifier(spark, d)
    rows = got.join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    assert got.count() == spark.read.parquet(f"{d}/documents.parquet").count()


def test_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a " * 50_000), (None, "x"), (2, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, quality int")
    rows = C.score(docs, C.learn(docs, labels)).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert C.score(docs.limit(0), C.learn(docs, labels.limit(0))).count() == 0
    model = C.fit([(*C.features(b"good words here" * k), 1) for k in range(1, 6)] + [(*C.features(b"### $$$" * k), 0) for k in range(1, 6)])
    assert model.score(b"good words here") > 0.5 > model.score(b"### $$$")
    again = C.fit([(*C.features(b"good words here" * k), 1) for k in range(1, 6)] + [(*C.features(b"### $$$" * k), 0) for k in range(1, 6)])
    assert (again.factors == model.factors).all()
