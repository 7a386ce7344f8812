from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioframe.llm import language_mixture as L
from folioframe.llm.queries import op13_language_mixture


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60), st.integers(1, 20))
def test_slices_change_nothing(text, size):
    text = text.lower()  # lower-casing may look at neighbours
    whole = np.concatenate([np.zeros(0, np.int64), *L.trigrams(text)])
    before, L.SLICE = L.SLICE, size
    try:
        cut = np.concatenate([np.zeros(0, np.int64), *L.trigrams(text)])
    finally:
        L.SLICE = before
    assert (whole == cut).all() and bool(len(whole)) == any(c.isalpha() for c in text)


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    got = op13_language_mixture(spark, d)
    assert got.count() == docs.count()
    rows = got.join(docs, "doc_id").where("held_out and lang is not null").collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.98 * len(rows) > 0
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.fixture(scope="module")
def model():
    r = np.random.default_rng(2)
    counts = r.integers(0, 4, (4, 1 << 10)) * r.integers(0, 2, (4, 1 << 10)) * 50
    return L.Languages.of(list("abcd"), counts, 10)


def likelihood(p, rounds=3000):
    theta = np.full(p.shape[1], 1 / p.shape[1])
    for _ in range(rounds):
        theta = theta * (p / (p @ theta)[:, None]).mean(axis=0)
    return float(np.log(p @ theta).sum()), theta


@pytest.mark.parametrize("shares", [(1, 0, 0, 0), (0.5, 0.5, 0, 0), (0.2, 0.8, 0, 0), (0.4, 0.3, 0.3, 0), (0, 0.05, 0, 0.95)])
def test_mixture_against_all_subsets(model, shares, monkeypatch):
    """Greedy choice by slopes against every subset of languages, each fitted by long EM."""
    r = np.random.default_rng(7)
    draws = np.concatenate([r.choice(1 << 10, int(3000 * s), p=model.p[:, i] / model.p[:, i].sum()) for i, s in enumerate(shares)])
    monkeypatch.setattr(L, "trigrams", lambda text, bits: iter([draws]))
    penalty = L.OVERLAP * (0.5 * np.log(len(draws) + 1) + np.log(4))
    sets = [s for k in range(1, 5) for s in combinations(range(4), k)]
    fitted = {s: likelihood(model.p[draws][:, s]) for s in sets}
    best = max(sets, key=lambda s: fitted[s][0] - penalty * (len(s) - 1))
    got = model.mixture("whatever")
    assert {x for x, _ in got} == {"abcd"[i] for i in best}
    want = dict(zip(("abcd"[i] for i in best), fitted[best][1], strict=True))
    assert all(abs(want[x] - s) < 0.01 for x, s in got) and abs(sum(s for _, s in got) - 1) < 1e-9


def test_two_languages_in_one_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    m = L.learn(docs)
    texts = {r.lang: r.text for r in docs.where("n_chars between 1500 and 3000").orderBy("doc_id").collect()}
    got = dict(m.mixture(texts["en"][:1400] + "\n" + texts["de"][:700]))
    assert set(got) == {"en", "de"} and 0.55 < got["en"] < 0.8


def test_counts_weigh_as_positions(model, monkeypatch):
    r = np.random.default_rng(1)
    draws = r.choice(1 << 10, 5000, p=model.p[:, :2].mean(axis=1) / model.p[:, :2].mean(axis=1).sum())
    monkeypatch.setattr(L, "trigrams", lambda text, bits: iter([draws]))
    one = model.mixture("x")
    monkeypatch.setattr(L, "trigrams", lambda text, bits: iter([draws[:2000], draws[2000:]]))
    assert [x for x, _ in one] == [x for x, _ in model.mixture("x")] and np.allclose([s for _, s in one], [s for _, s in model.mixture("x")])


def test_edges(spark):
    kind = "doc_id long, text string, lang string, score double, languages string"
    rows = [(1, "alpha beta gamma " * 30, "x"), (1, "alpha beta gamma " * 30, "x"), (2, "uno dos tres quatro " * 30, "y"), (3, None, "x"), (4, "", None), (5, "12 34 !?", "z"), (None, "beta alpha", None), (6, "dos uno " * 200_000, None)]
    docs = spark.createDataFrame([(*r, 0.5, "q") for r in rows], kind)
    m = L.learn(docs)
    assert m.names == ["x", "y"]  # z has no letters
    got = L.identify(docs, m).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and by[1].lang_pred == by[None].lang_pred == "x" and by[2].lang_pred == by[6].lang_pred == "y"
    assert all(by[i].lang_pred == L.UNKNOWN and by[i].score == 0 and by[i].languages == [] for i in (3, 4, 5))
    assert L.identify(docs.limit(0), m).count() == 0
    none = L.learn(docs.limit(0))
    assert {r.lang_pred for r in L.identify(docs, none).collect()} == {L.UNKNOWN}
    tie = L.Languages.of(["p", "q"], np.ones((2, 1 << 8), int), 8)
    assert tie.mixture("hello")[0][0] == "p"


def test_many_languages_are_handed_on(monkeypatch):
    monkeypatch.setattr(L, "HELD", 2)
    batches = [pa.RecordBatch.from_arrays([pa.array([f"l{k}", f"l{k + 1}"]), pa.array(["some text", "some text"])], names=["lang", "text"]) for k in range(4)]
    parts = list(L._counting(10)(iter(batches)))
    n = sum(sum(r["n"] for r in p.to_pylist() if r["lang"] == "l1") for p in parts)
    assert n == 2 * sum(len(h) for h in L.trigrams("some text", 10)) and len(parts) > 2
