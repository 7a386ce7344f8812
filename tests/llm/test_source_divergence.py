import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioframe.llm import source_divergence as D
from folioframe.llm.queries import op11_source_divergence, oracle_sql

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least=10, top=10):
    """By the definition, in Python's integers."""
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source, found = lang or "", source or "", TERM.findall((text or "").translate(SMALL))
        groups[lang].add(source)
        n[lang, source].update(found)
        docs[lang].update(set(found))
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for t, k in docs[lang].items() if k >= least)
        counts = {s: [n[lang, s][t] for t in kept] for s in sources}
        share = lambda c: [1 + 10**9 * (x + 2) // (sum(c) + 2 * len(kept)) for x in c]
        p = {s: share(c) for s, c in counts.items()}
        q = share([sum(x) for x in zip(*counts.values(), strict=True)])
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pair = [(o, sum(map(f, p[s], p[o]))) for o in sources - {s}]
            term = [(t, f(x, y)) for t, c, x, y in zip(kept, counts[s], p[s], q, strict=True) if c and x > y]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                order = sorted(found, key=lambda r: (-r[1], r[0].encode()))[:most]
                out |= {(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(order)}
    return out


def rows_of(df):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_terms(text):
    assert [t.decode() for t in D.terms(text.encode())] == TERM.findall(text.translate(SMALL))


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 9 * 10**15), st.integers(1, 9 * 10**15))
def test_shares(count, total):
    import numpy as np

    count = min(count, total - 2) if total > 2 else 0
    total = max(total, 2)
    assert int(D.shares(np.array([count]), np.array([total]))[0]) == 1 + 10**9 * (count + 2) // total


def test_twin_whole_result(spark, duck, small):
    got = rows_of(op11_source_divergence(spark, small))
    want = duck.execute(oracle_sql()["op11_source_divergence"]).fetchall()
    assert got == set(want) and len(want) > 1000


@pytest.mark.parametrize("options", [{}, {"block": 3, "tile": 2}, {"least": 1, "top": 3, "tile": 1}])
def test_brute_force(spark, options, monkeypatch):
    r = random.Random(5)
    words = ["the", "The", "été", "ÉTÉ", "x", "don't", "語", "a1b", "rare" * 3, "z"]
    rows = [(r.choice(["en", "fr", None, ""]), r.choice(["a", "b", "c", "d", "e", None]), " ".join(r.choices(words, range(10, 0, -1), k=r.randint(0, 30)))) for _ in range(400)]
    rows += [("hot", "one", "same words here")] * 300 + [("hot", f"s{i}", "same other") for i in range(40)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    assert rows_of(D.audit(docs, **options)) == brute(rows, options.get("least", 10), options.get("top", 10))


def test_edges(spark):
    kind = "n long, lang string, source string, text string, term string, docs long, tile int"
    assert D.audit(spark.createDataFrame([], kind)).count() == 0
    # A language without kept terms, one of a single source, nulls, a very long text, ties, repeated rows and clashing columns.
    rows = [("xx", "a", None), ("xx", "b", ""), ("yy", "a", "w " * 200_000), (None, None, "12 34")] + [("zz", s, "aa bb") for s in "pq" * 10]
    docs = spark.createDataFrame([(i, *r, "k", 3, 1) for i, r in enumerate(rows)], kind)
    got = rows_of(D.audit(docs))
    assert got == brute(rows)
    assert {("xx", "a", "pair", "b", 0, 1), ("zz", "p", "pair", "q", 0, 1)} <= got and not any(r[0] in ("yy", "") for r in got)


def test_dictionaries_are_handed_on(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(D, "HELD", 3)
    texts = ["a b c d", "a b", "e f g h i", "a"]
    batch = pa.RecordBatch.from_arrays([pa.array(["l"] * 4), pa.array(["s"] * 4), pa.array(texts)], names=["lang", "source", "text"])
    parts = list(D._counting(iter([batch])))
    assert len(parts) > 1
    n, docs = Counter(), Counter()
    for p in parts:
        for r in p.to_pylist():
            n[r["term"]] += r["n"]
            docs[r["term"]] += r["docs"]
    assert n["a"] == docs["a"] == 3 and n["e"] == 1 and "" in n
