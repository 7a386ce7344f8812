"""Phrase mining and review lists against plain Python over all documents."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from folioframe import queries as Q
from folioframe.plans import candidates, grams, mining

CUT, WORD = re.compile(r"[.,;:!?()\[\]\n]+"), re.compile(r"[^\W\d_]{2,}")


def clauses_of(text):
    return [w for c in CUT.split(text or "") if (w := WORD.findall(c))]


def mined(docs, stop, least=2, most=6, min_count=3):
    """phrase -> (n, count, pages, loglik, example), by counting everything."""
    count, pages, first = Counter(), defaultdict(set), {}
    right, left, total = Counter(), Counter(), 0
    for doc in sorted(docs):
        for words in clauses_of(docs[doc]):
            t = [w.lower() for w in words]
            total += len(t)
            right.update(t[:-1])
            left.update(t[1:])
            for n in range(least, most + 1):
                for i in range(len(t) - n + 1):
                    g = tuple(t[i : i + n])
                    if g[0] not in stop and g[-1] not in stop:
                        count[g] += 1
                        pages[g].add(doc)
                        first.setdefault(g, " ".join(words[i : i + n]))
    kept = {g: c for g, c in count.items() if c >= min_count}
    gone = {s for g in kept if len(g) > least for s in (g[:-1], g[1:]) if kept.get(s) == kept[g]}

    def loglik(a, b, c):
        o = [c, max(0, right[a] - c), max(0, left[b] - c), max(0, total - right[a] - left[b] + c)]
        s = sum(o)
        e = [(o[0] + o[1]) * (o[0] + o[2]), (o[0] + o[1]) * (o[1] + o[3]), (o[2] + o[3]) * (o[0] + o[2]), (o[2] + o[3]) * (o[1] + o[3])]
        return 2 * sum(x * math.log(x * s / y) for x, y in zip(o, e, strict=True) if x)

    return {" ".join(g): (len(g), c, len(pages[g]), loglik(*g, c) if len(g) == 2 else None, first[g]) for g, c in kept.items() if g not in gone}


@pytest.fixture(scope="module")
def docs(spark, small):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}


def test_phrase_mining(spark, small, docs):
    want = mined(docs, Q._STOP)
    got = {r.phrase: r for r in Q.phrase_mining(spark, small).collect()}
    assert set(got) == set(want) and len(want) > 1000
    for p, (n, c, pages, loglik, _) in want.items():
        assert (got[p].n, got[p]["count"], got[p].pages) == (n, c, pages)
        assert got[p].loglik is None if loglik is None else abs(got[p].loglik - loglik) < 0.006


def test_levels_without_filters_worth_the_name(spark, small, docs, monkeypatch):
    """A filter of 64 bits admits nearly all and changes nothing."""
    monkeypatch.setattr(grams, "LEAST_BITS", 9)
    monkeypatch.setattr(grams, "MOST_BITS", 9)
    few = spark.read.parquet(f"{small}/documents.parquet").where("doc_id % 5 = 0")
    got = {r.phrase: (r.n, r["count"], r.pages, r.example) for r in grams.frequent_grams(grams.prepared(mining.surface_clauses(few, "doc_id", "text"), "doc_id", ["the"]), 1, 3, 2).collect()}
    count = Counter(tuple(w.lower() for w in c[i : i + n]) for k, t in docs.items() if k % 5 == 0 for c in clauses_of(t) for n in (1, 2, 3) for i in range(len(c) - n + 1))
    want = {" ".join(g): c for g, c in count.items() if c >= 2 and g[0] != "the" and g[-1] != "the"}
    assert {p: x[1] for p, x in got.items()} == want


def test_filter(spark):
    h = np.random.default_rng(1).integers(-(2**63), 2**63, 5000)
    f = grams.filter_of(spark.createDataFrame([(int(x),) for x in h], "h long").repartition(5))
    assert f(h.view(np.uint64)).all()
    others = np.random.default_rng(2).integers(0, 2**63, 20000).view(np.uint64)
    assert f(others).mean() < 0.08 and grams.filter_of(spark.createDataFrame([], "h long")) is None


def test_hard_clauses(spark):
    rows = [(1, "a b. Red Fox, red fox; red fox! x red fox ran"), (2, None), (3, ""), (4, "..."), (5, "ab " * 5000), (1, "red fox")]
    got = {r.phrase: (r.n, r["count"], r.pages, r.example) for r in grams.frequent_grams(grams.prepared(mining.surface_clauses(spark.createDataFrame(rows, "p int, t string"), "p", "t"), "p", ["ran"])).collect()}
    # Page 1 comes twice, and its second row has the phrase in an earlier clause.
    assert got == {"red fox": (2, 5, 1, "red fox"), **{" ".join(["ab"] * n): (n, 5001 - n, 1, " ".join(["ab"] * n)) for n in range(2, 7)}}
    assert grams.frequent_grams(grams.prepared(mining.surface_clauses(spark.createDataFrame([], "p int, t string"), "p", "t"), "p", ["x"])).count() == 0


def key(phrase):
    for e in ("ibus|arum|orum|erum|ium", "que", "is|es|em|um|us|as|os|ae|am|i|o|a|e|m|s"):
        phrase = " ".join(re.sub(f"(?:{e})$", "", w) for w in phrase.split(" "))
    return phrase


def test_review_candidates(spark, small):
    docs = {r.doc_id: r.t for r in Q._shaped(spark, small, Q._NAMED).collect()}
    count, pages, seen, capital = Counter(), defaultdict(set), Counter(), Counter()
    for d, text in docs.items():
        for words in clauses_of(text):
            for i, w in enumerate(words):
                count[w.lower()] += 1
                pages[w.lower()].add(d)
                seen[w.lower()] += i > 0
                capital[w.lower()] += i > 0 and w[0].isupper()
    proper = {w for w in count if seen[w] >= 2 and capital[w] >= 0.6 * seen[w]}
    phrases = mined(docs, Q._STOP)
    rows = {c: [(p, x[1], x[2], x[4]) for p, x in phrases.items() if all(w in proper for w in p.split()) == (c == "proper_name")] for c in ("proper_name", "term")}
    rows["proper_name"] += [(w, count[w], len(pages[w]), w) for w in proper if count[w] >= 3 and len(w) > 2 and w not in candidates.ABBREVIATIONS and w not in Q._STOP]
    want = set()
    for c, most in (("proper_name", 60), ("term", 70)):
        groups = defaultdict(list)
        for r in rows[c]:
            groups[key(r[0])].append(r)
        concepts = []
        for g in groups.values():
            g.sort(key=lambda r: (-r[1], r[0]))
            if max(r[2] for r in g) >= 3:
                concepts.append((g[0][0], tuple(r[0] for r in g), sum(r[1] for r in g), max(r[2] for r in g), g[0][3]))
        concepts.sort(key=lambda x: (-x[2], x[0]))
        want |= {(c, i + 1, *x) for i, x in enumerate(concepts[:most])}
    got = {(r.category, r["rank"], r.term, tuple(r.variants), r.total, r.pages, r.example) for r in Q.review_candidates(spark, small).collect()}
    assert got == want
    names = [w for w in want if w[0] == "proper_name"]
    assert any(set(w[3]) >= {"josephus", "josepho"} for w in names) and any(" " in w[2] for w in names) and any(len(w[3]) > 1 for w in want if w[0] == "term")
    seed = Q.glossary_seed(spark, small).collect()
    assert len(seed) == len(want) and all(r.approved == r.banned == [] and r.needs_review and r.latin_pattern == r.term and r.note.startswith("[REVIEW] variants: ") for r in seed)
