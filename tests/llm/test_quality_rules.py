import collections
import re

import pytest
from pyspark.sql import functions as F

from folioframe.llm import quality_rules as Q
from folioframe.llm.queries import op2_quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = collections.Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


CASES = ["", None, "  \t\n ", "one", "a b c a b c a b c", "x y z\nx y z\n\n \nq", "# | <a> $5 é ü", "t " * 500, "w1 w2 w3 w4 w2 w3 w4 w1", "a\x0bb\x1cc d", "A b. " * 40 + "C d. " * 3]


def test_features(spark):
    docs = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string").withColumn("kept", F.lit("clash"))
    got = {r["doc_id"]: r for r in Q.judge(docs).collect()}
    assert len(got) == len(CASES)
    for i, text in enumerate(CASES):
        r, b = got[i], brute(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == b, text
        assert r.base_failed == (b[0] < 50 or 100 * b[4] > 50 * b[0])
        assert not (r.base_failed and r.kept)


def test_whole_table(spark, small):
    got = {r.doc_id: r for r in op2_quality_rules(spark, small).collect()}
    for doc, text in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect():
        r = got[doc]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(text)
    labels = spark.read.parquet(f"{small}/labels.parquet").collect()
    able = [x for x in labels if x.doc_id in got and not got[x.doc_id].base_failed]
    assert sum(got[x.doc_id].kept == bool(x.quality) for x in able) >= 0.95 * len(able)


def test_em_is_stable():
    v = lambda *x: tuple(x)
    clean = {v(Q.ABSTAIN, Q.FOR): 900, v(Q.FOR, Q.FOR): 50}
    odds, table = Q.fit_votes(clean, 2)
    assert odds > 0
    mixed = clean | {v(Q.AGAINST, Q.AGAINST): 40, v(Q.AGAINST, Q.ABSTAIN): 10}
    odds, table = Q.fit_votes(mixed, 2)
    logit = lambda x: odds + sum(__import__("math").log(table[j][k][0] / table[j][k][1]) for j, k in enumerate(x))
    assert logit(v(Q.AGAINST, Q.ABSTAIN)) < 0 < logit(v(Q.ABSTAIN, Q.FOR))
    assert Q.fit_votes({}, 2)[0] > 0


def plain_em(votes, rounds=100, prior=0.8, strength=20.0):
    """The same model, document by document."""
    given = {Q.FOR: (0.29, 0.15), Q.AGAINST: (0.01, 0.15)}
    post = [0.1 if Q.AGAINST in v else 0.9 for v in votes]
    for _ in range(rounds):
        good = sum(post)
        share = (good + strength * prior) / (len(votes) + strength)
        rate = []
        for j in range(len(votes[0])):
            here = {}
            for vote, (g0, b0) in given.items():
                g = (strength * g0 + sum(p for p, v in zip(post, votes, strict=True) if v[j] == vote)) / (strength + good)
                b = (strength * b0 + sum(1 - p for p, v in zip(post, votes, strict=True) if v[j] == vote)) / (strength + len(votes) - good)
                here[vote] = max(g, b) / b if vote == Q.FOR else g / max(g, b)
            rate.append(here)
        new = []
        for v in votes:
            odds = share / (1 - share)
            for j, x in enumerate(v):
                odds *= rate[j].get(x, 1.0)
            new.append(odds / (1 + odds))
        moved, post = max(abs(a - b) for a, b in zip(new, post, strict=True)), new
        if moved < 1e-9:
            break
    return post


def test_verdicts_equal_a_plain_em(spark, small):
    rows = Q.judge(spark.read.parquet(f"{small}/documents.parquet")).collect()
    want = plain_em([tuple(r[f"vote_{k}"] for k in Q.default_rules()) for r in rows])
    for r, p in zip(rows, want, strict=True):
        assert abs(r.p_good - p) < 1e-6
        assert r.kept == (not r.base_failed and p >= 0.5) or abs(p - 0.5) < 1e-6


def test_repeats_against_the_length(spark):
    """Half of what repeats in a text of any length weighs against what one sentence said twice would be there."""
    said = lambda k, n: " ".join([f"w{i} x{i}" for i in range(k)] * 2 + [f"y{i}" for i in range(n - 4 * k)])
    shares = {(n, k): 4 * k / n for n in (60, 130, 199, 200, 1000) for k in range(1, n // 8)}
    docs = [(n * 1000 + k, said(k, n)) for n, k in shares if n < 1000 or k % 10 == 0]
    docs += [(7, "very long text " * 200_000), (8, None)]
    got = {r.doc_id: (r.n_words, r.vote_repeats) for r in Q.judge(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for (n, k), share in shares.items():
        if n < 1000 or k % 10 == 0:
            assert got[n * 1000 + k] == (n, Q.AGAINST if share > Q.REPEATED + Q.SAID_TWICE / n else Q.FOR if share < 0.1 else Q.ABSTAIN)
    assert got[7] == (600_000, Q.AGAINST) and got[8] == (0, Q.ABSTAIN)
    assert Q.judge(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_repeats_count_in_long_texts_only(spark):
    part = " ".join(f"w{i} x{i}" for i in range(60))
    docs = [(1, part + " " + " ".join(f"y{i}" for i in range(180)) + " " + part + " " + " ".join(f"v{i}" for i in range(100))), (2, "a b c d e f g h i j k l m n o p q r s t " * 2 + " ".join(f"z{i}" for i in range(60)))]
    votes = {r.doc_id: (r.base_failed, r.vote_repeats) for r in Q.judge(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert votes == {1: (False, Q.AGAINST), 2: (False, Q.ABSTAIN)}


@pytest.mark.parametrize("rows", [[], [(None, "word " * 60, None), (None, None, "x"), (1, "word other third " * 20, "y"), (1, "word other third " * 20, "y")]])
def test_filter_keeps_columns(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    out = Q.filter_documents(docs)
    assert out.schema == docs.schema or out.dtypes == docs.dtypes
    out.collect()
