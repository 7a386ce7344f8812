import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioframe.llm import mixing as M


def sainte_lague(votes, seats):
    won = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = max((k for k in votes if votes[k] > 0), key=lambda k: (votes[k] / (2 * won[k] + 1), [-ord(c) for c in k]))
        won[best] += 1
    return won


@pytest.mark.parametrize("seed", range(4))
def test_apportionment(spark, seed):
    r = random.Random(seed)
    votes = {f"s{i:02}": r.choice([0, r.randint(1, 50), r.randint(1, 5000)]) for i in range(r.randint(2, 12))}
    votes["s00"] = 7
    seats = r.randint(0, 300)
    df = spark.createDataFrame([(k, v, seats) for k, v in votes.items()], "s string, v long, n long")
    got = {r.s: r.won for r in M.apportion(df, ["s"], [], "v", "n", "won").collect()}
    assert got == sainte_lague(votes, seats)


def water(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Resharing in rounds, as the contract puts it."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, out = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in out]
        rest = total - sum(out.values())
        over = [s for s in free if rest * w[s] / sum(w[x] for x in free) > most * sizes[s] + 1e-9]
        if not over:
            return out | {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        out |= {s: most * sizes[s] for s in over}


@settings(max_examples=12, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=9), st.booleans())
def test_targets(spark, sizes, null):
    named = {f"s{i}": n for i, n in enumerate(sizes)} | ({None: 50} if null else {})
    df = spark.createDataFrame([(k, v) for k, v in named.items()], "source string, source_size long")
    got = {r.source: r.target for r in M.source_targets(df).collect()}
    want = water(named)
    assert all(math.isclose(got[s], want[s], abs_tol=1e-6) for s in named)


def test_plan(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = M.plan(docs, shard_docs=30).collect()
    assert sorted(map(str, rows)) == sorted(map(str, M.plan(docs.repartition(3), shard_docs=30).collect()))
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        by.setdefault(r.source, []).append(r)
    want = water({s: sum(r.size for r in x) for s, x in by.items()})
    for s, x in by.items():
        assert math.isclose(x[0].target, want[s])
        assert abs(sum(r.taken for r in x) - want[s]) <= 3 * M.BLOCK + 0.01 * want[s]


def test_columns_without_an_order_and_long_texts(spark):
    rows = [(i, "w " * (200_000 if i == 3 else 5), "s", {"k": i}, [{"a": 1}]) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, m map<string,int>, l array<map<string,int>>")
    out = M.mix(docs)
    assert out.dtypes == docs.dtypes
    assert abs(out.agg(F.sum(F.size(F.split("text", " +")))).head()[0] / (1.5 * 200_035) - 1) < 0.01


def test_mix_gives_the_words_taken(spark):
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(i % 40)), f"s{i % 4}", "x") for i in range(200)] + [(None, None, None, None), (7, "", "s1", ""), (8, "rep eat ed", None, "y"), (8, "rep eat ed", None, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    taken = sum(r.taken for r in M.plan(docs).collect())
    out = M.mix(docs)
    assert out.dtypes == docs.dtypes
    assert out.agg(F.sum(F.size(F.split("text", " ")))).head()[0] == taken
    assert M.mix(docs.limit(0)).count() == 0
