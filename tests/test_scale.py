"""Exact medians and rule joins on rows where their larger plans show: hot groups, ties, nulls, several blocks."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from folioframe.operators import aggregates as A
from folioframe.operators import joins as J


@pytest.mark.parametrize("keys", [["g"], []])
def test_medians(spark, keys):
    r = random.Random(5)
    rows = [("hot", r.gauss(0, 1)) for _ in range(30001)] + [("even", float(r.randrange(9))) for _ in range(20000)] + [(None, 2.0), (None, 4.0), ("one", 7.5), ("none", None), ("tied", 1.0), ("tied", 1.0)]
    rows += [(f"small{n}", float(r.randrange(5))) for n in range(2, 40) for _ in range(n)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    want = {}
    for g, v in rows:
        want.setdefault(g if keys else None, []).extend([] if v is None else [v])
    x = A.score_stats(df, keys, "v").collect()
    assert {(row["g"] if keys else None): (row["n"], row["median"]) for row in x} == {g: (len(vs), statistics.median(vs) if vs else None) for g, vs in want.items()}


def test_medians_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "g string, a double, b double")
    assert A.score_stats(empty, ["g"], "a").count() == 0
    x = A.win_tie_loss(empty, "a", "b").collect()
    assert len(x) == 1 and x[0]["n"] == 0 and x[0]["median_a"] is None


def test_rules_in_blocks(spark, monkeypatch):
    texts = spark.createDataFrame([(i, f"word{i} and {i % 3}") for i in range(20)] + [(90, None), (91, "")], "id int, t string")
    rules = spark.createDataFrame([(f"r{i}", f"word{i % 9}\\b") for i in range(30)] + [("null", None), ("all", "^")], "rule string, p string")
    found = lambda: sorted((r["id"], r["rule"]) for r in J.matching_rules(texts, "t", rules, "p").collect())
    whole = found()
    assert whole == sorted([(i, f"r{k}") for i in range(9) for k in range(30) if k % 9 == i] + [(i, "all") for i in [*range(20), 91]])
    monkeypatch.setattr(J, "RULES_AT_MOST", 2)
    assert found() == whole
    assert J.matching_rules(texts, "t", rules.where(F.lit(False)), "p").count() == 0


def test_containment_by_the_rarest_item(spark):
    """One item in all sets: pairs come from rarer ones."""
    import random

    r = random.Random(3)
    big = {i: [0, *r.sample(range(1, 400), 12)] for i in range(300)}
    small = {i: [0, *(r.sample(big[i], 3) if i % 2 else r.sample(range(1, 400), 3))] for i in range(200)}
    small |= {900: [0], 901: [], 902: [0, 999], 903: [0, None]}
    frame = lambda sets, k: spark.createDataFrame(list(sets.items()), f"{k} int, items array<int>")
    b, s = frame(big, "b"), frame(small, "s")
    got = {(x.b, x.s, x.n) for x in J.contained_sets(b, s, "b", "s", "items").collect()}
    assert got == {(i, j, len(set(y))) for i, x in big.items() for j, y in small.items() if y and set(y) <= set(x)}
    holders = {x: sum(x in v for v in big.values()) for x in range(1000)}
    bound = sum(min((holders.get(x, 0) for x in y), default=0) for y in small.values())
    assert J.rarest_holders(b, s, "b", "s", "items").count() <= bound < 300 * 200 / 8


def test_ranks_by_ranges(spark):
    from folioframe.operators import windows as W

    rows = spark.range(5000).selectExpr("id", "cast(id * 7919 % 97 as int) AS v", "'x' AS rank_part").repartition(9)
    order = [F.col("v").desc_nulls_last(), F.col("id")]
    got = {r.id: r["rank"] for r in W.rank_by_ranges(rows, order).collect()}
    want = sorted(range(5000), key=lambda i: (-(i * 7919 % 97), i))
    assert got == {i: k + 1 for k, i in enumerate(want)}
    assert W.rank_by_ranges(rows.limit(0), order).count() == 0


def test_sums_and_sessions_by_ranges(spark):
    """Against one pass in Python: blocks without an end, sessions over several blocks, a block of many rows."""
    import random

    from folioframe.operators import windows as W

    r = random.Random(8)
    rows = [(b, i, r.choice(["a.", "b", "c", "d"])) for b in range(400) for i in range(300 if b == 7 else r.randrange(1, 4))]
    got = {(x.session, x.home, x.lines, x.text) for x in W.sessions_across(spark.createDataFrame(rows, "b int, i int, t string").repartition(5), F.col("t").endswith("."), "b", ["i"], "t").collect()}
    want, session, held = set(), 0, []
    for row in [*rows, None]:
        if held and (row is None or held[-1][2].endswith(".")):
            want.add((session, held[0][0], len(held), " ".join(t for *_, t in held)))
            session, held = session + 1, []
        held.append(row)
    assert got == want
    x = W.sum_before_by_ranges(spark.createDataFrame([(i, None if i % 5 else i) for i in range(1000)], "i int, v int"), [F.col("i")], F.col("v"), "s")
    assert {q.i: q.s for q in x.collect()} == {i: sum(range(0, i, 5)) for i in range(1000)}
    assert W.sessions_across(spark.createDataFrame([], "b int, i int, t string"), F.col("t").endswith("."), "b", ["i"], "t").count() == 0
