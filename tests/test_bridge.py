"""Matching blocks against difflib, and the token bridge over a whole table against one that uses it."""

import difflib
import random
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from folioframe import queries as Q
from folioframe.functions.pages import folded
from folioframe.plans.alignment import bridge_lines, matching_blocks


def joined(blocks):
    out = []
    for x, y, k in blocks:
        if out and (out[-1][0] + out[-1][2], out[-1][1] + out[-1][2]) == (x, y):
            x, y, k = out[-1][0], out[-1][1], out.pop()[2] + k
        out.append((x, y, k))
    return out


def by_difflib(a, b):
    return [tuple(m) for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()[:-1]]


@settings(max_examples=400, deadline=None)
@given(st.data())
def test_blocks_are_those_of_difflib(data):
    letters = "ab" if data.draw(st.booleans()) else "abcdefgh"
    a, b = (data.draw(st.lists(st.sampled_from(letters), max_size=40)) for _ in range(2))
    if data.draw(st.booleans()):
        b = [x for x in a if data.draw(st.integers(0, 9))]
    assert joined(matching_blocks(a, b)) == by_difflib(a, b)


def test_long_texts():
    """100,000 tokens a side with edits, a third of them one word; difflib takes hours for these."""
    r = random.Random(4)
    a = ["et" if r.random() < 0.33 else str(r.randrange(5000)) for _ in range(100_000)]
    b = [x if r.random() < 0.98 else "new" for x in a if r.random() < 0.99]
    began = time.perf_counter()
    blocks = matching_blocks(a, b)
    assert time.perf_counter() - began < 60
    assert sum(k for *_, k in blocks) > 95_000
    assert all(a[x : x + k] == b[y : y + k] for x, y, k in blocks)
    assert all(p[0] + p[2] <= q[0] and p[1] + p[2] <= q[1] for p, q in zip(blocks, blocks[1:], strict=False))


def test_one_word_only():
    assert matching_blocks(["a"] * 3000, ["a"] * 2000) == [(0, 0, 2000)]
    assert matching_blocks([], ["a"]) == matching_blocks(["a"], []) == matching_blocks(["a"], ["b"]) == []


def plain_bridge(source, reference):
    if not reference:
        return [(0, 0)] * len(source)
    a, b = ([(t, i) for i, x in enumerate(lines) for t in x] for lines in (source, reference))
    votes = [[] for _ in source]
    for x, y, k in by_difflib([t for t, _ in a], [t for t, _ in b]):
        for d in range(k):
            votes[a[x + d][1]].append(b[y + d][1])
    known = {i: sum(v) / len(v) for i, v in enumerate(votes) if v}
    if not known:
        return [(0, 0)] * len(source)
    out, least = [], 0
    for i, v in enumerate(votes):
        least = max(least, min(max(round(float(np.interp(i, list(known), list(known.values())))), 0), len(reference) - 1))
        out.append((least, len(v)))
    return out


def test_the_query_over_all_conversations(spark, small):
    talks = {}
    for r in sorted(spark.read.parquet(f"{small}/conversations.parquet").collect(), key=lambda r: (r.conv_id, r.turn)):
        talks.setdefault(r.conv_id, {True: [], False: []})[r.role == "user"].append((r.turn, folded(r.text)))
    want = {}
    for c, sides in talks.items():
        lines = [t for _, t in sides[True]], [t for _, t in sides[False]]
        want |= {(c, turn): x for (turn, _), x in zip(sides[False], plain_bridge(lines[1], lines[0]), strict=True)}
    got = {(r.conv_id, r.turn): (r.line, r.votes) for r in Q.token_bridge_mapping(spark, small).collect()}
    assert got == want
    assert len(set(got.values())) > 3


def test_bridge_of_lines_by_difflib():
    r = random.Random(9)
    for _ in range(60):
        lines = lambda: [[r.choice("abcdef") for _ in range(r.randrange(5))] for _ in range(r.randrange(1, 8))]  # noqa: E731, B023
        a, b = lines(), lines()
        assert bridge_lines(a, b) == plain_bridge(a, b)
