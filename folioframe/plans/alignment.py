"""Alignment of units with sentences and of source with reference lines: sequential programs, one document at a time."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

MOST_SENTENCES, SKIP = 24, 0.05
#: What counts as a content word.
CONTENT_WORD = r"[a-zà-ÿ]{3,}"
STOP_WORDS = """the and that was his with for which this not are but have had from they were been their them also who him her she you
all one out into when then there these those""".split()


def span_scores(unit: set[str], sentences: list[set[str]], most: int = MOST_SENTENCES) -> np.ndarray:
    """[start, length - 1]: Jaccard of the unit's words and the union of a span's, scaled by 0.5 + 0.5 * (fewer / more words).

    A span that reaches beyond the last sentence has -inf, one without words, or a unit without, 0.
    """
    n = len(sentences)
    out = np.full((n, min(most, n)), -np.inf)
    vocabulary = {w: i for i, w in enumerate(sorted(set().union(*sentences)))} if n else {}
    has = np.zeros((len(vocabulary), n), bool)
    for j, words in enumerate(sentences):
        has[[vocabulary[w] for w in words], j] = True
    mine = np.zeros(len(vocabulary), bool)
    mine[[vocabulary[w] for w in unit if w in vocabulary]] = True
    for start in range(n):
        union = np.logical_or.accumulate(has[:, start : start + most], axis=1)
        size, both = union.sum(axis=0), union[mine].sum(axis=0)
        either = len(unit) + size - both
        with np.errstate(divide="ignore", invalid="ignore"):
            balance = np.minimum(len(unit), size) / np.maximum(len(unit), size)
            score = both / either * (0.5 + 0.5 * balance)
        out[start, : len(size)] = np.where((size == 0) | (len(unit) == 0), 0.0, score)
    return out


def align_spans(scores: list[np.ndarray], n: int, skip: float = SKIP) -> list[tuple[int, int]]:
    """Each unit takes the next 0 or more of the ``n`` sentences so that the spans' scores add up to the most.

    ``scores[u]`` is :func:`span_scores` of unit u. A unit without a span costs ``skip``; sentences between spans are never left
    out, those after the last one are free. Of equal choices the longest last span wins, and of equal ends the first.
    """
    best = np.full(n + 1, -np.inf)
    best[0] = 0.0
    came: list[np.ndarray] = []
    for table in scores:
        new, start = np.full(n + 1, -np.inf), np.arange(n + 1)
        for k in range(table.shape[1], 0, -1):
            value = best[: n + 1 - k] + table[: n + 1 - k, k - 1]
            better = value > new[k:]
            new[k:][better] = value[better]
            start[k:][better] = np.flatnonzero(better)
        none = best - skip > new
        new[none], start[none] = best[none] - skip, np.flatnonzero(none)
        came.append(start)
        best = new
    spans, at = [], int(np.argmax(best))
    for start in reversed(came):
        spans.append((int(start[at]), at))
        at = int(start[at])
    return spans[::-1]


def _words(text: str | None) -> set[str]:
    return set(re.findall(CONTENT_WORD, (text or "").lower())) - set(STOP_WORDS)


def align(rows: DataFrame, doc: str, side: str, pos: str, text: str) -> DataFrame:
    """(doc, unit, first, last) from rows with side 'unit' or 'sentence': sentences [first, last) of each unit, none if equal.

    One document's rows meet in a task; documents are of bounded size.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(pos)
        units, sentences = (pdf[pdf[side] == s] for s in ("unit", "sentence"))
        words = [_words(t) for t in sentences[text]]
        spans = align_spans([span_scores(_words(t), words) for t in units[text]], len(words))
        return pd.DataFrame({doc: pdf[doc].iloc[0], "unit": units[pos].to_numpy(), "first": [x for x, _ in spans], "last": [y for _, y in spans]})

    return rows.select(doc, side, pos, text).groupBy(doc).applyInPandas(run, f"{doc} {rows.schema[doc].dataType.simpleString()}, unit long, first long, last long")


def _numbered(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1]


def _shared(keys: np.ndarray, ok: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Numbers of the keys, equal for equal ones, where ``ok`` and on both sides; -1 elsewhere."""
    out = np.full(len(keys), -1)
    at = np.flatnonzero(ok)
    if len(at):
        number = _numbered(keys[at])
        both = np.zeros(number.max() + 1, int)
        both[number[left[at]]] |= 1
        both[number[~left[at]]] |= 2
        at, number = at[both[number] == 3], number[both[number] == 3]
        out[at] = number
    return out


def longest_blocks(token: np.ndarray, left: np.ndarray, window: np.ndarray) -> dict[int, tuple[int, int, int]]:
    """For each window the longest run of tokens on both its sides, as (place on the left, place on the right, length).

    Rows lie by window and side, a side's in text order. Of equally long runs that first on the left is taken, and of its places
    on the right the first. Runs of 1, 2, 4, ... tokens get numbers from those of their halves; lengths between are reached from
    the longest such power down. Places whose run isn't on both sides drop out at once.
    """
    n = len(token)
    side = np.flatnonzero(np.r_[True, (window[1:] != window[:-1]) | (left[1:] != left[:-1])]) if n else np.empty(0, int)
    end = np.repeat(np.r_[side[1:], n], np.diff(np.r_[side, n])) if n else np.empty(0, int)  # where each row's side ends
    w = _numbered(window) if n else window
    here = np.arange(n)

    def longer(run: np.ndarray, length: np.ndarray, by: np.ndarray) -> np.ndarray:
        ok = run >= 0
        then = np.where(ok, here + length, 0)
        ok &= then < end
        tail = by[np.where(ok, then, 0)]
        ok &= tail >= 0
        return _shared(run * (n + 1) + tail, ok, left)

    powers = [_shared(w * (int(token.max(initial=0)) + 1) + token, np.ones(n, bool), left)]
    while (powers[-1] >= 0).any():
        powers.append(longer(powers[-1], np.full(n, 1 << (len(powers) - 1)), powers[-1]))
    powers.pop()
    length, run = np.zeros(w.max(initial=-1) + 1, int), np.full(n, -1)
    for t in reversed(range(len(powers))):
        more = np.where(length[w] == 0, powers[t], longer(run, length[w], powers[t]) if (run >= 0).any() else -1)
        grown = np.zeros(len(length), bool)
        grown[w[more >= 0]] = True
        run = np.where(grown[w], more, run)
        length[grown] += 1 << t
    out = {}
    at = np.flatnonzero((run >= 0) & left)
    first = at[np.unique(w[at], return_index=True)[1]]
    right = np.flatnonzero((run >= 0) & ~left)
    of = w * (n + 1) + run  # a number may come up in several windows
    kept = dict(zip(*np.unique(of[right], return_index=True), strict=True))
    for i in first:
        out[int(window[i])] = (int(i), int(right[kept[of[i]]]), int(length[w[i]]))
    return out


def matching_blocks(a: list[str], b: list[str]) -> list[tuple[int, int, int]]:
    """(start in a, start in b, length) of the longest common block, the first one in a and then in b, and of those before and after it in
    turn, in order: the blocks of difflib without junk, before it joins neighbours.

    All windows of one depth are searched together, so a depth costs a few sorts of the tokens that are still left. Texts whose
    longest block lies near their end again and again have as many depths as blocks; otherwise depths grow with the logarithm.
    """
    number = _numbered(np.array([*a, *b], dtype=object)) if a or b else np.empty(0, int)
    ta, tb = number[: len(a)], number[len(a) :]
    todo, out = [(0, len(a), 0, len(b))] if a and b else [], []
    while todo:
        sizes = np.array([(ah - al, bh - bl) for al, ah, bl, bh in todo])
        place = np.concatenate([np.arange(x, y) for al, ah, bl, bh in todo for x, y in ((al, ah), (bl, bh))])
        left = np.repeat(np.tile([True, False], len(todo)), sizes.ravel())
        window = np.repeat(np.arange(len(todo)), sizes.sum(axis=1))
        token = np.where(left, ta[np.where(left, place, 0)], tb[np.where(left, 0, place)])
        after = []
        for i, (x, y, k) in longest_blocks(token, left, window).items():
            al, ah, bl, bh = todo[i]
            x, y = int(place[x]), int(place[y])
            out.append((x, y, k))
            after += [q for q in ((al, x, bl, y), (x + k, ah, y + k, bh)) if q[0] < q[1] and q[2] < q[3]]
        todo = after
    return sorted(out)


def matching_lines(source: list[list[str]], reference: list[list[str]]) -> list[list[int]]:
    """For each source line the reference lines of its tokens in matching blocks, one a token."""
    flat = lambda lines: ([t for x in lines for t in x], [i for i, x in enumerate(lines) for _ in x])
    (a, at_a), (b, at_b) = flat(source), flat(reference)
    votes: list[list[int]] = [[] for _ in source]
    for x, y, size in matching_blocks(a, b):
        for k in range(size):
            votes[at_a[x + k]].append(at_b[y + k])
    return votes


def bridge_lines(source: list[list[str]], reference: list[list[str]]) -> list[tuple[int, int]]:
    """(reference line, votes) for each source line: the mean line of its matching tokens; lines without any are interpolated
    between their neighbours; then lines are rounded, and never fall. Without any match, or reference, all lie at 0."""
    votes = matching_lines(source, reference) if reference else [[] for _ in source]
    known = [i for i, v in enumerate(votes) if v]
    if not known:
        return [(0, 0) for _ in source]
    mean = np.interp(np.arange(len(source)), known, [sum(votes[i]) / len(votes[i]) for i in known])
    # Python's round and numpy's rint both take halves to the even number.
    lines = np.maximum.accumulate(np.clip(np.rint(mean), 0, len(reference) - 1).astype(int))
    return [(int(x), len(v)) for x, v in zip(lines, votes, strict=True)]


def bridge(rows: DataFrame, doc: str, side: str, pos: str, text: str) -> DataFrame:
    """(doc, pos, line, votes) of the rows with side 'bridge' against those with side 'reference', by folded tokens.

    One document's rows meet in a task; documents are of bounded size. Blocks are difflib's (:func:`matching_blocks`).
    """
    from ..functions.pages import folded

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(pos)
        mine, theirs = (pdf[pdf[side] == s] for s in ("bridge", "reference"))
        got = bridge_lines([folded(t) for t in mine[text]], [folded(t) for t in theirs[text]])
        return pd.DataFrame({doc: pdf[doc].iloc[0], pos: mine[pos].to_numpy(), "line": [x for x, _ in got], "votes": [v for _, v in got]})

    kinds = {c: rows.schema[c].dataType.simpleString() for c in (doc, pos)}
    return rows.select(doc, side, pos, text).groupBy(doc).applyInPandas(run, f"{doc} {kinds[doc]}, {pos} {kinds[pos]}, line long, votes long")
