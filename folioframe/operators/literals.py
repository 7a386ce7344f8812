"""Literals that a pattern's matches must hold, so that a rule is tried on those texts only that hold one of them."""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Literals shorter than this are no help; up to so many of a block are looked up one by one.
LEAST, FEW = 3, 32
#: Letters that Java takes as equal to an ASCII letter when case doesn't count.
FOLD = str.maketrans(string.ascii_uppercase + "ſKİı", string.ascii_lowercase + "skii")


class _Unsure(ValueError):
    """The pattern holds something that isn't judged here."""


def required(pattern: str, least: int = LEAST) -> frozenset[str]:
    """Folded literals of which every match of the Java pattern holds at least one; empty where none can be named.

    Careful rather than clever: nested classes, back references, comments and the like name none, and so does an alternative without a literal.
    """
    if re.search(r"\(\?[a-zA-Z-]*x", pattern):
        return frozenset()
    exact = not re.search(r"\(\?[a-zA-Z-]*[uU]", pattern)  # else letters beyond ASCII have twins too
    try:
        found, end = _choice(pattern, 0, least, exact)
        return frozenset(found or ()) if end == len(pattern) else frozenset()
    except (_Unsure, IndexError):
        return frozenset()


def _choice(p: str, i: int, least: int, exact: bool) -> tuple[set[str] | None, int]:
    options = []
    while True:
        best, i = _sequence(p, i, least, exact)
        options.append(best)
        if i == len(p) or p[i] != "|":
            return (None if None in options else set().union(*options)), i
        i += 1


def _sequence(p: str, i: int, least: int, exact: bool) -> tuple[set[str] | None, int]:
    """The most telling set of one alternative. ``run`` is the literal text up to here; what may be anything ends it."""
    found: list[set[str]] = []
    run = ""
    while i < len(p) and p[i] not in "|)":
        item, i = _item(p, i, least, exact)
        times, i = _times(p, i)
        if isinstance(item, str):
            run, item = run + item[:-1], item[-1:]
            if not exact and not item.isascii():
                item = None
        if item == "":
            continue
        again = ""
        if isinstance(item, str) and times != 0:
            run += item
            again = item if times else ""
        if not isinstance(item, str) or times is not None:
            found.append({run.translate(FOLD)})
            run = again
        if isinstance(item, set) and times != 0:
            found.append(item)
    found.append({run.translate(FOLD)})
    sure = [s for s in found if s and min(map(len, s)) >= least]
    return max(sure, key=lambda s: min(map(len, s)), default=None), i


def _item(p: str, i: int, least: int, exact: bool) -> tuple[str | set[str] | None, int]:
    """Text that stands for itself (empty: takes no room), a group's literals, or None for anything else; and where it ends."""
    c = p[i]
    if c == "[":
        return None, _class_end(p, i)
    if c == "(":
        return _group(p, i, least, exact)
    if c == "\\":
        return _escape(p, i, exact)
    if c in "^$":
        return "", i + 1
    if c == ".":
        return None, i + 1
    if c in "*+?{":
        raise _Unsure
    return c, i + 1


def _group(p: str, i: int, least: int, exact: bool) -> tuple[str | set[str] | None, int]:
    head = re.compile(r"\((?:\?(?:(?P<look><?[=!])|:|>|<[A-Za-z]\w*>|(?P<flags>[a-zA-Z-]+)(?P<end>[:)])))?").match(p, i)
    if p.startswith("(?", i) and head.end() == i + 1:
        raise _Unsure
    if head["end"] == ")":
        return "", head.end()
    found, end = _choice(p, head.end(), least, exact)
    if p[end] != ")":
        raise _Unsure
    return (None if head["look"] else found), end + 1


def _class_end(p: str, i: int) -> int:
    i += 2 if p[i + 1] == "^" else 1
    first = i
    while p[i] != "]":
        if p[i] == "[" or p.startswith("\\Q", i):
            raise _Unsure
        i += 2 if p[i] == "\\" else 1
    if i == first:
        raise _Unsure
    return i + 1


def _escape(p: str, i: int, exact: bool) -> tuple[str | None, int]:
    c = p[i + 1]
    if c == "Q":
        end = p.find("\\E", i + 2)
        end = len(p) if end < 0 else end
        text = p[i + 2 : end]
        return (text if exact or text.isascii() else None), min(end + 2, len(p))
    if c in "bBAzZG":
        if p.startswith("{", i + 2):
            raise _Unsure
        return "", i + 2
    if c in "pP":
        return None, p.index("}", i) + 1 if p[i + 2] == "{" else i + 3
    if c in "dDwWsShHvVRXtnrfea":
        return None, i + 2
    if c.isalnum():
        raise _Unsure
    return c, i + 2


def _times(p: str, i: int) -> tuple[int | None, int]:
    """The least number of repeats, None without a quantifier."""
    m = re.compile(r"(?:([?*])|\+|\{(\d+)(?:,\d*)?\})[?+]?").match(p, i)
    if not m:
        if p.startswith("{", i):
            raise _Unsure
        return None, i
    return (0 if m[1] else int(m[2]) if m[2] else 1), m.end()


def possible(text: Column, needs: dict[str, list[str]]) -> Column:
    """The patterns one of whose literals a text holds, as an array; ``needs`` gives patterns by literal.

    A few literals are looked up one by one, more of them in one Aho-Corasick pass a text.
    """
    if len(needs) > FEW:
        return _by_automaton(needs)(text)
    low = F.translate(text, *map("".join, zip(*((chr(k), chr(v)) for k, v in FOLD.items()), strict=True)))
    held = F.transform(F.array(low), lambda t: F.flatten(F.array(*[F.when(F.contains(t, F.lit(literal)), F.array(*map(F.lit, sorted(ps)))).otherwise(F.array().cast("array<string>")) for literal, ps in needs.items()])))
    return F.array_distinct(F.flatten(held))


def _by_automaton(needs: dict[str, list[str]]):
    @F.pandas_udf("array<string>")
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for literal in needs:
            automaton.add_word(literal, literal)
        automaton.make_automaton()

        def of(text: str | None) -> list[str]:
            held = {literal for _, literal in automaton.iter(text.translate(FOLD))} if isinstance(text, str) else ()
            return sorted({p for literal in held for p in needs[literal]})

        for batch in texts:
            yield batch.map(of)

    return find
