"""Source divergence audit: how far the sources of a language lie apart in their words, and which words set each apart.

Terms are runs of letters: ASCII letters, of which capitals count as small ones, and everything beyond ASCII. A language keeps
the terms that at least ``least`` of its documents hold. With ``count`` occurrences of a term among a group's N, and V kept terms,
the group gives it p = 1 + floor(10^9 (count + 2) / (N + 2 V)); two distributions differ at a term by floor((p - q)^2 / (p + q)).

Tasks count terms in dictionaries and hand on one row a term and group. Kept terms are dealt into blocks by their hash, and a
language's sources into tiles; a block's counts for a pair of tiles become a dense int64 matrix of groups by terms, whose pairs
of rows are compared by broadcasting. A task adds up its blocks' pair matrices and keeps a heap of the best terms a group;
Spark sums the partial matrices and merges the heaps. Terms that neither tile holds all give the same value: what a block adds for
a term is taken relative to it, and block 0 adds it once a kept term, so that no task needs the list of terms.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from .common import stored
from .textsets import as_bytes

#: Documents of its language that a kept term is in, and terms reported a group.
LEAST, TOP = 10, 10
#: Terms of a block and groups of a tile, on average.
BLOCK, TILE = 512, 64
#: Entries of a task's dictionaries after which they are handed on.
HELD = 250_000
_SPLIT = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COUNTED = "lang string, source string, term string, n long, docs long"
_FOUND = "lang string, source string, part string, item string, value long"


def terms(text: bytes) -> list[bytes]:
    """All terms of a text in UTF-8, in order. Bytes beyond ASCII are parts of characters beyond ASCII, so cutting bytes cuts characters."""
    return text.translate(_SPLIT).split()


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (lang, source, text): occurrences and documents a term, once or more a group and term; the empty term says that a group occurs."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in groups.items():
            size = len(n) + 1
            cols = [pa.array([lang] * size), pa.array([source] * size), pa.array([b"", *n], pa.binary()).cast(pa.string(), safe=False), pa.array([0, *n.values()], pa.int64()), pa.array([0, *(docs[t] for t in n)], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["lang", "source", "term", "n", "docs"])
        groups.clear()

    for b in batches:
        for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            before, found = len(n), terms(as_bytes(text))
            n.update(found)
            docs.update(set(found))
            held += len(n) - before
            if held > HELD:
                yield from flush()
                held = 0
    yield from flush()


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / total) in three digits of a thousand, so that totals up to 9 * 10^15 stay exact."""
    rest, out = count + 2, np.int64(0)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return 1 + out


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


class _Tile:
    """Sums and heaps of one pair of tiles of a language, while its blocks go by."""

    def __init__(self, key: tuple[str, int, int], top: int):
        self.key, self.top, self.sources, self.matrix, self.heaps = key, top, None, None, {}

    def add(self, head: pa.RecordBatch, rows: pa.Table) -> None:
        """One block: ``head`` has a row a group of the tiles, ``rows`` the counts, sorted by term."""
        _, a, b = self.key
        source, tile = np.array(head["source"].to_pylist(), object), head["tile"].to_numpy()
        order = np.array(sorted(range(len(source)), key=lambda i: (tile[i] != a, source[i])), np.int64)
        source, tile = source[order], tile[order]
        total, constant, everyone = (head[c].to_numpy()[order] for c in ("total", "constant", "everyone"))
        left = int((tile == a).sum())
        if self.sources is None:
            self.sources, self.left = source, left
            self.matrix = np.zeros((len(source), len(source)), np.int64)
        zero = shares(np.zeros(len(source), np.int64), total)
        first = lambda i: i + 1 if a == b else left
        if constant[0]:
            for i in range(left):
                self.matrix[i, first(i) :] += constant[0] * apart(zero[i], zero[first(i) :])
        if not rows.num_rows:
            return
        place = {s: i for i, s in enumerate(source)}
        g = np.array([place[s] for s in rows["source"].to_pylist()], np.int64)
        words = rows["term"].to_pylist()
        new = np.array([True, *(x != y for x, y in zip(words, words[1:], strict=False))])
        t, names = np.cumsum(new) - 1, [w for w, n in zip(words, new, strict=True) if n]
        count = np.zeros((len(source), len(names)), np.int64)
        count[g, t] = rows["n"].to_numpy()
        p = shares(count, total[:, None])
        for i in range(left):
            rest = slice(first(i), None)
            self.matrix[i, rest] += apart(p[i], p[rest]).sum(axis=1) - len(names) * apart(zero[i], zero[rest])
        if a == b:
            q = shares(rows["everywhere"].to_numpy()[new], everyone[0])
            for i in range(left):
                at = np.flatnonzero((count[i] > 0) & (p[i] > q))
                value = apart(p[i, at], q[at])
                best = np.argsort(-value, kind="stable")[: self.top]
                found = [(-int(value[k]), names[at[k]]) for k in best]
                self.heaps[source[i]] = heapq.nsmallest(self.top, self.heaps.get(source[i], []) + found)

    def rows(self) -> pa.RecordBatch:
        lang, a, b = self.key
        out = []
        for i in range(self.left):
            for j in range(i + 1 if a == b else self.left, len(self.sources)):
                value = int(self.matrix[i, j])
                out += [(self.sources[i], "pair", self.sources[j], value), (self.sources[j], "pair", self.sources[i], value)]
        out += [(s, "term", name, -value) for s, heap in self.heaps.items() for value, name in heap]
        source, part, item, value = zip(*out, strict=True) if out else ((), (), (), ())
        cols = [pa.array([lang] * len(out), pa.string()), pa.array(source, pa.string()), pa.array(part, pa.string()), pa.array(item, pa.string()), pa.array(value, pa.int64())]
        return pa.RecordBatch.from_arrays(cols, names=["lang", "source", "part", "item", "value"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Table]]:
    """Whole blocks ((lang, a, b, block), rows) of sorted batches."""
    key, parts = None, []
    for b in batches:
        if not b.num_rows:
            continue
        keys = list(zip(*(b.column(i).to_pylist() for i in range(4)), strict=True))
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if keys[lo] != key:
                if parts:
                    yield key, pa.Table.from_batches(parts)
                key, parts = keys[lo], []
            parts.append(b.slice(lo, hi - lo))
    if parts:
        yield key, pa.Table.from_batches(parts)


def _comparing(top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = None
        for key, block in _blocks(batches):
            if tile is None or tile.key != key[:3]:
                if tile:
                    yield tile.rows()
                tile = _Tile(key[:3], top)
            heads = int(np.count_nonzero(block["kind"].to_numpy() == 0))
            tile.add(block.slice(0, heads), block.slice(heads))
        if tile:
            yield tile.rows()

    return run


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least: int = LEAST, top: int = TOP, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has a row for every other source of the language, part ``term`` the ``top`` terms that a group uses more than its language.

    Null texts, languages and sources are read as empty ones; a group without kept terms takes part with the counts 0; a language
    without any gives pairs of value 0 and no terms, and one of a single source no pairs. Repeated rows count as often as they occur,
    ties go to the smaller item in UTF-8, texts may be of any length, other columns aren't read, an empty table gives no rows.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    empty = lambda c: F.coalesce(docs[c].cast("string"), F.lit(""))
    counted = docs.select(empty(lang_col).alias("lang"), empty(source_col).alias("source"), empty(text_col).alias("text")).mapInArrow(_counting, _COUNTED)
    counts = stored(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-counts")
    of_term = W.partitionBy("lang", "term")
    known = counts.where("term != ''").withColumns({"docs": F.sum("docs").over(of_term), "everywhere": F.sum("n").over(of_term), "one": (F.min("source").over(of_term) == F.col("source")).cast("long")})
    rows = stored(known.where(F.col("docs") >= least).drop("docs"), "divergence-kept")
    sums = rows.groupBy("lang").agg(F.sum("one").alias("terms"), F.sum("n").alias("words"))
    groups = counts.where("term = ''").select("lang", "source").join(rows.groupBy("lang", "source").agg(F.sum("n").alias("own")), ["lang", "source"], "left")
    langs = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(sums, "lang", "left").na.fill(0)
    langs = stored(langs.select("lang", "terms", "words", F.greatest(F.lit(1), F.ceil(F.col("terms") / block)).alias("blocks"), F.ceil(F.col("sources") / tile).alias("tiles")), "divergence-langs")

    own = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("tiles").cast("int") - 1), lambda o: F.struct(F.least(o, F.col("tile")).alias("a"), F.greatest(o, F.col("tile")).alias("b")))
    last = F.col("blocks").cast("int") - 1
    total = lambda words: F.greatest(F.lit(1).cast("long"), F.coalesce(words, F.lit(0)) + 2 * F.col("terms"))
    long = lambda c: F.lit(c).cast("long")
    heads = groups.join(langs, "lang").withColumn("tile", own).withColumn("at", F.explode(others)).withColumn("block", F.explode(F.sequence(F.lit(0), last)))
    heads = heads.select("lang", "at.a", "at.b", "block", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("term"), "source", "tile", long(None).alias("n"), long(None).alias("everywhere"),
                         total(F.col("own")).alias("total"), F.when(F.col("block") == 0, F.col("terms")).otherwise(0).alias("constant"), total(F.col("words")).alias("everyone"))
    data = rows.join(langs.select("lang", "blocks", "tiles"), "lang").withColumn("tile", own).withColumn("at", F.explode(others))
    data = data.select("lang", "at.a", "at.b", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), F.lit(1).alias("kind"), "term", "source", "tile", "n", "everywhere",
                       long(None).alias("total"), long(None).alias("constant"), long(None).alias("everyone"))
    place = ["lang", "a", "b", "block"]
    dealt = heads.union(data).repartition(n, *place).sortWithinPartitions(*place, "kind", "term")
    found = dealt.mapInArrow(_comparing(top), _FOUND).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top)).select("lang", "source", "part", "item", "value", F.col("rank").cast(T.IntegerType()).alias("rank"))
