"""Near-duplicate search over vectors: iterative quantisation and multi-index Hamming tables.

A bounded seeded sample gives axes and rotations that iterative quantisation (ITQ) turns until the signs of the rotated vectors lose
least; the first block of bits takes the principal axes, further ones random axes of the whole space. A code is cut into a substring
for each table; two vectors are candidates if some substring differs in at most one bit. Substrings are as wide as the logarithm of
the number of vectors, less a constant, so that a bucket and its neighbours hold a bounded number of unrelated vectors, and there are as many tables as
the wanted share of pairs at the threshold needs (:func:`plan`). Candidates are filtered by the distance of their whole codes
and reranked by cosine on the original vectors in double precision.

Equal vectors are one class with a weight, so copies aren't compared. Each class lies once in every table and asks, with its
code, for its substrings' neighbours; a bucket of many classes is cut into tiles to which askers are sent
alike. What has a candidate in a tile goes there again with its vector. A pair found in several tables counts in the first one
only, so links need no list of pairs: tasks return each class's number of links, and for each the smallest class of the component
that its links form there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .ngram_join import connected

#: Vectors that the rotation is learned from, at most, and rounds of learning.
FIT_ROWS, ROUNDS, SEED = 4096, 30, 11
COSINE = 0.9
#: Share of the pairs at the threshold that some table must bring together, and bits of a substring at least and at most.
SHARE, NARROWEST, WIDEST = 0.98, 8, 28
#: Bits of a block that one rotation gives at most, and unrelated classes of a bucket on average: rows cost more than comparisons.
BLOCK, LOAD = 64, 16
#: Classes of a bucket's tile.
TILE = 2048
#: Standard deviations of the code distance at the threshold's angle that the code filter allows.
SLACK = 3.5


def plan(classes: int, cosine: float = COSINE, share: float = SHARE) -> tuple[int, int]:
    """(bits of a substring, tables) for a number of vectors.

    A bit differs with the chance angle / pi, so a substring at most one bit apart is found with the chance below; tables are taken as
    independent. The work for a vector, tables times (bits + 1) buckets of about ``LOAD`` unrelated vectors each, grows with the square
    of a logarithm and not with the number of vectors, but for the tables that wider substrings need.
    """
    bits = int(np.clip(np.ceil(np.log2(max(2, classes / LOAD))), NARROWEST, WIDEST))
    p = float(np.arccos(np.clip(cosine, -1, 1))) / np.pi
    found = (1 - p) ** bits + bits * p * (1 - p) ** (bits - 1)
    return bits, max(1, int(np.ceil(np.log(1 - share) / np.log(1 - found)))) if found < 1 else 1


class Codes:
    """Learned hashing of unit vectors of one dimension to ``tables`` substrings of ``width`` bits, in words of 64."""

    def __init__(self, sample: np.ndarray, width: int = 16, tables: int = 10, rounds: int = ROUNDS, seed: int = SEED):
        unit, d = sample, sample.shape[1]
        self.width, self.tables, self.bits = width, tables, width * tables
        self.words = -(-self.bits // 64)
        rng = np.random.default_rng(seed)
        # Without a mean taken off, angles are kept: the distance of codes then follows the cosine.
        _, axes = np.linalg.eigh(unit.T @ unit)
        each, blocks = min(BLOCK, d), []
        while sum(x.shape[1] for x in blocks) < self.bits:
            p = axes[:, ::-1][:, :each] if not blocks else np.linalg.qr(rng.normal(size=(d, each)))[0]
            r = np.linalg.qr(rng.normal(size=(each, each)))[0]
            v = unit @ p
            for _ in range(rounds):
                b = np.where(v @ r >= 0, 1.0, -1.0)
                u, _, wt = np.linalg.svd(b.T @ v)
                r = (u @ wt).T
            blocks.append(p @ r)
        self.axes = np.concatenate(blocks, axis=1)[:, : self.bits]

    def __call__(self, vectors: np.ndarray) -> np.ndarray:
        """A row of words a vector."""
        on = np.pad(vectors @ self.axes >= 0, ((0, 0), (0, 64 * self.words - self.bits)))
        return np.packbits(on, axis=1, bitorder="little").view("<u8")

    def substring(self, code: np.ndarray, t: int) -> np.ndarray:
        """The t-th substrings of rows of words."""
        word, shift = divmod(t * self.width, 64)
        out = code[..., word] >> np.uint64(shift)
        if shift + self.width > 64:
            out = out | (code[..., word + 1] << np.uint64(64 - shift))
        return out & np.uint64((1 << self.width) - 1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Code distances of all rows of ``a`` from all rows of ``b``."""
    return sum(np.bitwise_count(a[:, None, w] ^ b[None, :, w]).astype(np.int16) for w in range(a.shape[1]))


def farthest(bits: int, cosine: float) -> int:
    """Code distance beyond which a pair at the threshold hardly lies."""
    p = float(np.arccos(np.clip(cosine, -1, 1))) / np.pi
    return int(np.ceil(bits * p + SLACK * np.sqrt(bits * p * (1 - p)) + 1))


def _unit(column: pa.Array, rows: int) -> np.ndarray:
    """The unit vectors of an Arrow list column without nulls, in double precision."""
    v = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)
    v = v / np.abs(v).max(axis=1, keepdims=True) if rows else v
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _asking(codes: Codes):
    """Of (class, vector): rows by bucket, with codes alone. kind 0 lies in it, 1 asks its own bucket, 2 asks one that has a bit set which it hasn't.

    So of two classes whose substrings differ in one bit, exactly one asks the other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                code, every = codes(_unit(part.column(1), part.num_rows)), np.arange(part.num_rows)
                keys, rows, kinds = [], [], []
                for t in range(codes.tables):
                    sub = codes.substring(code, t).astype(np.int64) | (t << 48)
                    unset = [np.flatnonzero(~sub & (1 << bit)) for bit in range(codes.width)]
                    keys += [sub, sub, *(sub[u] | (1 << bit) for bit, u in enumerate(unset))]
                    rows += [every, every, *unset]
                    kinds += [np.zeros(len(every), np.int8), np.ones(len(every), np.int8), *(np.full(len(u), 2, np.int8) for u in unset)]
                row = np.concatenate(rows)
                cols = [pa.array(np.concatenate(keys), pa.int64()), pa.array(np.concatenate(kinds), pa.int8()), part.column(0).take(pa.array(row)), *(pa.array(np.ascontiguousarray(code[row, w]).view(np.int64)) for w in range(codes.words))]
                yield pa.RecordBatch.from_arrays(cols, names=["key", "kind", "c", *_words(codes)])

    return run


def _words(codes: Codes) -> list[str]:
    return [f"w{i}" for i in range(codes.words)]


class _Pairs:
    """Which askers of a tile meet which of its classes: by the whole codes' distance, each pair in the first of its tables only."""

    def __init__(self, codes: Codes, cosine: float):
        self.codes, self.far = codes, farthest(codes.bits, cosine)

    def first_table(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.full(len(a), self.codes.tables, np.int64)
        for t in reversed(range(self.codes.tables)):
            out[np.bitwise_count(self.codes.substring(a, t) ^ self.codes.substring(b, t)) <= 1] = t
        return out

    def __call__(self, t: int, kind: np.ndarray, c: np.ndarray, code: np.ndarray, own: np.ndarray, own_code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        once = np.where(kind[:, None] == 2, True, c[:, None] < own[None, :])
        i, j = np.nonzero((distances(code, own_code) <= self.far) & once)
        here = self.first_table(code[i], own_code[j]) == t
        return i[here], j[here]


def _tiles(batches: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[tuple[pa.RecordBatch, list[tuple[tuple[int, int], int, int]]]]:
    """Batches of at most ``rows``, each with its stretches ((key, tile), begin, end). Rows must come sorted."""
    for b in (b.slice(at, rows) for b in batches for at in range(0, b.num_rows, rows)):
        key, tile = (b.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        new = np.ones(b.num_rows, bool)
        new[1:] = (key[1:] != key[:-1]) | (tile[1:] != tile[:-1])
        first = np.flatnonzero(new)
        yield b, [((int(key[lo]), int(tile[lo])), int(lo), int(hi)) for lo, hi in zip(first, [*first[1:], b.num_rows], strict=True)]


def _meeting(pairs: _Pairs):
    """Of (key, tile, kind, c, words of the code), sorted: the rows (key, tile, kind, c) that have a candidate in their tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = None, []

        def put(at: tuple[int, int], kind: np.ndarray, c: np.ndarray) -> None:
            if len(c):
                out.append((np.full(len(c), at[0]), np.full(len(c), at[1]), kind, c))

        def close() -> None:
            if held is not None:
                put(held[0], np.zeros(int(held[3].sum()), np.int8), held[1][held[3]])

        def flush() -> Iterator[pa.RecordBatch]:
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int8(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["key", "tile", "kind", "c"])
                out.clear()

        for b, stretches in _tiles(batches):
            kind, c, *words = (b.column(i).to_numpy(zero_copy_only=False) for i in range(2, b.num_columns))
            code = np.stack(words, axis=1).view(np.uint64)
            for at, lo, hi in stretches:
                own = lo + np.flatnonzero(kind[lo:hi] == 0)
                if held is None or held[0] != at:
                    close()
                    held = [at, c[own], code[own], np.zeros(len(own), bool)]
                elif len(own):
                    held = [at, *(np.concatenate(x) for x in zip(held[1:], (c[own], code[own], np.zeros(len(own), bool)), strict=True))]
                asking = lo + np.flatnonzero(kind[lo:hi])
                for k in range(0, len(asking) if len(held[1]) else 0, 256):
                    a = asking[k : k + 256]
                    i, j = pairs(at[0] >> 48, kind[a], c[a], code[a], held[1], held[2])
                    held[3][j] = True
                    met = a[np.unique(i)]
                    put(at, kind[met], c[met])
            yield from flush()
        close()
        yield from flush()

    return run


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges (a, b), and the smallest node that each reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _linked(codes: Codes, pairs: _Pairs, cosine: float):
    """Of (key, tile, kind, c, weight, vector), sorted: (c, links, root) of the classes that a tile links, root in the same component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b, stretches in _tiles(batches):
            kind, c, weight = (b.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
            vec = _unit(b.column(5), b.num_rows)
            code = codes(vec)
            out = []
            for at, lo, hi in stretches:
                own = lo + np.flatnonzero(kind[lo:hi] == 0)
                mine = (c[own], weight[own], code[own], vec[own])
                if held is None or held[0] != at:
                    held = (at, *mine)
                elif len(own):
                    held = (at, *(np.concatenate(x) for x in zip(held[1:], mine, strict=True)))
                asking = lo + np.flatnonzero(kind[lo:hi])
                for k in range(0, len(asking) if len(held[1]) else 0, 256):
                    a = asking[k : k + 256]
                    i, j = pairs(at[0] >> 48, kind[a], c[a], code[a], held[1], held[3])
                    good = np.einsum("ij,ij->i", vec[a[i]], held[4][j]) >= cosine
                    i, j = i[good], j[good]
                    if len(i):
                        ca, cb = c[a[i]], held[1][j]
                        nodes, root = _forest(ca, cb)
                        links = np.zeros(len(nodes), np.int64)
                        np.add.at(links, np.searchsorted(nodes, ca), held[2][j])
                        np.add.at(links, np.searchsorted(nodes, cb), weight[a[i]])
                        out.append((nodes, links, root))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*out, strict=True)], names=["c", "links", "root"])

    return run


def learn(classes: DataFrame, rows: int = FIT_ROWS, **options) -> Codes | None:
    """Rotations from the ``rows`` vectors of the smallest seeded hash; None for an empty table."""
    sample = classes.orderBy(F.xxhash64("c", F.lit(SEED)), "c").limit(rows).select("vector").toArrow()
    if not sample.num_rows:
        return None
    return Codes(_unit(sample.column(0).combine_chunks(), sample.num_rows), **options)


def links(classes: DataFrame, codes: Codes, cosine: float = COSINE) -> DataFrame:
    """(c, links, root) rows of the classes (c, weight, vector), to be summed by c; (c, root) are edges of the same components."""
    spark = classes.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = classes.select("c", "vector").mapInArrow(_asking(codes), "key long, kind tinyint, c long, " + ", ".join(f"{w} long" for w in _words(codes)))
    large = stored(rows.where("kind = 0").groupBy("key").agg(F.ceil(F.count("*") / TILE).alias("tiles")).where("tiles > 1"), "embed-large")
    some = large.count()
    if some:
        # At most one bucket in TILE classes and table; beyond a million of them the join is left to Spark.
        rows = rows.join(F.broadcast(large) if some <= 1_000_000 else large, "key", "left")
        last = F.coalesce(F.col("tiles"), F.lit(1)) - 1
        own = F.pmod(F.xxhash64("c"), last + 1)
        rows = rows.withColumn("tile", F.explode(F.when(F.col("kind") == 0, F.array(own)).otherwise(F.sequence(F.lit(0).cast("long"), last))))
    else:
        rows = rows.withColumn("tile", F.lit(0).cast("long"))
    pairs = _Pairs(codes, cosine)
    dealt = lambda x: x.repartition(n, "key", "tile").sortWithinPartitions("key", "tile", "kind")
    met = stored(dealt(rows.select("key", "tile", "kind", "c", *_words(codes))).mapInArrow(_meeting(pairs), "key long, tile long, kind tinyint, c long").distinct(), "embed-met")
    # Only what has a candidate in a tile is sent there with its vector.
    return dealt(met.join(classes, "c").select("key", "tile", "kind", "c", "weight", "vector")).mapInArrow(_linked(codes, pairs, cosine), "c long, links long, root long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, share: float = SHARE, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row a row of ``vectors``: its id, n_links (other rows linked with it), component_id (smallest id reachable) and kept.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of different
    dimensions. Repeated rows are copies of each other and link; a null id counts as larger than any other, and is kept
    only where it stands alone. Other columns aren't read; an empty table gives no rows.
    """
    v = F.col("_v")
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    good = v.isNotNull() & (F.size(v) > 0) & F.forall(v, number) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(vectors[id_col].cast("long").alias("_id"), vectors[vector_col].alias("_v")).withColumn("_good", F.coalesce(good, F.lit(False)))
    rows = rows.withColumn("_c", F.when(F.col("_good"), F.xxhash64("_v")))
    classes = stored(rows.where("_good").groupBy(F.col("_c").alias("c"), F.col("_v").alias("vector")).agg(F.count("*").alias("weight"), F.min("_id").alias("rep")), "embed-classes")
    found = None
    for size, n in classes.groupBy(F.size("vector")).count().collect():
        part = classes.where(F.size("vector") == size)
        width, tables = plan(n, cosine, share)
        some = links(part, learn(part, fit_rows, width=width, tables=tables), cosine)
        found = some if found is None else found.union(some)
    last = F.lit(2**63 - 1)
    if found is None:
        named = classes.select("c", (F.col("weight") - 1).alias("n_links"), F.col("rep").alias("component_id"))
    else:
        found = stored(found.groupBy("c", "root").agg(F.sum("links").alias("links")), "embed-links")
        roots = connected(found.select(F.col("c").alias("a"), F.col("root").alias("b")))
        counted = found.groupBy("c").agg(F.sum("links").alias("links"))
        full = classes.join(roots.withColumnRenamed("v", "c"), "c", "left").join(counted, "c", "left")
        full = full.select("c", "rep", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "c").alias("root"))
        least = full.groupBy("root").agg(F.min(F.coalesce("rep", last)).alias("least"))
        named = stored(full.join(least, "root").select("c", "n_links", F.nullif("least", last).alias("component_id")), "embed-components")
    known = rows.where("_good").select("_id", "_c").join(named, F.col("_c") == F.col("c")).select("_id", "n_links", "component_id")
    alone = rows.where("not _good").select("_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"))
    return known.union(alone).select(F.col("_id").alias(id_col), "n_links", "component_id", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))
