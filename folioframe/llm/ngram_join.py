"""Self join of documents on the Jaccard similarity of their word shingles, by PartEnum signatures.

Sets are banded by size, a band reaching from a power of two to the next. Two sets with Jaccard >= p/q differ in at
most d = (|A| + |B|) (q - p) / (q + p) elements. A band's feature domain is cut in two levels: into d // 2 + 1 groups, each
of three partitions (one group of eight where d is 1). Some group then differs in one partition at most, so all but that one agree:
the signatures are, for every group, the subsets of its partitions that leave one out, hashed with the elements there.

How many signatures d differing partitions can spoil is known, so of a set whose d is below its band's only that many
and one more have to be emitted, the smallest in an order that puts those without elements last. A set also emits for
the next band where a partner may lie there. So every pair above the threshold shares a signature; what shares
one is a candidate only.

Equal sets are one class from the start (two hashes of 64 bits say so). Then, over classes:

1. Buckets with the same members count once. In each, parity sketches, whose distance never exceeds the true one, tell which
   members may be linked. A task gives no pairs but a forest: one row at most for each member. Its components are the groups.
2. The texts of a group meet in one tile, where links are decided exactly and again a forest is given. A group too large for
   a tile is first held against its best connected class; then all that didn't link with it is compared with everything, tile
   by tile.

No bucket or group is capped, no pairs are listed, and nothing but counts comes to the driver. Intermediate tables
are in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove, stored, stored_at, unused
from .textsets import as_bytes, mix, shingles

SHINGLE = 5
THRESHOLD = (80, 100)
#: Members of a bucket's tile; classes, or shingles, of a group's tile; partners of a hub that one group of rows holds.
TILE, GROUP_TILE, TILE_SHINGLES, FAN = 4096, 1024, 4_000_000, 64
#: Hubs of many partners, and ids of needed texts, that may be broadcast: 8 and 16 MB. Beyond, both sides are shuffled.
FANS_AT_MOST, NEED_AT_MOST = 1_000_000, 1_000_000
_U = np.uint64
_BAND, _PART, _SECOND = _U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F), _U(0xE7037ED1A0B428DB)
_LAST = 2**63 - 1


def _distance(a: int, b: int, p: int, q: int) -> int:
    return (a + b) * (q - p) // (q + p)


def class_hash(items: np.ndarray, salt: np.uint64 = _PART) -> int:
    """Hash of a set: that of the sum of its mixed elements; 0 for the empty one."""
    return int(mix(mix(items ^ salt).sum(keepdims=True) ^ mix(np.array([len(items)], _U))).view(np.int64)[0]) if len(items) else 0


@lru_cache(64)
def _layout(band: int, p: int, q: int) -> tuple[int, int, np.ndarray]:
    """Groups and partitions a group of a band, and what tells its signatures apart."""
    top = (2 << band) - 1
    most = _distance(top, top, p, q)
    groups, parts = (1, 8) if most <= 1 else (most // 2 + 1, 3)
    with np.errstate(over="ignore"):
        return groups, parts, mix((np.arange(groups * parts, dtype=_U) + _U(1)) * _PART + mix(np.array([band], _U)))


def signatures(items: np.ndarray, p: int = THRESHOLD[0], q: int = THRESHOLD[1]) -> np.ndarray:
    """The signatures of a sorted set of hashes."""
    a = len(items)
    biggest = a * q // p
    if not a or _distance(a, biggest, p, q) == 0:  # only equal sets are similar enough
        return np.zeros(0, np.int64)
    out = []
    element = mix(items + _BAND)
    for band in range(a.bit_length() - 1, biggest.bit_length()):
        d = _distance(a, min((2 << band) - 1, biggest), p, q)
        groups, parts, told = _layout(band, p, q)
        part = (((items >> _U(32)) * _U(groups * parts)) >> _U(32)).astype(np.int64)
        first = np.flatnonzero(np.diff(part, prepend=-1))
        sums, some = np.zeros(groups * parts, _U), np.zeros(groups * parts, np.int8)
        sums[part[first]] = np.add.reduceat(element, first)
        some[part[first]] = 1
        sums, some = sums.reshape(groups, parts), some.reshape(groups, parts)
        sig = mix((sums.sum(axis=1, keepdims=True) - sums).ravel() ^ told)
        empty = (some.sum(axis=1, keepdims=True) == some).ravel()
        # A group's first differing partition spoils all signatures but the one that leaves it out, the second that one.
        emit = min(groups * parts, (parts - 1) * min(d, groups) + max(0, min(d - groups, groups)) + 1)
        full = sig[~empty]
        if len(full) > emit:
            out.append(np.partition(full, emit - 1)[:emit])
        else:
            out += [full, np.sort(sig[empty])[: emit - len(full)]]
    return np.concatenate(out).view(np.int64)


def sketch(items: np.ndarray, bits: int | None = None) -> bytes:
    """Parities of the set's elements in 2 to 4 buckets an element (or ``bits``); a power of two of bytes, so that it can be folded."""
    bits = bits or _bits(2 * len(items))
    counts = np.bincount((items & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(counts.astype(np.uint8), bitorder="little").tobytes()


def _bits(least: int) -> int:
    return max(64, 1 << (least - 1).bit_length())


def _fold(s: np.ndarray, size: int) -> np.ndarray:
    while len(s) > size:
        s = s[: len(s) // 2] ^ s[len(s) // 2 :]
    return s


def _batch(schema: list[tuple[str, pa.DataType]], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema, strict=True)], names=[n for n, _ in schema])


_EDGES = [("a", pa.int64()), ("b", pa.int64())]


def shingled(docs: DataFrame, size: int, p: int, q: int, class_bits: int = 64) -> DataFrame:
    """Of (_id, _th, _text): _id, _th, n, h, h2 for each row; sketch and signatures with the first row of a class in a task.

    h and h2 are the set's two hashes; ``class_bits`` cuts the first one, for tests.
    """
    schema = [("_id", pa.int64()), ("_th", pa.int64()), ("n", pa.int64()), ("h", pa.int64()), ("h2", pa.int64()), ("sketch", pa.binary()), ("sigs", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for b in batches:
            rows: list[list] = [[], [], [], [], []]
            held = 0
            lo = 0
            for i, text in enumerate(b.column(2)):
                items = shingles(as_bytes(text), size)
                h = (class_hash(items) >> (64 - class_bits), class_hash(items, _SECOND))
                new = len(items) > 0 and h not in seen
                sigs = signatures(items, p, q) if new else None
                for column, value in zip(rows, (len(items), *h, sketch(items) if new else None, sigs.tobytes() if new else None), strict=True):
                    column.append(value)
                held += 8 * len(sigs) if new else 0
                if new:
                    seen.add(h)
                if held > 8 << 20 or i == b.num_rows - 1:
                    yield _batch(schema, b.column(0)[lo : i + 1], b.column(1)[lo : i + 1], *rows)
                    rows, held, lo = [[], [], [], [], []], 0, i + 1

    return docs.mapInArrow(run, "_id long, _th long, n long, h long, h2 long, sketch binary, sigs binary")


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 512):
            part = b.slice(at, 512)
            parts = [np.frombuffer(s.as_buffer(), np.int64) for s in part.column(1)]
            if parts:
                yield _batch([("sig", pa.int64()), ("h", pa.int64())], np.concatenate(parts), np.repeat(part.column(0).to_numpy(zero_copy_only=False), [len(x) for x in parts]))


def _runs(batches: Iterator[pa.RecordBatch], columns: tuple[int, ...] = (0,)) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold whole runs of equal values in ``columns``, with the rows where runs begin. Rows must come sorted."""
    rest = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b])])
        first = _starts(t, columns)
        last = int(first[-1])
        if last:
            yield t.slice(0, last), first[:-1]
        rest = t.slice(last)
    if rest is not None:
        yield rest, np.zeros(1, np.int64)


def _starts(t: pa.Table, columns: tuple[int, ...]) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    new[0] = True
    for c in columns:
        x = t.column(c).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (sig, h), sorted: the distinct classes of each signature that has several, with a bucket number.

    Of a signature that reaches over batches only the first and the last class are held, so its size doesn't matter.
    """
    bucket = TaskContext.get().partitionId() << 40
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
    for b in batches:
        if not b.num_rows:
            continue
        new = (b.column(0).to_numpy(), b.column(1).to_numpy(), np.zeros(b.num_rows, bool))
        sig, h, told = (np.concatenate(x) for x in zip(held, new, strict=True))
        begins = np.ones(len(sig), bool)
        begins[1:] = sig[1:] != sig[:-1]
        fresh = begins.copy()
        fresh[1:] |= h[1:] != h[:-1]
        first, run = np.flatnonzero(begins), np.cumsum(begins) - 1
        n = np.bincount(run[fresh], minlength=len(first))
        out = fresh & (n[run] > 1) & ~told
        if out.any():
            yield _batch([("bucket", pa.int64()), ("h", pa.int64())], bucket + run[out], h[out])
        bucket += len(first) - 1
        keep = np.unique([first[-1], len(sig) - 1]) if n[-1] > 1 else first[-1:]
        held = (sig[keep], h[keep], np.full(len(keep), n[-1] > 1))


def _stars(label: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each label the edges from its smallest node to its others."""
    order = np.lexsort((node, label))
    label, node = label[order], node[order]
    begins = np.ones(len(label), bool)
    begins[1:] = label[1:] != label[:-1]
    hub = node[np.flatnonzero(begins)][np.cumsum(begins) - 1]
    other = hub != node
    edges = np.unique(np.stack([hub[other], node[other]], axis=1), axis=0)
    return edges[:, 0], edges[:, 1]


def _others(i: int, label: np.ndarray, tile: np.ndarray, ti: int, tj: int, n: np.ndarray, p: int, q: int) -> np.ndarray:
    """Members that row ``i`` of tile ``ti`` meets in the pair (ti, tj): of another label and a size near enough."""
    at = i + 1 if ti == tj else 0
    fit = label[at:] != label[i]
    if ti != tj:
        fit &= tile == tj
    other = at + np.flatnonzero(fit)
    return other[np.minimum(n[i], n[other]) * q >= np.maximum(n[i], n[other]) * p]


def _candidates(p: int, q: int):
    """Of (bucket, ti, tj, t, h, n, sketch), sorted by the first three: a forest over the members that sketches can't tell apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, first in _runs(batches, (0, 1, 2)):
            ti, tj, tile, h, n = (t.column(c).to_numpy() for c in (1, 2, 3, 4, 5))
            drawn = t.column(6).combine_chunks() if t.num_rows else None
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for lo, hi in zip(first, [*first[1:], t.num_rows], strict=True):
                raw = [np.frombuffer(drawn[i].as_buffer(), np.uint8) for i in range(lo, hi)]
                size = min(map(len, raw))
                s = np.stack([_fold(x, size) for x in raw]).view(np.uint64)
                nn, mine, label = n[lo:hi], tile[lo:hi], np.arange(hi - lo)
                apart = hi - lo
                for i in range(hi - lo):
                    if apart == 1:
                        break
                    if mine[i] != ti[lo]:
                        continue
                    other = _others(i, label, mine, ti[lo], tj[lo], nn, p, q)
                    if len(other):
                        far = np.bitwise_count(s[other] ^ s[i]).sum(axis=1, dtype=np.int64)
                        met = np.unique(label[other[far * (q + p) <= (nn[i] + nn[other]) * (q - p)]])
                        if len(met):
                            label[np.isin(label, met)] = label[i]
                            apart -= len(met)
                if apart < hi - lo:
                    found.append(_stars(label, h[lo:hi]))
            if found:
                yield _batch(_EDGES, *(np.concatenate(x) for x in zip(*found, strict=True)))

    return run


def _linked(a: np.ndarray, b: np.ndarray, p: int, q: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return q * both >= p * (len(a) + len(b) - both)


def _decided(size: int, p: int, q: int):
    """Of (g, ti, tj, t, h, root, text), sorted by the first three and h: a forest over the roots that a link joins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, first in _runs(batches, (0, 1, 2)):
            ti, tj, tile, root = (t.column(c).to_numpy() for c in (1, 2, 3, 5))
            text = t.column(6).combine_chunks()
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for lo, hi in zip(first, [*first[1:], t.num_rows], strict=True):
                items = [shingles(as_bytes(text[i]), size) for i in range(lo, hi)]
                n = np.array([len(x) for x in items])
                bits = _bits(8 * int(n.mean()) + 1)
                s = np.stack([np.frombuffer(sketch(x, bits), np.uint8) for x in items]).view(np.uint64)
                mine = tile[lo:hi]
                _, label = np.unique(root[lo:hi], return_inverse=True)
                for i in np.flatnonzero(mine == ti[lo]):
                    other = _others(i, label, mine, ti[lo], tj[lo], n, p, q)
                    if not len(other):
                        continue
                    far = np.bitwise_count(s[other] ^ s[i]).sum(axis=1, dtype=np.int64)
                    near = far * (q + p) <= (n[i] + n[other]) * (q - p)
                    other = other[near][np.argsort(far[near], kind="stable")]
                    while len(other):
                        j, other = other[0], other[1:]
                        if _linked(items[i], items[j], p, q):
                            label[label == label[j]] = label[i]
                            other = other[label[other] != label[i]]
                found.append(_stars(label, root[lo:hi]))
            if found:
                yield _batch(_EDGES, *(np.concatenate(x) for x in zip(*found, strict=True)))

    return run


def _checked(size: int, p: int, q: int):
    """Of (a, slot, hub, h, text), sorted so that each slot's hub comes first: the pairs (a, h) above the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hub = None, None
        for b in batches:
            a, slot, is_hub, h = (b.column(c).to_pylist() for c in range(4))
            out: list[tuple[int, int]] = []
            for i in range(b.num_rows):
                items = shingles(as_bytes(b.column(4)[i]), size)
                if is_hub[i]:
                    at, hub = (a[i], slot[i]), items
                elif at == (a[i], slot[i]) and _linked(hub, items, p, q):
                    out.append((a[i], h[i]))
            if out:
                yield _batch(_EDGES, *zip(*out, strict=True))

    return run


def _texts(rows: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """``rows`` (with h) and ``_text``, one text of each class."""
    rows = stored(rows.join(classes.select("h", "rep", "rep_th"), "h"), "join-rows")
    need = rows.select(F.col("rep").alias("_k"), F.col("rep_th").alias("_th")).distinct()
    if need.limit(NEED_AT_MOST + 1).count() <= NEED_AT_MOST:
        need = F.broadcast(need)
    # Texts that no row needs aren't shuffled, and repeated ones only once.
    texts = texts.join(need, ["_k", "_th"], "left_semi").groupBy("_k", "_th").agg(F.first("_text").alias("_text"))
    return rows.withColumnsRenamed({"rep": "_k", "rep_th": "_th"}).join(texts, ["_k", "_th"]).drop("_k", "_th")


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, size: int, p: int, q: int) -> DataFrame:
    """The pairs (a, b) of classes whose texts really are similar enough."""
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fans = stored(pairs.groupBy("a").agg(F.ceil(F.count("*") / FAN).alias("fan")).where("fan > 1"), "join-fans")
    # At most one hub in FAN pairs; beyond a million of them the join is left to Spark.
    fans = F.broadcast(fans) if fans.limit(FANS_AT_MOST + 1).count() <= FANS_AT_MOST else fans
    pairs = pairs.join(fans, "a", "left").withColumn("slot", F.pmod(F.xxhash64("b"), F.coalesce("fan", F.lit(1)))).drop("fan")
    rows = pairs.select("a", "slot", F.lit(False).alias("hub"), F.col("b").alias("h")).union(pairs.select("a", "slot", F.lit(True).alias("hub"), F.col("a").alias("h")).distinct())
    rows = _texts(rows, classes, texts).select("a", "slot", "hub", "h", "_text").repartition(n, "a", "slot").sortWithinPartitions("a", "slot", F.col("hub").desc(), "h")
    return rows.mapInArrow(_checked(size, p, q), "a long, b long")


def connected(edges: DataFrame) -> DataFrame:
    """(v, root) for every end of the edges (a, b): smallest label of the neighbourhood, then pointers are doubled; rounds grow with the logarithm of the components' width."""
    both = stored(edges.select(F.inline(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("w")), F.struct(F.col("b").alias("v"), F.col("a").alias("w"))))).where("v <> w").distinct(), "join-edges")
    labels = stored(both.groupBy("v").agg(F.least(F.col("v"), F.min("w")).alias("root")), "join-labels")
    while True:
        near = both.join(labels.select(F.col("v").alias("w"), "root"), "w").groupBy("v").agg(F.min("root").alias("least"))
        step = labels.join(near, "v").select("v", F.least("root", "least").alias("new"), "root")
        up = step.select(F.col("v").alias("_v"), F.col("new").alias("_up"))
        new = stored(step.join(up, F.col("new") == F.col("_v"), "left").select("v", F.least("new", F.coalesce("_up", "new")).alias("root"), (F.least("new", F.coalesce("_up", "new")) != F.col("root")).alias("moved")), "join-labels")
        labels = new.drop("moved")
        if new.where("moved").isEmpty():
            return labels


def _tiled(rows: DataFrame, key: str, tile: str = "t") -> DataFrame:
    """Rows of (key, t, tiles) once for each pair of tiles (ti, tj) that theirs is part of."""
    rows = rows.withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))).drop("tiles")
    return rows.withColumns({"ti": F.least(tile, "_o"), "tj": F.greatest(tile, "_o")}).drop("_o")


def _groups(members: DataFrame, sets: DataFrame, p: int, q: int) -> DataFrame:
    """(h, g): the classes that sketches connect, inside buckets, with others."""
    n_parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Near copies share many buckets with the same members: one of these stands for all.
    per = members.groupBy("bucket").agg(F.bit_xor(F.xxhash64("h")).alias("s"), F.bit_xor(F.xxhash64("h", F.lit(1))).alias("s2"), F.count("*").alias("c"))
    once = stored(per.groupBy("s", "s2", "c").agg(F.min("bucket").alias("bucket")).select("bucket", "c"), "join-once")
    rows = members.join(once, "bucket").withColumn("tiles", F.ceil(F.col("c") / TILE)).withColumn("t", F.pmod(F.xxhash64("h"), "tiles"))
    drawn = sets.where("sketch is not null").select("h", "n", "sketch").dropDuplicates(["h"])
    rows = _tiled(rows, "bucket").join(drawn, "h").select("bucket", "ti", "tj", "t", "h", "n", "sketch")
    rows = rows.repartition(n_parts, "bucket", "ti", "tj").sortWithinPartitions("bucket", "ti", "tj")
    return connected(rows.mapInArrow(_candidates(p, q), "a long, b long")).select(F.col("v").alias("h"), F.col("root").alias("g"))


def _links(groups: DataFrame, members: DataFrame, classes: DataFrame, texts: DataFrame, size: int, p: int, q: int) -> DataFrame:
    """(v, root) of the classes that links join with others, decided exactly inside each group."""
    n_parts = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = stored(groups.join(classes.select("h", "n"), "h"), "join-groups")
    tiles = lambda count, n: F.greatest(F.ceil(count / GROUP_TILE), F.ceil(n / TILE_SHINGLES))
    sizes = stored(groups.groupBy("g").agg(tiles(F.count("*"), F.sum("n")).alias("tiles")), "join-sizes")
    small = groups.join(sizes.where("tiles = 1"), "g").select("g", F.lit(0).cast("long").alias("ti"), F.lit(0).cast("long").alias("tj"), F.lit(0).cast("long").alias("t"), "h", F.col("h").alias("root"))
    large = sizes.where("tiles > 1").select("g")
    rows, stars = small, None
    if not large.isEmpty():
        large = stored(groups.join(large, "g"), "join-large")
        met = large.join(members.groupBy("h").agg(F.count("*").alias("met")), "h")
        hubs = stored(met.groupBy("g").agg(F.max(F.struct("met", "h")).alias("x")).select("g", F.col("x.h").alias("hub")), "join-hubs")
        stars = stored(_verified(large.join(hubs, "g").where("h <> hub").select(F.col("hub").alias("a"), F.col("h").alias("b")), classes, texts, size, p, q), "join-stars")
        own = large.join(hubs, "g").join(stars.select(F.col("b").alias("h"), F.lit(True).alias("by_hub")), "h", "left")
        own = own.select("g", "h", "n", "hub", (F.coalesce("by_hub", F.lit(False)) | (F.col("h") == F.col("hub"))).alias("inside"))
        own = stored(own, "join-inside")
        count = lambda c: tiles(F.count(F.when(c, 1)), F.sum(F.when(c, F.col("n")).otherwise(0)))
        parts = own.groupBy("g").agg(count(~F.col("inside")).alias("out_tiles"), count(F.col("inside")).alias("in_tiles")).where("out_tiles > 0")
        own = own.join(stored(parts, "join-parts"), "g")
        # Tiles of what the hub doesn't link come first and meet all tiles; those of what it links meet only these.
        t = F.when(F.col("inside"), F.col("out_tiles") + F.pmod(F.xxhash64("h"), "in_tiles")).otherwise(F.pmod(F.xxhash64("h"), "out_tiles"))
        own = own.select("g", "h", F.when(F.col("inside"), F.col("hub")).otherwise(F.col("h")).alias("root"), t.alias("t"), F.when(F.col("inside"), F.col("out_tiles")).otherwise(F.col("out_tiles") + F.col("in_tiles")).alias("tiles"))
        rows = rows.unionByName(_tiled(own, "g"))
    rows = _texts(rows, classes, texts).select("g", "ti", "tj", "t", "h", "root", "_text")
    edges = rows.repartition(n_parts, "g", "ti", "tj").sortWithinPartitions("g", "ti", "tj", "h").mapInArrow(_decided(size, p, q), "a long, b long")
    return connected(edges if stars is None else edges.union(stars))


def _told_apart(sets: DataFrame) -> DataFrame:
    """``sets`` with h changed where two sets have the same one: h2 tells them apart."""
    clash = sets.where("n > 0").groupBy("h").agg(F.min("h2").alias("lo"), F.max("h2").alias("hi")).where("lo <> hi").select("h", F.lit(True).alias("clash"))
    clash = stored(clash, "join-clash")
    if clash.isEmpty():
        return sets
    return stored(sets.join(clash, "h", "left").withColumn("h", F.when(F.col("clash"), F.xxhash64("h", "h2")).otherwise(F.col("h"))).select(sets.columns), "join-sets")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD, class_bits: int = 64) -> DataFrame:
    """One row a row of ``docs``: its id, n_shingles, component_id (smallest id reachable by links), and ``_th``, ``first``.

    ``first`` marks one (id, hash of text ``_th``) of each component. A null, empty or blank text has no shingles and is
    linked with nothing: its component is its own id. Repeated rows are copies of each other; rows that share an id
    but not their text are compared by their texts; a null id counts as larger than any other. A text of any length is
    one set. Other columns aren't read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    p, q = threshold
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(docs[id_col].cast("long").alias("_id"), F.xxhash64(text).alias("_th"), text.alias("_text"))
    texts = rows.select(F.coalesce("_id", F.lit(_LAST)).alias("_k"), "_th", "_text")
    sets, sets_at = stored_at(shingled(rows, shingle, p, q, class_bits), "join-sets")
    sets = _told_apart(sets)
    ids = stored(sets.select("_id", "_th", "n", "h"), "join-ids")
    least = F.min(F.struct(F.coalesce("_id", F.lit(_LAST)).alias("k"), F.col("_id").isNull().alias("none"), F.col("_th").alias("th"))).alias("r")
    classes = stored(ids.where("n > 0").groupBy("h").agg(least, F.first("n").alias("n")).select("h", "n", "r", F.col("r.k").alias("rep"), F.col("r.th").alias("rep_th")), "join-classes")
    sigs = sets.where(F.octet_length("sigs") > 0).select("h", "sigs").mapInArrow(_exploded, "sig long, h long")
    members, members_at = stored_at(sigs.repartition(n_parts, "sig").sortWithinPartitions("sig", "h").mapInArrow(_members, "bucket long, h long"), "join-buckets")
    groups = _groups(members, sets, p, q)
    remove(spark, sets_at)
    ends = _links(groups, members, classes, texts, shingle, p, q)
    remove(spark, members_at)
    full = stored(classes.join(ends.withColumnRenamed("v", "h"), "h", "left").select("h", "r", F.coalesce("root", "h").alias("root")), "join-full")
    firsts = stored(full.groupBy("root").agg(F.min("r").alias("c")), "join-least")
    named = full.join(firsts, "root").select("h", F.when(~F.col("c.none"), F.col("c.k")).alias("component_id"), F.col("c.th").alias("_first"))
    known = ids.where("n > 0").join(stored(named, "join-components"), "h")
    first = F.col("_id").eqNullSafe(F.col("component_id")) & (F.col("_th") == F.col("_first"))
    known = known.select("_id", "n", "component_id", "_th", first.alias("first"))
    known = known.unionByName(ids.where("n = 0").select("_id", "n", F.col("_id").alias("component_id"), "_th", F.lit(True).alias("first")))
    return known.withColumnsRenamed({"_id": id_col, "n": "n_shingles"})


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id; documents without words all stay but for repeated rows.

    All columns are carried, whatever their names and types; of rows with equal id and text, any one stays.
    """
    k, th = unused(docs.columns, "id"), unused(docs.columns, "th")
    kept = components(docs, id_col, text_col, **options).where("first").select(F.coalesce(id_col, F.lit(_LAST)).alias(k), F.col(id_col).isNull().alias(f"{k}n"), F.col("_th").alias(th)).distinct()
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    marked = docs.withColumns({k: F.coalesce(docs[id_col].cast("long"), F.lit(_LAST)), f"{k}n": docs[id_col].isNull(), th: F.xxhash64(text)})
    return marked.join(kept, [k, f"{k}n", th]).dropDuplicates([k, f"{k}n", th]).select(*docs.columns)
