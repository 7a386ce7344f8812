"""Frequent n-grams level by level: an n-gram is looked at only where both its (n-1)-grams are frequent.

Clauses are stored once with their words' hashes. A level's pass reads the hashes alone, makes the hash of each n-gram whose two
parts the last level's filter admits, and counts hashes in the task before Spark sums them: by their first ``ADDRESS`` digits, sorted,
as differences of four bytes of which two are nearly always 0, so that the shuffle moves a few bytes an n-gram. What is frequent
becomes the next filter: bits addressed by a hash's first digits, built in slices by Spark and of bounded size. A short address or a
filter that is too small admits more and loses nothing. The last pass writes out the words of what is left, once a block of many pages
where it can, and Spark counts those exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import pieces, spread
from ..workspace import tightly as stored

#: Bits of a filter: at least, a frequent gram, and at most (32 MB).
LEAST_BITS, BITS_A_GRAM, MOST_BITS = 16, 16, 28
#: Digits by which hashes are counted, and the first of them that name a slice; words or rows that a task holds before it counts, and half of its hashes.
ADDRESS, SLICE, HELD = 36, 10, 1 << 20
#: Addresses of a slice that are held one by one; beyond, a slice has a counter for each that may be.
SPARSE = 1 << 22
_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


class Filter:
    """Membership by the first bits of a hash: no misses, some false hits."""

    def __init__(self, power: int, bits: np.ndarray):
        self.power, self.bits = power, bits

    def __call__(self, h: np.ndarray) -> np.ndarray:
        at = h >> _U(64 - self.power)
        return (self.bits[at >> _U(3)] >> (at & _U(7)).astype(np.uint8)) & np.uint8(1) != 0


def _pieces(batches: Iterator[pa.RecordBatch], lists: str) -> Iterator[pa.RecordBatch]:
    """Batches of long texts in pieces, by the words that the column ``lists`` holds."""
    for b in batches:
        for p in pieces(pc.list_value_length(b.column(lists)).to_numpy(zero_copy_only=False)):
            yield b.slice(p.start, p.stop - p.start)


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words' hashes of a batch, where each word's clause ends, and each clause's first place."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    return lists.flatten().to_numpy(zero_copy_only=False).view(_U), np.repeat(offsets[1:], np.diff(offsets)), offsets


def _hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n-gram that begins at each place."""
    h = _mixed(words)
    for k in range(2, n + 1):
        h = _longer(h, words, k)
    return h


def _longer(h: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n-gram, of those one word shorter."""
    return _mixed(h[:-1] * _U(0x9E3779B97F4A7C15) + words[n - 1 :]) if len(h) > 1 else h[:0]


def _packed(hashes: list[np.ndarray]) -> pa.RecordBatch:
    """(slice, packed): the addresses of hashes and how often each comes, a row a slice."""
    at, c = np.unique(np.concatenate(hashes) >> _U(64 - ADDRESS), return_counts=True)
    low = (at & _U((1 << (ADDRESS - SLICE)) - 1)).astype(np.int64)
    ends = np.searchsorted(at, np.arange(1, (1 << SLICE) + 1, dtype=_U) << _U(ADDRESS - SLICE))
    c, slices, rows, begin = np.minimum(c, 65535).astype(np.uint16), [], [], 0
    for s, end in enumerate(ends.tolist()):
        if end > begin:
            step = np.diff(low[begin:end], prepend=0)
            slices.append(s)
            rows.append(b"".join(x.astype(np.uint16).tobytes() for x in (step & 65535, step >> 16, c[begin:end])))
        begin = end
    return pa.RecordBatch.from_arrays([pa.array(slices, pa.int32()), pa.array(rows, pa.binary())], names=["slice", "packed"])


def _counting(n: int, admitted: Filter | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in _pieces(batches, "hashes"):
            words, end, _ = _flat(b.column(0))
            shorter = _hashes(words, n - 1) if admitted is not None else None
            h = _hashes(words, n) if shorter is None else _longer(shorter, words, n)
            good = np.arange(len(h)) + n <= end[: len(h)]
            if shorter is not None and len(h):
                part = admitted(shorter)
                good &= part[: len(h)] & part[1 : len(h) + 1]
            held.append(h[good])
            size += len(held[-1])
            if size > 2 * HELD:
                yield _packed(held)
                held, size = [], 0
        if size:
            yield _packed(held)

    return run


def _given(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            yield _packed([b.column(0).to_numpy().view(_U)])


def _merging(min_count: int):
    """Of packed rows in order of their slices: (slice, n, low), the addresses that come ``min_count`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size, dense = -1, [], 0, None

        def summed() -> tuple[np.ndarray, np.ndarray]:
            low, place = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            return low, np.bincount(place, np.concatenate([c for _, c in held]), len(low)).astype(np.int64)

        def row() -> pa.RecordBatch:
            low = np.flatnonzero(dense >= min_count) if dense is not None else np.compress(*(lambda low, c: (c >= min_count, low))(*summed()))
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([len(low)], pa.int64()), pa.array([low.astype(np.uint32).tobytes()], pa.binary())], names=["slice", "n", "low"])

        for b in batches:
            for s, packed in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if s != now:
                    if now >= 0:
                        yield row()
                    now, held, size, dense = s, [], 0, None
                few, many, c = np.frombuffer(packed.as_buffer(), np.uint16).reshape(3, -1).astype(np.int64)
                low = np.cumsum(few + (many << 16))
                if dense is not None:
                    dense[low] = np.minimum(dense[low] + c, 65535)
                    continue
                held.append((low, c))
                size += len(low)
                if size > SPARSE:
                    held = [summed()]
                    size = len(held[0][0])
                    if size > SPARSE // 2:
                        dense = np.zeros(1 << (ADDRESS - SLICE), np.uint16)
                        dense[held[0][0]] = np.minimum(held[0][1], 65535)
                        held = []
        if now >= 0:
            yield row()

    return run


def _merged(packed: DataFrame, min_count: int) -> DataFrame:
    """(slice, n, low) of packed rows, stored."""
    x = packed.repartition("slice").sortWithinPartitions("slice").mapInArrow(_merging(min(min_count, 65535)), "slice int, n long, low binary")
    return stored(x, "grams")


def _bits(power: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, low in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                at = (np.frombuffer(low.as_buffer(), np.uint32).astype(np.int64) + (s << (ADDRESS - SLICE))) >> (ADDRESS - power)
                if len(at):
                    first = int(at[0]) >> 3
                    bits = np.zeros(8 * ((int(at[-1]) >> 3) - first + 1), bool)
                    bits[at - 8 * first] = True
                    yield pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], names=["first", "bits"])

    return run


def _filter(merged: DataFrame) -> Filter | None:
    n = merged.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if not n:
        return None
    power = min(MOST_BITS, max(LEAST_BITS, (BITS_A_GRAM * n - 1).bit_length()))
    bits = np.zeros(1 << (power - 3), np.uint8)
    for r in merged.select("slice", "low").mapInArrow(_bits(power), "first long, bits binary").toLocalIterator():
        piece = np.frombuffer(r.bits, np.uint8)
        bits[r.first : r.first + len(piece)] |= piece
    return Filter(power, bits)


def filter_of(frequent: DataFrame) -> Filter | None:
    """The filter of a table's hashes ``h``; None if it is empty. A slice's piece of the filter reaches the driver at a time."""
    return _filter(_merged(frequent.select("h").mapInArrow(_given, "slice int, packed binary"), 1))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (page's hash, words): the hashes of pages, once a run of rows, twice if the run is of more than ``HELD`` words."""
    last, words = None, 0
    for b in batches:
        h, n = b.column(0).to_numpy(), b.column(1).to_numpy()
        begins = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.array([], np.int64)
        out = []
        for at, size in zip(begins.tolist(), np.add.reduceat(n, begins).tolist() if len(h) else [], strict=True):
            new = last is None or h[at] != last
            before = 0 if new else words
            last, words = h[at], before + size
            out += [last] * (int(new) + int(before <= HELD < words))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["h"])


def _blocks(apart: Filter | None, block):
    """Of batches (page, ..., page's hash, hashes): what ``block`` makes of each run of whole pages; of pages ``apart`` a run may hold a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            b = b.rename_columns(["page", *b.schema.names[1:]])
            h = b.column("page_hash").to_numpy()
            # A block ends where a page does, or within one that stands apart.
            cuts = np.flatnonzero(np.r_[False, (h[1:] != h[:-1]) | (apart(h[1:].view(_U)) if apart else False)]) if len(h) else []
            last = held[-1].column("page_hash")[-1].as_py() if held else None
            if size > HELD and (h[0] != last or len(cuts)):
                at = 0 if h[0] != last else int(cuts[0])
                if at:
                    held.append(b.slice(0, at))
                yield from block(held)
                held, size, b = [], 0, b.slice(at)
            if b.num_rows:
                held.append(b)
                size += pc.sum(pc.list_value_length(b.column("hashes"))).as_py()
        if held:
            yield from block(held)

    return run


def _writing(filters: dict[int, Filter], apart: Filter | None, shown: bool):
    """Of (page, pos, tokens, good, hashes, page's hash, surfaces if shown): (phrase, n, apart, page, c, pages, pos, at, example, slice) of
    what the filters admit, once a block of pages and phrase. Pages of ``apart``, whose rows may come elsewhere too, have rows of their own.
    """

    def block(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        code = t.column("page").combine_chunks().dictionary_encode(null_encoding="encode")
        rank = np.empty(len(code.dictionary), np.int64)
        rank[pc.sort_indices(code.dictionary, null_placement="at_start").to_numpy()] = np.arange(len(rank))
        pages = rank[code.indices.to_numpy(zero_copy_only=False)]
        order = np.lexsort((t.column("pos").to_numpy(), pages))
        t, pages = t.take(pa.array(order)).combine_chunks(), pages[order]
        one = lambda name: t.column(name).combine_chunks()
        words, end, first = _flat(one("hashes"))
        good, tokens = one("good").flatten().to_numpy(zero_copy_only=False).astype(bool), one("tokens").flatten()
        surfaces = one("surfaces").flatten() if shown else None
        alone = apart(one("page_hash").to_numpy().view(_U)) if apart else np.zeros(len(pages), bool)
        clause = np.repeat(np.arange(t.num_rows), np.diff(first))
        pair, h, reached = _hashes(words, 2), _mixed(words), 1
        for n, admits in filters.items():
            for reached in range(reached + 1, n + 1):
                h = _longer(h, words, reached)
            size = len(h)
            if not size:
                continue
            at = np.flatnonzero((np.arange(size) + n <= end[:size]) & good[:size] & good[n - 1 : n - 1 + size] & admits(h))
            if not len(at):
                continue
            at = at[np.argsort(h[at], kind="stable")]
            of = clause[at]
            moved = pages[of][1:] != pages[of][:-1]
            new = moved & (alone[of][1:] | alone[of][:-1])
            for k in range(n):
                new |= words[at + k][1:] != words[at + k][:-1]
            begins = np.flatnonzero(np.r_[True, new])
            count, spread_over = np.diff(np.r_[begins, len(at)]), np.add.reduceat(np.r_[True, moved | new], begins)
            at, of = at[begins], of[begins]
            text = lambda x: pc.binary_join_element_wise(*[x.take(pa.array(at + k)) for k in range(n)], " ")  # noqa: B023, E731
            phrase = text(tokens)
            part = ((h if n == 1 else pair)[at] >> _U(64 - SLICE)).astype(np.int32)
            cols = [phrase, pa.array(np.full(len(at), n, np.int32)), pa.array(alone[of]), one("page").take(pa.array(of)), pa.array(count), pa.array(spread_over.astype(np.int64)), one("pos").take(pa.array(of)), pa.array((at - first[of]).astype(np.int32)), text(surfaces) if shown else pa.nulls(len(at), pa.string()), pa.array(part)]
            # In order of the phrases, so that neighbours begin alike and compress.
            found = pa.RecordBatch.from_arrays(cols, names=["phrase", "n", "apart", "page", "c", "pages", "pos", "at", "example", "slice"]).take(pc.sort_indices(phrase))
            for i in range(0, found.num_rows, 100_000):
                yield found.slice(i, 100_000)

    return _blocks(apart, block)


def _word_rows(admits: Filter, apart: Filter | None):
    """Of (page, tokens, upper, hashes, page's hash): (word, apart, page, c, pages, inner, capital) of what the filter admits, once a block
    of pages and word: how often it comes, and does so within a clause, and there with a capital. Pages of ``apart`` have rows of their own.
    """

    def block(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).combine_chunks()
        one = lambda name: t.column(name).combine_chunks()
        words, _, first = _flat(one("hashes"))
        upper, tokens = one("upper").flatten().to_numpy(zero_copy_only=False).astype(bool), one("tokens").flatten()
        page = one("page").dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        alone = apart(one("page_hash").to_numpy().view(_U)) if apart else np.zeros(t.num_rows, bool)
        clause = np.repeat(np.arange(t.num_rows), np.diff(first))
        at = np.flatnonzero(admits(_hashes(words, 1)))
        if not len(at):
            return
        at = at[np.lexsort((page[clause[at]], words[at]))]
        of = clause[at]
        new, moved = words[at][1:] != words[at][:-1], page[of][1:] != page[of][:-1]
        begins = np.flatnonzero(np.r_[True, new | moved & (alone[of][1:] | alone[of][:-1])])
        inner = at > first[of]
        sums = [np.add.reduceat(x.astype(np.int64), begins) for x in (np.ones(len(at), bool), np.r_[True, new | moved], inner, inner & upper[at])]
        word, of = tokens.take(pa.array(at[begins])), of[begins]
        found = pa.RecordBatch.from_arrays([word, pa.array(alone[of]), one("page").take(pa.array(of)), *map(pa.array, sums)], names=["word", "apart", "page", "c", "pages", "inner", "capital"]).take(pc.sort_indices(word))
        for i in range(0, found.num_rows, 100_000):
            yield found.slice(i, 100_000)

    return _blocks(apart, block)


def _packing(batches: Iterator[pa.RecordBatch], shown: bool = True) -> Iterator[pa.RecordBatch]:
    """Of rows of :func:`_writing`: (slice, packed), once many rows and slice; an example that is the phrase itself is left out, and all places if none are ``shown``."""

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        t = t.take(pc.sort_indices(t, [("slice", "ascending"), ("phrase", "ascending")])).combine_chunks()
        if shown:
            same = pc.fill_null(pc.equal(t.column("example"), t.column("phrase")), False)
            t = t.set_column(t.schema.get_field_index("example"), "example", pc.if_else(same, pa.scalar(None, pa.string()), t.column("example")))
        else:
            page = t.column("page")
            t = t.set_column(t.schema.get_field_index("page"), "page", pc.if_else(t.column("apart"), page, pa.scalar(None, page.type))).drop_columns(["pos", "at", "example"])
        s = t.column("slice").to_numpy()
        cuts = [0, *(np.flatnonzero(s[1:] != s[:-1]) + 1).tolist(), len(s)]
        rows = [_shut(t.slice(i, k - i).drop_columns("slice")) for i, k in zip(cuts, cuts[1:], strict=False)]
        return pa.RecordBatch.from_arrays([pa.array(s[cuts[:-1]], pa.int32()), pa.array(rows, pa.binary())], names=["slice", "packed"])

    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size > HELD:
            yield block(held)
            held, size = [], 0
    if size:
        yield block(held)


def _summing(min_count: int, shown: bool = True):
    """Of packed rows of :func:`_writing`: (phrase, n, count, pages, example) of what comes ``min_count`` times; the example is the first by page, clause and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _slices(batches):
            t = t.take(pc.sort_indices(t, [(k, "ascending") for k in ("phrase", "page", *(["pos", "at"] if shown else []))], null_placement="at_start")).combine_chunks()
            one = lambda name: t.column(name).combine_chunks()  # noqa: B023, E731
            code, page = (one(k).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False) for k in ("phrase", "page"))
            new = np.r_[True, code[1:] != code[:-1]]
            begins = np.flatnonzero(new)
            alone, c = one("apart").to_numpy(zero_copy_only=False), np.add.reduceat(one("c").to_numpy(), begins)
            # Rows of a page that stands apart are of that page alone, and stand together.
            pages = np.add.reduceat(np.where(alone, new | np.r_[True, page[1:] != page[:-1]], one("pages").to_numpy()), begins)
            often = c >= min_count
            first = pa.array(begins[often])
            phrase = one("phrase").take(first)
            example = pc.coalesce(one("example").take(first), phrase) if shown else pa.nulls(len(first), pa.string())
            yield pa.RecordBatch.from_arrays([phrase, one("n").take(first), pa.array(c[often]), pa.array(pages[often]), example], names=["phrase", "n", "count", "pages", "example"])

    return run


def prepared(clauses: DataFrame, page: str, stopwords: list[str]) -> DataFrame:
    """Clauses (page, pos, tokens, surfaces if there are any) stored, with ``good``, which words are no stopwords, ``hashes``, and the page's; null and empty clauses are left out.

    Tokens are the surfaces in lower case. What can be made of the words is made again when they are read: stored it takes three times as much.
    """
    shown = "surfaces" in clauses.columns
    x = spread(clauses.where(F.size("tokens") > 0)).select(page, F.col("pos").cast("int").alias("pos"), "surfaces" if shown else "tokens")
    x = stored(x, "clauses")
    if shown:
        x = x.withColumns({"tokens": F.transform("surfaces", F.lower), "upper": F.transform("surfaces", lambda w: w.rlike(r"^\p{Lu}"))})
    return x.withColumns({"good": F.transform("tokens", lambda w: ~w.isin(*stopwords)), "hashes": F.transform("tokens", lambda w: F.xxhash64(w)), "page_hash": F.xxhash64(page)})


def levels(x: DataFrame, most: int = 6, min_count: int = 3) -> tuple[dict[int, Filter], Filter | None]:
    """Of :func:`prepared` clauses: by length, filters of n-grams seen ``min_count`` times; a filter of the pages whose rows don't stand together, or fill more than a block."""
    filters, admitted = {}, None
    for n in range(1, most + 1):
        admitted = _filter(_merged(x.select("hashes").mapInArrow(_counting(n, admitted), "slice int, packed binary"), min_count))
        if admitted is None:
            break
        filters[n] = admitted
    # Few pages, unless rows were dealt out.
    runs = x.select("page_hash", F.size("tokens").alias("n")).mapInArrow(_runs, "h long").groupBy("h").count().where("count > 1")
    return filters, filter_of(runs)


def frequent_words(x: DataFrame, min_count: int, found: tuple[dict[int, Filter], Filter | None]) -> DataFrame:
    """(word, count, pages, inner, capital) of :func:`prepared` clauses with surfaces: words seen ``min_count`` times, how often they are so within a clause, and there with a capital."""
    page, kind = x.columns[0], x.schema[0].dataType.simpleString()
    if 1 not in found[0]:
        return x.sparkSession.createDataFrame([], "word string, count long, pages long, inner long, capital long")
    shared = x.sparkSession.sparkContext.broadcast((found[0][1], found[1]))
    rows = x.select(page, "tokens", "upper", "hashes", "page_hash").mapInArrow(lambda batches: _word_rows(*shared.value)(batches), f"word string, apart boolean, page {kind}, c long, pages long, inner long, capital long")
    own, sums = F.when(F.col("apart"), F.col("page")), [F.sum(k).alias(k) for k in ("inner", "capital")]
    each = rows.repartition("word").groupBy("word", "apart", own.alias("own")).agg(F.sum("c").alias("c"), F.when(F.col("apart"), 1).otherwise(F.sum("pages")).alias("pages"), *sums)
    return each.groupBy("word").agg(F.sum("c").alias("count"), F.sum("pages").alias("pages"), *sums).where(F.col("count") >= min_count)


def frequent_grams(x: DataFrame, least: int = 2, most: int = 6, min_count: int = 3, found: tuple[dict[int, Filter], Filter | None] | None = None) -> DataFrame:
    """(phrase, n, count, pages, and example if there are surfaces) of :func:`prepared` clauses: n-grams seen ``min_count`` times, no stopword at their ends.

    ``example`` is the first occurrence as written, by page, clause and place. ``found`` is what :func:`levels` gives for the same clauses.
    """
    filters, apart = found or levels(x, most, min_count)
    page, shown = x.columns[0], "surfaces" in x.columns
    shared = x.sparkSession.sparkContext.broadcast(({n: f for n, f in filters.items() if n >= least}, apart))  # at most 2^28 bits a level
    columns = [page, "pos", "tokens", "good", "hashes", "page_hash", *(["surfaces"] if shown else [])]
    packed = x.select(*columns).mapInArrow(lambda batches: _packing(_writing(*shared.value, shown)(batches), shown), "slice int, packed binary")
    counted = packed.repartition("slice").sortWithinPartitions("slice").mapInArrow(_summing(min_count, shown), "phrase string, n int, count long, pages long, example string")
    return counted if shown else counted.drop("example")


def first_examples(x: DataFrame, phrases: DataFrame) -> DataFrame:
    """(phrase, example) of a few phrases: how the first of each by page, clause and place is written in :func:`prepared` clauses."""
    numbers: dict[int, list] = {}
    for r in phrases.select(F.transform(F.split("phrase", " "), lambda w: F.xxhash64(w)).alias("h")).collect():
        numbers.setdefault(len(r.h), []).append(_hashes(np.array(r.h, np.int64).view(_U), len(r.h))[0])
    filters = {}
    for n, h in sorted(numbers.items()):
        bits = np.zeros(1 << LEAST_BITS, bool)
        bits[np.array(h, _U) >> _U(64 - LEAST_BITS)] = True
        filters[n] = Filter(LEAST_BITS, np.packbits(bits, bitorder="little"))
    page, kind = x.columns[0], x.schema[0].dataType.simpleString()
    rows = x.select(page, "pos", "tokens", "good", "hashes", "page_hash", "surfaces").mapInArrow(lambda batches: _writing(filters, None, True)(batches), f"phrase string, n int, apart boolean, page {kind}, c long, pages long, pos int, at int, example string, slice int")
    first = rows.groupBy("phrase").agg(F.min(F.struct("page", "pos", "at", "example")).alias("e"))
    return phrases.select("phrase").join(first.select("phrase", F.col("e.example").alias("example")), "phrase")


def _reach(filters: dict[int, Filter | None], words: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Words of the longest n-gram from each place on that its filter admits, as all shorter ones there are; 1 where no pair is."""
    places, reach = np.arange(len(words)), np.ones(len(words), np.int8)
    good, h = np.ones(len(words), bool), _mixed(words)
    for n, admits in filters.items():
        h = _longer(h, words, n)
        size = len(h)
        if not admits or not size:
            break
        good = good[:size] & (places[:size] + n <= end[:size]) & admits(h)
        reach[:size][good] = n
    return reach


def _alone(filters: dict[int, Filter | None]):
    """Of (tokens, hashes): (phrase, count) of the longest n-grams that come once, as no filter admits them, and of such shorter ones that are a whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _pieces(batches, "hashes"):
            words, end, first = _flat(b.column(1))
            tokens, places, most = b.column(0).flatten(), np.arange(len(words)), max(filters)
            reach, begin = _reach(filters, words, end), np.repeat(first[:-1], np.diff(first))
            for n in filters:
                at = np.flatnonzero((reach < n) & ((places + n <= end) if n == most else (places == begin) & (places + n == end)))
                phrase = pc.binary_join_element_wise(*[tokens.take(pa.array(at + k)) for k in range(n)], " ")
                yield pa.RecordBatch.from_arrays([phrase, pa.array(np.ones(len(at), np.int64))], names=["phrase", "count"])

    return run


def _windows(filters: dict[int, Filter | None]):
    """Of (tokens, hashes): (slice, packed), once a block of texts and slice: the longest admitted n-gram from each place on, in order.

    Beside each stand how often it comes, the word before it, if the triple with that word is admitted, and whether it is a whole text.
    All n-grams that begin with the same pair are in one slice.
    """

    def block(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).combine_chunks()
        words, end, first = _flat(t.column("hashes").combine_chunks())
        tokens = t.column("tokens").combine_chunks().flatten()
        reach, begin = _reach(filters, words, end), np.repeat(first[:-1], np.diff(first))
        pair, found = _hashes(words, 2) >> _U(64 - SLICE), []
        for n in filters:
            at = np.flatnonzero(reach == n)
            if not len(at):
                continue
            before = np.where((at > begin[at]) & (reach[np.maximum(at - 1, 0)] > 2), at - 1, -1)
            cols = {
                "slice": pa.array(pair[at].astype(np.int32)),
                "window": pc.binary_join_element_wise(*[tokens.take(pa.array(at + k)) for k in range(n)], " "),
                "left": tokens.take(pa.array(before, mask=before < 0)),
                "whole": pa.array((at == begin[at]) & (at + n == end[at])),
            }
            found.append(pa.table(cols).group_by(list(cols)).aggregate([([], "count_all")]))
        if not found:
            return
        t = pa.concat_tables(found)
        t = t.take(pc.sort_indices(t, [("slice", "ascending"), ("window", "ascending"), ("left", "ascending")])).combine_chunks()
        s = t.column("slice").to_numpy()
        cuts = [0, *(np.flatnonzero(s[1:] != s[:-1]) + 1).tolist(), len(s)]
        rows = [_shut(t.slice(i, k - i).drop_columns("slice")) for i, k in zip(cuts, cuts[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([pa.array(s[cuts[:-1]], pa.int32()), pa.array(rows, pa.binary())], names=["slice", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in _pieces(batches, "hashes"):
            held.append(b)
            size += pc.sum(pc.list_value_length(b.column("hashes"))).as_py() or 0
            if size > HELD:
                yield from block(held)
                held, size = [], 0
        if size:
            yield from block(held)

    return run


def _shut(t: pa.Table) -> bytes:
    """A table as compressed bytes; strings as their lengths and their letters, since offsets compress badly."""
    zstd, letters = pa.Codec("zstd", 6), {}
    for i, name in enumerate(t.column_names):
        if pa.types.is_string(t.schema.field(i).type):
            x = t.column(i).combine_chunks()
            sizes, x = pc.fill_null(pc.binary_length(x), -1), pc.fill_null(x, "")
            at = np.frombuffer(x.buffers()[1], np.int32)[x.offset : x.offset + len(x) + 1]
            letters[name] = zstd.compress(x.buffers()[2].slice(at[0], at[-1] - at[0]) if at[-1] > at[0] else b"", asbytes=True)
            t = t.set_column(i, name, sizes)
    t = t.replace_schema_metadata(letters)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression=zstd)) as out:
        out.write_table(t)
    return sink.getvalue().to_pybytes()


def _opened(packed: pa.Buffer) -> pa.Table:
    """What :func:`_shut` packed."""
    t = pa.ipc.open_stream(packed).read_all()
    for name, letters in (t.schema.metadata or {}).items():
        i = t.schema.get_field_index(name.decode())
        sizes = t.column(i).to_numpy()
        at = np.r_[0, np.cumsum(np.maximum(sizes, 0))].astype(np.int32)
        known = pa.py_buffer(np.packbits(sizes >= 0, bitorder="little").tobytes())
        text = pa.Codec("zstd").decompress(letters, int(at[-1])) if at[-1] else pa.py_buffer(b"")
        t = t.set_column(i, name.decode(), pa.StringArray.from_buffers(len(sizes), pa.py_buffer(at), text, known))
    return t.replace_schema_metadata(None)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The tables of each slice, of packed rows in order of their slices, as one."""
    now, held = None, []
    for b in batches:
        for s, packed in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            if held and s != now:
                yield pa.concat_tables(held).combine_chunks()
                held = []
            now = s
            held.append(_opened(packed.as_buffer()))
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _maximal(most: int):
    """Of packed windows: (phrase, count) of the n-grams that no longer one of equal count, of ``most`` words at most, begins or ends with.

    In order of their words the windows that begin with an n-gram stand together. One that comes twice or more goes if the windows
    go on with one word only, or if the same word is before all of them; one that comes once stays if it is longest or a whole text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _slices(batches):
            split = pc.split_pattern(t.column("window").combine_chunks(), " ")
            sizes = pc.list_value_length(split).to_numpy()
            code = split.flatten().dictionary_encode()
            m = np.full((len(sizes), most), -1, np.int32)
            m[np.arange(most) < sizes[:, None]] = code.indices.to_numpy()
            order = np.lexsort(m.T[::-1])
            m, sizes = m[order], sizes[order]
            left = t.column("left").combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy()[order]
            whole, c = t.column("whole").to_numpy()[order], t.column("count_all").to_numpy()[order]
            new, levels = np.zeros(len(m), bool), []
            for n in range(1, most + 1):
                new = new | np.r_[True, m[1:, n - 1] != m[:-1, n - 1]]
                if n > 1:
                    levels.append((n, np.flatnonzero(new)))
            further = None  # of the level above: where its n-grams begin and how often they come
            for n, begins in reversed(levels):
                count = np.where(sizes[begins] >= n, np.add.reduceat(c, begins), 0)
                keep = count > 0
                if n < most:
                    at, more = further
                    longest = np.maximum.reduceat(more, np.searchsorted(at, begins))
                    low, high = np.minimum.reduceat(left, begins), np.maximum.reduceat(left, begins)
                    texts = np.maximum.reduceat(whole & (sizes == n), begins)
                    keep &= np.where(count > 1, (longest < count) & ((low < 0) | (low < high)), texts)
                further = begins, count
                first = begins[keep]
                phrase = pc.binary_join_element_wise(*[code.dictionary.take(pa.array(m[first, k])) for k in range(n)], " ")
                yield pa.RecordBatch.from_arrays([phrase, pa.array(count[keep])], names=["phrase", "count"])

    return run


def _repeated(filters: dict[int, Filter | None]):
    """Of (tokens, hashes): (phrase, n, c, left_low, left_high, right_low, right_high) of what filters admit, once a block of texts.

    The last four are the least and greatest hashes of a pair's neighbours, apart where one has none, and 0 for triples. Only its test
    calls it: :func:`_windows` took its place.
    """
    none = np.iinfo(np.int64)

    def block(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).combine_chunks()
        words, end, first = _flat(t.column("hashes").combine_chunks())
        tokens, number = t.column("tokens").combine_chunks().flatten(), words.view(np.int64)
        begin = np.repeat(first[:-1], np.diff(first))
        for n, admits in filters.items():
            h = _hashes(words, n)
            size = len(h)
            at = np.flatnonzero((np.arange(size) + n <= end[:size]) & admits(h)) if admits and size else words[:0]
            if not len(at):
                continue
            at = at[np.argsort(h[at], kind="stable")]
            new = np.zeros(len(at) - 1, bool)
            for k in range(n):
                new |= words[at + k][1:] != words[at + k][:-1]
            begins = np.flatnonzero(np.r_[True, new])
            sides = [np.zeros(len(begins), np.int64)] * 4
            if n == 2:
                left, right = number[np.maximum(at - 1, 0)], number[np.minimum(at + 2, len(words) - 1)]
                has_left, has_right = at > begin[at], at + 2 < end[at]
                sides = [f.reduceat(np.where(has, x, lost), begins) for x, has in ((left, has_left), (right, has_right)) for f, lost in ((np.minimum, none.min), (np.maximum, none.max))]
            phrase = pc.binary_join_element_wise(*[tokens.take(pa.array(at[begins] + k)) for k in range(n)], " ")
            cols = [phrase, pa.array(np.full(len(begins), n, np.int32)), pa.array(np.diff(np.r_[begins, len(at)])), *map(pa.array, sides)]
            found = pa.RecordBatch.from_arrays(cols, names=["phrase", "n", "c", "left_low", "left_high", "right_low", "right_high"]).take(pc.sort_indices(phrase))
            for i in range(0, found.num_rows, 100_000):
                yield found.slice(i, 100_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in _pieces(batches, "hashes"):
            held.append(b)
            size += pc.sum(pc.list_value_length(b.column("hashes"))).as_py() or 0
            if size > HELD:
                yield from block(held)
                held, size = [], 0
        if size:
            yield from block(held)

    return run


def maximal_repeats(texts: DataFrame, tokens: str, most: int = 3) -> DataFrame:
    """(phrase, count) of all n-grams of two to ``most`` words, but those that begin or end an n-gram of equal count with one word more.

    Words hold no blanks. What comes once, as the addresses of hashes tell level by level, is written out where it stands; of the rest
    the longest n-gram of each place alone is shuffled, and the shorter ones are counted as what it begins with.
    """
    x = stored(spread(texts.select(F.col(tokens).alias("tokens")).where(F.size("tokens") > 1)), "texts")
    x = x.withColumn("hashes", F.transform("tokens", lambda w: F.xxhash64(w)))  # made again when read: stored they take more than the words
    filters, admitted = dict.fromkeys(range(2, most + 1)), None
    for n in filters:
        filters[n] = admitted = _filter(_merged(x.select("hashes").mapInArrow(_counting(n, admitted), "slice int, packed binary"), 2))
        if admitted is None:
            break
    shared = x.sparkSession.sparkContext.broadcast(filters)  # at most 2^28 bits each
    alone = x.mapInArrow(lambda batches: _alone(shared.value)(batches), "phrase string, count long")
    rows = x.mapInArrow(lambda batches: _windows(shared.value)(batches), "slice int, packed binary")
    kept = rows.repartition("slice").sortWithinPartitions("slice").mapInArrow(_maximal(most), "phrase string, count long")
    return alone.unionByName(kept)
