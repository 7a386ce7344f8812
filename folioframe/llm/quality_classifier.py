"""Quality classifier: a second-order factorisation machine.

Features are hashed words (log-damped counts), structure statistics cut into steps, and metadata of the text itself
(its length among the statistics); no label, language, source or id is one of them. The pairwise
interactions are of low rank, and a text is scored in time linear in its features by
sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2].

The model is fitted on the driver by seeded Adagrad from a bounded sample of labelled rows (``FIT_ROWS``, those of the
smallest hash of their id); every row is scored, in one stage without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textsets import as_bytes, mix, word_hashes, word_spans

#: Labelled rows that the model is fitted on, at most.
FIT_ROWS = 8000
HASH_BITS, RANK, EPOCHS, RATE, DECAY, SEED = 15, 6, 6, 0.08, 1e-5, 7
_U = np.uint64
_KINDS = np.full(256, 5, np.uint8)
_KINDS[[0x20, *range(0x09, 0x0E)]] = 0
_KINDS[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = 1
_KINDS[[*range(ord("A"), ord("Z") + 1)]] = 2
_KINDS[[*range(ord("0"), ord("9") + 1)]] = 3
_KINDS[[ord(c) for c in ".,;:?'-"]] = 4
_STATS = 12
#: Steps into which each statistic is cut, so that its effect needn't be linear.
_STEPS = 10


def structure(text: bytes) -> np.ndarray:
    """Statistics of a text's shape, each from 0 to 1."""
    data = np.frombuffer(text, np.uint8)
    start, end = word_spans(data)
    n, size = len(start), max(1, len(data))
    kinds = np.bincount(_KINDS[data], minlength=6) / size
    h = word_hashes(text)
    distinct = len(np.unique(h)) / max(1, n)
    pairs = len(np.unique(mix(h[:-1]) + h[1:])) / max(1, n - 1) if n > 1 else 1.0
    lines = text.split(b"\n")
    length = (end - start).mean() if n else 0.0
    plain = float(np.isin(_KINDS[data[end - 1]], (1, 4)).mean()) if n else 0.0
    single = float((end - start == 1).mean()) if n else 0.0
    ends = sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / len(lines)
    damp = lambda x, top: min(1.0, float(np.log1p(x)) / top)
    return np.array([damp(n, 12), damp(length, 4), kinds[2] * 2, kinds[3] * 5, kinds[4] * 4, kinds[5] * 4, distinct, pairs, 1 - len(set(lines)) / len(lines), plain, single * 2, ends]).clip(0, 1)


def features(text: bytes, bits: int = HASH_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values; the first 1 << bits indices are hashed words, the steps of the statistics follow."""
    h = word_hashes(text)
    idx, count = np.unique((mix(h) >> _U(64 - bits)).astype(np.int32), return_counts=True)
    value = np.log1p(count)
    value = value / np.sqrt((value**2).sum()) if len(value) else value
    stat = structure(text)
    step = np.minimum((stat * _STEPS).astype(np.int32), _STEPS - 1)
    where = (1 << bits) + np.arange(_STATS, dtype=np.int32) * _STEPS + step
    return np.concatenate([idx, where]), np.concatenate([value, np.full(_STATS, 0.5)])


@dataclass
class Model:
    """bias, linear weights and factors of a fitted machine."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    bits: int

    def logit(self, idx: np.ndarray, value: np.ndarray) -> float:
        v = self.factors[idx] * value[:, None]
        return float(self.bias + self.linear[idx] @ value + 0.5 * ((v.sum(axis=0) ** 2).sum() - (v * v).sum()))

    def score(self, text: bytes) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(*features(text, self.bits)), -35, 35))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = HASH_BITS, rank: int = RANK, epochs: int = EPOCHS, rate: float = RATE, decay: float = DECAY, seed: int = SEED) -> Model:
    """Adagrad on the logistic loss, classes weighed alike, so that 0.5 parts them. Without both classes the model is the classes' share."""
    rng = np.random.default_rng(seed)
    size = (1 << bits) + _STATS * _STEPS
    model = Model(0.0, np.zeros(size), rng.normal(0, 0.05, (size, rank)), bits)
    good = sum(y for *_, y in rows)
    if not 0 < good < len(rows):
        model.factors[:] = 0
        model.bias = 0.0 if not rows else (4.0 if good else -4.0)
        return model
    weight = {1: len(rows) / (2 * good), 0: len(rows) / (2 * (len(rows) - good))}
    g0, gl, gf = 1.0, np.ones(size), np.ones((size, rank))
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            idx, x, y = rows[i]
            v = model.factors[idx]
            vx = v * x[:, None]
            s = vx.sum(axis=0)
            z = model.bias + model.linear[idx] @ x + 0.5 * ((s * s).sum() - (vx * vx).sum())
            d = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y) * weight[y]
            gw = d * x + decay * model.linear[idx]
            gv = d * (x[:, None] * s - v * (x * x)[:, None]) + decay * v
            g0 += d * d
            gl[idx] += gw * gw
            gf[idx] += gv * gv
            model.bias -= rate * d / np.sqrt(g0)
            model.linear[idx] -= rate * gw / np.sqrt(gl[idx])
            model.factors[idx] = v - rate * gv / np.sqrt(gf[idx])
    return model


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [features(as_bytes(t)) for t in b.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array([i.astype("<i4").tobytes() for i, _ in got], pa.binary()), pa.array([x.astype("<f4").tobytes() for _, x in got], pa.binary()), b.column(1)], names=["idx", "value", "y"])


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = FIT_ROWS, **options) -> Model:
    """Fit on at most ``rows`` labelled rows, those whose ids have the smallest hashes. Null ids and labels are left out; of repeated label rows the smallest label counts."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("_lid")).agg(F.min(label_col).cast("int").alias("_y"))
    picked = known.orderBy(F.xxhash64("_lid"), "_lid").limit(rows)
    texts = docs.select(docs[id_col].alias("_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("_t"))
    # The picked rows are at most ``rows``, so this side may be broadcast.
    joined = texts.join(F.broadcast(picked), F.col("_id") == F.col("_lid")).select("_t", "_y", "_id")
    got = joined.select("_t", "_y").mapInArrow(_sampled, "idx binary, value binary, y int").collect()
    got = sorted((bytes(r.idx), bytes(r.value), r.y) for r in got)
    return fit([(np.frombuffer(i, "<i4"), np.frombuffer(x, "<f4").astype(np.float64), y) for i, x, y in got], **options)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row: 0 to 1, higher where label 1 is likelier. Null texts score as empty ones; repeated rows each get theirs; other columns aren't read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: (1 + rank) doubles an index

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m.score(as_bytes(t)) for t in b.column(1)], pa.float64())], names=["_id", "score"])

    rows = docs.select(docs[id_col].cast("long").alias("_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("_t"))
    return rows.mapInArrow(run, "_id long, score double").withColumnRenamed("_id", id_col)
