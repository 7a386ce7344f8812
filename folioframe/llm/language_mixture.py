"""Language identification by multilingual mixture inference.

A language is a distribution over hashed letter trigrams, counted over all labelled texts and mixed with the pooled distribution of
all languages. A text's trigrams are taken as draws from a mixture of languages: expectation-maximisation estimates the proportions,
and the set of languages grows one by one while the likelihood gains more than a penalty. The text's language is the one
of the largest proportion.

The likelihood is concave in the proportions, so adding a language can't gain more than its slope there: languages whose slope
is below the penalty are passed over without EM, which changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textsets import as_bytes, mix

#: Bits of a trigram's hash, share of the pooled distribution in every language's, and rounds of EM at most.
BITS, POOLED, ROUNDS = 16, 0.1, 60
#: Trigrams overlap, so each letter is drawn three times; the penalty counts accordingly.
OVERLAP = 3
#: Letters handled at once, and languages whose counts a task holds at once.
SLICE, HELD = 1 << 20, 64
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    return np.frombuffer(bytes(chr(c).isalpha() for c in range(0x110000)), bool)


def trigrams(text: str, bits: int = BITS) -> Iterator[np.ndarray]:
    """Hashes of the trigrams of a text's letters, lower-cased, in slices; a run of anything else counts as one blank. None if no letter occurs."""
    carry, seen = np.zeros(1, np.uint32), False
    for at in range(0, len(text), SLICE):
        c = np.frombuffer(text[at : at + SLICE].lower().encode("utf-32-le", "surrogatepass"), "<u4")
        c = np.where(_letters()[c], c, 0)
        seen = seen or bool(c.any())
        c = np.concatenate([carry, c, *([np.zeros(1, np.uint32)] if at + SLICE >= len(text) else [])])
        c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]
        if len(c) > 2 and seen:
            x = c.astype(np.uint64)
            yield (mix((x[:-2] << np.uint64(42)) ^ (x[1:-1] << np.uint64(21)) ^ x[2:]) >> np.uint64(64 - bits)).astype(np.int64)
        carry = c[-2:]


def _counting(bits: int):
    """Of (lang, text): (lang, hash, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, n in held.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], names=["lang", "hash", "n"])
            held.clear()

        for b in batches:
            waiting: dict[str, list[np.ndarray]] = {}

            def count(lang: str) -> None:
                more = np.bincount(np.concatenate(waiting.pop(lang)), minlength=1 << bits)
                held[lang] = held[lang] + more if lang in held else more

            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for h in trigrams(as_bytes(text).decode("utf-8", "replace"), bits):
                    waiting.setdefault(lang, []).append(h)
                    if sum(map(len, waiting[lang])) > SLICE or len(waiting[lang]) > 1000:
                        count(lang)
            for lang in list(waiting):
                count(lang)
            if len(held) > HELD:
                yield from flush()
        yield from flush()

    return run


@dataclass
class Languages:
    """Learned language names, sorted, and the probability of each hash in each, hashes first."""

    names: list[str]
    p: np.ndarray
    bits: int

    @classmethod
    def of(cls, names: list[str], counts: np.ndarray, bits: int, pooled: float = POOLED) -> Languages:
        """From counts by language and hash; all languages weigh alike in the pool, so that a rare one isn't likelier for its gaps."""
        counts = counts.astype(np.float64)
        own = counts / np.maximum(1, counts.sum(axis=1, keepdims=True))
        everywhere = own.sum(axis=0) + 1.0 / (1 << bits)
        return cls(names, np.ascontiguousarray(((1 - pooled) * own + pooled * everywhere / max(1e-300, everywhere.sum())).T), bits)

    def mixture(self, text: str, rounds: int = ROUNDS) -> list[tuple[str, float]]:
        """(language, proportion), largest first; ties go to the smaller name. Empty if the text has no letter or nothing was learned."""
        if not self.names:
            return []
        h = n = weight = None
        for part in trigrams(text, self.bits):
            if h is None:
                h = part
            else:
                n = np.bincount(h, minlength=1 << self.bits) if n is None else n
                n += np.bincount(part, minlength=1 << self.bits)
        if h is None:
            return []
        if n is not None:
            h = np.flatnonzero(n)
            weight = n[h].astype(np.float64)
        p = self.p[h]
        total = float(weight.sum()) if weight is not None else float(len(h))
        count = lambda x: weight @ x if weight is not None else x.sum(axis=0)
        alone = count(np.log(p))
        chosen, share = [int(alone.argmax())], np.ones(1)
        best, now = float(alone.max()), p[:, chosen[0]]
        penalty = OVERLAP * (0.5 * np.log(total + 1) + np.log(len(self.names)))
        while len(chosen) < len(self.names):
            slope = count(p / now[:, None]) - total
            slope[chosen] = -np.inf
            found = None
            for m in np.argsort(-slope, kind="stable"):
                if slope[m] <= penalty or (found and slope[m] <= found[0] - best):
                    break
                trial = [*chosen, int(m)]
                theta, value, mixed = _fitted(p[:, trial], count, total, np.append(share * 0.8, 0.2), rounds)
                if value - best > penalty and (found is None or value > found[0]):
                    found = (value, trial, theta, mixed)
            if found is None:
                break
            best, chosen, share, now = found
        order = sorted(range(len(chosen)), key=lambda i: (-share[i], self.names[chosen[i]]))
        return [(self.names[chosen[i]], float(share[i])) for i in order]


def _fitted(p: np.ndarray, count, total: float, theta: np.ndarray, rounds: int) -> tuple[np.ndarray, float, np.ndarray]:
    """Proportions by EM, their log-likelihood, and the mixture's probability of each trigram."""
    for _ in range(rounds):
        mixed = p @ theta
        new = theta * count(p / mixed[:, None]) / total
        moved = np.abs(new - theta).max()
        theta = new / new.sum()
        if moved < 1e-4:
            break
    mixed = p @ theta
    return theta, float(count(np.log(mixed))), mixed


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", bits: int = BITS) -> Languages:
    """Count every text of ``docs`` that has a language; the driver gets at most 2^bits counts a language."""
    rows = docs.where(docs[lang_col].isNotNull() & docs[text_col].isNotNull()).select(docs[lang_col].cast("string").alias("lang"), docs[text_col].cast("string").alias("text"))
    counted = rows.mapInArrow(_counting(bits), "lang string, hash int, n long").groupBy("lang", "hash").agg(F.sum("n").alias("n")).toArrow()
    langs = counted["lang"].to_pylist()
    names = sorted(set(langs))
    place = {x: i for i, x in enumerate(names)}
    counts = np.zeros((len(names), 1 << bits), np.int64)
    counts[[place[x] for x in langs], counted["hash"].to_numpy()] = counted["n"].to_numpy()
    return Languages.of(names, counts, bits)


def identify(docs: DataFrame, model: Languages, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, languages) of every row: the language of the largest proportion, that proportion, and the chosen set with proportions.

    ``und`` with the score 0 and no languages if the text is null, has no letter, or nothing was learned. Repeated rows each
    get theirs, null ids stay, texts of any length are read whole, ties go to the smaller name; other columns aren't read, and
    an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^bits doubles a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            found = [m.mixture(as_bytes(t).decode("utf-8", "replace")) for t in b.column(1)]
            sets = pa.array([[{"lang": x, "share": s} for x, s in f] for f in found], pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))
            cols = [b.column(0), pa.array([f[0][0] if f else UNKNOWN for f in found], pa.string()), pa.array([min(1.0, f[0][1]) if f else 0.0 for f in found], pa.float64()), sets]
            yield pa.RecordBatch.from_arrays(cols, names=["_id", "lang_pred", "score", "languages"])

    rows = docs.select(docs[id_col].cast("long").alias("_id"), docs[text_col].cast("string").alias("_t"))
    return rows.mapInArrow(run, "_id long, lang_pred string, score double, languages array<struct<lang:string,share:double>>").withColumnRenamed("_id", id_col)
