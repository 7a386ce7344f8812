"""Words and shingles of a text as 64-bit hashes, computed by numpy on the text's UTF-8 bytes.

A word's hash is a polynomial over its bytes modulo 2**64, mixed; a shingle's hash combines those of its words in
order. Two different shingles of a pair of documents of together a million words collide with a chance of about 3e-8.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_powers = [np.ones(1, _U), np.ones(1, _U)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for k, b in enumerate((_BASE, _INVERSE)):
            t = np.full(size, b, _U)
            t[0] = 1
            _powers[k] = np.multiply.accumulate(t)
    return _powers


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word of the bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(text: bytes, fold: bool = True) -> np.ndarray:
    """One hash a word, in order; with ``fold``, A-Z count as a-z."""
    data = np.frombuffer(text, np.uint8)
    start, end = word_spans(data)
    if not len(start):
        return np.zeros(0, _U)
    power, inverse = _tables(len(data))
    if fold:
        data = _LOWER[data]
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * power[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(_U))


def shingles(text: bytes, size: int) -> np.ndarray:
    """The distinct shingles, sorted. Fewer words than ``size`` make one shingle; none make none."""
    w = word_hashes(text)
    if not len(w):
        return w
    take = min(size, len(w))
    n = len(w) - take + 1
    out = np.full(n, take, _U)
    for k in range(take):
        out = (out + w[k : k + n]) * _BASE
    return np.unique(mix(out))


def as_bytes(text) -> bytes:
    """UTF-8 of an Arrow string scalar or of a str; none for null."""
    if text is None:
        return b""
    if isinstance(text, str):
        return text.encode("utf-8", "surrogatepass")
    b = text.as_buffer() if hasattr(text, "as_buffer") else None
    return b.to_pybytes() if b is not None else b""
