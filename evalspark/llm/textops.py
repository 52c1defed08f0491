"""Whole Arrow batches of text as byte arrays: words, rolling hashes and shingles without a Python loop per word."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 19  # bytes of text worked on at a time; one longer text makes a piece of its own

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        n = max(n, PIECE + 1024)
        have = np.full(n, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 4 * PIECE:
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Rolling:
    """Hashes of any byte ranges of ``data`` from one prefix sum (a polynomial over a random value for each byte)."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * powers(_BASE, n + 1)[:n], out=self.sums[1:])
        self.inverse = powers(_INVERSE, n + 1)

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, end) + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:n]) * self.inverse[:n])


def pieces(texts: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``limit`` bytes. Null is taken as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        end = min(end, len(texts))
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the maximal runs where ``inside`` holds; no run crosses from one row to the next."""
    n = len(inside)
    if not n:
        e = np.zeros(0, np.int64)
        return e, e, e
    cuts = offsets[(offsets > 0) & (offsets < n)]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word: runs of other bytes than ASCII white space, A-Z lower-cased."""
    data = LOWER[data]
    start, end, row = spans(~IS_SPACE[data], offsets)
    return Rolling(data).of(start, end), row


_STEP = [np.uint64(((0x9FB21C651E98DF25 + 0x632BE59BD9B4E018 * i) & ((1 << 64) - 1)) | 1) for i in range(16)]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """For each row its sorted distinct ``n``-word shingles as 64-bit hashes; fewer words make one shingle, none an empty set."""
    words, row = word_hashes(data, offsets)
    rows = len(offsets) - 1
    first = np.searchsorted(row, np.arange(rows + 1))
    if len(words) >= n:
        m = len(words) - n + 1
        made = np.zeros(m, np.uint64)
        for i in range(n):
            made += words[i : i + m] * _STEP[i]
        made = mix(made + np.uint64(n))
    else:
        made = np.zeros(0, np.uint64)
    out = []
    for i in range(rows):
        a, b = first[i], first[i + 1]
        if b - a >= n:
            out.append(np.unique(made[a : b - n + 1]))
        elif b > a:
            few = np.zeros(1, np.uint64)
            for j in range(b - a):
                few += words[a + j : a + j + 1] * _STEP[j]
            out.append(mix(few + np.uint64(b - a)))
        else:
            out.append(made[:0])
    return out


def digest(a: np.ndarray | bytes) -> bytes:
    return hashlib.blake2b(a if isinstance(a, bytes) else a.tobytes(), digest_size=16).digest()
