"""Vectorised text kernels over the bytes of one Arrow batch.

All character classes of the operators are ASCII classes, so words and lines can be cut on
UTF-8 bytes: bytes of 0x80 and more only occur inside characters beyond ASCII.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_SEGMENT = 1 << 18  # bytes hashed at once; keeps the power tables in the CPU cache
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)  # odd


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every input bit."""
    x = x + U(0x9E3779B97F4A7C15)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _byte_values(seed: int) -> np.ndarray:
    """A random value per byte; A-Z share those of a-z, which lower-cases them."""
    t = mix(np.arange(256, dtype=U) + U(seed * 1000))
    t[65:91] = t[97:123]
    return t


#: Two lower-casing tables, and one that tells cases apart.
_VALUES = (_byte_values(1), _byte_values(2), mix(np.arange(256, dtype=U) + U(3000)))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i in 0..m."""
    have = _POWERS.get(which)
    if have is None or len(have[0]) <= m:
        size = max(_SEGMENT, 1 << int(m).bit_length()) + 1
        tables = []
        for b in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
            p = np.full(size, b, U)
            p[0] = 1
            tables.append(np.cumprod(p, dtype=U))
        have = tuple(tables)
        if size <= 4 * _SEGMENT:
            _POWERS[which] = have
    return have


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the byte offsets of each; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def byte_class(inside) -> np.ndarray:
    """Look-up table of the bytes b with inside(b)."""
    return np.array([bool(inside(b)) for b in range(256)])


#: ``[^\x20\x09-\x0D]``
NON_SPACE = byte_class(lambda b: b != 0x20 and not 9 <= b <= 13)
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after A-Z were lower-cased
LETTER_DIGIT = byte_class(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A
                          or 0x61 <= b <= 0x7A or b >= 0x80)


def runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
    """Starts and ends of the maximal runs of a byte class; a run never leaves its text."""
    return runs_of(inside[data], offsets)


def runs_of(w: np.ndarray, offsets: np.ndarray):
    """Starts and ends of the runs of set bytes."""
    n = len(w)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = w.copy(), w.copy()
    first[1:] &= ~w[:-1]
    last[:-1] &= ~w[1:]
    at = offsets[:-1][offsets[:-1] < n]
    first[at] = w[at]
    at = offsets[1:][offsets[1:] > 0] - 1
    last[at] = w[at]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0):
    """64-bit hash of each byte range (ascending, disjoint); 0 and 1 take A-Z as a-z."""
    out = np.empty(len(starts), U)
    values, i, n = _VALUES[which], 0, len(starts)
    while i < n:
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, lo + _SEGMENT, "right")))
        m = int(ends[j - 1]) - lo
        power, inverse = _powers(which, m)
        c = np.empty(m + 1, U)
        c[0] = 0
        v = values[data[lo:lo + m]]
        v *= power[:m]
        np.cumsum(v, out=c[1:])
        s = starts[i:j] - lo
        h = c[ends[i:j] - lo]
        h -= c[s]
        h *= inverse[s]
        out[i:j] = h
        i = j
    out += (ends - starts).astype(U) * U(0xA24BAED4963EE407)
    return mix(out)


def grams(h: np.ndarray, k: int, which: int = 0) -> np.ndarray:
    """Hash of the k consecutive values from each position (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    step = U(((_BASES[which] * 3 + 2 * k) & ((1 << 64) - 1)) | 1)
    acc = h[:n].copy()
    for j in range(1, k):
        acc *= step
        acc += h[j:j + n]
    return mix(acc)


class Words:
    """The words of a batch of texts: byte ranges, hashes and the words of each text."""

    def __init__(self, texts: pa.Array, inside: np.ndarray, which: int = 0):
        self.data, self.offsets = flat(texts)
        self.starts, self.ends = runs(self.data, self.offsets, inside)
        self.hash = hash_ranges(self.data, self.starts, self.ends, which)
        #: words of text i are bounds[i]:bounds[i + 1]
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.bounds)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def distinct(sorted_values: np.ndarray) -> np.ndarray:
    if len(sorted_values) < 2:
        return sorted_values
    keep = np.empty(len(sorted_values), bool)
    keep[0] = True
    np.not_equal(sorted_values[1:], sorted_values[:-1], out=keep[1:])
    return sorted_values[keep]


def shingle_sets(texts: pa.Array, size: int):
    """Per text, the sorted distinct hashes (int64) of its word shingles. A text of fewer
    words, but not none, has its whole sequence as the one shingle."""
    w = Words(texts, NON_SPACE)
    g = grams(w.hash, size)
    for a, b in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist()):
        if b - a >= size:
            yield distinct(np.sort(g[a:b - size + 1].view(np.int64)))
        elif b > a:
            yield (grams(w.hash[a:b], b - a) ^ U(b - a)).view(np.int64)
        else:
            yield np.zeros(0, np.int64)
