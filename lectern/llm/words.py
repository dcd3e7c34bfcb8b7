"""Words of Arrow text columns as numpy arrays.

Tasks that look at every word of every text work on the UTF-8 buffer of an Arrow
column: word bounds and 64-bit word hashes come from whole-buffer numpy passes,
without a Python string per word. Memory stays bounded: ``chunks`` hands over
at most ``CHUNK_BYTES`` of text at a time (one longer text alone), and hashing
runs over blocks of words of at most ``BLOCK_BYTES``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
BLOCK_BYTES = 1 << 20


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    for a, b in ranges:
        t[a:b + 1] = True
    return t


#: Word bytes of ``[^\x20\x09-\x0D]+``.
SPACED = ~byte_set((0x20, 0x20), (0x09, 0x0D))
#: Word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower-cased.
ALNUM = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
SAME = np.arange(256, dtype=np.uint8)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n`` of each."""
    if len(_powers[0]) < n:
        m = max(n, 1 << 16)
        for k, b in enumerate((int(_BASE), pow(int(_BASE), -1, 1 << 64))):
            p = np.full(m, np.uint64(b))
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mixer (three xor-shift, two multiply steps)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and ``n + 1`` offsets of a string column; null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64, len(col) + 1, 8 * col.offset) if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = int(offsets[0])
    return raw[lo:int(offsets[-1])], offsets - lo


def chunks(batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose texts hold at most ``most`` bytes together."""
    _, off = text_buffer(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = int(np.searchsorted(off, off[at] + most, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield batch.slice(at, to - at)
        at = to


@dataclass
class Words:
    """Words of a chunk: byte bounds, hash, and each document's first word index."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray          # n_docs + 1 entries

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def bounds(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of ``kind`` bytes inside each text."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    w = kind[data]
    s, e = w.copy(), w.copy()
    s[1:] &= ~w[:-1]
    e[:-1] &= ~w[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    s[inner] = w[inner]
    e[inner - 1] = w[inner - 1]
    return np.flatnonzero(s), np.flatnonzero(e) + 1


def words_of(col: pa.Array, kind: np.ndarray) -> Words:
    data, offsets = text_buffer(col)
    starts, ends = bounds(data, offsets, kind)
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = SAME) -> np.ndarray:
    """64-bit hash of each slice ``data[start:end]`` (ascending, not overlapping)."""
    out = np.empty(len(starts), np.uint64)
    table = _BYTE[fold]
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK_BYTES, side="right")))
        lo, hi = int(starts[at]), int(ends[to - 1])
        up, down = _pow(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(table[data[lo:hi]] * up[:hi - lo], out=sums[1:])
        s, e = starts[at:to] - lo, ends[at:to] - lo
        out[at:to] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        at = to
    return out


def grams(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``k`` words inside documents, and the index of each
    window's first word."""
    n = len(h)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    g = h[:n - k + 1].copy()
    for i in range(1, k):
        g = mix(g) + h[i:n - k + 1 + i] * np.uint64(0x9FB21C651E98DF25 + 2 * i)
    ok = np.ones(n - k + 1, bool)
    for b in first[1:-1]:
        if 0 < b < n:
            ok[max(0, b - k + 1):b] = False
    at = np.flatnonzero(ok)
    return mix(g[at]), at


def hash_words(words: list[bytes]) -> np.ndarray:
    """Hashes of separate byte strings, equal to those of ``hashes``."""
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    return hashes(data, np.concatenate(([0], ends[:-1])).astype(np.int64), ends) if words else np.zeros(0, np.uint64)
