"""Vectorised text kernels: Arrow strings as numpy code-point arrays, without per-row string calls.

A batch of strings becomes one array of code points plus row offsets. Case folding, canonical forms, words, word hashes
and shingles are then lookups, prefix sums and gathers over the whole batch.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

N_CODES = sys.maxunicode + 1
_PRIME = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_PRIME), -1, 1 << 64))


def row_slices(size: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` summed size; one row alone may exceed it. Every row is in exactly one range."""
    cum, start, n = np.cumsum(size), 0, len(size)
    while start < n:
        base = cum[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(cum, base + limit, side="right")))
        yield start, stop
        start = stop


def byte_sizes(*columns: pa.Array) -> np.ndarray:
    """Bytes of each row over several string columns; null counts as 0."""
    return sum(pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)


def codepoints(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all rows, offsets of the rows in them); null reads as the empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.empty(0, np.uint32), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if offsets[-1] == offsets[0]:
        return np.empty(0, np.uint32), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=before[1:])
    return np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32), before[offsets - offsets[0]]


def to_arrow(codes: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The inverse of codepoints()."""
    width = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
    ends = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(width, out=ends[1:])
    data = np.ascontiguousarray(codes, np.uint32).tobytes().decode("utf-32-le").encode("utf-8")
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(ends[offsets].tobytes()), pa.py_buffer(data)])


class Expansion:
    """A map of code points to zero or more code points, as flat lookup tables."""

    def __init__(self, changed: dict[int, str]):
        size = np.ones(N_CODES, np.uint8)
        single = np.arange(N_CODES, dtype=np.uint32)
        start = np.zeros(N_CODES, np.uint32)
        flat: list[int] = []
        for code, text in changed.items():
            size[code] = len(text)
            if len(text) == 1:
                single[code] = ord(text)
            elif text:
                start[code] = len(flat)
                flat.extend(map(ord, text))
        self.size, self.single, self.start, self.flat = size, single, start, np.array(flat or [0], np.uint32)

    def apply(self, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lookup gathers; where a code point grows or vanishes, the offsets of all later ones shift."""
        size = self.size[codes]
        out = self.single[codes]
        odd = size != 1
        if not odd.any():
            return out, offsets
        size = size.astype(np.int64)
        at = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(size, out=at[1:])
        whole = np.empty(at[-1], np.uint32)
        same = ~odd
        whole[at[:-1][same]] = out[same]
        for k in range(int(size.max())):
            more = odd & (size > k)
            whole[at[:-1][more] + k] = self.flat[self.start[codes[more]] + k]
        return whole, at[offsets]


@functools.cache
def casefold_table() -> Expansion:
    return Expansion({c: f for c in range(N_CODES) if not 0xD800 <= c < 0xE000 and (f := chr(c).casefold()) != chr(c)})


@functools.cache
def alnum_table() -> np.ndarray:
    """True for letters and digits."""
    return np.fromiter((unicodedata.category(chr(c))[0] in "LN" for c in range(N_CODES)), bool, N_CODES)


@functools.lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _PRIME, np.uint64), np.full(n, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser with full avalanche."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span [start, end) of the code points, by prefix sums of a polynomial modulo 2**64."""
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _powers(1 << max(10, int(len(codes)).bit_length()))
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix(codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Words:
    """The words (runs of letters and digits, case folded) of each row of a column of texts."""

    def __init__(self, column: pa.Array):
        codes, offsets = codepoints(column)
        self.codes, offsets = casefold_table().apply(codes, offsets)
        letter = alnum_table()[self.codes]
        n = len(self.codes)
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        if n:
            before[1:], after[:-1] = letter[:-1], letter[1:]
            inner = offsets[(offsets > 0) & (offsets < n)]
            before[inner] = False
            after[inner - 1] = False
        self.starts = np.flatnonzero(letter & ~before)
        self.ends = np.flatnonzero(letter & ~after) + 1
        self.row = np.searchsorted(offsets, self.starts, side="right") - 1
        self.n_rows = len(offsets) - 1

    @functools.cached_property
    def hashes(self) -> np.ndarray:
        return span_hashes(self.codes, self.starts, self.ends)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, row) of every run of k words inside one row; shingle i begins at word i of the words whose run fits."""
        h, n = self.hashes, len(self.starts) - k + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        acc = np.zeros(n, np.uint64)
        for j in range(k):
            acc = acc * _PRIME + h[j : j + n]
        acc = mix(acc)
        keep = self.row[:n] == self.row[k - 1 :]
        return acc[keep], self.row[:n][keep]


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The least of every w neighbours, by doubling: a window is two overlapping ones of a power of two."""
    n, size = len(x) - w + 1, 1
    if n <= 0:
        return x[:0]
    least = x
    while 2 * size <= w:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    return np.minimum(least[:n], least[w - size : w - size + n])


def window_signatures(hashes: np.ndarray, rows: np.ndarray, w: int, permutations: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature, row) of every w neighbouring shingles of a row: one band of the MinHashes of their set under several permutations.

    Neighbours with equal signatures are merged.
    """
    n = len(hashes) - w + 1
    if n <= 0:
        return hashes[:0], rows[:0]
    band = np.full(n, w, np.uint64)
    for k in range(permutations):
        band = mix(band * _PRIME + sliding_min(hashes if not k else mix(hashes ^ np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))), w))
    keep = rows[:n] == rows[w - 1 :]
    band, row = band[keep], rows[:n][keep]
    fresh = np.ones(len(band), bool)
    fresh[1:] = (band[1:] != band[:-1]) | (row[1:] != row[:-1])
    return band[fresh], row[fresh]
