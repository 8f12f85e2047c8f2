"""Numpy kernels over the UTF-8 bytes of many texts at once.

Texts of an Arrow column lie one after another in one byte buffer.  Words, lines
and shingles are found and hashed for the whole buffer in a few vector passes; no
Python code runs per word.  Hashes of up to ``LONG`` bytes are 64-bit polynomial values over
the bytes (every byte counts, so equal strings have equal hashes), mixed at the end;
such a value modulo 2^64 is weak on long strings (Thue-Morse), so longer ones get a
cryptographic digest.  Where equality itself decides a result, strings are numbered by
their bytes (``numbers``) or compared.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = np.uint64(0x9E3779B97F4A7C55)
#: Bytes beyond which a hash is a digest of the string.
LONG = 128
_POW: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse for i < n."""
    if "p" not in _POW or len(_POW["p"]) < n:
        inv = np.uint64(pow(int(BASE), -1, 1 << 64))
        p = np.full(n, BASE, np.uint64)
        q = np.full(n, inv, np.uint64)
        p[0] = q[0] = 1
        _POW["p"], _POW["q"] = np.cumprod(p), np.cumprod(q)
    return _POW["p"], _POW["q"]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without nulls; offsets start at 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


class Prefix:
    """Prefix sums from which the hash of any byte range is read."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        self._buf = buf
        p, self._q = _powers(n + 1)
        self._h = np.zeros(n + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * p[:n], out=self._h[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self._h[end] - self._h[start]) * self._q[start]

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = mix(self.raw(start, end) + (end - start).astype(np.uint64))
        for i in np.flatnonzero(end - start > LONG).tolist():
            h[i] = int.from_bytes(hashlib.blake2b(self._buf[start[i]:end[i]].tobytes(), digest_size=8).digest(), "little")
        return h

    def grams(self, k: int) -> np.ndarray:
        """Hash of every k bytes in a row, by start."""
        m = len(self._h) - k
        if m <= 0:
            return np.zeros(0, np.uint64)
        return mix((self._h[k:] - self._h[:m]) * self._q[:m])


def byte_table(chars: bytes | range | list) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


#: Not space: words of `[^\x20\x09-\x0D]+`.
NON_SPACE = ~byte_table(b" \t\n\x0b\x0c\r")
#: ASCII letters, digits and all bytes of non-ASCII characters.
WORD = byte_table(range(128, 256)) | byte_table(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
#: Lower-cases ASCII.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def runs(flag: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of True that do not cross a text border: starts, ends, and the texts' borders in the run list."""
    n = len(flag)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    begin = flag.copy()
    begin[1:] &= ~flag[:-1]
    stop = flag.copy()
    stop[:-1] &= ~flag[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    begin[inner] = flag[inner]
    stop[inner - 1] = flag[inner - 1]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return start, end, np.searchsorted(start, offsets)


def numbers(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A number of each string data[offsets[i]:offsets[i + 1]], the same for equal bytes only."""
    strings = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    return strings.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def run_numbers(buf: np.ndarray, flag: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``numbers`` of the runs of ``flag`` (all of them, as ``runs`` gives them)."""
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=offsets[1:])
    return numbers(buf[flag], offsets)


def equal_rows(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order, same): rows grouped by equal columns, first ones first; whether each place of the order but the first equals the one before.

    Grouped by a hash; if two rows of a hash differ, by the columns themselves.
    """
    key = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        key = mix(key * np.uint64(0xD1342543DE82EF95) + c.astype(np.uint64))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if any((c[order][1:][same] != c[order][:-1][same]).any() for c in columns):
        order = np.lexsort(columns[::-1])
        same = np.logical_and.reduce([c[order][1:] == c[order][:-1] for c in columns])
    return order, same


def owner(borders: np.ndarray) -> np.ndarray:
    """Text number of each run."""
    return np.repeat(np.arange(len(borders) - 1), np.diff(borders))


def shingles(words: np.ndarray, borders: np.ndarray, k: int, short: bool = False):
    """Hashes of k words in a row within a text, their text and the number of their first word.

    ``short``: a text of 1 to k-1 words makes one shingle of all its words.
    """
    n = np.diff(borders)
    count = np.maximum(n - k + 1, 0)
    text = np.repeat(np.arange(len(n)), count)
    first = borders[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    h = np.zeros(len(first), np.uint64)
    for i in range(k):
        h = h * np.uint64(0xD1342543DE82EF95) + words[first + i]
    h = mix(h)
    if short:
        few = np.flatnonzero((n > 0) & (n < k))
        if len(few):
            at = borders[:-1][few]
            g = np.zeros(len(few), np.uint64)
            for i in range(k - 1):
                has = i < n[few]
                g = np.where(has, g * np.uint64(0xD1342543DE82EF95) + words[np.where(has, at + i, 0)], g)
            order = np.argsort(np.concatenate([text, few]), kind="stable")
            h, text, first = (np.concatenate(x)[order] for x in ((h, mix(g + np.uint64(1))), (text, few), (first, at)))
    return h, text, first


def per_text(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between borders."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[borders[1:]] - total[borders[:-1]]
