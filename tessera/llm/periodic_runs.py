"""Operator 13: periodic runs of words, by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words with smallest period q and at least
``max(MIN_WORDS, MIN_REPEATS * q)`` words that no neighbouring word extends.

1. *Splitting.*  A run of period q holds each of its words ``MIN_REPEATS`` times or
   more.  So a word that occurs less often within the current segment (first: the
   document) lies in no run of the segment, and splits it.  Pieces shorter than
   ``MIN_WORDS`` go, the others are counted anew, until no piece loses a word.
2. *Lag scan.*  In each segment left, and for each lag q up to a fourth of it, the
   segment is cut into blocks of q words.  A run of period q holds three whole blocks
   or more, which are equal, so only starts of two equal neighbour pairs are looked at:
   n / q hashes for lag q, n log n for all lags, however long the segment is.  Each
   place found is extended word by word to both sides; equality of words, not of
   hashes, decides.  Two blocks inside a run of a smaller period repeat that run (both
   periods fit in the two blocks, so the smaller divides the larger) and are left out.

Words are numbered by their bytes (a dictionary, no hash), for many texts at once.
All work is per document, so nothing is shuffled; a task holds a slice of about
``SLICE`` bytes, or one longer text.

``repeat_tails`` is the rule by which the query's contract turns some documents into
periodic ones; ``periodic_runs`` takes it as an argument and applies none by default.

Null, empty and wordless texts have no words and no run (four nulls; the hashes are
those of no bytes).  A null id is kept and its text is not changed by the rule.
Repeated rows are judged each; ties of the longest run go to the smallest start, then
period; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import doc_text, text_slices

MIN_REPEATS = 4
MIN_WORDS = 6
SLICE = 4 << 20
SCHEMA = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")
TEXTS = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def repeat_tails(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(a, p): from word a on, the document repeats its words a to a + p - 1; None: it stays."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... of each run, one after another."""
    total = np.cumsum(length)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(start - total + length, length)


def word_numbers(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number of each word, the same for words of the same bytes only."""
    length = end - start
    off = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length, out=off[1:])
    return K.numbers(buf[ragged(start, length)], off)


def split_by_frequency(word: np.ndarray, borders: np.ndarray, repeats: int = MIN_REPEATS, least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the segments in which each word occurs ``repeats`` times or more; no other place is in a run."""
    start, end = borders[:-1], borders[1:]
    keep = end - start >= least
    start, end = start[keep], end[keep]
    done: list[tuple[np.ndarray, np.ndarray]] = []
    kinds = int(word.max()) + 1 if len(word) else 1
    while len(start):
        length = end - start
        at = ragged(start, length)
        seg = np.repeat(np.arange(len(start)), length)
        _, which, count = np.unique(seg * kinds + word[at], return_inverse=True, return_counts=True)
        often = count[which] >= repeats
        lost = np.bincount(seg[~often], minlength=len(start))
        done.append((start[lost == 0], end[lost == 0]))
        change = often & (lost[seg] > 0)
        at, seg = at[change], seg[change]
        fresh = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(seg, prepend=-1) != 0))
        last = np.append(fresh[1:], len(at)) - 1 if len(fresh) else fresh
        start, end = at[fresh], at[last] + 1
        keep = end - start >= least
        start, end = start[keep], end[keep]
    if not done:
        return start, end
    return np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])


def _extend(word: np.ndarray, at: int, q: int, lo: int, hi: int) -> tuple[int, int]:
    """The longest stretch of period q inside [lo, hi) that holds [at, at + q)."""
    right, step = at, 64
    while right + q < hi:
        n = min(step, hi - q - right)
        differ = np.flatnonzero(word[right:right + n] != word[right + q:right + q + n])
        if len(differ):
            right += int(differ[0])
            break
        right, step = right + n, step * 2
    left, step = at, 64
    while left > lo:
        n = min(step, left - lo)
        differ = np.flatnonzero(word[left - n:left] != word[left - n + q:left + q])
        if len(differ):
            left += int(differ[-1]) + 1 - n
            break
        left, step = left - n, step * 2
    return left, right + q


def lag_scan(word: np.ndarray, start: np.ndarray, end: np.ndarray, repeats: int = MIN_REPEATS, least: int = MIN_WORDS) -> np.ndarray:
    """Rows (start, end, period) of the runs inside the segments."""
    out: list[tuple[int, int, int]] = []
    length = end - start
    order = np.argsort(-length, kind="stable")
    start, length = start[order], length[order]
    if not len(start):
        return np.zeros((0, 3), np.int64)
    prefix = K.Prefix(K.mix(word.astype(np.uint64)))
    reach = np.zeros(len(word) + 1, np.int64)  # by place: the furthest end of a run found that holds it
    live = len(start)
    for q in range(1, int(length[0]) // repeats + 1):
        live = int(np.searchsorted(-length[:live], -repeats * q, side="right"))
        blocks = length[:live] // q
        at = ragged(np.zeros(live, np.int64), blocks)
        seg = np.repeat(np.arange(live), blocks)
        at = start[seg] + at * q
        h = prefix.raw(at, at + q)
        same = (h[1:] == h[:-1]) & (seg[1:] == seg[:-1])
        two = np.flatnonzero(same[1:] & same[:-1])
        if not len(two):
            continue
        two = two[reach[at[two]] < at[two] + 2 * q]
        for k in two.tolist():
            a, j = int(at[k]), int(seg[k])
            if reach[a] >= a + 2 * q:
                continue  # in the run that an earlier block found
            lo, hi = _extend(word, a, q, int(start[j]), int(start[j] + length[j]))
            if hi - lo >= max(least, repeats * q):
                out.append((lo, hi, q))
                reach[lo:hi] = np.maximum(reach[lo:hi], hi)
    return np.array(out, np.int64).reshape(-1, 3)


class Slice:
    """Words, runs and kept words of the texts of an Arrow column."""

    def __init__(self, ids: list, column: pa.Array, rule: Callable | None):
        self.buf, off = K.utf8(column)
        self.start, self.end, self.borders = K.runs(K.NON_SPACE[self.buf], off)
        if rule:
            source = np.arange(len(self.start))
            for k, (i, a, b) in enumerate(zip(ids, self.borders.tolist(), self.borders[1:].tolist())):
                tail = rule(i, b - a)
                if tail:
                    first, p = a + tail[0], tail[1]
                    source[first:b] = first + (source[first:b] - first) % p
            self.start, self.end = self.start[source], self.end[source]
        word = word_numbers(self.buf, self.start, self.end)
        found = lag_scan(word, *split_by_frequency(word, self.borders))
        found = found[np.lexsort((found[:, 2], found[:, 0]))]
        text = np.searchsorted(self.borders, found[:, 0], side="right") - 1
        self.cut = np.searchsorted(text, np.arange(len(self.borders)))  # borders of the texts among the runs
        self.runs = np.stack([found[:, 0] - self.borders[text], found[:, 1] - found[:, 0], found[:, 2]], axis=1)
        cover = np.zeros(len(word) + 1, np.int64)
        np.add.at(cover, found[:, 0] + found[:, 2], 1)
        np.add.at(cover, found[:, 1], -1)
        self.kept = np.cumsum(cover[:-1]) == 0

    def collapsed(self) -> list[memoryview]:
        """Kept words of each text, joined by one space."""
        start, end = self.start[self.kept], self.end[self.kept]
        length = end - start + 1  # with the space behind
        stop = np.cumsum(length)
        data = np.full(int(stop[-1]) if len(stop) else 0, 32, np.uint8)
        data[ragged(stop - length, length - 1)] = self.buf[ragged(start, length - 1)]
        total = np.append(0, stop)
        n = np.zeros(len(self.kept) + 1, np.int64)
        np.cumsum(self.kept, out=n[1:])
        view = memoryview(data)
        at = total[n[self.borders]].tolist()
        return [view[a:max(a, b - 1)] for a, b in zip(at, at[1:])]


def _slices(batches, rule):
    for batch in batches:
        for part in text_slices(batch, limit=SLICE):
            ids = part.column("doc_id").to_pylist()
            yield ids, Slice(ids, part.column("text"), rule)


def periodic_runs(docs: DataFrame, rule: Callable | None = None) -> DataFrame:
    """One row per document: its number of runs, the longest, and hashes of all runs and of the kept words."""

    def run(batches):
        for ids, s in _slices(batches, rule):
            rows = []
            for k, (i, words, kept) in enumerate(zip(ids, np.diff(s.borders).tolist(), s.collapsed())):
                runs = s.runs[s.cut[k]:s.cut[k + 1]].tolist()
                best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
                text = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
                rows.append((i, words, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                             hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
            types = [pa.int64()] * 7 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)],
                                             names=[c.split()[0] for c in SCHEMA.split(", ")])

    return doc_text(docs).mapInArrow(run, SCHEMA)


def collapse_runs(docs: DataFrame) -> DataFrame:
    """doc_id, all runs (start, length, period) and the text of the kept words joined by one space."""

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for ids, s in _slices(batches, None):
            runs = [[dict(zip(("start", "length", "period"), r)) for r in s.runs[s.cut[k]:s.cut[k + 1]].tolist()] for k in range(len(ids))]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(runs, kind), pa.array([bytes(x).decode() for x in s.collapsed()], pa.string())],
                                             names=["doc_id", "runs", "collapsed"])

    return doc_text(docs).mapInArrow(run, TEXTS)
