"""Operator 5: benchmark decontamination by SimHash windows as long as the items.

Words are runs of letters and digits (lower-cased); shingles are five words.  Each
item, and each window of as many words in a document, has a 64-bit SimHash of its
shingles, weighted by how often each is found in it.  The fingerprints of the items
are kept in a multi-index: with seven blocks of about nine bits, a fingerprint
within ``RADIUS`` = 20 bits of another is within 2 bits of it in at least one
block, so looking up all block values within 2 bits finds every fingerprint
within the radius.  At a similarity of 0.8 fingerprints differ in 9.7 bits on
average (standard deviation 2.9).  Candidates within the radius are verified by
the exact weighted Jaccard similarity of their shingles (sums of smaller and of
larger counts), ``SIMILARITY`` or more; each document and item is reported once,
with its most similar window.

Windows that share no shingle with any item have similarity 0 and are not
fingerprinted; all others are, at every start and every item length.

Items are the query set: they are read in blocks of about ``BLOCK_BYTES`` of text,
and each block goes against all documents.  Documents are scanned in place;
nothing is shuffled.

Items and documents of fewer than five words have one shingle, of all their words.
Null and wordless texts match nothing.  Repeated documents are reported each;
equal items are reported each.  Empty tables on either side give no rows.  Other
columns of ``documents`` are handed through by ``decontaminate`` only.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import doc_text, text_slices

WORDS = 5
SIMILARITY = 0.8
RADIUS = 20
PARTS = 7
NEAR = RADIUS // PARTS
BLOCK_BYTES = 4 << 20
SCHEMA = "doc_id long, item_id long, similarity double, hamming int, start_word long, n_words long"
_EDGES = [64 * i // PARTS for i in range(PARTS + 1)]


def shingled(buf: np.ndarray, off: np.ndarray):
    """Shingle hashes, their borders by text, and the number of words of each text."""
    low = K.LOWER[buf]
    start, end, borders = K.runs(K.WORD[low], off)
    h, text, _ = K.shingles(K.Prefix(low).hash(start, end), borders, WORDS, short=True)
    return h, np.searchsorted(text, np.arange(len(off))), np.diff(borders)


def signs(h: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 64 bits of each hash."""
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").reshape(-1)


class Index:
    """Items of one block, by shingle and by fingerprint."""

    def __init__(self, ids: list[int], texts: list[str]):
        h, borders, n = shingled(*K.utf8(pa.array(texts, pa.string())))
        has = np.flatnonzero(n > 0)
        self.ids = [ids[i] for i in has]
        self.size = n[has]
        each = [h[borders[i]:borders[i + 1]] for i in has]
        self.counts = [Counter(x.tolist()) for x in each]
        self.prints = fingerprints(np.array([signs(x).sum(axis=0) for x in each], np.int32).reshape(-1, 64))
        everything = np.concatenate(each) if each else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(each)), [len(x) for x in each])
        self.known, at = np.unique(everything, return_inverse=True)
        sizes = np.unique(np.stack([at, self.size[item]]), axis=1) if each else np.zeros((2, 0), np.int64)
        self.size_at, self.sizes = np.searchsorted(sizes[0], np.arange(len(self.known) + 1)), sizes[1]  # item lengths of each shingle
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.known >> np.uint64(44)).astype(np.int64)] = True
        self.blocks = []  # for each part: items whose value is near each value
        for a, b in zip(_EDGES, _EDGES[1:]):
            value = ((self.prints >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)).astype(np.uint64)
            apart = np.bitwise_count(np.arange(1 << (b - a), dtype=np.uint64)[:, None] ^ np.unique(value)[None, :]) <= NEAR
            order = np.argsort(value, kind="stable")
            cuts = np.searchsorted(value[order], np.unique(value), "left").tolist() + [len(order)]
            groups = [order[x:y] for x, y in zip(cuts, cuts[1:])]
            self.blocks.append((a, np.uint64((1 << (b - a)) - 1), [np.flatnonzero(row) for row in apart], groups))

    def near(self, fp: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(window, items, distances) of all items within the radius of each fingerprint."""
        out = []
        for w, f in enumerate(fp):
            found = [groups[g] for a, mask, near, groups in self.blocks for g in near[int((f >> np.uint64(a)) & mask)]]
            if found:
                items = np.unique(np.concatenate(found))
                apart = np.bitwise_count(self.prints[items] ^ f)
                keep = apart <= RADIUS
                if keep.any():
                    out.append((w, items[keep], apart[keep]))
        return out

    def hits(self, column: pa.Array) -> list[tuple[int, int, float, int, int, int]]:
        """(row, item, similarity, distance, first word, words) of each text and item at or above the similarity."""
        h, borders, n = shingled(*K.utf8(column))
        if not len(self.known) or not len(h):
            return []
        maybe = np.flatnonzero(self.sieve[(h >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.known, h[maybe]), len(self.known) - 1)
        hit = self.known[at] == h[maybe]
        seed, at = maybe[hit], at[hit]
        out = []
        text = np.searchsorted(borders, seed, "right") - 1
        cuts = np.flatnonzero(np.diff(text, prepend=-1)).tolist() + [len(text)]
        for a, b in zip(cuts, cuts[1:]):
            row = int(text[a])
            out += [(row, *x) for x in self._document(h[borders[row]:borders[row + 1]], int(n[row]), seed[a:b] - borders[row], at[a:b])]
        return out

    def _document(self, h: np.ndarray, n: int, seed: np.ndarray, at: np.ndarray):
        """Best window of each item in one document; ``seed``: its shingles that some item has."""
        by_size: dict[int, list[tuple[int, int]]] = {}
        for p, u in zip(seed.tolist(), at.tolist()):
            for size in self.sizes[self.size_at[u]:self.size_at[u + 1]].tolist():
                by_size.setdefault(size, []).append((max(0, p + min(WORDS, size) - size), min(p, max(0, n - size))))
        best: dict[int, tuple] = {}
        low, high = max(0, int(seed[0]) - int(self.size.max())), int(seed[-1]) + int(self.size.max()) + 1
        total = None
        for size, ranges in by_size.items():
            m = max(1, size - WORDS + 1)  # shingles of a window
            if n < size and len(h) > m:
                continue
            mark = np.zeros(max(b for _, b in ranges) + 2 - low, np.int32)
            for a, b in ranges:
                if a <= b:
                    mark[a - low] += 1
                    mark[b + 1 - low] -= 1
            start = np.flatnonzero(np.cumsum(mark) > 0)  # from ``low``
            if not len(start):
                continue
            if total is None:
                total = np.zeros((min(high, len(h)) - low + 1, 64), np.int32)
                np.cumsum(signs(h[low:high]), axis=0, out=total[1:])
            stop = np.minimum(start + m, len(total) - 1)
            for w, items, apart in self.near(fingerprints(total[stop] - total[start])):
                a = int(start[w]) + low
                found = None
                for i, d in zip(items.tolist(), apart.tolist()):
                    if int(self.size[i]) != size:
                        continue
                    found = found or Counter(h[a:a + m].tolist())
                    want = self.counts[i]
                    both = sum(min(c, found[s]) for s, c in want.items() if s in found)
                    s = both / (sum(found.values()) + sum(want.values()) - both)
                    if s >= SIMILARITY and (i not in best or s > best[i][1]):
                        best[i] = (i, s, d, a, min(size, n))
        return sorted(best.values())


def indexes(benchmark: DataFrame):
    """An index for each block of items."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    n = max(1, -(-size // BLOCK_BYTES))
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        yield Index([r.item_id for r in rows], [r.text for r in rows])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity, hamming, start_word and n_words of each contaminated document and item."""
    out = None
    for index in indexes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            ids = shared.value.ids
            for batch in batches:
                for part in text_slices(batch):
                    hits = shared.value.hits(part.column("text"))
                    doc = part.column("doc_id").to_pylist()
                    cols = list(zip(*[(doc[r], ids[i], *rest) for r, i, *rest in hits])) or [[]] * 6
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, _TYPES)], names=_NAMES)

        found = doc_text(docs).mapInArrow(run, SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out


_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
_TYPES = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int64(), pa.int64()]


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, without those that hold an item."""
    for index in indexes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            for batch in batches:
                for part in text_slices(batch):
                    keep = np.ones(part.num_rows, bool)
                    keep[[x[0] for x in shared.value.hits(part.column("text"))]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
