"""Operator 7: sum-of-squares online packing of token ids into sequences.

Each input partition is one stream with a level array ``N``: ``N[h]`` windows are
filled to ``h`` tokens.  A document is encoded (ids and an end id); its full
windows are cut off, and the rest, of size s, goes to the level h (0: a new window)
for which the sum of squares of ``N`` grows least after one window moves from h to
h + s; ties go to the fullest level, then the oldest window.  At the end of a
stream the windows still open are cut again in order: they refill whole windows, and the last
rest becomes sequences of decreasing powers of two, which need no padding.

Nothing is shuffled: a stream is a scan partition, which a lost executor's
successor reads again in the same order.  Pieces are handed on as soon as their
window is full; only open windows (few, by the rule) are held.

Null and empty texts hold the end id alone.  Repeated rows are packed each; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import doc_text, text_slices
from .token_counts import ENCODE_BYTES, encoder, tokenizer_path

CAPACITY = 2_048
END_ID = 1
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")])


class Stream:
    """One online packer."""

    def __init__(self, capacity: int, first_id: int):
        self.size, self.next_id = capacity, first_id
        self.levels = np.zeros(capacity + 1, np.int64)
        self.open: list[deque] = [deque() for _ in range(capacity + 1)]  # (sequence, pieces) by level
        self.out: list[tuple] = []

    def _new(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def level(self, s: int) -> int:
        """The level to which a piece of size s goes."""
        n, size = self.levels, self.size
        after = n[s:size + 1].copy()
        after[-1] = 0  # a full window leaves the array
        growth = 2 * (after - n[:size + 1 - s]) + 2
        growth[-1] -= 1
        growth[0] = 2 * after[0] + 1 if s < size else 0
        growth[1:][n[1:size + 1 - s] == 0] = np.iinfo(np.int64).max
        return len(growth) - 1 - int(np.argmin(growth[::-1]))

    def _emit(self, seq: int, pieces: list) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.out.append((doc, start, n, zlib.crc32(ids), total, seq, at))
            at += n

    def add(self, doc: int | None, ids: bytes) -> None:
        total, start = len(ids) // 4, 0
        while total - start >= self.size:
            self._emit(self._new(), [(doc, start, ids[4 * start:4 * (start + self.size)], total)])
            start += self.size
        s = total - start
        if not s:
            return
        h = self.level(s)
        piece = (doc, start, ids[4 * start:], total)
        if h:
            seq, pieces = self.open[h].popleft()
            self.levels[h] -= 1
        else:
            seq, pieces = self._new(), []
        pieces.append(piece)
        if h + s == self.size:
            self._emit(seq, pieces)
        else:
            self.open[h + s].append((seq, pieces))
            self.levels[h + s] += 1

    def close(self) -> None:
        """Cut what is in open windows into whole ones and powers of two."""
        rest = deque(p for level in reversed(self.open) for _, pieces in level for p in pieces)
        left = sum(len(p[2]) // 4 for p in rest)
        while left:
            size = min(self.size, 1 << (left.bit_length() - 1)) if left < self.size else self.size
            taken, pieces = 0, []
            while taken < size:
                doc, start, ids, total = rest.popleft()
                n = min(len(ids) // 4, size - taken)
                pieces.append((doc, start, ids[:4 * n], total))
                if 4 * n < len(ids):
                    rest.appendleft((doc, start + n, ids[4 * n:], total))
                taken += n
            self._emit(self._new(), pieces)
            left -= size

    def take(self) -> pa.RecordBatch:
        out, self.out = self.out, []
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*out) if out else [[]] * len(_ARROW))], schema=_ARROW)


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        enc = encoder(tokenizer_path(path))
        stream = Stream(capacity, TaskContext.get().partitionId() << 40)
        for batch in batches:
            for part in text_slices(batch, limit=ENCODE_BYTES):
                ids, borders = enc.encode(part.column("text"))
                ids, borders = ids.tobytes(), (4 * borders).tolist()
                for doc, a, b in zip(part.column("doc_id").to_pylist(), borders, borders[1:]):
                    stream.add(doc, ids[a:b] + end)
                yield stream.take()
        stream.close()
        yield stream.take()

    return doc_text(docs).mapInArrow(run, SCHEMA)
