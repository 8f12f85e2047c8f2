"""Operator 1: token counts of whole texts, with overlap resynchronisation of huge ones.

A text of at most ``chunk_chars`` code points is encoded as it is.  A longer one is
cut into chunks that overlap by ``overlap_chars``; each chunk is encoded by itself, in
any task, with offsets, and reports the borders of its pieces (what the byte-level
pre-tokenizer hands to the merges) in the overlaps with its neighbours.  Two
neighbours are spliced at the first border that both encodings show.  If they show none
in common, the text is cut again with an overlap four times as wide, until they do
or one chunk reaches the end of the text.

Why a common border is stable: the pre-tokenizer scans from left to right, looks at most two
characters ahead, never back, and no merge leaves a piece.  So the left chunk's pieces, which begin at a
border of the whole text, are those of the whole as long as they end ``margin``
characters before the chunk's own end (the margin also holds the longest special string, which is split off
first); and from a border on, the right chunk's scan is that of the whole.  The next splice continues from there.

Null and empty texts count 0 tokens.  Repeated rows give repeated rows; an empty
table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import json
import os
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .common import doc_text, text_slices, written

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 256
#: Factor of the overlap after a failed alignment.
WIDEN = 4
LIMIT = 1_024
#: Units in a worker's memo at which the half used longest ago is dropped.
MEMO_WORDS = 500_000
#: Text encoded at once: the more, the fewer look-ups of a unit found again.
ENCODE_BYTES = 3 << 20

_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """The library's encoder with a bounded memo of words.

    A text is cut before each space that follows a character other than white
    space.  White space only opens a piece, or stands alone, so those cuts are token borders; the ids of the
    text are those of its units in order, and a unit seen lately is not encoded
    again.  Units are found for many texts at once, numbered by their bytes, and each distinct
    one is looked up by its bytes, so no two units share an entry.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer, processors

        self.tok = Tokenizer.from_file(path)
        self.tok.post_processor = processors.ByteLevel(trim_offsets=False)  # adds no token; offsets with their spaces
        parts = json.loads(self.tok.to_str())
        pre = parts["pre_tokenizer"] or {}
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or parts["normalizer"]:
            raise ValueError("the boundary proof holds for byte-level pre-tokenizers without a prefix space or a normalizer only")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in parts["added_tokens"]):
            raise ValueError("the boundary proof holds for special strings that are found as they stand only")
        #: Characters before a cut end within which pieces may differ from those of the whole text.
        self.margin = 2 + max([1, *(len(t["content"]) for t in parts["added_tokens"])])
        self.opens = np.zeros(self.tok.get_vocab_size(with_added_tokens=True) + 1, bool)
        for token, i in self.tok.get_vocab(with_added_tokens=True).items():
            self.opens[i] = token.startswith("Ġ")  # the byte alphabet's letter for a space
        self.slot: dict[bytes, int] = {}  # unit -> place in the arrays below
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.used = np.zeros(0, np.int64)
        self.pool = np.zeros(0, "<u4")
        self.round = 0

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, "<u4") for x in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the units one after another, their lengths, and the order in which they come.

        Units that hold no space but their first character are encoded in long joined strings, whose units begin at
        the tokens that begin with a space.
        """
        plain, odd = [], []
        for i, u in enumerate(units):
            (odd if u.rfind(b" ") else plain).append(i)
        order, ids, length = [], [], []
        parts = [plain[i:i + 256] for i in range(0, len(plain), 256)]
        for part, found in zip(parts, self._ids([b"".join([units[i] for i in p]).decode() for p in parts])):
            cut = np.flatnonzero(self.opens[found])
            if len(cut) == len(part):
                order += part
                ids.append(found)
                length.append(np.diff(np.append(cut, len(found))))
            else:
                odd += part
        rest = self._ids([units[i].decode() for i in odd])
        length.append(np.array([len(x) for x in rest], np.int64))
        return np.concatenate([*ids, *rest, self.pool[:0]]), np.concatenate(length), np.array(order + odd, np.int64)

    def _forget(self) -> None:
        """Keep the units used last, at most half of the memo."""
        keep = self.used > np.sort(self.used)[len(self.used) // 2]
        kept = [(k, i) for k, i in self.slot.items() if keep[i]]
        slots = np.array([i for _, i in kept], np.int64)
        self.pool = self.pool[_ragged(self.start[slots], self.length[slots])]
        self.length, self.used = self.length[slots], self.used[slots]
        self.start = np.cumsum(self.length) - self.length
        self.slot = {k: i for i, (k, _) in enumerate(kept)}

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the texts' borders among them."""
        ids, total, start, off = self._encode(column)
        return ids, total[np.searchsorted(start, off)]

    def borders(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Where the pieces of a text begin (in code points, the last is its end) and the tokens before each, by its own encoding."""
        found = self.tok.encode(text, add_special_tokens=False)
        word = np.array(found.word_ids, np.int64)
        new = np.flatnonzero(np.diff(word, prepend=-1) != 0)
        at = np.array([a for a, _ in found.offsets], np.int64)[new]
        return np.append(at, len(text)), np.append(new, len(word))

    def _encode(self, column: pa.Array):
        """Ids, tokens before each unit, where each unit starts, and the texts' offsets."""
        if len(self.slot) > MEMO_WORDS:
            self._forget()
        self.round += 1
        buf, off = K.utf8(column)
        if not len(buf):
            return np.zeros(0, "<u4"), np.zeros(1, np.int64), np.zeros(0, np.int64), off
        at = np.flatnonzero(buf == 32)
        at = at[at > 0]
        one, two, three = (buf[np.maximum(at - i, 0)] for i in (1, 2, 3))
        more = (one & 0xC0) == 0x80
        firm = ((one > 32) & (one < 127)) | (more & (two >= 0xC3) & (two < 0xE0)) | (more & ((two & 0xC0) == 0x80) & ((three == 0xE0) | (three >= 0xE4)))
        start = np.sort(np.concatenate([off[:-1][np.diff(off) > 0], at[firm]]), kind="stable")
        start = start[np.diff(start, prepend=-1) > 0]
        offsets = np.append(start, len(buf))
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(buf)]).dictionary_encode()
        where = units.indices.to_numpy(zero_copy_only=False)
        key = units.dictionary.to_numpy(zero_copy_only=False).tolist()  # bytes; far cheaper than to_pylist
        slot = np.fromiter(map(self.slot.get, key, repeat(-1)), np.int64, len(key))
        new = np.flatnonzero(slot < 0)
        if len(new):
            ids, length, came = self._encode_units([key[i] for i in new.tolist()])
            new = new[came]
            slot[new] = np.arange(len(self.start), len(self.start) + len(new))
            self.slot.update((key[i], j) for i, j in zip(new.tolist(), slot[new].tolist()))
            self.start = np.concatenate([self.start, len(self.pool) + np.cumsum(length) - length])
            self.length = np.concatenate([self.length, length])
            self.used = np.concatenate([self.used, np.zeros(len(new), np.int64)])
            self.pool = np.concatenate([self.pool, ids])
        self.used[slot] = self.round
        slot = slot[where]
        length = self.length[slot]
        total = np.zeros(len(slot) + 1, np.int64)
        np.cumsum(length, out=total[1:])
        return self.pool[_ragged(self.start[slot], length)], total, start, off


def _ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... of each run, one after another."""
    total = np.cumsum(length)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(start - total + length, length)


def encoder(path: str) -> Encoder:
    """One per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenizer_path(path: str | None) -> str:
    """A given file, or the public 50k byte-level vocabulary installed on every node."""
    if path:
        return path
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def cut(text: str, chunk_chars: int, overlap_chars: int) -> list[tuple[int, str]]:
    """(place, chunk): chunks start every ``chunk_chars`` code points and reach ``overlap_chars`` into the next one."""
    return [(at, text[at:at + chunk_chars + overlap_chars]) for at in range(0, len(text), chunk_chars)]


def overlaps(enc: Encoder, at: int, chunk: str, n: int, chunk_chars: int, overlap_chars: int) -> dict:
    """Places in the text of the chunk's borders that a splice may use, on its left and its right, and the tokens before each."""
    place, before = enc.borders(chunk)
    place = place + at
    end = at + len(chunk)
    left = place < at + overlap_chars
    left |= (place == n) & (n <= at + overlap_chars)
    right = (place >= at + chunk_chars) & (place <= (n if end == n else end - enc.margin))
    return {"left": place[left], "left_n": before[left], "right": place[right], "right_n": before[right], "n": int(before[-1])}


_OVERLAPS = ("left", "left_n", "right", "right_n")


def _huge(rows: DataFrame, path: str | None, chunk_chars: int, overlap_chars: int) -> DataFrame:
    """doc_id, n_bytes, digest, n_tokens (null if some neighbours did not align) and n_chunks of each row."""

    def pieces(batches):
        for batch in batches:
            for i, b, d, row, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_bytes", "digest", "row", "text"))):
                for at, chunk in cut(text, chunk_chars, overlap_chars):
                    yield pa.RecordBatch.from_pylist([{"doc_id": i, "n_bytes": b, "digest": d, "row": row, "size": len(text), "at": at, "chunk": chunk}],
                                                     schema=chunk_schema)

    def encoded(batches):
        enc = encoder(tokenizer_path(path))
        for batch in batches:
            found = [overlaps(enc, at, chunk, n, chunk_chars, overlap_chars) for at, chunk, n in zip(*(batch.column(c).to_pylist() for c in ("at", "chunk", "size")))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array([x[c] for x in found], pa.list_(pa.int64())) for c in _OVERLAPS),
                                              pa.array([x["n"] for x in found], pa.int64())], names=[*kept, *_OVERLAPS, "n"])

    kept = ["doc_id", "n_bytes", "digest", "row", "at"]
    columns = "doc_id long, n_bytes long, digest string, row long, "
    chunk_schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("digest", pa.string()), ("row", pa.int64()), ("size", pa.int64()),
                              ("at", pa.int64()), ("chunk", pa.string())])
    chunks = (rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(pieces, columns + "size long, at long, chunk string")
              .repartition("row", "at")
              .mapInArrow(encoded, columns + "at long, " + ", ".join(f"{c} array<long>" for c in _OVERLAPS) + ", n long"))
    order = Window.partitionBy("row").orderBy("at")
    here = F.when(F.col("at") == 0, F.lit(0)).otherwise(F.array_min(F.array_intersect("left", F.lag("right").over(order))))
    spliced = chunks.withColumn("begin", here).withColumn("end", F.lead("begin").over(order)).withColumn("last", F.lead("at").over(order).isNull())
    # try_element_at: null where there is no common border
    before = F.expr("if(at = 0, 0, try_element_at(left_n, int(array_position(left, begin))))")
    after = F.expr("if(last, n, try_element_at(right_n, int(array_position(right, end))))")
    tokens = spliced.select("row", "doc_id", "n_bytes", "digest", (after - before).alias("n"))
    return tokens.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"), F.first("digest").alias("digest"),
                                     F.when(F.count("n") == F.count("*"), F.sum("n")).alias("n_tokens"), F.count("*").alias("n_chunks")).drop("row")


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT, chunk_chars: int = CHUNK_CHARS,
                 overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, n_chunks and overlap_chars (that aligned all chunks; null for one chunk) of every document."""

    def short(batches):
        enc = encoder(tokenizer_path(path))
        for batch in batches:
            for part in text_slices(batch, limit=ENCODE_BYTES):
                n = np.diff(enc.encode(part.column("text"))[1])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), pa.array(n, pa.int64())],
                                                 names=["doc_id", "n_bytes", "n_tokens"])

    chunk_chars = max(chunk_chars, overlap_chars)  # a chunk's left splice lies before its right one
    rows = doc_text(docs).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    out = (rows.where(F.length("text") <= chunk_chars).mapInArrow(short, "doc_id long, n_bytes long, n_tokens long")
           .select("*", F.lit(1).cast("long").alias("n_chunks"), F.lit(None).cast("long").alias("overlap_chars")))
    todo = rows.where(F.length("text") > chunk_chars).withColumn("digest", F.sha2("text", 256))
    huge = todo
    while True:
        found = written(_huge(huge, path, chunk_chars, overlap_chars), "spliced")
        done = found.where("n_tokens is not null").select("doc_id", "n_bytes", "n_tokens", "n_chunks", F.lit(overlap_chars).cast("long").alias("overlap_chars"))
        out = out.unionByName(done)
        failed = found.where("n_tokens is null").select("digest").distinct()
        if failed.isEmpty():
            return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_chunks", "overlap_chars")
        # equal texts fail alike, so all rows of these texts come again; in the end one chunk holds the text
        huge = todo.join(failed, "digest", "left_semi")
        overlap_chars *= WIDEN
        chunk_chars = max(chunk_chars, WIDEN * overlap_chars)
