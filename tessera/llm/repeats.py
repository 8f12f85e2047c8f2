"""Operator 3: removal of repeated passages by longest previous factors.

A byte goes if some ``LENGTH`` = 50-byte string that covers it also starts in a
document with a smaller id; all strings are judged on the input.  In terms of
longest-previous-factor arrays: with all 50-byte factors in suffix order and each factor's
place given by its document id, a factor has a previous factor of 50 bytes if
its previous or next smaller place in that order shares all 50 bytes.  As only
that length counts, the order is kept by groups of equal factors, in which the
smaller place is the least id; the suffix order between groups decides nothing and is not built.

The order is dealt out by anchors.  Of the ``LENGTH - GRAM + 1`` grams (of ``GRAM``
bytes) that start in a factor, the one with the least hash (leftmost of equals) is
its anchor; equal factors have equal anchors at the same place.  Factors of a
document with the same anchor follow each other and form a segment of some 65 bytes.

1. Texts are dealt into blocks by id, once; exact copies of a smaller id are marked beforehand.
2. Each block sends the distinct hashes of its anchors to buckets by hash (six
   bytes each); a bucket answers with those that other blocks have too.
3. Each block sends its distinct segments with such anchors (or anchors in two of
   its documents), with their least id, to buckets.  There factors are put in order
   by anchor and content, and for each segment the factors with a smaller id elsewhere are sent back as bits.
4. Each block marks the bytes of all such factors, and of segments found under a
   smaller id in the block.

A passage in very many documents counts once per block in every bucket; no task
holds more than its block or bucket, whose number grows with the input.

Null and empty texts have nothing removed; so have rows with a null id, which are
not compared.  Rows with one id are judged each, and not against each other.
An empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import blocks, doc_text, text_slices, written

LENGTH = 50
GRAM = 20
BLOCK_BYTES = 8 << 20
_MAIL = "block int, kind int, id long, a binary, b binary"
_ARROW = pa.schema([("block", pa.int32()), ("kind", pa.int32()), ("id", pa.int64()), ("a", pa.binary()), ("b", pa.binary())])
_TOP = np.uint64(0xFFFFFFFF00000000)


def segments(buf: np.ndarray, off: np.ndarray):
    """Anchor hash, text, first factor start, last factor start and hash of each segment."""
    span = LENGTH - GRAM + 1
    prefix = K.Prefix(buf)
    gram = prefix.grams(GRAM)
    m = len(gram) - span + 1
    if m <= 0:
        z = np.zeros(0, np.int64)
        return z.view(np.uint64), z, z, z, z.view(np.uint64)
    least = (gram & _TOP) | np.arange(len(gram), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
    anchor = (least[:m] & ~_TOP).astype(np.int64)
    valid = np.zeros(m + 1, np.int8)  # starts of factors that lie in one text
    long = np.diff(off) >= LENGTH
    np.add.at(valid, off[:-1][long], 1)
    np.add.at(valid, off[1:][long] - LENGTH + 1, -1)
    valid = np.cumsum(valid[:-1], dtype=np.int8) > 0
    new = valid.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    new[off[:-1][long]] = True
    low = np.flatnonzero(new)
    stop = valid.copy()
    stop[:-1] &= ~valid[1:] | new[1:]
    high = np.flatnonzero(stop)
    at = anchor[low]
    text = np.searchsorted(off, low, "right") - 1
    # least hashes are small numbers: mixed again, they spread over all buckets
    return K.mix(gram[at]), text, low, high, prefix.hash(low, high + LENGTH) ^ K.mix((at - low).astype(np.uint64))


def _block(docs: pa.Table, late: set):
    """Slices (bytes, offsets, row numbers) of a block's texts, without late copies and null ids."""
    ids = docs.column("doc_id").to_pylist()
    some = {d for d, _ in late}
    texts = docs.column("text")
    keep = np.array([i for i, d in enumerate(ids) if d is not None
                     and not (d in some and (d, hashlib.sha256(texts[i].as_buffer()).digest()) in late)], np.int64)
    if not len(keep):
        return
    rows = docs.select(["doc_id", "text"]).take(pa.array(keep)).combine_chunks()
    at = 0
    for batch in rows.to_batches():
        for part in text_slices(batch):
            yield (*K.utf8(part.column("text")), part.column("doc_id").to_numpy(), keep[at:at + part.num_rows])
            at += part.num_rows


def _late(mail: pa.Table) -> set:
    """(id, SHA-256 of the text) of exact copies of a smaller id's text."""
    return {(i, a) for k, i, a in zip(mail.column("kind").to_pylist(), mail.column("id").to_pylist(), mail.column("a").to_pylist()) if k == 0}


def _payloads(mail: pa.Table, kind: int, column: str, dtype: str) -> np.ndarray:
    found = [np.frombuffer(x, dtype) for k, x in zip(mail.column("kind").to_pylist(), mail.column(column).to_pylist()) if k == kind]
    return np.concatenate(found) if found else np.zeros(0, dtype)


def _groups(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the values, where each distinct one begins in it, and the number of its group for each place of the order."""
    order = np.argsort(values)
    v = values[order]
    new = np.ones(len(v), bool)
    new[1:] = v[1:] != v[:-1]
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def _six(h: np.ndarray) -> bytes:
    """The low six bytes of each hash."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _bucket(h: np.ndarray, n: int) -> np.ndarray:
    """Bucket of each hash, by its high 32 bits."""
    return ((h >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _split(bucket: np.ndarray):
    """(bucket, from, to) of ascending bucket numbers."""
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    return zip(bucket[cut].tolist(), cut.tolist(), np.append(cut[1:], len(bucket)).tolist())


def _send_anchors(n: int):
    def run(docs, mail):
        found = [segments(buf, off)[0] for buf, off, _, _ in _block(docs, _late(mail))]
        h = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
        block = docs.column("block")[0].as_py() if docs.num_rows else 0
        rows = [(b, block, _six(h[x:y])) for b, x, y in _split(_bucket(h, n))]
        return pa.table([pa.array(x, t) for x, t in zip(list(zip(*rows)) or [[]] * 3, (pa.int32(), pa.int32(), pa.binary()))], names=["bucket", "block", "a"])
    return run


def _shared(mail):
    """Of a bucket's anchors, those of two blocks or more, for each block that has them."""
    block = mail.column("block").to_pylist()
    parts = [np.frombuffer(x, np.uint8).reshape(-1, 6) for x in mail.column("a").to_pylist()]
    six = np.zeros((sum(map(len, parts)), 8), np.uint8)
    np.concatenate(parts, out=six[:, :6])
    h = six.view("<u8").reshape(-1)
    who = np.repeat(np.arange(len(parts)), list(map(len, parts)))
    order, start, group = _groups(h)
    many = (np.diff(np.append(start, len(h))) > 1)[group]
    order = order[many]
    order = order[np.argsort(who[order], kind="stable")]
    rows = [(block[i], 1, None, h[order[x:y]].tobytes(), None) for i, x, y in _split(who[order])]
    return pa.table([pa.array(x, f.type) for x, f in zip(list(zip(*rows)) or [[]] * 5, _ARROW)], schema=_ARROW)


_SEGMENTS = "bucket int, block int, anchor binary, seg binary, doc binary, length binary, text binary"


def _send_segments(n: int):
    def run(docs, mail):
        known = np.sort(_payloads(mail, 1, "a", "<u8"))
        low48 = np.uint64((1 << 48) - 1)
        parts = []
        for buf, off, ids, _ in _block(docs, _late(mail)):
            anchor, text, low, high, seg = segments(buf, off)
            parts.append((anchor, ids[text], low, high, seg, np.full(len(low), len(parts)), buf))
        if not parts:
            return _table([], _SEGMENTS)
        anchor, doc, low, high, seg, part = (np.concatenate([p[i] for p in parts]) for i in range(6))
        order, start, group = _groups(anchor)
        many = np.minimum.reduceat(doc[order], start) != np.maximum.reduceat(doc[order], start) if len(order) else np.zeros(0, bool)
        here = np.zeros(len(anchor), bool)
        here[order] = many[group]
        if len(known):
            key = anchor & low48
            here |= known[np.minimum(np.searchsorted(known, key), len(known) - 1)] == key
        at = np.flatnonzero(here)
        if not len(at):
            return _table([], _SEGMENTS)
        order, start, _ = _groups(seg[at])
        least = np.minimum.reduceat(doc[at][order], start)
        at = at[order[start]]  # one of each segment
        to = _bucket(anchor[at], n)
        order = np.argsort(to, kind="stable")
        at, least = at[order], least[order]
        length = high[at] + LENGTH - low[at]
        source, begin = part[at], low[at]
        raw = [p[6].tobytes() for p in parts]
        text = [raw[p][a:a + x] for p, a, x in zip(source.tolist(), begin.tolist(), length.tolist())]
        block = docs.column("block")[0].as_py()
        return _table([(b, block, anchor[at[x:y]].tobytes(), seg[at[x:y]].tobytes(), least[x:y].tobytes(), length[x:y].astype("<u2").tobytes(), b"".join(text[x:y]))
                       for b, x, y in _split(to[order])], _SEGMENTS)
    return run


def _table(rows: list[tuple], schema: str) -> pa.Table:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    names = [c.split() for c in schema.split(", ")]
    return pa.table([pa.array(x, types[t]) for x, (_, t) in zip(list(zip(*rows)) or [[]] * len(names), names)], names=[n for n, _ in names])


def _previous(mail):
    """Bits of the factors of each segment that have an equal factor with a smaller place, per block."""
    read = {c: [np.frombuffer(x, t) for x in mail.column(c).to_pylist()] for c, t in (("anchor", "<u8"), ("seg", "<u8"), ("doc", "<i8"), ("length", "<u2"), ("text", np.uint8))}
    block = np.repeat(np.array(mail.column("block").to_pylist(), np.int64), [len(x) for x in read["seg"]])
    anchor, seg, doc, length, buf = (np.concatenate(read[c]) for c in read)
    length = length.astype(np.int64)
    start = np.cumsum(length) - length
    factors = length - LENGTH + 1
    which = np.repeat(np.arange(len(seg)), factors)
    place = np.arange(len(which)) - np.repeat(np.cumsum(factors) - factors, factors)
    at = start[which] + place
    content = K.Prefix(buf).hash(at, at + LENGTH) + anchor[which]  # anchor and content name the group
    order, begin, group = _groups(content)
    who = doc[which[order]]
    later = who > np.minimum.reduceat(who, begin)[group]
    order = order[later]
    bits = np.zeros(len(seg), np.uint64)
    np.bitwise_or.at(bits, which[order], np.uint64(1) << place[order].astype(np.uint64))
    some = np.flatnonzero(bits)
    some = some[np.argsort(block[some], kind="stable")]
    return pa.table([pa.array(x, f.type) for x, f in zip(list(zip(*[
        (b, 2, None, seg[some[x:y]].tobytes(), bits[some[x:y]].tobytes()) for b, x, y in _split(block[some])])) or [[]] * 5, _ARROW)], schema=_ARROW)


_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _remove(docs, mail):
    """The result of a block."""
    late = _late(mail)
    keys, bits = _payloads(mail, 2, "a", "<u8"), _payloads(mail, 2, "b", "<u8")
    order = np.argsort(keys)
    keys, bits = keys[order], bits[order]
    parts = [(buf, off, ids, rows, *segments(buf, off)) for buf, off, ids, rows in _block(docs, late)]
    out: list = [None] * docs.num_rows
    if parts:
        seg = np.concatenate([p[8] for p in parts])
        doc = np.concatenate([p[2][p[5]] for p in parts])
        order, start, group = _groups(seg)
        gone = np.zeros(len(seg), bool)
        if len(seg):
            gone[order] = doc[order] > np.minimum.reduceat(doc[order], start)[group]
        done = 0
        for buf, off, ids, rows, _, text, low, high, key in parts:
            whole = gone[done:done + len(low)]
            done += len(low)
            mark = np.zeros(len(buf) + 1, np.int32)  # +1 where removal by some factor begins, -1 where it ends
            np.add.at(mark, low[whole], 1)
            np.add.at(mark, high[whole] + LENGTH, -1)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = np.flatnonzero((keys[at] == key) & ~whole)
                for j in range(LENGTH - GRAM + 1):
                    s = low[hit[(bits[at[hit]] >> np.uint64(j)) & np.uint64(1) == 1]] + j
                    np.add.at(mark, s, 1)
                    np.add.at(mark, s + LENGTH, -1)
            removed = np.cumsum(mark[:-1]) > 0
            n = K.per_text(removed, off)
            _, _, spans = K.runs(removed, off)
            for i, row in enumerate(rows.tolist()):
                a, b = off[i], off[i + 1]
                kept = buf[a:b] if not n[i] else buf[a:b][~removed[a:b]]
                out[row] = (int(ids[i]), int(b - a), int(n[i]), int(spans[i + 1] - spans[i]), hashlib.sha256(kept.tobytes()).hexdigest())
    for row, (i, text) in enumerate(zip(docs.column("doc_id").to_pylist(), docs.column("text").to_pylist())):
        if out[row] is None:  # a late copy, or no id
            raw = text.encode()
            whole = i is not None and len(raw) >= LENGTH
            out[row] = (i, len(raw), len(raw) * whole, int(whole), hashlib.sha256(b"" if whole else raw).hexdigest())
    return _table(out, _OUT)


def repeats(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    spark = docs.sparkSession
    keys = written(doc_text(docs).select("doc_id", F.sha2("text", 256).alias("key"), F.octet_length("text").cast("long").alias("n_bytes")), "text-keys")
    n = blocks(spark, keys.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0], block_bytes)
    block = F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int").alias("block")
    none = F.lit(None).cast("binary")
    first = keys.where("doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first <> last")
    late = keys.join(first, "key").where("doc_id > first").select(block, F.lit(0).alias("kind"), F.col("doc_id").alias("id"), F.unhex("key").alias("a"), none.alias("b"))
    late = written(late.distinct(), "late-copies")

    texts = doc_text(docs).select(block, "doc_id", "text").repartition(n, "block")

    def by_block(mail: DataFrame, f, schema: str) -> DataFrame:
        return texts.groupBy("block").cogroup(mail.groupBy("block")).applyInArrow(f, schema)

    anchors = by_block(late, _send_anchors(n), "bucket int, block int, a binary")
    shared = anchors.groupBy("bucket").applyInArrow(_shared, _MAIL)
    sent = by_block(late.unionByName(shared), _send_segments(n), _SEGMENTS)
    previous = sent.groupBy("bucket").applyInArrow(_previous, _MAIL)
    return by_block(late.unionByName(previous), _remove, _OUT)
