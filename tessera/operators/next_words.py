"""Kernels of the greedy word model: counts of word triples and pairs in packed pieces.

A *piece* is a list of distinct words, sorted by their bytes, and equally long columns of places in it,
sorted; the last column is a count or another number.  A task numbers the words of its own slice, sums equal rows
and deals them out in pieces by a hash of their context, so no word is written once a row and
no vocabulary is shipped.  As the words of a piece are sorted, the smallest place is the smallest word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BEGIN, END = "<s>", "</s>"
#: Words counted at once by a task that reads texts; a longer text makes a slice of its own.
SLICE_WORDS = 4_000_000
#: UTF-8 bytes split at once.
SLICE_BYTES = 8 << 20
#: Rows gathered before equal ones are summed.
MERGE_ROWS = 2_000_000
#: Bytes that a packed word shares with the one before at most.
SHARED_BYTES = 6
#: Words that fit a third of a 63-bit key.
NARROW = 1 << 21
#: Most buckets that share a list of words until they are merged.
SHARE = 8
#: The bytes that ``functions.text.WORD_SPLIT`` splits at.
BLANK = np.isin(np.arange(256), list(b" \t\n\r\f"))
PIECES = "part int, size long, words binary, n array<bigint>, codes array<binary>"
MODEL = "bucket int, size long, words binary, n long, codes binary"

Piece = tuple[pa.Array, list[np.ndarray]]


# ------------------------------------------------------------------ pieces --
def _planes(x: np.ndarray) -> tuple[int, bytes]:
    """(bytes a value, byte planes) of numbers from 0 on."""
    if not len(x):
        return 1, b""
    wide = x.astype("<i8" if x.dtype.itemsize == 8 else "<i4", copy=False)
    k = max(1, (int(x.max()).bit_length() + 7) // 8)
    return k, wide.view(np.uint8).reshape(len(x), -1)[:, :k].T.tobytes()


def _numbers(raw: np.ndarray, k: int, dtype: str) -> np.ndarray:
    n = len(raw) // k
    out = np.zeros((n, np.dtype(dtype).itemsize), np.uint8)
    out[:, :k] = raw.reshape(k, n).T
    return out.view(dtype).ravel()


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a large binary array."""
    _, off, data = words.buffers()
    off = np.frombuffer(off, np.int64)[words.offset:words.offset + len(words) + 1]
    return off - off[0], np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)


def _own(offsets: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Which bytes lie beyond the first ``same`` of their word."""
    out = np.ones(offsets[-1], bool)
    for k in range(int(same.max()) if len(same) else 0):
        out[offsets[:-1][same > k] + k] = False
    return out


def pack_words(words: pa.Array) -> tuple[int, bytes]:
    """(number of words, their lengths, the bytes each shares with the word before, the other bytes)."""
    offsets, text = _bytes_of(words)
    lengths = np.diff(offsets)
    least = np.minimum(lengths[1:], lengths[:-1])
    same, rows = np.zeros(len(lengths), np.uint8), np.arange(1, len(lengths))
    for k in range(SHARED_BYTES):
        rows = rows[least[rows - 1] > k]
        rows = rows[text[offsets[rows] + k] == text[offsets[rows - 1] + k]]
        if not len(rows):
            break
        same[rows] += 1
    own = text[_own(offsets, same)]
    k, planes = _planes(lengths.astype(np.int32))
    return len(words), np.array([k, len(own)], "<i8").tobytes() + _codec().compress(planes + same.tobytes() + own.tobytes(), asbytes=True)


def unpack_words(size: int, packed: bytes) -> pa.Array:
    k, length = np.frombuffer(packed[:16], "<i8").tolist()
    raw = np.frombuffer(_codec().decompress(packed[16:], size * (k + 1) + length, asbytes=True), np.uint8)
    lengths, same, own = _numbers(raw[:size * k], k, "<i4"), raw[size * k:size * (k + 1)], raw[size * (k + 1):]
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    first = np.concatenate([[0], np.cumsum(lengths - same, dtype=np.int64)])[:-1] - same  # where a word's bytes would start among the written ones
    text, written, rows, filled = np.empty(offsets[-1], np.uint8), np.ones(offsets[-1], bool), np.arange(size, dtype=np.int32), []
    for j in range(int(same.max()) if size else 0):  # byte j is that of the last word that has it written
        at = np.flatnonzero(same > j)
        source = np.where(same <= j, rows, 0)
        np.maximum.accumulate(source, out=source)
        filled.append((offsets[at] + j, first[source[at]] + j))
        written[filled[-1][0]] = False
    text[written] = own
    for to, of in filled:
        text[to] = own[of]
    return pa.Array.from_buffers(pa.large_binary(), size, [None, pa.py_buffer(offsets), pa.py_buffer(text)])


def pack_columns(cols: list[np.ndarray]) -> tuple[int, bytes]:
    """(rows, byte planes of the columns, the first as differences)."""
    widths, planes = zip(*map(_planes, [np.diff(cols[0], prepend=cols[0].dtype.type(0)), *cols[1:]]))
    return len(cols[0]), bytes(widths) + _codec().compress(b"".join(planes), asbytes=True)


def unpack_columns(n: int, packed: bytes, places: int, first: int | None = None) -> list[np.ndarray]:
    """``places`` columns of places and the last one; those after the ``first`` stay byte planes."""
    widths = list(packed[:places + 1])
    raw = np.frombuffer(_codec().decompress(packed[places + 1:], n * sum(widths), asbytes=True), np.uint8)
    ends = n * np.cumsum(widths)
    cols = [raw[e - n * k:e] for e, k in zip(ends, widths)]
    cols = [_numbers(x, k, "<i8" if i == places else "<i4") if first is None or i < first else x for i, (x, k) in enumerate(zip(cols, widths))]
    return [np.cumsum(cols[0], dtype=np.int32), *cols[1:]]


def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=1)


def numbered(lists: list[pa.Array]) -> tuple[pa.Array, list[np.ndarray]]:
    """(the distinct words of all lists, sorted by their bytes; for each list the places of its words)."""
    coded = pa.concat_arrays(lists).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    at = place[coded.indices.to_numpy()]
    return coded.dictionary.take(pa.array(order)), np.split(at, np.cumsum([len(x) for x in lists])[:-1])


def summed(cols: list[np.ndarray], weights: np.ndarray | None, n_words: int) -> list[np.ndarray]:
    """Distinct rows of ``cols``, sorted, with the sums of their weights (None: 1 each) as the last column."""
    if not len(cols[0]):
        return [*cols, np.zeros(0, np.int64)]
    if n_words <= NARROW and len(cols) <= 3:
        key = cols[0].astype(np.int64)
        for x in cols[1:]:
            key <<= 21
            key |= x
        if weights is None:
            key.sort()
        else:
            order = np.argsort(key)
            key = key[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sums = np.diff(np.append(starts, len(key))) if weights is None else np.add.reduceat(weights[order], starts)
        key = key[starts]
        return [*((key >> 21 * (len(cols) - 1 - k) & (NARROW - 1)).astype(np.int32) for k in range(len(cols))), sums]
    order = np.lexsort(cols[::-1])
    cols = [x[order] for x in cols]
    starts = np.flatnonzero(np.concatenate([[True], np.any([x[1:] != x[:-1] for x in cols], axis=0)]))
    sums = np.diff(np.append(starts, len(order))) if weights is None else np.add.reduceat(weights[order], starts)
    return [*(x[starts] for x in cols), sums]


def merged(pieces: list[Piece]) -> Piece:
    """One piece with the words of all; equal rows are summed.  The list is emptied."""
    if len(pieces) == 1:
        return pieces[0]
    words, places = numbered([w for w, _ in pieces])
    cols = [np.concatenate([place[mine[k]] for place, (_, mine) in zip(places, pieces)]) for k in range(len(pieces[0][1]) - 1)]
    counts = np.concatenate([mine[-1] for _, mine in pieces])
    pieces.clear()
    return words, summed(cols, counts, len(words))


def used(words: pa.Array, cols: list[np.ndarray]) -> Piece:
    """A piece of the words that ``cols`` (all but the last) name; keeps their order."""
    *places, last = cols
    if len(words) > 16 * len(last):
        named, at = np.unique(np.concatenate(places), return_inverse=True)
        places = np.split(at.astype(np.int32), len(places))
    else:
        flags = np.zeros(len(words), bool)
        for x in places:
            flags[x] = True
        named = np.flatnonzero(flags)
        at = np.cumsum(flags, dtype=np.int32) - 1
        places = [at[x] for x in places]
    return words.take(pa.array(named)), [*places, last]


# ------------------------------------------------------------------ buckets --
def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit number of each word by its bytes; it decides the bucket only."""
    offsets, text = _bytes_of(words)
    if not len(text):
        return np.zeros(len(words), np.uint64)
    lengths = np.diff(offsets)
    powers = np.full(int(lengths.max()) + 1, 0x9E3779B97F4A7C55, np.uint64)
    powers[0] = 1
    value = (text.astype(np.uint64) + np.uint64(1)) * np.cumprod(powers)[np.arange(len(text)) - np.repeat(offsets[:-1], lengths)]
    full = np.flatnonzero(lengths)
    out = np.zeros(len(words), np.uint64)
    out[full] = np.add.reduceat(value, offsets[full])
    out = (out ^ out >> np.uint64(31)) * np.uint64(0x7FB5D329728EA185)
    return out ^ out >> np.uint64(29)


def bucket_of(hashes: list[np.ndarray], n: int) -> np.ndarray:
    """Bucket by the hashes of a context's words."""
    h = hashes[0] * np.uint64(0x9E3779B97F4A7C15)
    for x in hashes[1:]:
        h ^= x * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h >> np.uint64(33)) % np.uint64(n)).astype(np.int32)


def shared(n: int) -> int:
    """Buckets of a part: with many, lists of words would outweigh the numbers."""
    return min(SHARE, max(1, n // 64))


def dealt(piece: Piece, n: int, hashes: np.ndarray) -> Iterator[tuple]:
    """Rows of ``PIECES``: the piece's rows by the bucket of their context, all columns but the last two."""
    words, cols = piece
    group = shared(n)
    at = bucket_of([hashes[x] for x in cols[:-2]], n)
    order = np.argsort(at.astype(np.uint16) if n <= 1 << 16 else at, kind="stable")
    borders = np.searchsorted(at[order], np.arange(0, n + group))
    for part in range(-(-n // group)):
        ends = borders[part * group:(part + 1) * group + 1]
        rows = order[ends[0]:ends[-1]]
        if len(rows):
            mine, codes = used(words, [x[rows] for x in cols])
            packed = [pack_columns([x[lo:hi] for x in codes]) for lo, hi in zip(ends[:-1] - ends[0], ends[1:] - ends[0])]
            yield (part, *pack_words(mine), [x[0] for x in packed], [x[1] for x in packed])


# ----------------------------------------------------------------- counting --
def words_of(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the words of all texts, how many each text has): what ``WORD_SPLIT`` leaves."""
    offsets, raw = _bytes_of(pc.fill_null(text, "").cast(pa.large_binary()))
    inside = ~BLANK[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][np.diff(offsets) > 0]
    begins[first] = inside[first]
    counts = np.diff(np.searchsorted(np.flatnonzero(begins), offsets))
    kept = raw[inside]
    ends = np.append(np.flatnonzero(begins[inside]), len(kept)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(kept)]), counts


def stream_of(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, places, last): two marks of the beginning, the words and the mark of the end of each text; ``last``: not a beginning."""
    flat, counts = words_of(text)
    coded = flat.dictionary_encode()
    words = coded.dictionary
    mark = []
    for m in (BEGIN.encode(), END.encode()):  # a text may have the marks as words
        found = pc.index(words, pa.scalar(m, pa.large_binary())).as_py()
        if found < 0:
            found, words = len(words), pa.concat_arrays([words, pa.array([m], pa.large_binary())])
        mark.append(found)
    ends = np.cumsum(counts + 3)
    start = ends - (counts + 3)
    stream = np.full(int(ends[-1]) if len(ends) else 0, mark[1], np.int32)
    plain, last = np.ones(len(stream), bool), np.ones(len(stream), bool)
    for x in (plain, last):
        x[start] = x[start + 1] = False
    plain[ends - 1] = False
    stream[start] = stream[start + 1] = mark[0]
    stream[plain] = coded.indices.to_numpy()
    return words, stream, last


def _parts(text: pa.Array) -> Iterator[pa.Array]:
    """The texts in slices of about ``SLICE_BYTES``, one text at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy().astype(np.int64))
    lo = 0
    while lo < len(text):
        hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + SLICE_BYTES, "right")))
        yield text.slice(lo, hi - lo)
        lo = hi


def _counted(held: list[tuple], order: int, n: int) -> Iterator[tuple]:
    words, places = numbered([x[0] for x in held])
    stream, last = np.concatenate([place[x[1]] for place, x in zip(places, held)]), np.concatenate([x[2] for x in held])
    held.clear()
    at = np.flatnonzero(last)  # the two before are of the same text
    cols = [stream[at - k] for k in range(order, -1, -1)]
    del at, last, stream
    yield from dealt((words, summed(cols, None, len(words))), n, word_hashes(words))


def _batches(rows: Iterable[tuple], limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.binary()))
    out, size = [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=["part", "size", "words", "n", "codes"])

    for row in rows:
        out.append(row)
        size += len(row[2]) + sum(map(len, row[4]))
        if size >= limit:
            yield batch()
            out, size = [], 0
    if out:
        yield batch()


def counted(batches: Iterable[pa.RecordBatch], order: int, n: int) -> Iterator[pa.RecordBatch]:
    """Counts of every word after its context, the ``order`` words before it, from batches of one text column; dealt by context."""
    held, total = [], 0
    for batch in batches:
        for text in _parts(batch.column(0)):
            held.append(stream_of(text))
            total += len(held[-1][1])
            if total >= SLICE_WORDS:
                yield from _batches(_counted(held, order, n))
                total = 0
    if held:
        yield from _batches(_counted(held, order, n))


# ----------------------------------------------------------------- choosing --
def best(piece: Piece) -> Piece:
    """(context, next word, count of the context): the word seen most often; ties go to the smallest word."""
    words, cols = piece
    *context, w, c = cols
    starts = np.flatnonzero(np.concatenate([[True], np.any([x[1:] != x[:-1] for x in context], axis=0)]))
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(c))))
    top = np.flatnonzero(c == np.maximum.reduceat(c, starts)[group])
    first = top[np.concatenate([[True], np.diff(group[top]) != 0])]
    return used(words, [*(x[first] for x in context), w[first], np.add.reduceat(c, starts)])


def chosen(batches: Iterable[pa.RecordBatch], order: int, n: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``MODEL``: one piece of ``best`` a bucket, from all its pieces; they are packed until the bucket's turn."""
    packed: dict[int, list[tuple]] = {}
    for batch in batches:
        for part, *row in zip(*(batch.column(c).to_pylist() for c in ("part", "size", "words", "n", "codes"))):
            packed.setdefault(part, []).append(row)
    for part in list(packed):
        mine = packed.pop(part)
        for k in range(len(mine[0][2])):
            pieces, rows, base = [], 0, 0
            for size, words, counts, codes in mine:
                if counts[k]:
                    pieces.append(used(unpack_words(size, words), unpack_columns(counts[k], codes[k], order + 1)))
                    rows += counts[k]
                    codes[k] = None
                if rows >= MERGE_ROWS + 2 * base and len(pieces) > 1:
                    pieces = [merged(pieces)]
                    rows = base = len(pieces[0][1][0])
            if pieces:
                words, cols = best(merged(pieces))
                size, text = pack_words(words)
                count, codes = pack_columns(cols)
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((part * shared(n) + k, size, text, count, codes),
                                                  (pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.binary()))], names=["bucket", "size", "words", "n", "codes"])


def lookup(model: pa.Table, context: list[pa.Array]) -> pa.Array:
    """The next word of each context by the pieces of one bucket; null where the context is not in it."""
    rows = len(context[0])
    if not model.num_rows or not rows:
        return pa.nulls(rows, pa.string())
    size, text, n, packed = (model.column(c)[0].as_py() for c in ("size", "words", "n", "codes"))
    words, (*cols, nxt, _) = unpack_words(size, text), unpack_columns(n, packed, len(context) + 1, len(context))
    names, codes = numbered([x.cast(pa.large_binary()) for x in context])
    found = pc.index_in(words, value_set=names)  # few contexts are asked, many words known
    mine = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
    place = np.full(len(names), -1, np.int64)
    place[found.drop_null().to_numpy()] = mine
    key, asked, known = np.zeros(n, np.int64), np.zeros(rows, np.int64), np.ones(rows, bool)
    for code, x in zip(codes, cols):
        known &= place[code] >= 0
        asked = asked * len(words) + np.maximum(place[code], 0)
        key = key * len(words) + x
    at = np.minimum(np.searchsorted(key, asked), len(key) - 1)
    known &= key[at] == asked
    return words.take(pa.array(_numbers(np.ascontiguousarray(nxt.reshape(-1, n)[:, at]).ravel(), len(nxt) // n, "<i4"), mask=~known)).cast(pa.string())


def frequent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, count) of the contexts of one word with the highest count in their bucket, the smallest two and ``BEGIN``.

    Marks are counted among the words here: whoever takes the first must leave them out.
    """
    for batch in batches:
        for size, text, n, codes in zip(*(batch.column(c).to_pylist() for c in ("size", "words", "n", "codes"))):
            words, (v, _, c) = unpack_words(size, text), unpack_columns(n, codes, 2)
            marks = pc.index_in(pa.array([BEGIN.encode(), END.encode()], pa.large_binary()), value_set=words).drop_null().to_numpy()
            plain = np.where(np.isin(v, marks), 0, c)
            rows = np.unique(np.append(np.flatnonzero(np.isin(v, marks)), np.argmax(plain)))  # the first of equal counts: the smallest word
            yield pa.RecordBatch.from_arrays([words.take(pa.array(v[rows])).cast(pa.string()), pa.array(c[rows], pa.int64())], names=["word", "n"])


# --------------------------------------------------------------- generation --
def _buckets(n: int, *context: pa.Array) -> pa.Array:
    return pa.array(bucket_of([word_hashes(x.cast(pa.large_binary())) for x in context], n))


def placed(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Rows with the ``bucket`` of their (u, v)."""
    for batch in batches:
        yield batch.set_column(0, "bucket", _buckets(n, batch.column("u"), batch.column("v")))


def by_two(rows: pa.Table, piece: pa.Table, n: int) -> pa.Table:
    """The rows of a bucket with ``word``, the next word by (u, v), null if that is not known; ``bucket`` becomes that of v."""
    u, v = (_plain(rows.column(c)) for c in "uv")
    return rows.set_column(rows.column_names.index("bucket"), "bucket", _buckets(n, v)).append_column("word", lookup(piece, [u, v]))


def by_one(rows: pa.Table, piece: pa.Table, n: int, overall: str) -> pa.Table:
    """The rows one word further: ``word``, else the next word by v, else ``overall``."""
    v, word = (_plain(rows.column(c)) for c in ("v", "word"))
    if word.null_count:
        word = pc.coalesce(word, lookup(piece, [v]), pa.scalar(overall, pa.string()))
    return further(rows, word, n)


def seen(rows: pa.Table, piece: pa.Table, n: int) -> pa.Table:
    """The rows one word further, where the model knows every (u, v) that is not done."""
    u, v = (_plain(rows.column(c)) for c in "uv")
    word = lookup(piece, [u, v])
    done = _plain(rows.column("done"))
    if pc.any(pc.and_(pc.is_null(word), pc.invert(done))).as_py():
        raise ValueError("a context of the model's own words is not in the model")
    return further(rows, pc.fill_null(word, END), n)


def further(rows: pa.Table, word: pa.Array, n: int) -> pa.Table:
    """The rows with ``word`` added where it isn't the end; ``bucket`` becomes that of the new (u, v)."""
    u, v, out, made = (_plain(rows.column(c)) for c in ("u", "v", "out", "made"))
    done = pc.or_(_plain(rows.column("done")), pc.equal(word, END))
    longer = pc.if_else(pc.equal(made, 0), word, pc.binary_join_element_wise(out, word, " "))
    out, made = pc.if_else(done, out, longer), pc.add(made, pc.cast(pc.invert(done), pa.int64()))
    u, v = pc.if_else(done, u, v), pc.if_else(done, v, word)
    return pa.table({"bucket": _buckets(n, u, v), "u0": rows.column("u0"), "v0": rows.column("v0"), "u": u, "v": v, "out": out, "made": made, "done": done})


def _plain(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
