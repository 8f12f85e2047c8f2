"""Operator 6: near duplicates by improved consistent weighted sampling of TF-IDF shingles.

Words are runs of letters and digits (lower-cased), shingles are five words (a
shorter text is one shingle of all its words).  The weight of a shingle is its
count in the text times its IDF, ln(1 + R / df) / ln(1 + R) with R = ``REFERENCE``, at
least ``FLOOR``: below that a large group of copies would lose its links to its own
frequency.  R is fixed, so a link depends on the two texts and on how many documents hold
their shingles, not on the size of the table.

Each distinct text draws ``BANDS * ROWS`` consistent weighted samples (Ioffe's
improved scheme; two texts agree on each with a probability that is their weighted
Jaccard similarity), in bands of three: at 0.8 a pair meets in some band with
probability 0.9992, at 0.77 with 0.997.  Exact copies (same words) are one text from the start.
For the samples, and only for them, document frequencies are estimated by ``BUCKETS`` hashed
counters less their mean load; all texts use the same ones.

1. Every text of a band's bucket is compared with the bucket's least one; pairs that
   agree on ``AGREE`` samples are compared exactly.
2. In buckets that still hold several classes, every pair of texts of different
   classes is compared exactly, by an inverted list of shingles.  A pure bucket, however large, costs
   one pair per text; a mixed one is dealt out in chunks, two at a time, so none is gathered in one task.
3. A pair is a link if its weighted Jaccard similarity is ``SIMILARITY`` or more with
   TF or with TF-IDF weights.  TF alone decides at ``SIMILARITY`` and above, and below ``GREY``,
   where no IDF can lift a pair to ``SIMILARITY``.  Between, a pair is left out if its classes are joined
   anyway, or if the texts of its bucket alone make its shared shingles too common; for the other pairs
   the document frequencies of their shingles are counted exactly over all documents.

Links are joined to classes.  ``near_duplicates`` returns doc_id and class_id (least doc_id of the
class) of every row; an id that comes with several texts is one document and joins their classes.
``deduplicate`` keeps all columns and one row of each class (the least id's); it judges rows, so
no text goes because of another text of its id.  Texts without words (null, empty) and
rows with a null id make no links.  An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import add_blocks, doc_text, release, text_slices, written
from .components import components
from .privacy import free_name

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 10, 3
AGREE = 13
BUCKETS = 1 << 20
BLOCK = 1 << 14
FLOOR = 0.85
#: Documents to which document frequencies are related.
REFERENCE = 1_000_000
#: IDF of a shingle that two documents hold.
SHARED = math.log1p(REFERENCE / 2) / math.log1p(REFERENCE)
#: TF similarity from which a pair can reach SIMILARITY: shared shingles weigh SHARED at most, others FLOOR at least.
GREY = SIMILARITY * FLOOR / (SHARED * (1 - SIMILARITY) + SIMILARITY * FLOOR)
#: Bits (2^BITS) of the filter of the shingles whose document frequencies are asked for, and bytes of its blocks.
BITS, BLOCK_BYTES = 27, 1 << 17
#: Texts of a mixed bucket compared in one group, at most about twice this.
CHUNK = 2_000
_LOW = np.uint64(0xFFFF)


def vectors(column: pa.Array):
    """Distinct shingles of each text: 51-bit hashes (ascending in a text), counts, texts and borders."""
    buf, off = K.utf8(column)
    low = K.LOWER[buf]
    start, end, borders = K.runs(K.WORD[low], off)
    words = K.Prefix(low).hash(start, end)
    h, text, _ = K.shingles(words, borders, WORDS, short=True)
    key = np.sort((text.astype(np.uint64) << np.uint64(51)) | (h >> np.uint64(13)))
    new = np.flatnonzero(np.diff(key, prepend=~key[:1]) != 0)
    count = np.diff(np.append(new, len(key)))
    key = key[new]
    text = (key >> np.uint64(51)).astype(np.int64)
    return key & np.uint64((1 << 51) - 1), count, text, np.searchsorted(text, np.arange(len(off)))


def digests(column: pa.Array) -> list[bytes]:
    """SHA-256 of each text's words, joined by one space: equal for copies only."""
    buf, off = K.utf8(column)
    low = K.LOWER[buf]
    word = K.WORD[low]
    keep = word.copy()
    keep[1:] |= word[:-1]  # a word and what follows it
    borders = off[(off > 0) & (off < len(buf))]
    keep[borders] = word[borders]
    n = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(keep, out=n[1:])
    data = memoryview(np.where(word, low, 32).astype(np.uint8)[keep])
    at = n[off].tolist()
    return [hashlib.sha256(data[a:b - 1] if b > a and data[b - 1] == 32 else data[a:b]).digest() for a, b in zip(at, at[1:])]


def _bucket(shingle: np.ndarray) -> np.ndarray:
    return (shingle >> np.uint64(31)).astype(np.int64)


def idf(df: np.ndarray) -> np.ndarray:
    """IDF weight of shingles found in ``df`` documents."""
    return np.maximum(FLOOR, np.log1p(REFERENCE / df) / np.log1p(REFERENCE))


def _frequencies(batches):
    total, n = np.zeros(BUCKETS, np.int32), 0
    for batch in batches:
        n += batch.num_rows
        for part in text_slices(batch):
            total += np.bincount(_bucket(vectors(part.column("text"))[0]), minlength=BUCKETS).astype(np.int32)
    if n:
        for i, x in enumerate(total.astype(np.int64).reshape(-1, BLOCK)):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["block", "counts"])


def counters(texts: DataFrame) -> np.ndarray:
    """(text, distinct shingle) pairs of all texts by hashed counter (a table of fixed size)."""
    total = np.zeros((BUCKETS // BLOCK, BLOCK), np.int64)
    for r in add_blocks(texts.select("text").mapInArrow(_frequencies, "block int, counts binary"), BLOCK).toLocalIterator():
        total[r.block] += np.frombuffer(r.counts, np.int64)
    return total.reshape(-1)


def sampling_weights(docs: DataFrame) -> np.ndarray:
    """Estimated IDF of each counter; a shingle whose counter does not stand out by four standard deviations counts as found once."""
    df = counters(doc_text(docs)).astype(np.float64)
    mean = df.mean()
    df -= mean
    df[df < 1 + 4 * np.sqrt(mean)] = 1
    return idf(df).astype(np.float32)


def _gamma() -> np.ndarray:
    """Quantiles of Gamma(2, 1)."""
    x = np.linspace(0, 30, 300_001)
    return np.interp((np.arange(1 << 16) + 0.5) / (1 << 16), 1 - (1 + x) * np.exp(-x), x)


_R = _gamma().astype(np.float32)
_RINV = (1 / _gamma()).astype(np.float32)
_LNC = np.log(_gamma()).astype(np.float32)
_SEEDS = K.mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def samples(shingle: np.ndarray, weight: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """32-bit hashes of the consistent samples (shingle, level) of each text that has shingles."""
    start = borders[:-1][np.diff(borders) > 0]
    count = np.diff(np.append(start, borders[-1]))
    log_weight = np.log(weight)
    out = np.zeros((len(start), len(_SEEDS)), np.int32)
    for i, seed in enumerate(_SEEDS):
        u = K.mix(shingle ^ seed)
        at = (u & _LOW).astype(np.int64)
        r = _R[at]
        beta = (u >> np.uint64(40)).astype(np.float32) * np.float32(2.0 ** -24)
        t = np.floor(log_weight * _RINV[at] + beta)
        a = _LNC[((u >> np.uint64(16)) & _LOW).astype(np.int64)] - r * (t - beta + np.float32(1))
        least = np.flatnonzero(a == np.repeat(np.minimum.reduceat(a, start), count))
        pick = least[np.searchsorted(least, start)]
        out[:, i] = (K.mix(u[pick] + t[pick].astype(np.int64).view(np.uint64) * np.uint64(0xD1342543DE82EF95)) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def _rows(docs: DataFrame) -> DataFrame:
    return doc_text(docs).withColumn("raw", F.sha2("text", 256))


def signatures(docs: DataFrame, weights) -> DataFrame:
    """doc_id, SHA-256 of the text, the digest of its words, and the samples (null without words) of every row; ``weights``: a broadcast table."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                shingle, count, _, borders = vectors(part.column("text"))
                n = np.diff(borders)
                sig = samples(shingle, count * weights.value[_bucket(shingle)], borders) if len(shingle) else np.zeros((0, len(_SEEDS)), np.int32)
                each = np.zeros(len(n) + 1, np.int32)
                np.cumsum((n > 0) * len(_SEEDS), out=each[1:])
                lists = pa.ListArray.from_arrays(pa.array(each), pa.array(sig.reshape(-1)), mask=pa.array(n == 0))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("raw"), pa.array(digests(part.column("text")), pa.binary()), lists],
                                                 names=["doc_id", "raw", "digest", "sig"])

    return _rows(docs).mapInArrow(run, "doc_id long, raw string, digest binary, sig array<int>")


def _jaccard(x: np.ndarray, y: np.ndarray, p: np.ndarray, q: np.ndarray) -> float:
    """Weighted Jaccard similarity; x[p] and y[q] belong to the same shingles."""
    low = np.minimum(x[p], y[q]).sum()
    return float(low / (x.sum() + y.sum() - low))


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose exact TF similarity is ``GREY`` or more; sure: ``SIMILARITY`` or more."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "ta", 1 << 20):
                found = []
                sides = [vectors(part.column(c)) for c in ("ta", "tb")]
                for i in range(part.num_rows):
                    (x, cx), (y, cy) = [(s[b[i]:b[i + 1]], c[b[i]:b[i + 1]]) for s, c, _, b in sides]
                    both, p, q = np.intersect1d(x, y, assume_unique=True, return_indices=True)
                    found.append(_jaccard(cx, cy, p, q) if len(both) else 0.0)
                keep = [i for i, s in enumerate(found) if s >= GREY]
                rows = part.select(["a", "b"]).take(pa.array(keep, pa.int64()))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array([found[i] >= SIMILARITY for i in keep], pa.bool_())], names=["a", "b", "sure"])

    one = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long, sure boolean")


def _bit(shingle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte of the filter and the bit in it of each shingle."""
    at = shingle & np.uint64((1 << BITS) - 1)
    return (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)


def _filter(texts: DataFrame) -> np.ndarray:
    """Bits of all shingles of the texts (a table of fixed size)."""

    def own(batches):
        bits = None
        for batch in batches:
            for part in text_slices(batch):
                bits = np.zeros(1 << (BITS - 3), np.uint8) if bits is None else bits
                np.bitwise_or.at(bits, *_bit(vectors(part.column("text"))[0]))
        yield from _blocks({} if bits is None else {i: x for i, x in enumerate(bits.reshape(-1, BLOCK_BYTES)) if x.any()})

    def joined(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, x in zip(batch.column("block").to_pylist(), batch.column("bits")):
                x = np.frombuffer(x.as_buffer(), np.uint8)
                total[block] = total[block] | x if block in total else x.copy()
        yield from _blocks(total)

    bits = np.zeros((1 << (BITS - 3)) // BLOCK_BYTES * BLOCK_BYTES, np.uint8).reshape(-1, BLOCK_BYTES)
    schema = "block int, bits binary"
    for r in texts.select("text").mapInArrow(own, schema).repartition("block").mapInArrow(joined, schema).toLocalIterator():
        bits[r.block] = np.frombuffer(r.bits, np.uint8)
    return bits.reshape(-1)


def _blocks(found: dict):
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([x.tobytes() for x in found.values()], pa.binary())], names=["block", "bits"])


def by_idf(pairs: DataFrame, texts: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose TF-IDF similarity is high enough, by document frequencies counted exactly for their shingles."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    asked = _step(texts.join(nodes, "id"), "asked")
    # most other shingles are left out by a filter of fixed size; what gets through is compared by the join
    some = docs.sparkSession.sparkContext.broadcast(_filter(asked))

    def each(batches):
        for batch in batches:
            for part in text_slices(batch):
                shingle, count, text, _ = vectors(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(text)), pa.array(shingle.view(np.int64)), pa.array(count, pa.int64())], names=["id", "shingle", "n"])

    def found(batches):
        for batch in batches:
            for part in text_slices(batch):
                shingle = vectors(part.column("text"))[0]
                at, bit = _bit(shingle)
                hit = some.value[at] & bit > 0
                shingle, n = np.unique(shingle[hit], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(shingle.view(np.int64)), pa.array(n, pa.int64())], names=["shingle", "n"])

    def weighed(batches):
        for batch in batches:
            keep = []
            for i, row in enumerate(zip(*(batch.column(c).to_pylist() for c in ("va", "vb")))):
                (x, wx), (y, wy) = [(np.array([e["shingle"] for e in v], np.int64), np.array([e["n"] for e in v]) * idf(np.array([e["df"] for e in v], np.float64))) for v in row]
                _, p, q = np.intersect1d(x, y, assume_unique=True, return_indices=True)
                if _jaccard(wx, wy, p, q) >= SIMILARITY:
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    mine = asked.mapInArrow(each, "id long, shingle long, n long")
    df = doc_text(docs).select("text").mapInArrow(found, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("df"))
    vector = _step(mine.join(df, "shingle").groupBy("id").agg(F.collect_list(F.struct("shingle", "n", "df")).alias("v")), "vectors")
    return (pairs.select("a", "b").join(vector.select(F.col("id").alias("a"), F.col("v").alias("va")), "a")
            .join(vector.select(F.col("id").alias("b"), F.col("v").alias("vb")), "b").mapInArrow(weighed, "a long, b long"))


def _mixed_links(key, table):
    """Pairs between texts of different classes, of one chunk or two of a bucket, as ``compared`` gives them."""
    table = table.combine_chunks()
    band, one, two = (x.as_py() for x in key[1:])
    ids, label, chunk = (table.column(c).to_numpy() for c in ("id", "class", "chunk"))
    n, same = len(ids), one == two
    sig = np.array(table.column("sig").to_pylist(), np.int32).reshape(n, BANDS, ROWS)[:, :band]
    shingle, count, text, borders = vectors(table.column("text"))
    size = np.bincount(text, weights=count, minlength=n)
    order = np.argsort(shingle, kind="stable")
    by, owner, count_by = shingle[order], text[order], count[order]
    held = np.searchsorted(by, by, "right") - np.searchsorted(by, by, "left")  # documents here that hold it: its df or fewer
    most = idf(np.maximum(held, 2))
    classes, at, members = np.unique(label, return_inverse=True, return_counts=True)
    main = at == np.argmax(members)  # its members are compared with the others only
    out: dict = {}
    for i in np.flatnonzero(~main):
        far = (label != label[i]) & (main | (ids > ids[i])) & (same | (chunk != chunk[i]))
        far &= ~(sig == sig[i]).all(axis=2).any(axis=1)  # pairs that meet in an earlier band are compared there
        if not far.any():
            continue
        mine, often = shingle[borders[i]:borders[i + 1]], count[borders[i]:borders[i + 1]]
        left, right = np.searchsorted(by, mine, "left"), np.searchsorted(by, mine, "right")
        span = right - left
        hit = np.arange(span.sum()) + np.repeat(left - np.cumsum(span) + span, span)
        both = np.minimum(count_by[hit], np.repeat(often, span))
        low, high = (np.bincount(owner[hit], weights=w, minlength=n) for w in (both, both * most[hit]))
        all_ = size + size[i] - low
        open_ = high >= SIMILARITY * (high + FLOOR * (all_ - low)) - 1e-9
        for j in np.flatnonzero(far & ((low >= SIMILARITY * all_) | open_)):
            out[min(ids[i], ids[j]), max(ids[i], ids[j])] = bool(low[j] >= SIMILARITY * all_[j])
    a, b = zip(*out) if out else ([], [])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "sure": pa.array(list(out.values()), pa.bool_())})


def _step(df: DataFrame, name: str) -> DataFrame:
    """``written``; the driver forgets the step's plan, code and broadcasts at once."""
    out = written(df, name)
    release(df.sparkSession)
    return out


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signatures of all rows; (digest, id, doc_id, raw) of each distinct text, named by its least row; (node, class) of linked texts."""
    spark = docs.sparkSession
    weights = spark.sparkContext.broadcast(sampling_weights(docs))
    sigs = _step(signatures(docs, weights), "signatures")
    distinct = (sigs.where("doc_id is not null and sig is not null").groupBy("digest")
                .agg(F.min(F.struct("doc_id", "raw")).alias("row"), F.first("sig").alias("sig")))
    distinct = _step(distinct.select(F.monotonically_increasing_id().alias("id"), "digest", "row.doc_id", "row.raw", "sig"), "distinct-texts")
    reps = distinct.select("id", "sig")

    band = F.expr(f"transform(sequence(0, {BANDS - 1}), b -> xxhash64(b, {', '.join(f'sig[b * {ROWS} + {i}]' for i in range(ROWS))}))")
    bands = reps.select("id", F.posexplode(band).alias("band", "key"))
    full = bands.groupBy("key").agg(F.min("id").alias("lead"), F.count("*").alias("n")).where("n > 1")
    members = _step(bands.join(full, "key"), "members")
    involved = distinct.select("id", "doc_id", "raw").join(members.select("id").distinct(), "id")
    texts = _rows(docs).join(involved, ["doc_id", "raw"]).dropDuplicates(["doc_id", "raw"])
    texts = _step(texts.select("id", "text"), "candidates")

    agree = F.expr("aggregate(zip_with(sa, sb, (x, y) -> if(x = y, 1, 0)), 0, (s, x) -> s + x)") >= AGREE
    first = members.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    first = (first.join(reps.select(F.col("id").alias("a"), F.col("sig").alias("sa")), "a")
             .join(reps.select(F.col("id").alias("b"), F.col("sig").alias("sb")), "b").where(agree).select("a", "b"))
    first = _step(compared(first, texts), "links")

    near = _step(components(first.where("sure").select("a", "b")), "classes")
    labelled = members.join(near, members.id == near.node, "left").select("band", "key", "id", F.coalesce("class", "id").alias("class"))
    mixed = labelled.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("m")).where("low <> high")
    chunks = F.ceil(F.col("m") / CHUNK).cast("int")
    rows = (labelled.join(mixed.select("key", "m"), "key").join(reps, "id").join(texts, "id")
            .select("key", "band", "id", "class", "sig", "text", chunks.alias("chunks"), F.pmod(F.xxhash64("id"), chunks).cast("int").alias("chunk"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .withColumn("i", F.least("chunk", "other")).withColumn("j", F.greatest("chunk", "other")))
    more = (rows.select("key", "band", "i", "j", "id", "class", "sig", "text", "chunk").groupBy("key", "band", "i", "j")
            .applyInArrow(_mixed_links, "a long, b long, sure boolean"))
    more = _step(more.distinct(), "links")
    links = first.union(more)
    sure = links.where("sure").select("a", "b")

    joined = _step(components(sure), "classes")
    # pairs that TF leaves open, unless their classes are joined anyway
    one, two = (joined.select(F.col("node").alias(x), F.col("class").alias("c" + x)) for x in "ab")
    grey = (links.where("not sure").select("a", "b").distinct().join(one, "a", "left").join(two, "b", "left")
            .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))
    grey = _step(grey, "open-pairs")
    if not grey.isEmpty():
        more = _step(by_idf(grey, texts, docs), "links")
        if not more.isEmpty():
            joined = components(joined.select(F.col("node").alias("a"), F.col("class").alias("b")).union(more))
    return sigs, distinct.drop("sig"), joined


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id and class_id of every document row."""
    sigs, distinct, classes = _classes(docs)
    classes = _step(classes, "classes")
    named = distinct.join(classes, distinct.id == classes.node, "left").select("digest", F.coalesce("class", "id").alias("class"))
    rows = sigs.where("doc_id is not null and sig is not null").select("doc_id", "digest").join(named, "digest").groupBy("doc_id", "class").agg(F.count("*").alias("n"))
    rows = _step(rows, "memberships")
    # an id with several texts joins their classes
    twice = rows.groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("z")).where("a <> z").select("doc_id", "a")
    if not twice.isEmpty():
        joined = components(rows.join(twice, "doc_id").select("a", F.col("class").alias("b")))
        rows = rows.join(joined, rows["class"] == joined.node, "left").select("doc_id", F.coalesce(joined["class"], rows["class"]).alias("class"))
    least = rows.groupBy("class").agg(F.min("doc_id").alias("class_id"))
    found = rows.join(least, "class").select(F.col("doc_id").alias("of"), "class_id").distinct()
    ids = sigs.select("doc_id")
    return ids.join(found, ids.doc_id == found.of, "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """The documents, all columns: one row of each class (of its least id), all rows with a null id, and texts without words once an id."""
    sigs, distinct, classes = _classes(docs)
    classes = _step(classes, "classes")
    named = distinct.join(classes, distinct.id == classes.node, "left").select("digest", "doc_id", "raw", F.coalesce("class", "id").alias("class"))
    named = _step(named, "named-texts")
    kept = named.groupBy("class").agg(F.min(F.struct("doc_id", "raw")).alias("row")).select("row.doc_id", "row.raw")
    seen = sigs.where("doc_id is not null and sig is not null").select("doc_id", "raw").distinct()
    gone = seen.join(kept, ["doc_id", "raw"], "left_anti")
    raw, of, key = (free_name(docs, name) for name in ("raw_sha", "gone_id", "gone_sha"))
    gone = gone.select(F.col("doc_id").alias(of), F.col("raw").alias(key))
    rows = docs.where("doc_id is not null").withColumn(raw, F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    rows = rows.join(gone, (F.col("doc_id").cast("long") == F.col(of)) & (F.col(raw) == F.col(key)), "left_anti").dropDuplicates(["doc_id", raw])
    return docs.where("doc_id is null").unionByName(rows.select(docs.columns))
