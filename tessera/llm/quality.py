"""Operator 2: importance-style quality rule on hashed n-grams.

Tokens are runs of letters and digits (ASCII lower-cased) and runs of other visible
characters.  Their unigrams and bigrams are hashed into ``BUCKETS`` buckets; two
multinomials are counted, one over all documents (raw) and one over trusted ones
(the target: documents labelled quality 1).  A document's score is the mean over
its n-grams of log(target / raw), so length does not matter.  The target is
smoothed toward the raw corpus, so a bucket without evidence scores 0.

The raw counts cover all documents, the target all trusted ones, and all labelled
documents that pass the base rules set the threshold: an untrusted one by its score, a
trusted one by the score that it has when its own n-grams leave the target.  The
threshold is the middle of the interval in which the shares of wrongly rejected and
wrongly kept rows sum least (without untrusted rows: the 1 % quantile of trusted ones;
without trusted rows every document passes).  It is found by running sums over the
distinct scores, so nothing but the bucket counts and the threshold meets the driver.

The rules of ``base`` are counted over whole texts in the same pass.  Null, empty
and wordless texts have zero counts and score 0, and fail the word minimum.
Repeated rows are judged each alike; an empty table gives an empty one; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordinal import with_running
from . import kernels as K
from .common import add_blocks, doc_text, label_rows, text_slices, written

BUCKETS = 1 << 16
BLOCK = 1 << 12
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
SYMBOLS = K.byte_table(b"#*$%&|<>")


def ngram_buckets(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each unigram and bigram, and the text it is in."""
    low = K.LOWER[buf]
    word = K.WORD[low]
    ws, we, wb = K.runs(word, off)
    ps, pe, pb = K.runs(~word & K.NON_SPACE[low], off)
    start = np.concatenate([ws, ps])
    order = np.argsort(start, kind="stable")
    start = start[order]
    h = K.Prefix(low).hash(start, np.concatenate([we, pe])[order])
    borders = wb + pb
    text = K.owner(borders)
    pair = text[1:] == text[:-1]
    two = K.mix(h[:-1] * np.uint64(0xD1342543DE82EF95) + h[1:])[pair]
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    return (np.concatenate([h, two]) >> shift).astype(np.int64), np.concatenate([text, text[:-1][pair]])


def base(buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """word_chars, n_words, n_symbols, n_dup_lines and n_repeat_words of each text."""
    visible = K.NON_SPACE[buf]
    start, end, borders = K.runs(visible, off)
    out = {"n_words": np.diff(borders), "word_chars": K.per_text(visible & ((buf & 0xC0) != 0x80), off),
           "n_symbols": K.per_text(SYMBOLS[buf], off)}
    within = buf != 10
    ls, le, lb = K.runs(within, off)
    seen = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(visible, out=seen[1:])
    full = seen[le] > seen[ls]
    text = K.owner(lb)[full]
    line = K.run_numbers(buf, within, ls, le)[full]
    out["n_dup_lines"] = np.bincount(text[_repeated([text, line], later=True)], minlength=len(off) - 1)
    word = K.run_numbers(buf, visible, start, end)
    _, text, first = K.shingles(word.astype(np.uint64), borders, 5)
    first = first[_repeated([text, *(word[first + i] for i in range(5))])]
    cover = np.zeros(len(start) + 6, np.int64)
    np.add.at(cover, first, 1)
    np.add.at(cover, first + 5, -1)
    out["n_repeat_words"] = K.per_text(np.cumsum(cover)[:len(start)] > 0, borders)
    return out


def base_failed(found: dict[str, np.ndarray]) -> np.ndarray:
    return (found["n_words"] < MIN_WORDS) | (100 * found["n_repeat_words"] > MAX_REPEAT_PCT * found["n_words"])


def _repeated(columns: list[np.ndarray], later: bool = False) -> np.ndarray:
    """Which rows of the columns are found twice or more (``later``: all but the first of equal ones)."""
    order, same = K.equal_rows(columns)
    out = np.zeros(len(order), bool)
    out[order[1:][same]] = True
    if not later:
        out[order[:-1][same]] = True
    return out


def _count(batches):
    """Two bucket counts of a task (raw, target), in blocks."""
    total = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        for part in text_slices(batch):
            bucket, text = ngram_buckets(*K.utf8(part.column("text")))
            total[0] += np.bincount(bucket, minlength=BUCKETS)
            target = np.asarray(part.column("target").to_numpy(zero_copy_only=False), bool)
            if target.any():
                total[1] += np.bincount(bucket[target[text]], minlength=BUCKETS)
    if total.any():
        flat = total.reshape(-1, BLOCK)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array([x.tobytes() for x in flat], pa.binary())],
                                         names=["block", "counts"])


def ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log(target / raw) of each bucket; the target has ``BUCKETS`` pseudo-counts spread as the raw corpus."""
    share = (raw + 0.5) / (raw.sum() + 0.5 * BUCKETS)
    return np.log((target / share + BUCKETS) / (target.sum() + BUCKETS))


def threshold(good: np.ndarray, bad: np.ndarray) -> float:
    """The threshold of two arrays of scores; ``cut`` finds the same one in a table."""
    if not len(good):
        return float("-inf")
    if not len(bad):
        return float(np.quantile(good, 0.01))
    cuts = np.unique(np.concatenate([good, bad]))
    cuts = np.concatenate([[cuts[0] - 1], (cuts[1:] + cuts[:-1]) / 2, [cuts[-1] + 1]])
    loss = np.searchsorted(np.sort(good), cuts) / len(good) + 1 - np.searchsorted(np.sort(bad), cuts) / len(bad)
    best = np.flatnonzero(loss <= loss.min() + 1e-12)
    return float(cuts[best].mean()) if best[-1] - best[0] == len(best) - 1 else float(cuts[best[0]])


def scores(buf: np.ndarray, off: np.ndarray, weights: np.ndarray) -> np.ndarray:
    bucket, text = ngram_buckets(buf, off)
    n = np.bincount(text, minlength=len(off) - 1)
    return np.bincount(text, weights=weights[bucket], minlength=len(off) - 1) / np.maximum(n, 1)


def own_scores(buf: np.ndarray, off: np.ndarray, raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Score of each text by the target that is left when the text's own n-grams are taken out of it."""
    bucket, text = ngram_buckets(buf, off)
    key, own = np.unique(text * BUCKETS + bucket, return_counts=True)
    text, bucket = key // BUCKETS, key % BUCKETS
    n = np.bincount(text, weights=own, minlength=len(off) - 1)
    share = (raw + 0.5) / (raw.sum() + 0.5 * BUCKETS)
    part = own * np.log(np.maximum(target[bucket] - own, 0) / share[bucket] + BUCKETS)
    total = np.bincount(text, weights=part, minlength=len(off) - 1) - n * np.log(np.maximum(target.sum() - n, 0) + BUCKETS)
    return total / np.maximum(n, 1)


def counts(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """n-grams in each bucket, of all documents and of the trusted ones."""
    trusted = label_rows(labels, "quality").where("label = 1")
    trusted = trusted.select("doc_id", F.lit(True).alias("target")).hint("shuffle_hash")  # grows with the labels; texts need no sort
    rows = doc_text(docs).join(trusted, "doc_id", "left")
    target = F.coalesce("target", F.lit(False))
    blocks = add_blocks(rows.select("text", target.alias("target")).mapInArrow(_count, "block int, counts binary"), BLOCK).collect()
    total = np.zeros((2 * BUCKETS // BLOCK, BLOCK), np.int64)
    for r in blocks:
        total[r.block] += np.frombuffer(r.counts, np.int64)
    raw, trusted = total.reshape(2, BUCKETS)
    return raw, trusted


def _scored(docs: DataFrame, weights: np.ndarray, found: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """Counts, base_failed and llr of every document; with the bucket counts ``found`` also own_llr."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    columns = ["doc_id", *names, "base_failed", "llr", *(["own_llr"] if found else [])]

    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                buf, off = K.utf8(part.column("text"))
                rules = base(buf, off)
                own = [pa.array(own_scores(buf, off, *found))] if found else []
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(rules[c], pa.int64()) for c in names), pa.array(base_failed(rules)),
                                                  pa.array(scores(buf, off, weights)), *own], names=columns)

    own = ", own_llr double" if found else ""
    return doc_text(docs).mapInArrow(run, f"doc_id long, {', '.join(f'{c} long' for c in names)}, base_failed boolean, llr double{own}")


def cut(rows: DataFrame, partitions: int | None = None) -> float:
    """``threshold`` of the rows (label, llr), by running sums over their distinct scores."""
    found = written(rows.groupBy("llr").agg(F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") != 1).alias("bad")), "scores")
    every = found.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.max("llr").alias("last")).first()
    if not every.good:
        return float("-inf")
    if not every.bad:
        at = 0.01 * (every.good - 1)
        before = with_running(found, ["llr"], "good", num_partitions=partitions)
        low, high = (before.where((F.col("running") <= i) & (F.col("running") + F.col("good") > i)).first().llr for i in (int(at), min(int(at) + 1, every.good - 1)))
        return low + (high - low) * (at - int(at))
    # a cut lies below each score, and one above all: below a score that no row has
    end = found.sparkSession.createDataFrame([(every.last + 2, 0, 0)], found.schema)
    loss = (F.col("good").cast("decimal(19,0)") * every.bad - F.col("bad").cast("decimal(19,0)") * every.good).cast("decimal(38,0)")
    cuts = written(with_running(found.unionByName(end).withColumn("loss", loss), ["llr"], "loss", num_partitions=partitions).select("llr", "running"), "cuts")
    best = cuts.where(F.col("running") == cuts.agg(F.min("running")).first()[0]).agg(F.min("llr").alias("a"), F.max("llr").alias("b"), F.count(F.lit(1)).alias("n")).first()
    within = cuts.where(F.col("llr").between(best.a, best.b)).agg(F.count(F.lit(1)).alias("n"), F.sum("llr").alias("sum")).first()
    below = cuts.where(F.col("llr") < best.a).agg(F.max("llr")).first()[0]
    below = best.a - 2 if below is None else below
    return (below + best.a) / 2 if within.n > best.n else (below + 2 * within.sum - best.b) / (2 * within.n)


def _labelled_cut(scored: DataFrame, labels: DataFrame, partitions: int | None = None) -> float:
    """The threshold by all labelled documents that pass the base rules."""
    rows = scored.where(~F.col("base_failed")).join(label_rows(labels, "quality"), "doc_id")
    return cut(rows.select("label", F.when(F.col("label") == 1, F.col("own_llr")).otherwise(F.col("llr")).alias("llr")), partitions)


def _verdict(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.drop("own_llr").withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= F.lit(threshold)))


def fit(docs: DataFrame, labels: DataFrame, partitions: int | None = None) -> tuple[np.ndarray, float]:
    """(log ratio of each bucket, threshold); ``partitions``: of the running sums over the scores."""
    found = counts(docs, labels)
    weights = ratio(*found)
    return weights, _labelled_cut(_scored(docs, weights, found), labels, partitions)


def judge(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """Counts, base_failed, llr and kept of every document."""
    return _verdict(_scored(docs, model[0]), model[1])


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``judge`` by the model that ``fit`` finds; each document is scored once, for the threshold and for its verdict."""
    found = counts(docs, labels)
    scored = written(_scored(docs, ratio(*found), found), "scored")
    return _verdict(scored, _labelled_cut(scored, labels))
