"""Sequence packing.  PCK1 PCK2 PCK3 PCK4 PCK5 PCK6

The reference flattens every token of a split into one list (one EOS after
each document) and packs it greedily in a single process.  Here the flat list
is never built:

* PCK1 — each document becomes ``ids + [eos]``, cut after every EOS (an EOS
  inside a document is a boundary too), giving *segments*.
* PCK2 — greedy packing is planned on segment *lengths* only, exactly as one
  stream per split, in two passes over range partitions of
  ``(split, order, segment)``:

  1. each partition summarises itself as a step table: for an entering fill
     level ``c`` (0 <= c < M) -> (fill level after the partition, chunks
     emitted).  After its first flush a partition no longer depends on ``c``,
     so the table has at most one row per segment that starts within the
     first M tokens (plus one), not one per ``c``; adjacent rows with the same
     outcome are merged, typically leaving a handful;
  2. the tables (a few rows per partition) are chained per split in one task, which
     gives each partition its entering level and first chunk id; each
     partition then replays its segments with those values, jumping from flush
     to flush.

  A segment belongs to the chunk it starts in; tokens past ``M`` in the
  segment that fills a chunk are lost (reference behaviour, reported).
* PCK3 — the last chunk of a split is right-padded with the pad id.
* PCK6 — lossless alternative: a distributed running sum of lengths gives each
  token its offset, ``chunk = offset div M``; no tokens are dropped.

Chunks are built by joining the plan to the token arrays and grouping by
chunk id: a group holds at most ``M`` tokens.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_IDS, MAX_LENGTH, SpecialIds
from ..session import reliable_checkpoint, shuffle_partitions, staged_parquet
from .ordinal import with_running


# ----------------------------------------------------------------- PCK1 ----
def with_eos(ids: Column, eos: int) -> Column:
    return F.concat(ids, F.array(F.lit(eos)))


def segments(encoded: DataFrame, order: Sequence[str] = ("split", "shuffle_rank"),
             ids_col: str = "input_ids", eos: int = DEFAULT_IDS.eos) -> DataFrame:
    """PCK1: one row per EOS-terminated segment: order keys, ``seg_no``, ``seg_ids``, ``n``."""
    ids2 = with_eos(F.col(ids_col), eos)
    with_ids = encoded.select(*order, ids2.alias("_ids"))
    ends = F.filter(F.sequence(F.lit(1), F.size("_ids")), lambda i: F.element_at(F.col("_ids"), i) == F.lit(eos))
    staged = with_ids.withColumn("_ends", ends)
    starts = F.concat(F.array(F.lit(1)), F.transform(F.slice(F.col("_ends"), 1, F.size("_ends") - 1),
                                                      lambda e: e + 1))
    staged = staged.withColumn("_starts", starts)
    segs = F.transform(
        F.sequence(F.lit(1), F.size("_ends")),
        lambda k: F.slice(F.col("_ids"), F.element_at(F.col("_starts"), k),
                          F.element_at(F.col("_ends"), k) - F.element_at(F.col("_starts"), k) + 1))
    out = staged.select(*order, F.posexplode(segs).alias("seg_no", "seg_ids"))
    return out.withColumn("seg_no", F.col("seg_no").cast("bigint")).withColumn(
        "n", F.size("seg_ids").cast("bigint"))


def segment_lengths(encoded: DataFrame, order: Sequence[str] = ("split", "shuffle_rank"),
                    ids_col: str = "input_ids", eos: int = DEFAULT_IDS.eos) -> DataFrame:
    """PCK1 without the ids: order keys, ``seg_no`` and ``n``, for plans that need lengths only."""
    ids2 = with_eos(F.col(ids_col), eos)
    ends = F.filter(F.sequence(F.lit(1), F.size("_ids")), lambda i: F.element_at(F.col("_ids"), i) == F.lit(eos))
    staged = encoded.select(*order, ids2.alias("_ids")).select(*order, ends.alias("_ends"))
    n = F.transform("_ends", lambda e, i: e - F.when(i == 0, 0).otherwise(F.element_at(F.col("_ends"), F.greatest(i, F.lit(1)))))
    return staged.select(*order, F.posexplode(n).alias("seg_no", "n")).select(
        *order, F.col("seg_no").cast("bigint").alias("seg_no"), F.col("n").cast("bigint").alias("n"))


# ----------------------------------------------------------------- PCK2 ----
#: Segments (three narrow columns) that one partition of a plan holds, about.
SEGMENTS_PER_PARTITION = 2_000_000


def _ranged(df: DataFrame, keys: Sequence[str], num_partitions: int | None) -> DataFrame:
    n = num_partitions or max(shuffle_partitions(df.sparkSession), -(-df.count() // SEGMENTS_PER_PARTITION))
    ranged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id()))
    return reliable_checkpoint(ranged)


def _flushes(total: np.ndarray, at: np.ndarray, M: int) -> np.ndarray:
    """First segment border at which a chunk that began empty at border ``at`` is full (beyond the last: none)."""
    return np.searchsorted(total, total[at] + M, side="left")


def _step_rows(lengths: np.ndarray, M: int) -> list[tuple]:
    """Step table of one partition's segment lengths (see module doc)."""
    K = len(lengths)
    P = np.zeros(K + 1, dtype=np.int64)
    np.cumsum(lengths, out=P[1:])
    first = int(np.searchsorted(P, M, side="left"))  # borders up to here can be a first flush
    k = np.arange(1, min(first, K) + 1)
    at, chunks = k.copy(), np.ones(len(k), np.int64)
    live = np.arange(len(k))
    while len(live):  # one round per chunk, all entering levels at once
        nxt = _flushes(P, at[live], M)
        live, nxt = live[nxt <= K], nxt[nxt <= K]
        at[live] = nxt
        chunks[live] += 1
    rows: list[list] = []
    for i, j in enumerate(k.tolist()):
        # entering level c flushes first after segment j-1 where P[j-1] < M - c <= P[j]
        hi, lo = int(M - P[j - 1]), int(max(0, M - P[j]))
        if lo < hi:
            out = [True, int(P[K] - P[at[i]]), int(chunks[i])]
            if rows and rows[-1][0] == hi and rows[-1][2:] == out:
                rows[-1][0] = lo  # adjacent piece with the same outcome: merge (lossless)
            else:
                rows.append([lo, hi, *out])
    if P[K] < M:
        rows.append([0, int(M - P[K]), False, int(P[K]), 0])
    return [tuple(r) for r in rows]


def _replay(lengths: np.ndarray, M: int, level: int, chunk: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(chunk_id, start, take) of each segment, entering at ``level`` of ``chunk``; jumps from flush to flush."""
    K = len(lengths)
    P = np.zeros(K + 1, dtype=np.int64)
    np.cumsum(lengths, out=P[1:])
    cid, start = np.empty(K, np.int64), np.empty(K, np.int64)
    at, base = 0, P[0] - level  # ``base``: where the open chunk would have begun
    while at < K:
        end = min(int(np.searchsorted(P, base + M, side="left")), K)
        cid[at:end] = chunk
        start[at:end] = P[at:end] - base
        at, base, chunk = end, P[end], chunk + 1
    return cid, start, np.minimum(lengths, M - start)


def _partition_frames(batches: Iterator[pd.DataFrame]) -> pd.DataFrame | None:
    frames = list(batches)
    return pd.concat(frames, ignore_index=True) if frames else None


def greedy_plan(segs: DataFrame, max_length: int = MAX_LENGTH, order: Sequence[str] = ("shuffle_rank",),
                group: str = "split", num_partitions: int | None = None) -> DataFrame:
    """PCK2: per segment (group, order, seg_no, n): ``chunk_id``, ``start``, ``take``, ``lost``.

    Exact single-stream greedy semantics per ``group``, computed in parallel: the
    step tables of a group's partitions are chained in one task per group, whose
    result (one row per partition and group) joins the segments.
    """
    M = int(max_length)
    keys = [group, *order, "seg_no"]
    ranged = _ranged(segs.select(*keys, "n"), keys, num_partitions)

    def steps(batches):
        pdf = _partition_frames(batches)
        if pdf is None or pdf.empty:
            return
        pid = int(pdf["_pid"].iloc[0])
        out = []
        for g, part in pdf.groupby(group, sort=False):
            for lo, hi, flush, end, chunks in _step_rows(part["n"].to_numpy(dtype=np.int64), M):
                out.append((pid, g, lo, hi, flush, end, chunks))
        yield pd.DataFrame(out, columns=["pid", "grp", "lo", "hi", "flush", "end", "chunks"])

    def chain(rows: pd.DataFrame) -> pd.DataFrame:
        level, base, out = 0, 0, []
        for pid, part in rows.groupby("pid", sort=True):
            out.append((pid, part["grp"].iloc[0], level, base))
            row = part[(part["lo"] <= level) & (level < part["hi"])].iloc[0]
            base += int(row["chunks"])
            level = int(row["end"]) if row["flush"] else level + int(row["end"])
        return pd.DataFrame(out, columns=["_pid", group, "_level", "_base"])

    grp = ranged.schema[group].dataType.simpleString()
    step_schema = f"pid int, grp {grp}, lo long, hi long, flush boolean, end long, chunks long"
    table = ranged.select("_pid", group, "n").mapInPandas(steps, step_schema)
    entering = table.groupBy("grp").applyInPandas(chain, f"_pid int, {group} {grp}, _level long, _base long")

    def replay(batches):
        pdf = _partition_frames(batches)
        if pdf is None or pdf.empty:
            return
        for _, part in pdf.groupby(["_pid", group], sort=False):
            part = part.sort_values(order_cols, kind="stable")
            n = part["n"].to_numpy(dtype=np.int64)
            cid, start, take = _replay(n, M, int(part["_level"].iloc[0]), int(part["_base"].iloc[0]))
            yield part.drop(columns=["_pid", "_level", "_base"]).assign(chunk_id=cid, start=start, take=take, lost=n - take)

    order_cols = [*order, "seg_no"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranged.drop("_pid").schema.fields)
    schema += ", chunk_id long, start long, take long, lost long"
    # at most one row per partition and group; the broadcast leaves the ranged partitions as they are
    return ranged.join(F.broadcast(entering), ["_pid", group]).select(*ranged.columns, "_level", "_base").mapInPandas(replay, schema)


def _pad(ids: Column, M: int, pad: int) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(pad), F.greatest(F.lit(M) - F.size(ids), F.lit(0))))


def greedy_chunks(segs: DataFrame, plan: DataFrame, max_length: int = MAX_LENGTH,
                  ids: SpecialIds = DEFAULT_IDS, order: Sequence[str] = ("shuffle_rank",),
                  group: str = "split") -> DataFrame:
    """PCK2/PCK3: (split, chunk_id, input_ids[M]); the tail chunk padded with the pad id."""
    keys = [group, *order, "seg_no"]
    pieces = (plan.select(*keys, "chunk_id", "start", "take")
              .join(segs.select(*keys, "seg_ids"), on=keys, how="inner")
              .select(group, "chunk_id", F.struct("start", F.slice("seg_ids", 1, F.col("take").cast("int"))
                                                  .alias("piece")).alias("p")))
    chunks = pieces.groupBy(group, "chunk_id").agg(F.array_sort(F.collect_list("p")).alias("_ps"))
    flat = F.flatten(F.transform("_ps", lambda p: p["piece"]))
    return chunks.select(group, "chunk_id", _pad(flat, int(max_length), ids.pad_id).alias("input_ids"))


def materialized_segments(encoded: DataFrame, order: Sequence[str] = ("split", "shuffle_rank"),
                          eos: int = DEFAULT_IDS.eos) -> DataFrame:
    """PCK1 output written once, as Parquet: the plan reads its lengths and the chunk build its ids,
    and the encode that produced it is not run twice."""
    return staged_parquet(segments(encoded, order, eos=eos), "segments")


def pack_greedy(encoded: DataFrame, max_length: int = MAX_LENGTH, ids: SpecialIds = DEFAULT_IDS,
                order: str = "shuffle_rank", group: str = "split") -> DataFrame:
    """PCK1 + PCK2 + PCK3 end to end."""
    segs = materialized_segments(encoded, (group, order), eos=ids.eos)
    plan = greedy_plan(segs, max_length, (order,), group)
    return greedy_chunks(segs, plan, max_length, ids, (order,), group)


def no_pack(encoded: DataFrame) -> DataFrame:
    """PCK4: one row per document, unchanged."""
    return encoded


def pack_report(plan: DataFrame, max_length: int = MAX_LENGTH, group: str = "split") -> DataFrame:
    """PCK5: per split: sequences, tokens in, kept, lost, padding, mean sequence length."""
    M = int(max_length)
    per = plan.groupBy(group).agg(
        (F.max("chunk_id") + 1).cast("bigint").alias("sequences"),
        F.sum("n").cast("bigint").alias("tokens_in"),
        F.sum("take").cast("bigint").alias("tokens_kept"),
        F.sum("lost").cast("bigint").alias("tokens_lost"),
    )
    return per.select(group, "sequences", "tokens_in", "tokens_kept", "tokens_lost",
                      (F.col("sequences") * F.lit(M) - F.col("tokens_kept")).cast("bigint").alias("pad_tokens"),
                      F.lit(float(M)).alias("mean_length"))


# ----------------------------------------------------------------- PCK6 ----
def pack_concat(encoded: DataFrame, max_length: int = MAX_LENGTH, ids: SpecialIds = DEFAULT_IDS,
                order: str = "shuffle_rank", group: str = "split",
                lengths: DataFrame | None = None, key: str = "ord") -> DataFrame:
    """PCK6: lossless concat-and-chunk; every token kept, the last chunk padded.

    ``lengths``: (group, key, order, n) of documents that have ``key`` instead of ``order`` and are
    written already; n counts the end id.
    """
    M = int(max_length)
    ids2 = with_eos(F.col("input_ids"), ids.eos).alias("_ids")
    if lengths is None:
        docs = staged_parquet(encoded.select(group, order, ids2).withColumn("n", F.size("_ids").cast("bigint")), "documents")  # read twice below, once without the ids
        lengths, on = docs.select(group, order, "n"), [group, order, "n"]
    else:
        docs, on = encoded.select(group, key, ids2), [group, key]
    offs = with_running(lengths.select(*dict.fromkeys([*on, order, "n"])), [order], "n", [group], op="sum", out="offset")
    placed = offs.join(docs, on=on, how="inner")
    k = F.col("k")
    exploded = placed.select(
        group, "offset", "n", "_ids",
        F.explode(F.sequence(F.floor(F.col("offset") / M).cast("bigint"),
                             F.floor((F.col("offset") + F.col("n") - 1) / M).cast("bigint"))).alias("k"))
    lo = F.greatest(k * M - F.col("offset"), F.lit(0))                  # 0-based start inside the doc
    hi = F.least((k + 1) * M - F.col("offset"), F.col("n"))             # exclusive end
    pos = F.greatest(F.col("offset") - k * M, F.lit(0))                 # start inside the chunk
    pieces = exploded.select(group, k.alias("chunk_id"),
                             F.struct(pos.alias("pos"), F.slice("_ids", (lo + 1).cast("int"), (hi - lo).cast("int"))
                                      .alias("piece")).alias("p"))
    chunks = pieces.groupBy(group, "chunk_id").agg(F.array_sort(F.collect_list("p")).alias("_ps"))
    flat = F.flatten(F.transform("_ps", lambda p: p["piece"]))
    return chunks.select(group, "chunk_id", _pad(flat, M, ids.pad_id).alias("input_ids"))


def concat_report(encoded: DataFrame, max_length: int = MAX_LENGTH, group: str = "split") -> DataFrame:
    """PCK5 for the lossless path: sequences, tokens in and kept (all), and padding, per split, from lengths only."""
    M = F.lit(int(max_length))
    tokens = F.sum(F.size("input_ids") + F.lit(1)).cast("bigint")  # each document and its end id
    per = encoded.groupBy(group).agg(tokens.alias("tokens_in"))
    sequences = F.ceil(F.col("tokens_in") / M).cast("bigint")
    return per.select(group, sequences.alias("sequences"), "tokens_in", F.col("tokens_in").alias("tokens_kept"),
                      F.lit(0).cast("bigint").alias("tokens_lost"), (sequences * M - F.col("tokens_in")).cast("bigint").alias("pad_tokens"))
