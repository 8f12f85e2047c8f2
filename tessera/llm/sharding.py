"""Operator 12: shards by a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns ``nodes`` pseudo-random points of a ring of 64-bit numbers; a document
lies at the hash of its id and belongs to the arc of the first point clockwise.  Shard
k may hold floor(n / shards) documents, the first n mod shards one more, so together
the shards hold just all n and counts differ by one at most (law ``rows``).  A full
shard passes on what overflows: first each shard takes from its own arcs, in ring order
and nearest the arc's begin first; what is left goes on clockwise, one shard a round,
to those with room.  So only the excess of a shard over its bound leaves it; the
arcs of a shard that is added or lost are all else that moves.  With ``slack`` the bound is
(1 + slack) n / shards instead: fewer rows move and counts differ more (law ``ring``).

Documents are never gathered by shard or arc.

1. Id, size, checksum and ring place of each row are written once (a narrow scan).
2. Rows are counted by arc: ``shards * nodes`` counts go to the driver, which deals the
   *counts* out by the rule above: a list of (arc, from, to, shard, first slot) with at
   most ``shards`` entries an arc, whatever the number of rows.
3. Each row's rank in its arc comes from a range sort in which a place of the file
   breaks ties: an id that a third of all rows share is split over many tasks.  The
   bounded list is broadcast and turns the rank into shard and slot.

Null texts have size 1 and the checksum of no bytes; a null id has a ring place of its
own.  Repeated rows are placed each, ties in any order (equal rows are interchangeable);
an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordinal import with_ordinal
from .common import written

SHARDS = 8
NODES = 128


def ring(shards: int, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """(points in ring order, shard of each); a shard's points do not depend on the number of shards."""
    points = sorted((int.from_bytes(hashlib.sha256(f"shard {s}, node {v}".encode()).digest()[:8], "little", signed=True), s)
                    for s in range(shards) for v in range(nodes))
    return np.array([p for p, _ in points], np.int64), np.array([s for _, s in points], np.int64)


def bounds(n: int, shards: int, slack: float = 0.0) -> list[int]:
    """Rows that each shard may hold; together at least n."""
    if slack:
        return [int(-(-n * (1 + slack) // shards))] * shards
    return [n // shards + (s < n % shards) for s in range(shards)]


def deal(counts: np.ndarray, owner: np.ndarray, room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, from, to, shard, first slot): which ranks of each arc go where, by counts alone."""
    room, arcs = list(room), len(counts)
    left, done = counts.astype(object), np.zeros(arcs, object)
    full, out = [0] * len(room), []
    path = []  # shards in the order met clockwise, for each arc
    for a in range(arcs):
        path.append(list(dict.fromkeys(np.roll(owner, -a).tolist())))
    for turn in range(len(room)):
        for a in range(arcs):
            if not left[a] or turn >= len(path[a]):
                continue
            shard = path[a][turn]
            take = min(left[a], room[shard])
            if take:
                out.append((a, int(done[a]), int(done[a] + take), shard, full[shard]))
                room[shard] -= take
                full[shard] += take
                left[a] -= take
                done[a] += take
    if any(left):
        raise ValueError("the bounds do not hold all rows")
    return out


def placed(docs: DataFrame, points: np.ndarray) -> DataFrame:
    """doc_id, size, text_crc32, ring place and arc of every row, written once."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("_text"))
    rows = rows.select("doc_id", (F.octet_length("_text") + F.lit(1)).cast("long").alias("size"), F.crc32("_text").alias("text_crc32"),
                       F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("ring")).alias("place"))

    def arcs(batches):
        for batch in batches:
            at = np.searchsorted(points, batch.column("place").to_numpy()) % len(points)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())], names=[*batch.schema.names, "arc"])

    rows = rows.mapInArrow(arcs, "doc_id long, size long, text_crc32 long, place long, arc long")
    return written(rows.withColumn("tie", F.monotonically_increasing_id()), "ring")


def shard(docs: DataFrame, shards: int = SHARDS, nodes: int = NODES, slack: float = 0.0) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (null: no law by key alone)."""
    points, owner = ring(shards, nodes)
    rows = placed(docs, points)
    counts = np.zeros(len(points), np.int64)
    for r in rows.groupBy("arc").count().collect():  # one row an arc
        counts[r["arc"]] = r["count"]
    plan = docs.sparkSession.createDataFrame(deal(counts, owner, bounds(int(counts.sum()), shards, slack)),
                                             "arc long, low long, high long, shard int, first long")
    ranked = with_ordinal(rows, ["place", "doc_id", "size", "text_crc32", "tie"], ["arc"], out="rank")
    found = ranked.join(F.broadcast(plan), "arc").where("rank >= low and rank < high")  # at most shards * shards * nodes entries
    return found.select("doc_id", "size", "text_crc32", F.lit("ring" if slack else "rows").alias("law"), "shard",
                        (F.col("first") + F.col("rank") - F.col("low")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
