"""Connected components of an edge list by alternating star contractions.

Each partition first replaces its own edges by a spanning forest (every node points to
the least node of its component there), which loses no connection and leaves at most
one edge a node.  Then each round joins and aggregates edges only: no group is gathered,
and a hub's edges stay as many rows as it has neighbours.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, written


#: Edges read by a task before it contracts them.
GATHER = 1 << 20


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) of the edges' nodes, without the least nodes themselves."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[:len(a)], ends[len(a):]
    least = np.arange(len(nodes))
    while True:
        low = np.minimum(least[x], least[y])
        before = least.copy()
        for end in (x, y):
            np.minimum.at(least, before[end], low)
            np.minimum.at(least, end, low)
        least = least[least]
        if (least == before).all():
            break
    far = np.flatnonzero(least != np.arange(len(nodes)))
    return nodes[far], nodes[least[far]]


def _forest(batches):
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    done = 0
    for batch in batches:
        a, b = np.concatenate([a, batch.column("a").to_numpy()]), np.concatenate([b, batch.column("b").to_numpy()])
        if len(a) > 2 * done + GATHER:
            a, b = contract(a, b)
            done = len(a)
    if len(a):
        a, b = contract(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _stars(e: DataFrame) -> bool:
    """Whether each node of the edges (a, b) either points to one node, which points to none, or is pointed to."""
    ends = e.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in")).union(
        e.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("in")))
    between = ends.groupBy("node").agg((F.sum("out") + F.max("in")).alias("n"), F.max("out").alias("out"))
    return not between.agg(F.count_if((F.col("out") == 1) & (F.col("n") > 1))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """(node, class): the least node of each connected component, for all nodes of ``edges`` (a, b)."""
    e = edges.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).where("a <> b").distinct()
    e = written(e.mapInArrow(_forest, "a long, b long").distinct(), "edges")
    while not _stars(e):  # every edge points to a lesser node, so a star's centre is its least node
        both = e.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("b", "a")).alias("a"), F.col("m").alias("b"))
        e = written(small.where("a <> b").distinct(), "edges")
        release(e.sparkSession)
    return e.select(F.col("a").alias("node"), F.col("b").alias("class")).union(e.select(F.col("b").alias("node"), F.col("b").alias("class"))).distinct()
