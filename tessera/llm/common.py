"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, release  # noqa: F401

#: UTF-8 bytes handled at once by the numpy kernels; one longer text makes a slice of its own.
SLICE_BYTES = 1 << 20
SLICE_ROWS = 1 << 13


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def doc_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) only, so that the scan reads two columns."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder as Parquet and read back (cuts lineage, keeps column pruning)."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES):
    """Sub-batches whose texts hold about ``limit`` bytes (one row at least, ``SLICE_ROWS`` at most)."""
    sizes = pc.binary_length(batch.column(column)).to_pylist()
    start, total = 0, 0
    for i, n in enumerate(sizes):
        n = n or 0
        if i > start and (total + n > limit or i - start == SLICE_ROWS):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def blocks(spark: SparkSession, total_bytes: int, per_block: int) -> int:
    """Number of partitions that hold about ``per_block`` bytes each; grows with the data."""
    return int(max(1, -(-total_bytes // per_block), spark.sparkContext.defaultParallelism))


def label_rows(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, label) of every labelled document.

    Null ids and labels are left out; an id labelled twice counts once, with its largest label.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label")).dropna()
    return rows.groupBy("doc_id").agg(F.max("label").alias("label"))


def label_sample(labels: DataFrame, column: str, limit: int, held_out: bool = False) -> DataFrame:
    """At most ``limit`` of the ``label_rows``, the same at every run: the smallest id hashes.

    ``held_out``: leave out ids whose crc32 (as text) mod 3 is 1.
    """
    rows = label_rows(labels, column)
    if held_out:
        rows = rows.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def add_blocks(parts: DataFrame, width: int) -> DataFrame:
    """Sum equally long int64 vectors, given as (block, counts) rows, by block.

    Rows stream through a task, which holds one sum per block that it meets.
    """

    def add(batches):
        import numpy as np
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, x in zip(batch.column("block").to_pylist(), batch.column("counts")):
                total.setdefault(block, np.zeros(width, np.int64))
                total[block] += np.frombuffer(x.as_buffer(), np.int64)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
                                             names=["block", "counts"])

    return parts.repartition("block").mapInArrow(add, "block int, counts binary")
