"""Shared helpers for the streaming jobs: working folders under the shared checkpoint folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run's sink and stream checkpoint, under ``spark.checkpoint.dir``."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/streams/{name}-{uuid.uuid4().hex[:12]}"


def run_available_now(writer, timeout_s: float | None = None) -> None:
    """Start a ``trigger(availableNow=True)`` query and wait for it to drain its source.

    ``timeout_s`` (default: ``TESSERA_STREAM_TIMEOUT`` seconds, else unlimited)
    stops a query that does not finish and raises.
    """
    limit = timeout_s if timeout_s is not None else float(os.environ.get("TESSERA_STREAM_TIMEOUT", "0")) or None
    q = writer.trigger(availableNow=True).start()
    finished = q.awaitTermination(limit) if limit else q.awaitTermination()
    if limit and not finished:
        q.stop()
        raise TimeoutError(f"streaming query did not finish within {limit} s")
    if q.exception() is not None:
        raise q.exception()


def rocksdb_state(spark: SparkSession) -> None:
    """State in RocksDB (list and value state and timers need it); a session that names a provider keeps it."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in spark.conf.get(key, ""):
        spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def stream_path(source: str) -> str:
    """A file source path: a folder or glob as given; one named file becomes a one-file glob.

    (The streaming file source lists a folder or a glob; a plain file path is
    not accepted.)
    """
    src = source.rstrip("/")
    last = src.rsplit("/", 1)[-1]
    if any(ch in last for ch in "*?[{") or "." not in last:
        return src
    return f"{src[:-1]}[{src[-1]}]"


def file_stream(spark: SparkSession, source: str, schema, fmt: str = "parquet", max_files_per_trigger: int | None = None):
    """``readStream`` over a folder, a glob, or one file."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(stream_path(source))


def update_sink(stream: DataFrame, base: str):
    """A writer of an update-mode stream: each micro-batch overwrites its own partition, so a replay changes nothing."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{base}/sink"))

    return stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{base}/checkpoint")


def latest(spark: SparkSession, base: str, schema: str, keys: list[str]) -> DataFrame:
    """The last row that an update sink holds for each key."""
    rows = spark.read.schema(f"{schema}, batch_id bigint").parquet(f"{base}/sink")
    values = [c for c in rows.columns if c not in (*keys, "batch_id")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_v")).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])
