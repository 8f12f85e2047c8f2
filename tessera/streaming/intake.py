"""STR1 incremental corpus intake: quality filter + keep-first prefix dedup over arriving files.

Each micro-batch is processed with batch operators inside ``foreachBatch``:
the batch's own keep-first is the skew-safe partial/final aggregate of
``dedup``; keys already written by *earlier* batches are removed with an
anti-join against the sink (the sink is the state, in shared storage, not in
executor memory), of which only the partitions are read whose filter may hold
one of the batch's keys (``history``).  Rows are written under ``batch_id=<n>`` with dynamic
partition overwrite, so replaying a batch after a failure rewrites the same
partition: the output is exactly-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..config import PLAN_QUALITY, QualityParams
from ..functions.text import text_key
from ..operators.dedup import keep_first, order_key
from ..operators.quality import quality_filter
from ..session import reliable_checkpoint
from ..sources.registry import docs_with_rank
from ..sources.sinks import dataset_exists
from ..sources.tables import spread
from . import history
from .common import run_available_now, stream_path, work_dir


def intake_batch(batch: DataFrame, batch_id: int, registry: DataFrame, sink: str,
                 quality: QualityParams, prefix_chars: int | None) -> None:
    spark = batch.sparkSession
    batch = spread(batch)  # a small micro-batch read by one task is spread over the cores
    ranked = docs_with_rank(batch, registry)  # sources that the registry lacks are kept
    kept = quality_filter(ranked, quality).withColumn("ord", order_key())
    keyed = kept.withColumn("_key", text_key(F.col("text"), prefix_chars))
    winners = keep_first(keyed, F.col("_key"), ["lang"], "ord")
    filters = f"{sink}-filters"
    if dataset_exists(spark, filters):
        winners = reliable_checkpoint(winners)  # asked for twice: its keys, then its rows
        earlier = spark.read.parquet(filters).where(F.col("batch_id") < batch_id)
        winners, _ = history.unseen(winners, ["lang", "_key"], spark, sink, earlier)
    (winners.select("doc_id", "lang", "source", "text", "_key", F.lit(batch_id).cast("bigint").alias("batch_id"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(sink))
    if dataset_exists(spark, sink):  # no row was kept so far
        history.write_filter(spark.read.parquet(sink).where(F.col("batch_id") == batch_id).select("lang", "_key"), ["lang", "_key"], batch_id, filters)


def incremental_intake(spark: SparkSession, source: str, schema: StructType, registry: DataFrame,
                       quality: QualityParams = PLAN_QUALITY, prefix_chars: int | None = None,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Run the intake stream over everything available at ``source`` and return the sink table."""
    base = work_dir(spark, "intake")
    sink, ckpt = f"{base}/sink", f"{base}/checkpoint"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(stream_path(source))
    writer = (stream.writeStream
              .foreachBatch(lambda df, bid: intake_batch(df, bid, registry, sink, quality, prefix_chars))
              .option("checkpointLocation", ckpt))
    run_available_now(writer)
    if not dataset_exists(spark, sink):
        return spark.createDataFrame([], "doc_id bigint, lang string, source string, text string, batch_id bigint")
    return spark.read.parquet(sink).drop("_key")


def dedup_within_watermark(stream: DataFrame, event_time: str, delay: str,
                           prefix_chars: int | None = None, quality: QualityParams = PLAN_QUALITY) -> DataFrame:
    """STR1 variant with bounded state: keep the first arrival of each (lang, key) seen within
    ``delay`` of event time (``dropDuplicatesWithinWatermark``); state older than the watermark
    is dropped, so a copy arriving later than ``delay`` is kept again."""
    kept = quality_filter(stream, quality).withColumn("_key", text_key(F.col("text"), prefix_chars))
    return kept.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["lang", "_key"]).drop("_key")
