"""STR2 live run-log rollup: event-time windows with a watermark (late rows dropped).

Per (run, tumbling window of ``ts``): records, mean loss, first/last record
time and records per second.  Update mode: each micro-batch writes the windows
it changed and the last row of each counts, so the windows still open when an
available-now run ends are there too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import file_stream, latest, run_available_now, update_sink, work_dir


def rollup(stream: DataFrame, window: str, delay: str) -> DataFrame:
    """The streaming aggregation (usable on any stream of run_id, ts, loss)."""
    w = F.window("ts", window)
    agg = (stream.withWatermark("ts", delay)
           .groupBy(F.col("run_id"), w.alias("w"))
           .agg(F.count(F.lit(1)).cast("bigint").alias("records"), F.avg("loss").alias("_avg"),
                F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")))
    span = F.timestamp_diff("MICROSECOND", F.col("first_ts"), F.col("last_ts")).cast("double") / F.lit(1e6)
    return agg.select("run_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "records", F.round("_avg", 6).alias("mean_loss"),
                      F.round(F.when(span > 0, F.col("records") / span), 6).alias("records_per_sec"))


def live_rollup(spark: SparkSession, source: str, schema: StructType, window: str = "1 hour",
                delay: str = "2 hours", to_log=None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Run the rollup stream over ``source`` (availableNow) and return all windows."""
    base = work_dir(spark, "runlog")
    stream = file_stream(spark, source, schema, max_files_per_trigger=max_files_per_trigger)
    if to_log is not None:
        stream = to_log(stream)
    run_available_now(update_sink(rollup(stream, window, delay), base))
    return latest(spark, base, "run_id bigint, window_start timestamp, window_end timestamp, records bigint, mean_loss double, "
                  "records_per_sec double", ["run_id", "window_start", "window_end"])
