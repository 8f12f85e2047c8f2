"""STR3 live completion reassembly: stateful per request (``transformWithStateInPandas``).

A request's chunks are a *list state*: a batch appends its chunks and never reads or
rewrites the earlier ones, so a response of n chunks costs n appends and one read.
A *value state* holds whether ``[DONE]`` was seen and when the request runs out.
A request is emitted

* when ``[DONE]`` arrives (and again, whole, if a late chunk follows it);
* by an *event timer*, incomplete, once the watermark is ``idle`` past its last line (with an event time);
  its state ends then;
* incomplete, at the end of a bounded run, from the chunks that the state store still holds.

State lives in RocksDB under the stream's checkpoint, in shared storage, not in executor memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..functions.text import py_strip
from ..operators.prompts import stream_chunk_text
from .common import file_stream, latest, rocksdb_state, run_available_now, update_sink, work_dir

OUT_SCHEMA = "request_id long, text string, complete boolean"
CHUNK_SCHEMA = "seq long, text string"
STATUS_SCHEMA = "done boolean, runs_out long"
IDLE_MS = 10 * 60 * 1000


class Reassembler(StatefulProcessor):
    """Chunks of one request; rows: seq, chunk (text or null), is_done, at_ms (event time or null)."""

    def __init__(self, idle_ms: int | None):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getListState("chunks", CHUNK_SCHEMA)
        self.status = handle.getValueState("status", STATUS_SCHEMA)

    def _row(self, key, complete: bool) -> pd.DataFrame:
        chunks = sorted(tuple(c) for c in self.chunks.get()) if self.chunks.exists() else []
        return pd.DataFrame({"request_id": [key[0]], "text": ["".join(t for _, t in chunks)], "complete": [complete]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        done, runs_out = self.status.get() if self.status.exists() else (False, None)
        latest_ms = None
        for pdf in rows:
            new = [(int(s), t) for s, t in zip(pdf["seq"], pdf["chunk"]) if t is not None]
            if new:
                self.chunks.appendList(new)
            done = done or bool(pdf["is_done"].any())
            if self.idle_ms is not None:
                latest_ms = max(int(pdf["at_ms"].max()), latest_ms or 0)
        if self.idle_ms is not None and (runs_out is None or latest_ms + self.idle_ms > runs_out):
            if runs_out is not None:
                self.handle.deleteTimer(runs_out)
            runs_out = latest_ms + self.idle_ms
            self.handle.registerTimer(runs_out)
        self.status.update((done, runs_out))
        if done:
            yield self._row(key, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        done = self.status.exists() and self.status.get()[0]
        if not done:  # else it was emitted whole
            yield self._row(key, False)
        self.chunks.clear()
        self.status.clear()


def reassembly_stream(lines: DataFrame, event_time: str | None = None, delay: str = "1 minute", idle_ms: int = IDLE_MS) -> DataFrame:
    """The stateful operator over a stream of (request_id, seq, line[, event time]); update mode.

    With ``event_time`` the stream has a watermark of ``delay``, and a request whose last line is
    ``idle_ms`` behind it is emitted incomplete and forgotten.
    """
    data = py_strip(F.regexp_replace(F.col("line"), F.lit("^data: "), F.lit("")))
    ms = F.unix_millis(event_time) if event_time else F.lit(None).cast("long")
    timed = lines.withWatermark(event_time, delay) if event_time else lines
    parsed = timed.select("request_id", "seq", stream_chunk_text(F.col("line")).alias("chunk"), (data == F.lit("[DONE]")).alias("is_done"), ms.alias("at_ms"),
                          *([event_time] if event_time else []))
    rocksdb_state(lines.sparkSession)
    return parsed.groupBy("request_id").transformWithStateInPandas(
        Reassembler(idle_ms if event_time else None), OUT_SCHEMA, "Update", "EventTime" if event_time else "None")


def open_requests(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(request_id, text, complete = false) of the requests without ``[DONE]`` that the state store holds."""
    state = spark.read.format("statestore").option("path", checkpoint)
    chunks = state.option("stateVarName", "chunks").load().select(F.col("key.request_id").alias("request_id"), "list_element.seq", "list_element.text")
    status = state.option("stateVarName", "status").load().select(F.col("key.request_id").alias("request_id"), "value.done")
    texts = chunks.groupBy("request_id").agg(F.array_sort(F.collect_list(F.struct("seq", "text"))).alias("_c"))  # one response: bounded by the generation length
    joined = status.where("not done").join(texts, "request_id")
    return joined.select("request_id", F.array_join(F.transform("_c", lambda c: c["text"]), "").alias("text"), F.lit(False).alias("complete"))


def live_reassembly(spark: SparkSession, source: str, schema: StructType, max_files_per_trigger: int | None = None, event_time: str | None = None,
                    delay: str = "1 minute", idle_ms: int = IDLE_MS) -> DataFrame:
    """Run the reassembly over a folder of stream-log files (availableNow): the last state of every request."""
    base = work_dir(spark, "completions")
    stream = file_stream(spark, source, schema, max_files_per_trigger=max_files_per_trigger)
    run_available_now(update_sink(reassembly_stream(stream, event_time, delay, idle_ms), base))
    emitted = latest(spark, base, OUT_SCHEMA, ["request_id"])
    return emitted.unionByName(open_requests(spark, f"{base}/checkpoint"))
