"""STR1-3: the availableNow streams equal the batch results."""

import os

from conftest import SF_SMALL

import __spark_entry__ as E

os.environ.setdefault("TESSERA_STREAM_TIMEOUT", "300")


def test_intake_equals_batch_dedup(spark):
    stream_ids = {r.doc_id for r in E.queries()["stream_intake"](spark, SF_SMALL).collect()}
    from tessera.config import PLAN_QUALITY
    from tessera.operators import dedup, quality
    from tessera.plans.prepare import ranked_documents
    from tessera.sources.tables import table
    batch = dedup.dedup_exact(quality.quality_filter(ranked_documents(table(spark, SF_SMALL, "documents")),
                                                      PLAN_QUALITY))
    assert stream_ids == {r.doc_id for r in batch.collect()}


def test_live_reassembly_equals_batch(spark):
    live = {r.request_id: r.text for r in E.queries()["stream_reassembly_live"](spark, SF_SMALL).collect()}
    batch = {r.request_id: r.text for r in E.queries()["stream_reassembly"](spark, SF_SMALL).collect()}
    assert live == batch and live


def test_rollup_runs(spark):
    assert E.queries()["stream_runlog_rollup"](spark, SF_SMALL).count() > 0


def test_watermark_dedup_variant(spark):
    from pyspark.sql import functions as F
    from tessera.streaming.common import run_available_now, work_dir
    from tessera.streaming.intake import dedup_within_watermark
    from tessera.streaming.common import file_stream
    src = work_dir(spark, "wm-src")
    x = "x" * 60 + "abcdefghijklmnop"
    rows = [(1, x, "en", "s", "2024-01-01 00:00:00"), (2, x, "en", "s", "2024-01-01 00:05:00"),
            (3, x, "fr", "s", "2024-01-01 00:06:00")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, t string") \
        .withColumn("ts", F.to_timestamp("t")).drop("t").write.parquet(src)
    schema = spark.read.parquet(src).schema
    out = work_dir(spark, "wm-out")
    q = dedup_within_watermark(file_stream(spark, src, schema), "ts", "1 hour")
    run_available_now(q.writeStream.format("parquet").option("path", out)
                      .option("checkpointLocation", out + "-ckpt"))
    got = sorted(r.lang for r in spark.read.parquet(out).collect())
    assert got == ["en", "fr"]


def test_three_micro_batches_equal_the_batch_result(spark):
    from pyspark.sql import functions as F
    from tessera.operators.prompts import reassemble
    from tessera.sources import registry
    from tessera.streaming import completions, intake, runlog
    from tessera.streaming.common import work_dir
    src = work_dir(spark, "batches")
    chunk = 'data: {{"choices": [{{"text": "{}"}}]}}'.format
    parts = [[(1, 1, chunk("a")), (2, 1, chunk("x"))], [(1, 3, "data: [DONE]  "), (3, 1, chunk("z")), (2, 2, chunk("y"))], [(1, 2, chunk("b")), (3, 2, "data: [DONE]")]]
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, "request_id long, seq long, line string").coalesce(1).write.mode("append").parquet(f"{src}/lines")
    lines = spark.read.parquet(f"{src}/lines")
    live = completions.live_reassembly(spark, f"{src}/lines", lines.schema, max_files_per_trigger=1)
    assert {r.request_id: (r.text, r.complete) for r in live.collect()} == {1: ("ab", True), 2: ("xy", False), 3: ("z", True)}
    assert {r.request_id: r.text for r in live.collect()} == {r.request_id: r.text for r in reassemble(lines).collect()}

    text = lambda i: f"text number {i} that is long enough for the minimum length rule of the intake stage"
    parts = [[(1, text(1), "en", "s"), (2, text(2), "en", "new")], [(3, text(1), "en", "s"), (4, text(4), "en", None)], [(5, text(2), "de", "s"), (6, text(4), "en", "s")]]
    for rows in parts:
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1).write.mode("append").parquet(f"{src}/docs")
    docs = spark.read.parquet(f"{src}/docs")
    known = registry.registry_from_table(docs.where("source = 's'"))
    got = intake.incremental_intake(spark, f"{src}/docs", docs.schema, known, max_files_per_trigger=1).collect()
    assert len({r.batch_id for r in got}) == 3 and len(got) == 4 and {r.lang for r in got} == {"en", "de"}

    ts = lambda m: f"2024-01-01 00:{m:02d}:00"
    for rows in ([(1, ts(1), 1.0)], [(1, ts(2), 3.0), (2, ts(3), 1.0)], [(1, ts(59), 5.0)]):
        spark.createDataFrame(rows, "run_id long, t string, loss double").select("run_id", F.to_timestamp("t").alias("ts"), "loss").coalesce(1).write.mode("append").parquet(f"{src}/log")
    log = spark.read.parquet(f"{src}/log")
    got = runlog.live_rollup(spark, f"{src}/log", log.schema, max_files_per_trigger=1).collect()
    assert {(r.run_id, r.records, r.mean_loss) for r in got} == {(1, 3, 3.0), (2, 1, 1.0)}


def test_abandoned_requests_run_out_by_an_event_timer(spark):
    from pyspark.sql import functions as F
    from tessera.operators.prompts import reassemble
    from tessera.streaming import completions
    from tessera.streaming.common import work_dir
    src = work_dir(spark, "timed")
    chunk = 'data: {{"choices": [{{"text": "{}"}}]}}'.format
    done = "data: [DONE]"
    parts = [[(1, 2, chunk("b"), 0), (2, 1, chunk("x"), 1), (3, 1, "", 1)],
             [(1, 1, chunk("a"), 5), (4, 1, chunk("late?"), 6)],
             [(1, 3, done, 30), (5, 1, chunk("e"), 30)],        # the watermark moves on: 2, 3 and 4 have run out
             [(1, 4, chunk("c"), 31), (5, 2, chunk("f"), 32)],   # a chunk after [DONE]
             [(6, 1, chunk("y"), 33)]]
    for rows in parts:
        (spark.createDataFrame(rows, "request_id long, seq long, line string, minute int")
         .select("request_id", "seq", "line", F.expr("timestamp '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, minute, 0)").alias("ts"))
         .coalesce(1).write.mode("append").parquet(src))
    lines = spark.read.parquet(src)
    got = completions.live_reassembly(spark, src, lines.schema, max_files_per_trigger=1, event_time="ts").collect()
    assert {r.request_id: (r.text, r.complete) for r in got} == {
        1: ("abc", True), 2: ("x", False), 3: ("", False), 4: ("late?", False), 5: ("ef", False), 6: ("y", False)} and len(got) == 6
    batch = {r.request_id: r.text for r in reassemble(lines).collect()}
    assert batch == {r.request_id: r.text for r in got if r.request_id != 3}


def test_history_reads_only_batches_that_may_hold_the_keys(spark):
    from pyspark.sql import functions as F
    from tessera.streaming import history
    from tessera.streaming.common import work_dir
    cols = ["lang", "_key"]
    sink = work_dir(spark, "history") + "/sink"
    key = F.sha2(F.col("id").cast("string"), 256).alias("_key")
    for b in range(6):  # batch 5 has null languages
        rows = spark.range(b * 1000, b * 1000 + 1000 * (b % 2 + 1) // 2).select(F.lit(None if b == 5 else "en").cast("string").alias("lang"), key, F.lit("text").alias("text"))
        rows.withColumn("batch_id", F.lit(b).cast("bigint")).write.mode("append").partitionBy("batch_id").parquet(sink)
        history.write_filter(rows, cols, b, f"{sink}-filters")
    filters = spark.read.parquet(f"{sink}-filters")
    assert filters.groupBy("batch_id").agg(F.max("blocks")).count() == 6

    def asked(first, n, lang="en", filters=filters):
        keys = spark.range(first, first + n).select(F.lit(lang).cast("string").alias("lang"), key)
        left, read = history.unseen(keys, cols, spark, sink, filters)
        return left.count(), read, left

    assert asked(1000, 10)[:2] == (0, [1]) and asked(5000, 10, None)[:2] == (0, [5])
    left, read, plan = asked(1990, 20)  # the end of batch 1, the begin of batch 2
    assert left == 0 and set(read) >= {1, 2}
    assert "PartitionFilters" in (text := plan._jdf.queryExecution().executedPlan().toString()) and "batch_id" in text
    left, read, plan = asked(1_000_000, 3)
    assert left == 3 and len(read) <= 1
    if not read:
        assert "Scan parquet" not in plan._jdf.queryExecution().executedPlan().toString()
    left, read, _ = asked(1_000_000, 5_000)
    assert left == 5_000  # false positives are resolved exactly
    found = history.may_hold(spark.range(1_000_000, 1_020_000).select(F.lit("en").alias("lang"), key), cols, filters)
    assert found.count() < 0.15 * 6 * 20_000
    one = history.make_filter(spark.range(50).select(F.lit("en").alias("lang"), key), cols, 1).withColumn("blocks", F.lit(1)).withColumn("batch_id", F.lit(0).cast("bigint"))
    assert asked(900_000, 40, filters=one)[0] == 40 and asked(900_000, 40, filters=filters.limit(0))[:2] == (40, [])
