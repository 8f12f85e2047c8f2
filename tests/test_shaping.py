"""AGG1/AGG5/BAT1-5: profile, histogram, masks, steps (FIXTURES 3.5)."""

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import batches, profile


def test_profile_case(spark):
    df = spark.createDataFrame([("train", n) for n in (1, 2, 3, 10)], "split string, n_tokens long")
    r = profile.length_profile(df).collect()[0]
    assert (r.samples, r.total_tokens, r.mean_length, r.median_length, r.min_length, r.max_length) == \
        (4, 16, 4.0, 2.5, 1, 10)
    assert abs(r.std_length - 3.5355339059) < 1e-6


def test_rollup_total_row(spark):
    df = spark.createDataFrame([("train", 1), ("train", 3), ("test", 5)], "split string, n_tokens long")
    got = {r.split: r.total_tokens for r in profile.length_profile_with_totals(df).collect()}
    assert got == {"train": 4, "test": 5, "ALL": 9}


def test_histogram_matches_numpy(spark):
    vals = [1, 1, 2, 5, 9, 9, 10, 37, 100]
    df = spark.createDataFrame([(v,) for v in vals], "n_tokens long")
    got = [r.n for r in profile.length_histogram(df, bins=10).orderBy("bin").collect()]
    assert got == list(np.histogram(vals, bins=10)[0])
    same = spark.createDataFrame([(4,), (4,)], "n_tokens long")
    got = [r.n for r in profile.length_histogram(same, bins=10).orderBy("bin").collect()]
    assert got == list(np.histogram([4, 4], bins=10)[0])


def test_masks(spark):
    df = spark.createDataFrame([([5, 6, 0, 0],), ([5, 9, 6, 9],)], "input_ids array<int>")
    rows = df.select(batches.labels(F.col("input_ids"), 0).alias("l"),
                     batches.attention_mask(F.col("input_ids"), 0).alias("m")).collect()
    assert rows[0].l == [5, 6, -100, -100] and rows[0].m == [1, 1, 0, 0]
    rows = df.select(batches.labels(F.col("input_ids"), 9).alias("l"),
                     batches.attention_mask(F.col("input_ids"), 9).alias("m")).collect()
    assert rows[1].l == [5, -100, 6, -100] and rows[1].m == [1, 0, 1, 0]


def test_steps(spark):
    s = batches.step_summary(1000, 2, 16, 1)
    assert (s["batches"], s["updates_per_epoch"], s["unused_batches"]) == (500, 31, 4)
    assert batches.step_summary(1000, 2, 16, 1, max_steps=10)["total_updates"] == 10
    df = spark.range(1000).select(F.lit("train").alias("split"), F.col("id").alias("doc_id"))
    plan = batches.step_plan(batches.assign_batches(df, "doc_id"))
    assert plan.agg(F.max("update_step")).first()[0] == 31
    assert plan.count() == 31 * 16


def test_batches_cover_rows_once(spark):
    df = spark.range(101).select(F.lit("validation").alias("split"), F.col("id").alias("chunk_id"))
    got = batches.assign_batches(df).collect()
    assert sorted((r.batch_id, r.pos) for r in got) == [(i // 2, i % 2) for i in range(101)]
    # eval splits keep id order
    assert all(r.batch_id == r.chunk_id // 2 for r in got)


def test_approximate_median_option(spark):
    df = spark.range(1, 1001).select(F.lit("train").alias("split"), F.col("id").alias("n_tokens"))
    exact = profile.length_profile(df).collect()[0].median_length
    approx = profile.length_profile(df, exact=False).collect()[0].median_length
    assert exact == 500.5 and abs(approx - exact) <= 1
