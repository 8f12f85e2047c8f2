"""Prepare -> pack -> stats as batch jobs writing split datasets, with skip-if-present."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.plans import jobs
from tessera.sources.tables import MissingDatasetError, read_splits, spread, table
from tessera.streaming.common import work_dir


def test_prepare_pack_stats_round_trip(spark):
    root = work_dir(spark, "jobs")
    docs = spread(table(spark, SF_SMALL, "documents"))
    assert jobs.prepare_job(spark, docs, f"{root}/prepared") is True
    assert jobs.prepare_job(spark, docs, f"{root}/prepared") is False  # skip if present
    tokens = read_splits(spark, f"{root}/prepared/tokens")
    stats = spark.read.json(jobs.stats_path(f"{root}/prepared")).first()
    assert stats.total_rows == tokens.count() and stats.train_samples > 0
    assert jobs.pack_job(spark, f"{root}/prepared/tokens", f"{root}/packed", max_length=512, lossless=False) is True
    packed = read_splits(spark, f"{root}/packed")
    assert packed.select(F.size("input_ids")).distinct().collect()[0][0] == 512
    report = spark.read.json(jobs.stats_path(f"{root}/packed"))
    total = report.agg(F.sum("tokens_kept") + F.sum("tokens_lost")).first()[0]
    assert total == tokens.agg(F.sum(F.col("n_tokens") + 1)).first()[0]
    assert jobs.pack_job(spark, f"{root}/prepared/tokens", f"{root}/whole", max_length=512) is True  # lossless by default
    whole = spark.read.json(jobs.stats_path(f"{root}/whole"))
    assert whole.agg(F.sum("tokens_kept")).first()[0] == total and whole.agg(F.sum("sequences")).first()[0] == read_splits(spark, f"{root}/whole").count()
    prof = {r.split: r.samples for r in jobs.stats_job(spark, f"{root}/prepared/tokens").collect()}
    assert prof["ALL"] == tokens.count()
    with pytest.raises(MissingDatasetError):
        jobs.stats_job(spark, f"{root}/nothing-here")


def test_evaluate_job(spark):
    from tessera.plans import derived
    bench = table(spark, SF_SMALL, "benchmark")
    runs = {"indommlu": derived.mcq_answers(bench),
            "indonlg": (derived.summary_pairs(bench), None)}
    out = jobs.evaluate_job(spark, runs, ["indommlu", "indonlg", "indo4b", "not-registered"],
                            losses=table(spark, SF_SMALL, "documents").selectExpr("(doc_id % 50) / 10.0 AS nll", "cast(length(text) AS bigint) AS n"))
    rows = {(r.benchmark, r.metric): (r.value, r.error) for r in out.collect()}
    assert ("indommlu", "accuracy") in rows and ("indonlg", "rouge1") in rows
    assert rows[("indo4b", None)][1].startswith("dataset not available")
    assert ("perplexity", "perplexity") in rows and not any(b == "not-registered" for b, _ in rows)


def test_benchmarks_are_loaded_by_name_and_split(spark):
    from tessera.operators import evaluation
    from tessera.plans import derived
    root = work_dir(spark, "benchmarks")
    items = derived.mcq_items(table(spark, SF_SMALL, "benchmark"))
    items.withColumn("split", F.when(F.col("item_id") % 4 == 0, "validation").otherwise("test")).write.partitionBy("split").parquet(f"{root}/indonlp/indommlu")
    items.withColumn("split", F.lit("train")).write.partitionBy("split").parquet(f"{root}/indonlp/nusax")
    answer = lambda df: (df, df.select("item_id", F.col("answer").alias("response")))
    out = jobs.evaluate_job(spark, {}, ["indommlu", "nusax", "indo4b", "other"], root=root, answer=answer)
    rows = {(r.benchmark, r.metric): (r.value, r.error) for r in out.collect()}
    assert rows[("indommlu", "accuracy")][0] == 1.0 and rows[("indommlu", "total")][0] == items.where("item_id % 4 <> 0").count()
    assert rows[("nusax", None)][1] == "split not available: test" and rows[("indo4b", None)][1] == "dataset not available: indonlp/indo4b"
    assert {b for b, _ in rows} == {"indommlu", "nusax", "indo4b"}
    assert evaluation.load_benchmarks(spark, ["other"], root) == ({}, {})


def test_command_line(spark, capsys):
    import json

    from tessera.__main__ import main
    from tessera.plans import derived
    root = work_dir(spark, "cli")
    text = "some words that are long enough for the rules, number "
    spark.createDataFrame([(i, f"{text}{i}") for i in range(12)], "doc_id long, content string").write.parquet(f"{root}/a")
    spark.createDataFrame([(f"{text}{i}",) for i in range(50, 58)], "value string").coalesce(1).write.text(f"{root}/b")
    entries = [{"lang": "id", "source": "a", "path": f"{root}/a", "max_samples": 5}, {"lang": "en", "source": "b", "path": f"{root}/b", "fmt": "text"},
               {"lang": "en", "source": "none", "path": None, "fmt": None}]
    spark.createDataFrame([(json.dumps(entries),)], "value string").coalesce(1).write.text(f"{root}/registry")
    main(["prepare", "--registry", f"{root}/registry", "--output", f"{root}/prep"])
    assert read_splits(spark, f"{root}/prep/tokens").count() == 20
    main(["prepare", "--registry", f"{root}/registry", "--use-registry-caps", "--output", f"{root}/capped"])
    assert dict(read_splits(spark, f"{root}/capped/tokens").groupBy("lang").count().collect()) == {"id": 5, "en": 8}
    main(["synthetic", "--rows", "200", "--output", f"{root}/syn"])
    assert {r.split: r.n for r in read_splits(spark, f"{root}/syn").groupBy("split").agg(F.count("*").alias("n")).collect()} == {"train": 198, "validation": 1, "test": 1}
    bench = table(spark, SF_SMALL, "benchmark")
    items, responses = derived.mcq_answers(bench)
    items.write.parquet(f"{root}/items")
    responses.write.parquet(f"{root}/responses")
    main(["evaluate", "--benchmark", f"indommlu={root}/items,{root}/responses", "--benchmark", "indo4b", "--output", f"{root}/eval"])
    rows = {(r.benchmark, r.metric) for r in spark.read.json(f"{root}/eval").collect()}
    assert ("indommlu", "accuracy") in rows and any(b == "indo4b" for b, _ in rows)
    main(["stats", "--dataset", f"{root}/prep/tokens"])
    assert "written" in capsys.readouterr().out
