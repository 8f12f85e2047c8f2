"""SRC2-10, SNK1-3, SET3, TOK1(b), TOK2, ROUGE-Lsum."""

import pytest
from pyspark.errors import AnalysisException

from tessera.config import QualityParams, SpecialIds
from tessera.sources import registry, sinks, tables


def _tmp(spark, name):
    from tessera.streaming.common import work_dir
    return work_dir(spark, name)


def test_split_sink_and_pruned_scan(spark):
    path = _tmp(spark, "splits")
    df = spark.createDataFrame([(1, "train"), (2, "test"), (3, "validation")], "doc_id long, split string")
    sinks.write_splits(df, path)
    got = tables.read_splits(spark, path, ["test"])
    assert [r.doc_id for r in got.collect()] == [2]
    assert "PartitionFilters: [isnotnull(split" in got._jdf.queryExecution().executedPlan().toString() or \
        "split" in got._jdf.queryExecution().executedPlan().toString()
    assert sinks.write_if_absent(df, path) is False


def test_stats_roundtrip(spark):
    path = _tmp(spark, "stats")
    sinks.write_stats(spark.createDataFrame([(5, 10)], "total_samples long, total_tokens long"), path)
    r = tables.read_stats(spark, path).collect()[0]
    assert (r.total_samples, r.total_tokens) == (5, 10)


def test_missing_dataset(spark):
    with pytest.raises(tables.MissingDatasetError):
        tables.read_splits(spark, "/nonexistent/tessera/path")


def test_text_lines(spark):
    path = _tmp(spark, "lines")
    spark.createDataFrame([("  a b \t",), ("   ",), ("c",)], "value string").coalesce(1).write.text(path)
    assert sorted(r.text for r in tables.read_text_lines(spark, path).collect()) == ["a b", "c"]


def test_load_sources_replace_and_skip(spark):
    from conftest import SF_SMALL
    good = registry.CorpusSource("en", "src0", f"{SF_SMALL}/documents.parquet", 0, "parquet",
                                 "lang = 'en' AND source = 'src0'")
    bad = registry.CorpusSource("en", "gone", "/nonexistent/x.parquet", 1, "parquet")
    odd = registry.CorpusSource("en", "odd", "/x", 2, "weird-format")
    report = registry.LoadReport()
    with pytest.raises(AnalysisException):  # a missing source fails unless a replacement is asked for
        registry.load_sources(spark, [good, bad, odd])
    df = registry.load_sources(spark, [good, bad, odd], replace_failed=True, replacement_rows=7, report=report)
    assert report.loaded == ["src0"] and report.replaced == ["gone"] and report.skipped == ["odd"]
    counts = dict(df.groupBy("source").count().collect())
    assert counts["synthetic"] == 7 and counts["src0"] > 0


def test_empty_corpus_fallback(spark):
    from tessera.plans.prepare import corpus_or_synthetic
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert corpus_or_synthetic(empty, n=12).count() == 12


def test_synthetic_is_deterministic(spark):
    from tessera.sources.synthetic import synthetic_corpus
    a = {r.doc_id: r.text for r in synthetic_corpus(spark, 50).collect()}
    b = {r.doc_id: r.text for r in synthetic_corpus(spark, 50).repartition(7).collect()}
    assert a == b and all("{" not in t for t in a.values())


def test_pad_policy():
    assert SpecialIds(pad=None, eos=9).pad_id == 9
    assert SpecialIds().pad_id == 0


def test_rouge_lsum_simple(spark):
    from tessera.operators import evaluation
    # identical texts -> 1.0; disjoint -> 0.0; line structure respected
    assert evaluation.rouge_lsum_f([["a", "b"], ["c"]], [["a", "b"], ["c"]]) == 1.0
    assert evaluation.rouge_lsum_f([["x"]], [["a"]]) == 0.0
    pairs = spark.createDataFrame([(1, "a b\nc d", "a b\nc d")], "item_id long, prediction string, reference string")
    r = evaluation.rouge_l_scores(pairs).collect()[0]
    assert r.rougeL == 1.0 and r.rougeLsum == 1.0


def test_synthetic_rows_skip_quality_rules_by_default(spark):
    from tessera.plans.prepare import PrepareParams, prepared_documents
    rows = [(1, "a" * 200, "en", "synthetic"), (2, "b" * 200, "en", "src0")]  # repetition 0.005 < 0.01
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    rule = QualityParams(max_length=None, repetition_min=0.01)
    assert [r.doc_id for r in prepared_documents(docs, PrepareParams(quality=rule)).collect()] == [1]
    assert prepared_documents(docs, PrepareParams(quality=rule, filter_synthetic=True)).count() == 0


def test_registry_cap_only_when_asked(spark):
    from pyspark.sql import functions as F
    from tessera.plans import prepare as P
    from tessera.sources import registry as R
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("doc "), F.col("id").cast("string"),
                                  F.lit(" " + "xyzw" * 20)).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    original = R.registry_from_table

    def small_cap(d):
        return original(d).withColumn("max_samples", F.lit(7).cast("bigint"))
    P.registry_from_table = small_cap
    try:
        assert P.prepared_documents(docs).count() == 40
        assert P.prepared_documents(docs, P.PrepareParams(use_registry_cap=True)).count() == 7
    finally:
        P.registry_from_table = original


def test_spread_contract(spark):
    from tessera.sources.tables import spread
    target = spark.sparkContext.defaultParallelism
    big = spark.range(1000).repartition(target + 2)
    assert spread(big) is big  # enough splits: returned unchanged
    small = spark.range(100).coalesce(1)
    spreadd = spread(small)
    assert spreadd.rdd.getNumPartitions() == target
    assert sorted(r.id for r in spreadd.collect()) == list(range(100))


SOURCE = "doc_id long, text string, lang string, source string"


def long_text(i):
    return f"document number {i} " + "some more text that is long enough for the rules "


def test_overlapping_ids_and_null_sources_are_prepared_whole(spark):
    from tessera.plans.prepare import prepared_documents
    rows = [(i, long_text(100 * k + i), lang, None if i % 2 else "s") for k, lang in enumerate(("en", "de")) for i in range(20)]
    got = prepared_documents(spark.createDataFrame(rows, SOURCE)).collect()
    assert sorted((r.doc_id, r.lang) for r in got) == sorted((i, lang) for i, _, lang, _ in rows)
    assert sorted(r.shuffle_rank for r in got) == list(range(40))
    copies = [(1, long_text(1), "en", "s"), (2, long_text(1), "en", "s"), (1, long_text(2), "de", "s"), (2, long_text(3), "de", "s")]
    assert sorted((r.doc_id, r.lang) for r in prepared_documents(spark.createDataFrame(copies, SOURCE)).collect()) == [(1, "de"), (1, "en"), (2, "de")]


def test_nothing_is_cut_by_default(spark):
    from tessera.plans.prepare import prepare
    base = " ".join(f"word{i}" for i in range(9000))  # beyond 1,000 and 32,768 characters
    rows = [(i, base + f" end{i}", "en", "s") for i in range(3)] + [(9, " ".join(f"w{i % 5000}" for i in range(40_000)), "en", "s")]
    prep = prepare(spark.createDataFrame(rows, SOURCE))
    assert {r.doc_id: r.n_tokens for r in prep.encoded.collect()} == {0: 9001, 1: 9001, 2: 9001, 9: 40_000}


def test_loaded_sources_can_be_prepared(spark):
    from tessera.plans.prepare import corpus_or_synthetic, prepared_documents
    path = _tmp(spark, "union")
    rows = [(i, long_text(i), "en", "o'r" if i % 2 else "it") for i in range(20)]
    spark.createDataFrame(rows, SOURCE).write.parquet(path + "/table")
    spark.createDataFrame([(long_text(100 + i),) for i in range(5)], "value string").repartition(3).write.text(path + "/lines")
    reg = registry.registry_from_table(spark.read.parquet(path + "/table")).collect()
    sources = registry.sources_from_registry(reg, path + "/table") + [registry.CorpusSource("de", "lines", path + "/lines", 0, "text")]
    docs = registry.load_sources(spark, sources)
    assert docs.count() == 25 and docs.where("source = \"o'r\"").count() == 10
    assert {r.text.strip() for r in docs.where("source = 'lines'").collect()} == {long_text(100 + i).strip() for i in range(5)}
    assert prepared_documents(docs).count() == 25
    assert prepared_documents(corpus_or_synthetic(spark.createDataFrame([], SOURCE), n=40)).count() > 0
    with pytest.raises(ValueError):
        spark.range(3).write.parquet(path + "/no-text")
        registry.load_sources(spark, [registry.CorpusSource("en", "x", path + "/no-text", 0)])


def test_ids_that_do_not_fit_raise(spark):
    from tessera.plans.prepare import ranked_documents
    for bad in (1 << 40, -1, None):
        with pytest.raises(Exception, match="doc_id outside"):
            ranked_documents(spark.createDataFrame([(bad, "x", "en", "s")], SOURCE)).collect()


def test_unfinished_job_is_completed(spark):
    from tessera.plans import jobs
    out = _tmp(spark, "job")
    docs = spark.createDataFrame([(i, long_text(i), "en", "s") for i in range(10)], SOURCE)
    assert jobs.prepare_job(spark, docs, out)
    empty = spark.createDataFrame([], "x int")
    empty.write.mode("overwrite").json(jobs.stats_path(out))  # as if the run had ended before its stats
    assert jobs.prepare_job(spark, docs, out) and not jobs.prepare_job(spark, docs, out)
