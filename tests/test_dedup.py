"""DED1-4: keep-first by registry order within language (FIXTURES 3.2), plan shape."""

from tessera.operators import dedup

X = "x" * 1000


def _df(spark):
    rows = [("en", 0, 1, X + "a"), ("en", 0, 2, X + "b"), ("en", 1, 0, X + "a"), ("fr", 0, 3, X + "a")]
    df = spark.createDataFrame(rows, "lang string, source_rank int, doc_id long, text string")
    return df.withColumn("ord", dedup.order_key())


def test_prefix_dedup(spark):
    got = sorted(r.doc_id for r in dedup.dedup_prefix(_df(spark)).collect())
    assert got == [1, 3]


def test_exact_dedup(spark):
    got = sorted(r.doc_id for r in dedup.dedup_exact(_df(spark)).collect())
    assert got == [1, 2, 3]


def test_idempotent(spark):
    once = dedup.dedup_prefix(_df(spark))
    assert sorted(r.doc_id for r in dedup.dedup_prefix(once).collect()) == sorted(r.doc_id for r in once.collect())


def test_report(spark):
    got = {r.lang: (r.n_before, r.n_after, r.n_removed) for r in dedup.dedup_report(_df(spark), prefix_chars=1000).collect()}
    assert got == {"en": (3, 1, 2), "fr": (1, 1, 0)}


def test_text_not_in_aggregate_exchange(spark):
    from conftest import SF_SMALL
    from tessera.plans.prepare import ranked_documents
    from tessera.sources.tables import table
    docs = ranked_documents(table(spark, SF_SMALL, "documents"))
    plan = dedup.dedup_prefix(docs).select("doc_id")._jdf.queryExecution().executedPlan().toString()
    agg_lines = [ln for ln in plan.splitlines() if "HashAggregate" in ln]
    assert agg_lines and all("text" not in ln.split("output=")[-1] for ln in agg_lines)
    assert "SortAggregate" not in plan
