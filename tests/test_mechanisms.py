"""Selection, epoch permutations, committed versions and observed metrics."""

import random

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tessera.operators import ordinal, permutation, quality, selection
from tessera.plans.prepare import PrepareParams, prepared_documents, split_documents
from tessera.sources import versions
from tessera.sources.registry import registry_from_table
from tessera.sources.tables import MissingDatasetError, table
from tessera.streaming.common import work_dir


def test_order_statistics_equal_sorting(spark):
    keys = spark.range(3000).select(selection.selection_key("id").alias("k"))
    keys = keys.unionAll(keys.limit(100)).cache()
    want = sorted(r.k for r in keys.collect())
    ranks = [0, 1, 57, 58, 1500, 3098, 3099]
    for digits, small in ((3, 4096), (2, 20), (1, 1)):
        assert selection.order_statistics(keys, "k", ranks, digits, small) == [want[r] for r in ranks]
    with pytest.raises(IndexError):
        selection.order_statistics(keys, "k", [3100])
    assert selection.order_statistics(keys, "k", []) == []


def test_split_by_selection_equals_split_by_rank(spark):
    for n in (0, 1, 2, 99, 100, 101, 250, 2017):
        ids = spark.range(n).withColumnRenamed("id", "doc_id")
        key = selection.selection_key("doc_id")
        bounds = selection.split_bounds(ids.select(key.alias("k")), "k")
        got = {r.doc_id: r.split for r in ids.withColumn("split", selection.split_by_bounds(key, bounds)).collect()}
        assert got == {r.doc_id: r.split for r in ordinal.three_way_split(ids).collect()}


def bag(df):
    return sorted(map(str, df.select("doc_id", "lang", "source", "split", F.sha2("text", 256)).collect()))


def test_split_documents_shuffles_no_text(spark):
    docs = table(spark, SF_SMALL, "documents")
    docs = docs.unionByName(docs.where("doc_id % 9 = 0"))  # rows repeated as they are
    docs = docs.unionByName(docs.where("doc_id % 11 = 0").withColumn("doc_id", F.col("doc_id") + 100_000))  # later copies
    want = bag(prepared_documents(docs))
    out = split_documents(docs)
    assert bag(out) == want and bag(split_documents(docs, limit=0)) == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.split("\n") if "Exchange" in line and "Broadcast" not in line]
    assert not shuffled, plan
    with pytest.raises(ValueError):
        split_documents(docs, PrepareParams(lang_cap=3))


def plain_place(x, n, epoch, seed):
    a, b = permutation.sides(n)
    while True:
        left, right = divmod(x, b)
        for i in range(permutation.ROUNDS):
            v = ((right if i % 2 == 0 else left) + permutation.round_key(seed, epoch, i)) & permutation.MASK
            for factor, shift in permutation.MIX:
                v = (v * factor) & permutation.MASK
                v ^= v >> shift
            if i % 2 == 0:
                left = (left + v) % a
            else:
                right = (right + v) % b
        x = left * b + right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 100, 1000, 4097])
def test_epochs_are_different_bijections(n):
    x = np.arange(n)
    orders = []
    for e in range(3):
        places = permutation.permute(x, n, np.full(n, e))
        assert sorted(places.tolist()) == x.tolist()
        assert (permutation.permute(places, n, np.full(n, e), undo=True) == x).all()
        assert places.tolist() == [plain_place(i, n, e, 42) for i in range(n)] if n <= 1000 else True
        orders.append(places)
    if n >= 100:
        assert np.mean(orders[0] == orders[1]) < 0.1 and abs(np.corrcoef(orders[0], orders[1])[0, 1]) < 0.3
        assert abs(np.corrcoef(orders[0], x)[0, 1]) < 0.3


def test_epoch_batches_and_resume(spark):
    n, epochs = 203, 3
    rows = spark.range(n).select(F.col("id").alias("idx"), F.concat(F.lit("d"), "id").alias("doc_id"))
    got = permutation.epoch_batches(rows, n, epochs, batch_size=4, grad_accum=5).collect()
    for e in range(epochs):
        mine = {(r.batch_id, r.pos): r for r in got if r.epoch == e}
        assert sorted(mine) == [(i // 4, i % 4) for i in range(n)] and {r.idx for r in mine.values()} == set(range(n))
        assert all(r.update_step == (e * 10 + r.batch_id // 5 + 1 if r.batch_id < 50 else None) for r in mine.values())
        left = {(r.batch_id, r.pos): r.idx for r in permutation.remaining_rows(spark, n, e, 7, 4, 5).collect()}
        assert left == {k: r.idx for k, r in mine.items() if k[0] >= 35}
    assert permutation.epoch_batches(rows.limit(0), 0, 2).collect() == []
    plan = permutation.epoch_batches(rows, n, epochs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_versions_commit_last(spark):
    root = work_dir(spark, "versions-test")
    rows = spark.createDataFrame([(i, f"t{i}", "train" if i % 3 else "test") for i in range(30)], "id long, text string, split string")
    with pytest.raises(MissingDatasetError):
        versions.read_committed(spark, root)
    assert versions.publish_if_changed(rows, root, {"a": 1}, ["train", "test"])
    assert not versions.publish_if_changed(rows, root, {"a": 1}, ["train", "test"])
    last = versions.latest(spark, root)
    assert (last["version"], last["rows"], {p["part"]: p["rows"] for p in last["parts"]}) == (1, 30, {"train": 20, "test": 10})
    assert versions.verify(spark, root)
    # a write that dies: files without a manifest, and a task that fails while writing
    rows.limit(3).write.partitionBy("split").parquet(f"{root}/data/000002-dead")
    bad = rows.withColumn("text", F.when(F.col("id") == 29, F.raise_error(F.lit("stop"))).otherwise(F.col("text")))
    with pytest.raises(Exception):
        versions.publish(bad, root, {"a": 2})
    assert versions.read_committed(spark, root).count() == 30 and versions.latest(spark, root)["version"] == 1
    # other parameters, another schema or another input: written anew, and the old version stays readable
    assert versions.publish_if_changed(rows.where("id < 5"), root, {"a": 2}, ["train"])
    assert versions.publish_if_changed(rows.where("id < 6"), root, {"a": 2}, ["train"], inputs=["x"])
    assert versions.read_committed(spark, root).count() == 6 and versions.read_committed(spark, root, version=1).count() == 30
    assert versions.read_committed(spark, root, version=1, parts=["test"]).count() == 10
    # a stored part that changes is found
    first = versions.manifests(spark, root).where("version = 1").first()
    spark.createDataFrame([(99, "extra", "test")], "id long, text string, split string").write.mode("append").partitionBy("split").parquet(first["data"])
    assert not versions.verify(spark, root, 1) and versions.verify(spark, root)
    versions.publish(rows.limit(0), root, {"a": 3})
    assert versions.read_committed(spark, root, version=2).count() == 5 and versions.latest(spark, root)["rows"] == 0


def test_observed_report_is_a_side_result_of_the_write(spark):
    docs = table(spark, SF_SMALL, "documents").unionByName(spark.createDataFrame([(1, None, None, None, 0)], "doc_id long, text string, lang string, source string, n_chars long"))
    sources = [(r["lang"], r["source"]) for r in registry_from_table(docs).collect()]
    random.Random(1).shuffle(sources)
    kept, seen = quality.observed_filter(docs, [*sources, ("none", "none")])
    path = work_dir(spark, "observed-test")
    kept.write.parquet(path)
    got = sorted(map(str, quality.observed_report(spark, [*sources, ("none", "none")], seen).collect()))
    assert got == sorted(map(str, quality.filter_report(docs).collect()))
    assert spark.read.parquet(path).count() == quality.quality_filter(docs).count()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
    kept, seen = quality.observed_filter(docs, sources[1:])
    kept.write.format("noop").mode("overwrite").save()
    with pytest.raises(ValueError):
        quality.observed_report(spark, sources[1:], seen)
