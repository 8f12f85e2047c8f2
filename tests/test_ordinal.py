"""ORD1/SHF1/SPL1/LIM1: exact sizes, permutation, partition-count invariance, no global window."""

from pyspark.sql import functions as F

from tessera.operators import ordinal


def test_split_sizes_table():
    # FIXTURES 3.4
    assert ordinal.split_sizes(1) == (0, 0, 1)
    assert ordinal.split_sizes(100) == (99, 0, 1)
    assert ordinal.split_sizes(101) == (99, 1, 1)
    assert ordinal.split_sizes(1000) == (990, 5, 5)
    assert ordinal.split_sizes(10050) == (9949, 50, 51)
    assert ordinal.split_sizes(700) == (693, 3, 4)  # integer arithmetic, no 7.000000000000001


def test_ordinal_is_total_order(spark):
    df = spark.range(2000).select((F.col("id") * 7919 % 2003).alias("k"), F.col("id"))
    got = ordinal.with_ordinal(df, ["k", "id"], num_partitions=5).select("k", "id", "ord").collect()
    want = sorted((r.k, r.id) for r in got)
    pos = {kv: i for i, kv in enumerate(want)}
    assert all(pos[(r.k, r.id)] == r.ord for r in got)


def test_grouped_ordinal_with_hot_group(spark):
    # one group holds most rows: its positions are still dense 0..n-1 in order
    df = spark.range(3000).select(F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.lit("cold")).alias("g"),
                                  F.col("id"))
    got = ordinal.with_ordinal(df, ["id"], ["g"], out="o", total="n", num_partitions=6).collect()
    for g in ("hot", "cold"):
        rows = sorted((r.id, r.o, r.n) for r in got if r.g == g)
        assert [o for _, o, _ in rows] == list(range(len(rows)))
        assert all(n == len(rows) for _, _, n in rows)


def test_shuffle_invariant_to_partitioning(spark):
    df = spark.range(500).withColumnRenamed("id", "doc_id")
    a = {r.doc_id: r.shuffle_rank for r in ordinal.seeded_shuffle(df.repartition(3)).collect()}
    b = {r.doc_id: r.shuffle_rank for r in ordinal.seeded_shuffle(df.repartition(11)).collect()}
    assert a == b and sorted(a.values()) == list(range(500))


def test_three_way_split_exact(spark):
    df = spark.range(1000).withColumnRenamed("id", "doc_id")
    rows = ordinal.three_way_split(df).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in rows} == {"train": 990, "validation": 5, "test": 5}


def test_head_per_group(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    got = ordinal.head_per_group(df, ["g"], ["id"], 4).collect()
    assert sorted((r.g, r.id) for r in got) == sorted((g, i) for g in range(3) for i in range(g, 100, 3)[:4])


def test_no_unpartitioned_window_in_plan(spark):
    """The only single-partition step runs over per-partition counts (at most n rows), never over rows."""
    df = spark.range(100).withColumnRenamed("id", "doc_id")
    lines = ordinal.three_way_split(df)._jdf.queryExecution().executedPlan().toString().splitlines()
    for i, ln in enumerate(lines):
        if "Exchange SinglePartition" in ln:
            assert "HashAggregate(keys=[_pid" in lines[i + 1]
    assert not any("row_number" in ln for ln in lines)
