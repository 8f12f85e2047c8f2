"""The Python data sources: the generator's rows as a table and as a stream, the registry as a table."""

import json

from pyspark.sql import functions as F

from tessera.sources.datasource import register_sources
from tessera.sources.synthetic import synthetic_corpus
from tessera.streaming.common import run_available_now, work_dir


def rows(df):
    return sorted(tuple(r) for r in df.select("doc_id", "text", "lang", "source").collect())


def test_synthetic_source_equals_the_generator(spark):
    register_sources(spark)
    for n, parts in ((0, 4), (1, 4), (9_000, 3)):
        df = spark.read.format("tessera_synthetic").option("rows", n).option("lang", "javanese").option("seed", 7).option("partitions", parts).load()
        assert rows(df) == rows(synthetic_corpus(spark, n, "javanese", 7))
        assert df.rdd.getNumPartitions() == max(1, min(n, parts))


def test_synthetic_stream_goes_on_at_its_offset(spark):
    register_sources(spark)
    base = work_dir(spark, "synthetic-test")
    seen = []
    for n in (40, 40, 100, 60):
        stream = spark.readStream.format("tessera_synthetic").option("rows", n).load()
        run_available_now(stream.writeStream.format("parquet").option("path", f"{base}/sink").option("checkpointLocation", f"{base}/checkpoint"), 60)
        seen.append(spark.read.parquet(f"{base}/sink").count())
    assert seen == [40, 40, 100, 100]
    assert rows(spark.read.parquet(f"{base}/sink")) == rows(synthetic_corpus(spark, 100))


def test_registry_source(spark):
    register_sources(spark)
    entries = [{"lang": "id", "source": "a", "path": "/x", "max_samples": 5}, {"lang": "en", "source": "b", "path": None, "fmt": None}, {"lang": "en", "source": "c", "path": "/y", "fmt": "odd"}]
    df = spark.read.format("tessera_registry").option("entries", json.dumps(entries)).load()
    assert {r.source: (r.source_rank, r.max_samples, r.readable) for r in df.collect()} == {"a": (0, 5, True), "b": (1, None, False), "c": (2, None, False)}
    assert spark.read.format("tessera_registry").load().agg(F.count("*")).first()[0] == 0
