"""Registered queries of the guards and fallbacks: skipped prompts, missing inputs, empty corpora, benchmark loading."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluation, packing
from ..sources import registry as reg
from ..sources.tables import MissingDatasetError, read_splits, table
from ..streaming import common as stream_common
from . import catalog, derived
from . import oracle_sql as sql
from .catalog import register
from .prepare import corpus_or_synthetic


# EV2: two of three items hold a question with choices or a text; the rest are skipped.
@register("eval_prompts", f"""
WITH {catalog._MCQ_ITEMS},
p AS (SELECT i.item_id, CASE WHEN i.item_id % 3 = 0 THEN {catalog._MCQ_PROMPT} WHEN i.item_id % 3 = 1 THEN question END AS prompt FROM items i)
SELECT item_id, prompt FROM p WHERE prompt IS NOT NULL""")
def q_eval_prompts(spark, d):
    items = derived.mcq_items(table(spark, d, "benchmark"))
    kind = F.col("item_id") % 3
    items = items.select("item_id", F.when(kind == 0, F.col("question")).alias("question"), F.when(kind != 2, F.col("choices")).alias("choices"),
                         F.when(kind == 1, F.col("question")).alias("text"))
    return items.select("item_id", evaluation.prompt(items).alias("prompt")).where(F.col("prompt").isNotNull())


_NUMBERED = "(SELECT unnest(range((SELECT count(*) FROM documents))) AS doc_id, 'indonesian' AS lang)"


@register("empty_corpus_fallback", catalog._synthetic_sql().replace("FROM documents", f"FROM {_NUMBERED}").replace("AS source", "AS source, 0 AS source_rank"))
def q_empty_corpus_fallback(spark, d):
    # SET3: no document is of this language, so the synthetic rows stand in
    docs = table(spark, d, "documents")
    nothing = docs.where("lang = 'no such language'").select("doc_id", "text", "lang", "source")
    return corpus_or_synthetic(nothing, docs.count())


@register("failed_source_replaced", f"""
WITH syn AS ({catalog._synthetic_sql().replace("FROM documents", f"FROM {_NUMBERED}")})
SELECT 'en' AS lang, 'given' AS source, 0 AS source_rank, count(*) AS n_docs, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS n_chars FROM documents
UNION ALL SELECT lang, source, 1, count(*), CAST(sum(length(text)) AS BIGINT) FROM syn GROUP BY lang, source""")
def q_failed_source_replaced(spark, d):
    # SRC3: the second source's path is missing and is replaced by as many synthetic rows; the third has no reader and is skipped
    path, n = f"{d.rstrip('/')}/documents.parquet", table(spark, d, "documents").count()
    sources = [reg.CorpusSource("en", "given", path, 0, "parquet"), reg.CorpusSource("indonesian", "gone", f"{path}-gone", 1, "parquet"),
               reg.CorpusSource("en", "odd", path, 2, "unreadable")]
    union = reg.load_sources(spark, sources, replace_failed=True, replacement_rows=n)
    return union.groupBy("lang", "source", "source_rank").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.length("text")).cast("bigint").alias("n_chars"))


@register("missing_input", """
SELECT 'present' AS input, split, count(*) AS rows, NULL AS error FROM (SELECT CASE WHEN doc_id % 2 = 0 THEN 'a' ELSE 'b' END AS split FROM documents) GROUP BY split
UNION ALL SELECT 'absent', NULL, NULL, 'MissingDatasetError'""")
def q_missing_input(spark, d):
    # SRC7: a data set that is there is read, one that is not gives the typed error
    path = stream_common.work_dir(spark, "guard")
    split = F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b")
    table(spark, d, "documents").select("doc_id", split.alias("split")).write.partitionBy("split").parquet(path)
    parts = []
    for name, at in (("present", path), ("absent", f"{path}-absent")):
        try:
            rows = read_splits(spark, at).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))
            parts.append(rows.select(F.lit(name).alias("input"), "split", "rows", F.lit(None).cast("string").alias("error")))
        except MissingDatasetError as e:
            parts.append(spark.createDataFrame([(name, None, None, type(e).__name__)], "input string, split string, rows long, error string"))
    return parts[0].unionByName(parts[1])


@register("no_pack", sql.with_encoded() + "SELECT split, doc_id, input_ids, n_tokens FROM encoded")
def q_no_pack(spark, d):
    # PCK4: one row a document
    return packing.no_pack(catalog._unranked(spark, d).encoded).select("split", "doc_id", "input_ids", "n_tokens")


@register("benchmark_scan", """
SELECT 'indommlu' AS benchmark, 'test' AS split, count(*) FILTER (WHERE item_id % 2 = 0) AS items, NULL AS error FROM benchmark
UNION ALL SELECT 'nusax', 'test', count(*), NULL FROM benchmark
UNION ALL SELECT 'indo4b', 'test', NULL, 'dataset not available: indonlp/indo4b'
UNION ALL SELECT 'indonlg', 'test', NULL, 'split not available: test'""")
def q_benchmark_scan(spark, d):
    # SRC9: items read by registry name and split; a missing data set or split is that benchmark's error, not the run's
    root = stream_common.work_dir(spark, "benchmarks")
    items = table(spark, d, "benchmark")
    side = F.when(F.col("item_id") % 2 == 0, "test").otherwise("validation")
    items.withColumn("split", side).write.partitionBy("split").parquet(f"{root}/indonlp/indommlu")
    items.withColumn("split", F.lit("test")).write.partitionBy("split").parquet(f"{root}/indonlp/nusax")
    items.withColumn("split", F.lit("train")).write.partitionBy("split").parquet(f"{root}/indonlp/indonlg")
    found, errors = evaluation.load_benchmarks(spark, ["indommlu", "nusax", "indo4b", "indonlg", "unknown"], root)
    out = spark.createDataFrame([(name, "test", None, message) for name, message in errors.items()], "benchmark string, split string, items long, error string")
    for name, df in found.items():
        out = out.unionByName(df.agg(F.count(F.lit(1)).alias("items")).select(
            F.lit(name).alias("benchmark"), F.lit("test").alias("split"), "items", F.lit(None).cast("string").alias("error")))
    return out
