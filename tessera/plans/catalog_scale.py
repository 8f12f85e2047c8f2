"""Registered queries of the scale mechanisms: split by selection, epoch permutations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import BATCH_SIZE, GRAD_ACCUM, SEED
from ..operators import permutation, profile, quality
from ..operators.ordinal import with_ordinal
from ..session import staged_parquet
from ..sources import versions
from ..sources.datasource import register_sources
from ..sources.registry import registry_from_table
from ..streaming import common as stream_common
from . import catalog
from . import oracle_sql as sql
from .catalog import register
from .prepare import split_documents

EPOCHS = 3


@register("select_split", f"""
WITH {sql.prepared_ctes()}
SELECT doc_id, lang, source, split, CAST(length(text) AS BIGINT) AS n_chars FROM prepared""")
def q_select_split(spark, d):
    # SPL1 by order statistics: the rows of three_way_split, and no text is shuffled
    return split_documents(catalog._docs(spark, d)).select("doc_id", "lang", "source", "split", F.length("text").cast("bigint").alias("n_chars"))


def _round_sql(value: str) -> str:
    """The round function over SQL text, one nested select a step."""
    q = f"SELECT *, ({value}) & {permutation.MASK} AS y0 FROM walk WHERE NOT done"
    for i, (factor, shift) in enumerate(permutation.MIX):
        q = f"SELECT *, xor((y{i} * {factor}) & {permutation.MASK}, ((y{i} * {factor}) & {permutation.MASK}) >> {shift}) AS y{i + 1} FROM ({q})"
    return q


def _permutation_sql() -> str:
    keys = "[" + ", ".join("[" + ", ".join(str(permutation.round_key(SEED, e, i)) for i in range(permutation.ROUNDS)) + "]" for e in range(EPOCHS)) + "]"
    last = len(permutation.MIX)
    rounds = permutation.ROUNDS
    return f"""WITH RECURSIVE {sql.prepared_ctes()},
rows AS (SELECT doc_id, row_number() OVER (ORDER BY shuffle_rank) - 1 AS idx FROM prepared WHERE split = 'train'),
size AS (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a, CAST(ceil(count(*) / ceil(sqrt(count(*)))) AS BIGINT) AS b FROM rows),
walk AS (
  SELECT doc_id, idx, epoch, {keys}[epoch + 1] AS k, n, a, b, idx // b AS l, idx % b AS r, 0 AS t, false AS done
  FROM rows, size, (SELECT unnest(range({EPOCHS})) AS epoch)
  UNION ALL
  SELECT doc_id, idx, epoch, k, n, a, b, l2, r2, (t + 1) % {rounds}, t + 1 = {rounds} AND l2 * b + r2 < n
  FROM (SELECT *, CASE WHEN t % 2 = 0 THEN (l + y{last}) % a ELSE l END AS l2, CASE WHEN t % 2 = 0 THEN r ELSE (r + y{last}) % b END AS r2
        FROM ({_round_sql("CASE WHEN t % 2 = 0 THEN r ELSE l END + k[t + 1]")}))
),
placed AS (SELECT doc_id, CAST(epoch AS INTEGER) AS epoch, l * b + r AS place, n FROM walk WHERE done),
steps AS (SELECT *, place // {BATCH_SIZE} AS batch_id, place % {BATCH_SIZE} AS pos, CAST(ceil(n / {BATCH_SIZE}) AS BIGINT) // {GRAD_ACCUM} AS upe FROM placed)
SELECT doc_id, epoch, batch_id, pos,
  CASE WHEN batch_id // {GRAD_ACCUM} < upe THEN CAST(epoch * upe + batch_id // {GRAD_ACCUM} + 1 AS BIGINT) END AS update_step
FROM steps"""


@register("epoch_batches", _permutation_sql())
def q_epoch_batches(spark, d):
    # BAT3 + BAT5: the train split in another order each epoch, by a keyed permutation of its row numbers
    train = catalog.prepared_documents(catalog._docs(spark, d)).where("split = 'train'").select("doc_id", "shuffle_rank")
    rows = with_ordinal(train, ["shuffle_rank"], out="idx").select("doc_id", "idx")
    n = rows.count()
    return permutation.epoch_batches(rows, n, EPOCHS).drop("idx")


RANK_ERROR = 0.02
QUANTILES = (0.25, 0.5, 0.9)


@register("length_sketches", sql.with_encoded() + f"""
, q AS (SELECT unnest([{', '.join(str(x) for x in QUANTILES)}])::DOUBLE AS quantile),
g AS (SELECT source, split, count(*) AS samples FROM encoded GROUP BY source, split)
SELECT g.source, g.split, g.samples, q.quantile, true AS within FROM g, q
UNION ALL SELECT 'ALL', split, CAST(sum(samples) AS BIGINT), quantile, true FROM g, q GROUP BY split, quantile""")
def q_length_sketches(spark, d):
    # AGG1 at scale: sketches a source and split are stored, rolled up to splits, and their quantiles held against exact ranks
    lengths = staged_parquet(catalog._unranked(spark, d).encoded.select("source", "split", "n_tokens"), "lengths")  # read five times
    stored = staged_parquet(profile.length_sketches(lengths), "sketches")
    parts = []
    for by in (["source", "split"], ["split"]):
        sketches = stored if len(by) == 2 else profile.merged_sketches(stored, by)
        found = staged_parquet(profile.sketch_quantiles(sketches, QUANTILES), "quantiles")
        errors = profile.rank_errors(lengths, found, by)
        source = F.col("source") if len(by) == 2 else F.lit("ALL")
        parts.append(errors.join(found, [*by, "quantile"]).select(
            source.alias("source"), "split", "samples", "quantile", (F.col("rank_error") <= RANK_ERROR).alias("within")))
    return parts[0].unionByName(parts[1])


@register("observed_filter_report", catalog.oracle()["filter_report"])
def q_observed_filter_report(spark, d):
    # FLT6 as a side result of the pass that writes the rows kept
    docs = catalog._docs(spark, d)
    sources = [(r["lang"], r["source"]) for r in registry_from_table(docs).collect()]  # one row a source
    kept, seen = quality.observed_filter(docs, sources)
    kept.write.parquet(stream_common.work_dir(spark, "observed"))
    return quality.observed_report(spark, sources, seen)


@register("committed_round_trip", f"""
WITH {sql.prepared_ctes()}
SELECT split, count(*) AS rows, CAST(sum(length(text)) AS BIGINT) AS n_chars, CAST(2 AS BIGINT) AS version, true AS verified FROM prepared GROUP BY split""")
def q_committed_round_trip(spark, d):
    # SNK1 + SNK3 with a manifest: a version, the same step skipped, changed parameters written anew, a write that never committed
    root = stream_common.work_dir(spark, "versions")
    docs = split_documents(catalog._docs(spark, d))
    names = ["train", "validation", "test"]
    versions.publish_if_changed(docs.where("split <> 'train'"), root, {"step": "prepare", "splits": names[1:]}, names)
    for _ in range(2):
        versions.publish_if_changed(docs, root, {"step": "prepare", "splits": names}, names)
    docs.limit(1).write.partitionBy("split").parquet(f"{root}/data/999999-abandoned")
    rows = versions.read_committed(spark, root).groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("text")).cast("bigint").alias("n_chars"))
    return rows.select("split", "rows", "n_chars", F.lit(versions.latest(spark, root)["version"]).cast("bigint").alias("version"),
                       F.lit(versions.verify(spark, root)).alias("verified"))


_SOURCE_SQL = catalog._synthetic_sql().replace("FROM documents", "FROM (SELECT unnest(range((SELECT count(*) FROM documents))) AS doc_id, 'indonesian' AS lang)")


@register("synthetic_source", _SOURCE_SQL)
def q_synthetic_source(spark, d):
    # SRC4 as a data source: as many rows as there are documents
    register_sources(spark)
    return spark.read.format("tessera_synthetic").option("rows", catalog._docs(spark, d).count()).load()


@register("synthetic_stream", _SOURCE_SQL)
def q_synthetic_stream(spark, d):
    # the same as a stream, in two runs from one checkpoint: the second goes on at the first one's offset
    register_sources(spark)
    base, n = stream_common.work_dir(spark, "synthetic"), catalog._docs(spark, d).count()
    for rows in (n // 3, n):
        stream = spark.readStream.format("tessera_synthetic").option("rows", rows).load()
        stream_common.run_available_now(stream.writeStream.format("parquet").option("path", f"{base}/sink").option("checkpointLocation", f"{base}/checkpoint"))
    return spark.read.parquet(f"{base}/sink")
