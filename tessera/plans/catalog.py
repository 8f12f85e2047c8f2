"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus the SQL check of each.

Every query reads the given tables (or data Spark derives from them) in full.
Column names and types are aligned with the SQL text in ``oracle()``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_IDS, MAX_LENGTH, QualityParams
from ..functions.time import instant_to_ntz, ntz_to_instant
from ..config import MCQ_CHOICES_HEADER, MCQ_FOOTER, MCQ_HEADER, MCQ_NEW_TOKENS, PLAN_QUALITY, SERVED_MODEL
from ..operators import batches, dedup, encoding, evaluation, ordinal, packing, profile, prompts, quality, runlog
from ..sources import registry as reg
from ..sources.synthetic import synthetic_rows
from ..session import reliable_checkpoint
from ..sources import sinks
from ..sources.tables import read_splits, read_stats, read_text_lines, spread, table
from ..streaming import common as stream_common
from ..streaming import completions as stream_completions
from ..streaming import intake as stream_intake
from ..streaming import runlog as stream_runlog
from . import derived
from . import oracle_sql as sql
from .prepare import PrepareParams, prepare, prepared_documents, ranked_documents, split_documents

QueryFn = Callable[[SparkSession, str], DataFrame]
DEFAULT_Q = QualityParams()
CAP_QUERY = 100          # per-language cap used by the lang_cap query
TRUNCATE_QUERY = 256     # max_length used by the encode_truncate query

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if oracle is not None:
            _SQL[name] = oracle
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle() -> dict[str, str]:
    return dict(_SQL)


def _docs(spark, d):
    return spread(table(spark, d, "documents"))


# ---------------------------------------------------------------- quality --
@register("quality_measures", f"""
SELECT doc_id, lang, source, CAST({sql.length_sql('text')} AS BIGINT) AS n_chars,
  CASE WHEN {sql.length_sql('text')} BETWEEN 50 AND 32768 THEN round({sql.rep_sql('text')}, 6) END AS repetition_ratio,
  CASE WHEN {sql.length_sql('text')} BETWEEN 50 AND 32768 THEN round({sql.printable_sql('text')}, 6) END AS printable_ratio,
  {sql.reason_sql('text')} AS quality_reason
FROM documents""")
def q_quality_measures(spark, d):
    return quality.quality_measures(_docs(spark, d))


@register("quality_reason_counts", f"""
SELECT coalesce({sql.reason_sql('text')}, 'kept') AS quality_reason, count(*) AS n_docs
FROM documents GROUP BY 1""")
def q_quality_reason_counts(spark, d):
    return quality.reason_counts(_docs(spark, d))


@register("quality_filter", f"""
SELECT doc_id, lang, source, CAST({sql.length_sql('text')} AS BIGINT) AS n_chars
FROM documents WHERE ({sql.reason_sql('text')}) IS NULL""")
def q_quality_filter(spark, d):
    kept = quality.quality_filter(_docs(spark, d))
    return kept.select("doc_id", "lang", "source", F.length("text").cast("bigint").alias("n_chars"))


@register("filter_report", f"""
SELECT lang, source, count(*) AS n_docs, CAST(count(*) FILTER (WHERE ({sql.reason_sql('text')}) IS NULL) AS BIGINT) AS n_kept
FROM documents GROUP BY lang, source""")
def q_filter_report(spark, d):
    return quality.filter_report(_docs(spark, d))


@register("text_fallback", """
SELECT doc_id,
  CAST(length(coalesce(CASE WHEN doc_id % 7 = 0 THEN NULL ELSE text END,
                       CASE WHEN doc_id % 7 = 0 THEN text END, '')) AS BIGINT) AS n_chars,
  doc_id % 7 = 0 AS from_content
FROM documents""")
def q_text_fallback(spark, d):
    # Derived input (same recipe in both engines): every 7th row has its text in ``content``.
    docs = _docs(spark, d)
    moved = docs.select(
        "doc_id",
        F.when(F.col("doc_id") % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("doc_id") % 7 == 0, F.col("text")).alias("content"),
    )
    out = quality.text_fallback(moved, out="resolved")
    return out.select("doc_id", F.length("resolved").cast("bigint").alias("n_chars"),
                      F.col("text").isNull().alias("from_content"))


# ------------------------------------------------------------------ dedup --
@register("dedup_prefix", f"""
WITH {sql.ranked_cte()},
w AS (SELECT lang, min(ord) AS ord FROM ranked GROUP BY lang, {sql.key_sql('text', 1000)})
SELECT r.doc_id, r.lang, r.source FROM ranked r JOIN w ON r.ord = w.ord""")
def q_dedup_prefix(spark, d):
    return dedup.dedup_prefix(ranked_documents(_docs(spark, d))).select("doc_id", "lang", "source")


@register("dedup_exact", f"""
WITH {sql.ranked_cte()},
w AS (SELECT lang, min(ord) AS ord FROM ranked GROUP BY lang, {sql.key_sql('text', None)})
SELECT r.doc_id, r.lang, r.source FROM ranked r JOIN w ON r.ord = w.ord""")
def q_dedup_exact(spark, d):
    return dedup.dedup_exact(ranked_documents(_docs(spark, d))).select("doc_id", "lang", "source")


@register("dedup_report", f"""
SELECT lang, CAST(sum(n) AS BIGINT) AS n_before, count(*) AS n_after, CAST(sum(n) - count(*) AS BIGINT) AS n_removed
FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang, {sql.key_sql('text', None)}) GROUP BY lang""")
def q_dedup_report(spark, d):
    return dedup.dedup_report(_docs(spark, d))


# ------------------------------------------------------ order / cap / split --
@register("lang_cap", f"""
WITH {sql.ranked_cte()},
w AS (SELECT lang, min(ord) AS ord FROM ranked GROUP BY lang, {sql.key_sql('text', 1000)}),
c AS (SELECT lang, ord, row_number() OVER (PARTITION BY lang ORDER BY ord) - 1 AS lang_rank FROM w)
SELECT r.doc_id, r.lang, r.source, c.lang_rank FROM c JOIN ranked r ON r.ord = c.ord WHERE c.lang_rank < {CAP_QUERY}""")
def q_lang_cap(spark, d):
    deduped = dedup.dedup_prefix(ranked_documents(_docs(spark, d)))
    capped = ordinal.head_per_group(deduped.select("doc_id", "lang", "source", "ord"), ["lang"], ["ord"],
                                    CAP_QUERY, out="lang_rank")
    return capped.select("doc_id", "lang", "source", "lang_rank")


@register("seeded_shuffle_rank", """
SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS shuffle_rank
FROM documents""")
def q_seeded_shuffle_rank(spark, d):
    return ordinal.seeded_shuffle(_docs(spark, d).select("doc_id"))


@register("three_way_split", f"""
WITH {sql.prepared_ctes()}
SELECT doc_id, lang, split, shuffle_rank FROM prepared""")
def q_three_way_split(spark, d):
    return prepared_documents(_docs(spark, d)).select("doc_id", "lang", "split", "shuffle_rank")


def _union_sql() -> str:
    """Documents with ids that repeat in every language and a null source on every fifth row."""
    return """docs_u AS (
  SELECT CAST(row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS BIGINT) AS doc_id, text, lang,
         CASE WHEN doc_id % 5 = 0 THEN NULL ELSE source END AS source FROM documents
),
"""


@register("prepare_union", "WITH " + _union_sql() + sql.prepared_ctes(docs="docs_u") + """
SELECT doc_id, lang, source, split, shuffle_rank FROM prepared""")
def q_prepare_union(spark, d):
    docs = _docs(spark, d).withColumnRenamed("doc_id", "_id")
    numbered = ordinal.with_ordinal(docs.select("_id", "lang"), ["_id"], ["lang"], out="doc_id")
    docs = docs.join(numbered.select("_id", "doc_id"), "_id").select(
        "doc_id", "text", "lang", F.when(F.col("_id") % 5 == 0, F.lit(None)).otherwise(F.col("source")).alias("source"))
    return prepared_documents(docs).select("doc_id", "lang", "source", "split", "shuffle_rank")


@register("pack_concat_report", sql.with_encoded() + f"""
SELECT split, CAST(ceil(sum(n_tokens + 1) / {MAX_LENGTH}) AS BIGINT) AS sequences, CAST(sum(n_tokens + 1) AS BIGINT) AS tokens_in,
       CAST(sum(n_tokens + 1) AS BIGINT) AS tokens_kept, CAST(0 AS BIGINT) AS tokens_lost,
       CAST(ceil(sum(n_tokens + 1) / {MAX_LENGTH}) * {MAX_LENGTH} - sum(n_tokens + 1) AS BIGINT) AS pad_tokens
FROM encoded GROUP BY split""")
def q_pack_concat_report(spark, d):
    return packing.concat_report(_unranked(spark, d).encoded)


def _work(spark) -> str:
    return stream_common.work_dir(spark, "round-trip")


@register("split_round_trip", f"""
WITH {sql.prepared_ctes()}
SELECT doc_id, lang, split, CAST(length(text) AS BIGINT) AS n_chars FROM prepared WHERE split <> 'train'""")
def q_split_round_trip(spark, d):
    # SNK1 + SNK3 + SRC6: written once, not again, and read back pruned to two splits
    path = _work(spark)
    prepared = prepared_documents(_docs(spark, d))
    sinks.write_if_absent(prepared, path)
    sinks.write_if_absent(prepared.limit(0), path)
    return read_splits(spark, path, ["validation", "test"]).select("doc_id", "lang", "split", F.length("text").cast("bigint").alias("n_chars"))


@register("stats_round_trip", "SELECT lang, count(*) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM documents GROUP BY lang")
def q_stats_round_trip(spark, d):
    # SNK2 + SRC10
    path = _work(spark)
    sinks.write_stats(table(spark, d, "documents").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.length("text")).cast("bigint").alias("n_chars")), path)
    return read_stats(spark, path)


@register("text_lines", """
SELECT trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS text, count(*) AS n
FROM (SELECT unnest(string_split(text, chr(10))) AS l FROM conversations)
WHERE trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '' GROUP BY 1""")
def q_text_lines(spark, d):
    # SRC8: conversations written as text files, their lines read back
    path = _work(spark)
    table(spark, d, "conversations").select("text").write.text(path)
    return read_text_lines(spark, path).groupBy("text").agg(F.count(F.lit(1)).alias("n"))


@register("split_counts", f"""
WITH {sql.prepared_ctes()}
SELECT split, count(*) AS samples FROM prepared GROUP BY split""")
def q_split_counts(spark, d):
    return profile.split_counts(split_documents(_docs(spark, d)))


# --------------------------------------------------------------- encoding --
@register("vocab", f"""
WITH {sql.prepared_ctes()},
{sql.vocab_ctes()}
SELECT word, n, token_id FROM vocab""")
def q_vocab(spark, d):
    return encoding.build_vocab(split_documents(_docs(spark, d)))


@register("encode_truncate", sql.with_encoded(TRUNCATE_QUERY) +
          "SELECT doc_id, split, input_ids, n_tokens FROM encoded")
def q_encode_truncate(spark, d):
    prep = prepare(_docs(spark, d), PrepareParams(max_length=TRUNCATE_QUERY, ranked=False))
    return prep.encoded.select("doc_id", "split", "input_ids", "n_tokens")


_PROFILE_SQL = """
SELECT coalesce(split, 'ALL') AS split, count(*) AS samples, CAST(sum(n_tokens) AS BIGINT) AS total_tokens,
  round(avg(n_tokens), 6) AS mean_length, round(median(n_tokens), 6) AS median_length,
  min(n_tokens) AS min_length, max(n_tokens) AS max_length, round(stddev_pop(n_tokens), 6) AS std_length
FROM encoded GROUP BY ROLLUP (split)"""


@register("length_profile", sql.with_encoded() + _PROFILE_SQL)
def q_length_profile(spark, d):
    return profile.length_profile_with_totals(_unranked(spark, d).encoded)


@register("corpus_totals", sql.with_encoded() + """
SELECT count(*) AS total_samples, CAST(sum(n_tokens) AS BIGINT) AS total_tokens,
  round(sum(n_tokens) * 4 / 1e9, 2) AS estimated_training_data_gb,
  round(sum(n_tokens) * 2 / 1e9, 2) AS tokens_x2_billion
FROM encoded""")
def q_corpus_totals(spark, d):
    return profile.corpus_totals(_unranked(spark, d).encoded)


@register("prepare_stats", sql.with_encoded() + f"""
SELECT CAST(sum(n_tokens) AS BIGINT) AS total_tokens, count(*) AS total_rows,
  count(*) FILTER (WHERE split = 'train') AS train_samples,
  count(*) FILTER (WHERE split = 'validation') AS val_samples,
  count(*) FILTER (WHERE split = 'test') AS test_samples,
  (SELECT count(*) FROM vocab) + {DEFAULT_IDS.count} AS vocab_size,
  CAST(NULL AS BIGINT) AS max_length
FROM encoded""")
def q_prepare_stats(spark, d):
    prep = _unranked(spark, d)
    return profile.prepare_stats(prep.encoded, prep.vocab_size, prep.max_length)


# ---------------------------------------------------------------- sources --
@register("union_sources", f"""
WITH {sql.ranked_cte()}
SELECT lang, source, source_rank, count(*) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS n_chars
FROM ranked GROUP BY lang, source, source_rank""")
def q_union_sources(spark, d):
    path = f"{d.rstrip('/')}/documents.parquet"
    registry_rows = reg.registry_from_table(_docs(spark, d)).collect()  # one row per source
    union = reg.load_sources(spark, reg.sources_from_registry(registry_rows, path))
    return union.groupBy("lang", "source", "source_rank").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_docs"),
        F.sum(F.length("text")).cast("bigint").alias("n_chars"))


def _synthetic_sql() -> str:
    from ..sources.synthetic import SLOTS, TEMPLATES

    def pick(values, slot):
        arr = "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"
        key = f"'42:' || CAST(doc_id AS VARCHAR) || ':{slot}'"
        return f"{arr}[CAST(('0x' || substr(md5({key}), 1, 8))::BIGINT % {len(values)} AS INTEGER) + 1]"

    text = pick(TEMPLATES, "template")
    for slot, values in SLOTS:
        text = f"replace({text}, '{{{slot}}}', {pick(values, slot)})"
    return f"SELECT doc_id, {text} AS text, lang, 'synthetic' AS source FROM documents"


@register("synthetic_corpus", _synthetic_sql())
def q_synthetic_corpus(spark, d):
    # SRC3/SRC4: a synthetic replacement row for every source row.
    docs = _docs(spark, d)
    return synthetic_rows(docs.select("doc_id", "lang"), F.col("lang"))



# ---------------------------------------------------------------- packing --
def _prepared(spark, d, **kw):
    return prepare(_docs(spark, d), PrepareParams(**kw))


def _unranked(spark, d):
    """Prepared and encoded without ranks: the split is a comparison, no text is shuffled."""
    return prepare(_docs(spark, d), PrepareParams(ranked=False))


def _apart(spark, d):
    """Prepared and encoded with the ranks in their own narrow table, by ``ord``: no text is shuffled."""
    return prepare(_docs(spark, d), PrepareParams(ranked=False, ranks_apart=True))


def _ranked_lengths(prep, encoded):
    """(split, shuffle_rank, seg_no, n): segment lengths meet their rank after the ids are gone."""
    lengths = packing.segment_lengths(encoded, ("split", "ord"))
    return reliable_checkpoint(lengths.join(prep.ranks, "ord").select("split", "shuffle_rank", "seg_no", "n"))


def _plan(spark, d):
    """The packing plan from segment lengths alone."""
    prep = _apart(spark, d)
    return packing.greedy_plan(_ranked_lengths(prep, prep.encoded), MAX_LENGTH)


def _greedy(spark, d):
    """Segments by ``ord``; the plan has both ``shuffle_rank``, whose order it keeps, and ``ord``."""
    prep = _apart(spark, d)
    segs = packing.materialized_segments(prep.encoded, ("split", "ord"), eos=DEFAULT_IDS.eos)
    lengths = segs.select("split", "ord", "seg_no", "n").join(prep.ranks, "ord")
    plan = packing.greedy_plan(lengths, MAX_LENGTH, ("shuffle_rank", "ord"))
    return prep, segs, plan


def _chunks(spark, d):
    _, segs, plan = _greedy(spark, d)
    return packing.greedy_chunks(segs, plan, MAX_LENGTH, order=("ord",))


_WALK = sql.with_encoded(recursive=True) + ",\n" + sql.greedy_walk_ctes() + "\n"


@register("pack_plan", _WALK + """
SELECT split, shuffle_rank, CAST(0 AS BIGINT) AS seg_no, n, chunk_id, start, take, n - take AS lost FROM walk""")
def q_pack_plan(spark, d):
    return _plan(spark, d)


EOS_EVERY = 97


@register("pack_interior_eos", sql.with_encoded(recursive=True) + f""",
segs AS (
  SELECT split, shuffle_rank, seg_no, CASE WHEN seg_no < n_tokens // {EOS_EVERY} THEN {EOS_EVERY} ELSE n_tokens % {EOS_EVERY} + 1 END AS n,
         row_number() OVER (PARTITION BY split ORDER BY shuffle_rank, seg_no) AS rn
  FROM (SELECT split, shuffle_rank, n_tokens, unnest(range(n_tokens // {EOS_EVERY} + 1)) AS seg_no FROM encoded)
),
walk AS (
  SELECT split, rn, CAST(0 AS BIGINT) AS start, CAST(0 AS BIGINT) AS chunk_id, CAST(n AS BIGINT) AS cur FROM segs WHERE rn = 1
  UNION ALL
  SELECT s.split, s.rn, CASE WHEN w.cur >= {MAX_LENGTH} THEN 0 ELSE w.cur END,
         w.chunk_id + CASE WHEN w.cur >= {MAX_LENGTH} THEN 1 ELSE 0 END,
         CASE WHEN w.cur >= {MAX_LENGTH} THEN 0 ELSE w.cur END + s.n
  FROM walk w JOIN segs s ON s.split = w.split AND s.rn = w.rn + 1
)
SELECT s.split, s.shuffle_rank, s.seg_no, CAST(s.n AS BIGINT) AS n, w.chunk_id, w.start,
       CAST(least(s.n, {MAX_LENGTH} - w.start) AS BIGINT) AS take, CAST(s.n - least(s.n, {MAX_LENGTH} - w.start) AS BIGINT) AS lost
FROM walk w JOIN segs s ON s.split = w.split AND s.rn = w.rn""")
def q_pack_interior_eos(spark, d):
    # derived input: every 97th token of a document is an end id, which closes a segment inside it
    marked = F.transform("input_ids", lambda x, i: F.when(i % EOS_EVERY == EOS_EVERY - 1, F.lit(DEFAULT_IDS.eos)).otherwise(x))
    prep = _apart(spark, d)
    return packing.greedy_plan(_ranked_lengths(prep, prep.encoded.select("split", "ord", marked.alias("input_ids"))), MAX_LENGTH)


@register("pack_greedy", _WALK + "SELECT split, chunk_id, input_ids FROM chunks")
def q_pack_greedy(spark, d):
    return _chunks(spark, d)


@register("pack_report", _WALK + f"""
SELECT split, max(chunk_id) + 1 AS sequences, CAST(sum(n) AS BIGINT) AS tokens_in,
  CAST(sum(take) AS BIGINT) AS tokens_kept, CAST(sum(n - take) AS BIGINT) AS tokens_lost,
  CAST((max(chunk_id) + 1) * {MAX_LENGTH} - sum(take) AS BIGINT) AS pad_tokens,
  CAST({MAX_LENGTH} AS DOUBLE) AS mean_length
FROM walk GROUP BY split""")
def q_pack_report(spark, d):
    return packing.pack_report(_plan(spark, d), MAX_LENGTH)


@register("pack_concat", sql.with_encoded() + f"""
, docs AS (SELECT split, shuffle_rank, list_concat(input_ids, [{DEFAULT_IDS.eos}]) AS ids, n_tokens + 1 AS n FROM encoded),
offs AS (SELECT *, CAST(coalesce(sum(n) OVER (PARTITION BY split ORDER BY shuffle_rank
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off FROM docs),
ex AS (SELECT split, off, n, ids, unnest(range(off // {MAX_LENGTH}, (off + n - 1) // {MAX_LENGTH} + 1)) AS k FROM offs),
pieces AS (SELECT split, k AS chunk_id, greatest(off - k * {MAX_LENGTH}, 0) AS pos,
                  ids[greatest(k * {MAX_LENGTH} - off, 0) + 1 : least((k + 1) * {MAX_LENGTH} - off, n)] AS piece FROM ex)
SELECT split, chunk_id, CAST(list_resize(flatten(list(piece ORDER BY pos)), {MAX_LENGTH}, {DEFAULT_IDS.pad_id}) AS INTEGER[]) AS input_ids
FROM pieces GROUP BY split, chunk_id""")
def q_pack_concat(spark, d):
    prep = _apart(spark, d)
    lengths = prep.encoded.select("split", "ord", (F.col("n_tokens") + 1).alias("n")).join(prep.ranks, "ord")
    return packing.pack_concat(prep.encoded, MAX_LENGTH, lengths=lengths)


# ---------------------------------------------------------------- batches --
@register("label_mask", _WALK + f"""
SELECT split, chunk_id, list_transform(input_ids, lambda x: CASE WHEN x = {DEFAULT_IDS.pad_id} THEN -100 ELSE x END) AS labels
FROM chunks""")
def q_label_mask(spark, d):
    chunks = _chunks(spark, d)
    return chunks.select("split", "chunk_id", batches.labels(F.col("input_ids"), DEFAULT_IDS.pad_id).alias("labels"))


@register("attention_mask", _WALK + f"""
SELECT split, chunk_id, list_transform(input_ids, lambda x: CAST(x <> {DEFAULT_IDS.pad_id} AS INTEGER)) AS attention_mask
FROM chunks""")
def q_attention_mask(spark, d):
    chunks = _chunks(spark, d)
    return chunks.select("split", "chunk_id",
                         batches.attention_mask(F.col("input_ids"), DEFAULT_IDS.pad_id).alias("attention_mask"))


def _batch_sql(id_col: str, source: str, bs: int = 2) -> str:
    return f"""
SELECT *, idx // {bs} AS batch_id, idx % {bs} AS pos FROM (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY
      CASE WHEN split = 'train' THEN md5('42:' || CAST({id_col} AS VARCHAR))
           ELSE lpad(CAST({id_col} AS VARCHAR), 20, '0') END, {id_col}) - 1 AS idx
  FROM {source})"""


@register("batch_assign", _WALK + f"""
SELECT split, chunk_id, batch_id, pos FROM ({_batch_sql('chunk_id', 'chunks')})""")
def q_batch_assign(spark, d):
    chunk_ids = _plan(spark, d).select("split", "chunk_id").distinct()
    return batches.assign_batches(chunk_ids, "chunk_id").select("split", "chunk_id", "batch_id", "pos")


@register("ragged_batches", sql.with_encoded() + f"""
SELECT split, batch_id, count(*) AS rows, min(n_tokens) AS min_len, max(n_tokens) AS max_len
FROM ({_batch_sql('doc_id', 'encoded')}) GROUP BY split, batch_id HAVING min(n_tokens) <> max(n_tokens)""")
def q_ragged_batches(spark, d):
    enc = _unranked(spark, d).encoded.select("split", "doc_id", "n_tokens")
    return batches.ragged_batches(batches.assign_batches(enc, "doc_id"))


STEP_EPOCHS = 2


@register("step_plan", sql.with_encoded() + f"""
, b AS (SELECT DISTINCT batch_id FROM ({_batch_sql('doc_id', 'encoded')}) WHERE split = 'train'),
s AS (SELECT (max(batch_id) + 1) // 16 AS upe FROM b),
r AS (SELECT batch_id, batch_id // 16 AS u, (SELECT upe FROM s) AS upe, unnest(range({STEP_EPOCHS})) AS epoch FROM b)
SELECT CAST(epoch AS INTEGER) AS epoch, batch_id, CAST(epoch * upe + u + 1 AS BIGINT) AS update_step FROM r
WHERE u < upe AND epoch * upe + u + 1 <= upe * {STEP_EPOCHS}""")
def q_step_plan(spark, d):
    enc = _unranked(spark, d).encoded.select("split", "doc_id", "n_tokens")
    return batches.step_plan(batches.assign_batches(enc, "doc_id"), epochs=STEP_EPOCHS)


@register("length_grouped_batches", sql.with_encoded() + """
, sh AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS s
         FROM encoded),
g AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY s // 100, n_tokens DESC, s) - 1 AS idx FROM sh)
SELECT split, idx // 2 AS batch_id, count(*) AS rows, max(n_tokens) AS max_len,
       CAST(max(n_tokens) * count(*) - sum(n_tokens) AS BIGINT) AS pad_waste
FROM g GROUP BY split, idx // 2""")
def q_length_grouped_batches(spark, d):
    enc = _unranked(spark, d).encoded.select("split", "doc_id", "n_tokens")
    return batches.padding_waste(batches.length_grouped_batches(enc))


@register("length_grouped_assignment", sql.with_encoded() + """
, sh AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS s
         FROM encoded),
g AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY s // 100, n_tokens DESC, s) - 1 AS idx FROM sh)
SELECT split, doc_id, idx // 2 AS batch_id, idx % 2 AS pos FROM g""")
def q_length_grouped_assignment(spark, d):
    enc = _unranked(spark, d).encoded.select("split", "doc_id", "n_tokens")
    return batches.length_grouped_batches(enc).select("split", "doc_id", "batch_id", "pos")


# --------------------------------------------------------------- profiles --
@register("length_histogram", sql.with_encoded() + """
, t AS (SELECT CAST(n_tokens AS DOUBLE) AS x FROM encoded WHERE split = 'train'),
b0 AS (SELECT min(x) AS lo, max(x) AS hi FROM t),
b AS (SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM b0),
c AS (SELECT CAST(least(floor((x - (SELECT lo FROM b)) * 100.0 / ((SELECT hi FROM b) - (SELECT lo FROM b))), 99) AS INTEGER) AS bin,
             count(*) AS n FROM t GROUP BY 1),
g AS (SELECT CAST(unnest(range(100)) AS INTEGER) AS bin)
SELECT g.bin, round((SELECT lo FROM b) + g.bin * ((SELECT hi FROM b) - (SELECT lo FROM b)) / 100.0, 6) AS bin_start,
       round((SELECT lo FROM b) + (g.bin + 1) * ((SELECT hi FROM b) - (SELECT lo FROM b)) / 100.0, 6) AS bin_end,
       coalesce(c.n, 0) AS n
FROM g LEFT JOIN c ON g.bin = c.bin""")
def q_length_histogram(spark, d):
    enc = _unranked(spark, d).encoded
    return profile.length_histogram(enc.where(F.col("split") == "train"))


@register("train_summary", sql.with_encoded() + """
SELECT round(avg(n_tokens), 6) AS mean_length, round(median(n_tokens), 6) AS median_length,
       max(n_tokens) AS max_length, CAST(sum(n_tokens) AS BIGINT) AS total_tokens
FROM encoded WHERE split = 'train'""")
def q_train_summary(spark, d):
    return profile.train_summary(_unranked(spark, d).encoded)


@register("language_distribution", sql.with_encoded() + """
, a AS (SELECT lang, source, count(*) AS n_docs, CAST(sum(n_tokens) AS BIGINT) AS n_tokens FROM encoded GROUP BY lang, source)
SELECT *, round(n_tokens / greatest(sum(n_tokens) OVER (), 1), 6) AS token_share FROM a""")
def q_language_distribution(spark, d):
    return profile.language_distribution(_unranked(spark, d).encoded)


@register("expected_vs_actual", f"""
WITH {sql.ranked_cte()},
a AS (SELECT lang, source, count(*) AS actual_docs, CAST(sum(length(text)) AS BIGINT) AS actual_chars
      FROM documents GROUP BY lang, source)
SELECT reg.lang, reg.source, CAST(100000000 AS BIGINT) AS expected_size, coalesce(a.actual_docs, 0) AS actual_docs,
       coalesce(a.actual_chars, 0) AS actual_chars, round(coalesce(a.actual_chars, 0) / 100000000, 6) AS fill_ratio
FROM reg LEFT JOIN a ON reg.lang = a.lang AND reg.source = a.source""")
def q_expected_vs_actual(spark, d):
    docs = _docs(spark, d)
    return profile.expected_vs_actual(reg.registry_from_table(docs), docs)


# ------------------------------------------------------------- evaluation --
def _lit(s: str) -> str:
    """A SQL expression for a Python string (newlines as chr(10))."""
    parts = [("'" + p.replace("'", "''") + "'") for p in s.split("\n")]
    return " || chr(10) || ".join(parts)


_WORDS = sql.words_sql("text")
_MCQ_ITEMS = f"""items AS (
  SELECT item_id, text AS question, {_WORDS}[1:4] AS choices,
         ['A', 'B', 'C', 'D'][item_id % 4 + 1] AS answer
  FROM benchmark
)"""
_STRIP = "regexp_replace({x}, '^[ \\t\\n\\r\\f]+|[ \\t\\n\\r\\f]+$', '', 'g')"


def _strip(x: str) -> str:
    return _STRIP.format(x=x)


_MCQ_PROMPT = f"""{_lit(MCQ_HEADER)} || question || {_lit(MCQ_CHOICES_HEADER)}
       || array_to_string(list_transform(choices, lambda c, i: chr(CAST(64 + i AS INTEGER)) || '. ' || c || chr(10)), '')
       || {_lit(MCQ_FOOTER)}"""


@register("mcq_prompt", f"""
WITH {_MCQ_ITEMS}
SELECT item_id, {_MCQ_PROMPT} AS prompt
FROM items""")
def q_mcq_prompt(spark, d):
    items = derived.mcq_items(table(spark, d, "benchmark"))
    return items.select("item_id", evaluation.prompt(items).alias("prompt"))


def _bigram_sql(src: str, alias: str, extra: str = "") -> str:
    return f"""{alias} AS (
  SELECT {extra} CASE WHEN i = 1 THEN '<s>' ELSE w[i - 1] END AS prev, w[i] AS word
  FROM (SELECT {extra} w, generate_subscripts(w, 1) AS i FROM (SELECT {extra} {_WORDS} AS w FROM {src}))
)"""


def _class_sql(c: int) -> str:
    """nll{c}: mean negative log-likelihood of the answered documents under the bigram model of class c."""
    return f"""{_bigram_sql(f"(SELECT text FROM lb WHERE side = 0 AND quality = {c})", f'ltb{c}')},
lbi{c} AS (SELECT prev, word, count(*) AS c_bi FROM ltb{c} GROUP BY prev, word),
lctx{c} AS (SELECT prev, count(*) AS c_ctx FROM ltb{c} GROUP BY prev),
lv{c} AS (SELECT count(DISTINCT word) + 1 AS vsize FROM ltb{c}),
nll{c} AS (
  SELECT e.doc_id, round(sum(-ln((coalesce(b.c_bi, 0) + 0.5) / (coalesce(x.c_ctx, 0) + 0.5 * (SELECT vsize FROM lv{c})))) / count(*), 6) AS nll
  FROM leb e LEFT JOIN lbi{c} b ON e.prev = b.prev AND e.word = b.word LEFT JOIN lctx{c} x ON e.prev = x.prev GROUP BY e.doc_id
)"""


_ACC_SQL = f"""
WITH RECURSIVE {_MCQ_ITEMS},
asked AS (SELECT item_id, answer, {_MCQ_PROMPT} AS prompt,
                 ('0x' || substr(md5('42:item:' || CAST(item_id AS VARCHAR)), 1, 8))::BIGINT % 2 AS side FROM items),
{sql.generator_ctes("(SELECT prompt || ' ' || answer AS text FROM asked WHERE side = 0)", 'mc')},
{sql.generate_ctes("(SELECT item_id, prompt FROM asked WHERE side = 1)", 'item_id', 'mc', MCQ_NEW_TOKENS)},
mcq AS (
  SELECT 'indommlu' AS benchmark, upper({_strip('a.answer')}) AS k, upper({_strip("array_to_string(g.out, ' ')")}) AS resp
  FROM asked a JOIN mc_gen g ON a.item_id = g.item_id WHERE g.done OR g.step = {MCQ_NEW_TOKENS}
),
lb AS (SELECT l.doc_id, l.quality, d.text, ('0x' || substr(md5('42:label:' || CAST(l.doc_id AS VARCHAR)), 1, 8))::BIGINT % 2 AS side
       FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
{_bigram_sql("(SELECT doc_id, text FROM lb WHERE side = 1)", 'leb', 'doc_id,')},
{_class_sql(0)},
{_class_sql(1)},
lab AS (
  SELECT 'nusax' AS benchmark, upper({_strip('CAST(l.quality AS VARCHAR)')}) AS k,
         CASE WHEN b.nll <= a.nll THEN '1 …' ELSE '0 …' END AS resp
  FROM lb l LEFT JOIN nll0 a ON l.doc_id = a.doc_id LEFT JOIN nll1 b ON l.doc_id = b.doc_id WHERE l.side = 1 AND l.text IS NOT NULL
),
scored AS (SELECT benchmark, length(k) > 0 AND starts_with(resp, substr(k, 1, 1)) AS hit FROM mcq
           UNION ALL SELECT benchmark, length(k) > 0 AND starts_with(resp, substr(k, 1, 1)) FROM lab),
acc AS (SELECT benchmark, count(*) FILTER (WHERE hit) AS correct, count(*) AS total FROM scored GROUP BY benchmark)
"""


@register("answer_accuracy", _ACC_SQL + """
SELECT benchmark, correct, total, round(correct / greatest(total, 1), 6) AS accuracy FROM acc""")
def q_answer_accuracy(spark, d):
    return _accuracy(spark, d)


def _accuracy(spark, d):
    bench = table(spark, d, "benchmark")
    labels, docs = table(spark, d, "labels"), _docs(spark, d)
    mcq = evaluation.accuracy(*derived.mcq_answers(bench), "indommlu")
    lab = evaluation.accuracy(*derived.label_answers(labels, docs), "nusax")
    return mcq.unionByName(lab)


def _rouge_tokens_sql(x: str) -> str:
    return f"list_filter(string_split(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '')"


def _ngrams_sql(t: str, n: int) -> str:
    if n == 1:
        return t
    return f"list_transform(range(1, len({t})), lambda i: {t}[i] || ' ' || {t}[i + 1])"


def _rouge_sql(n: int) -> str:
    return f"""
g{n} AS (SELECT item_id, {_ngrams_sql('tp', n)} AS gp, {_ngrams_sql('tr', n)} AS gr FROM toks),
sp{n} AS (SELECT item_id, unnest(gp) AS g, 1 AS p, 0 AS r FROM g{n}
         UNION ALL SELECT item_id, unnest(gr) AS g, 0 AS p, 1 AS r FROM g{n}),
ov{n} AS (SELECT item_id, sum(least(cp, cr)) AS overlap
         FROM (SELECT item_id, g, sum(p) AS cp, sum(r) AS cr FROM sp{n} GROUP BY item_id, g) GROUP BY item_id),
f{n} AS (SELECT s.item_id, coalesce(o.overlap, 0) / greatest(len(s.gp), 1) AS pr,
               coalesce(o.overlap, 0) / greatest(len(s.gr), 1) AS rc
        FROM g{n} s LEFT JOIN ov{n} o ON s.item_id = o.item_id)"""


_PAIRS_SQL = f"""pairs AS (
  SELECT item_id, array_to_string(list_filter({_WORDS}, lambda w, i: i % 3 <> 0), ' ') AS prediction,
         text AS reference FROM benchmark
),
toks AS (SELECT item_id, {_rouge_tokens_sql('prediction')} AS tp, {_rouge_tokens_sql('reference')} AS tr
         FROM pairs WHERE length(prediction) > 0 AND length(reference) > 0),"""


def _rouge_metric_sql(n: int) -> str:
    return (f"SELECT 'rouge{n}' AS metric, round(avg(CASE WHEN pr + rc > 0 THEN 2.0 * pr * rc / (pr + rc) "
            f"ELSE 0.0 END), 6) AS value FROM f{n}")


_ROUGE_CTES = _PAIRS_SQL + _rouge_sql(1) + "," + _rouge_sql(2)


@register("rouge_n", f"""
WITH {_ROUGE_CTES}
{_rouge_metric_sql(1)} UNION ALL {_rouge_metric_sql(2)}""")
def q_rouge_n(spark, d):
    return evaluation.rouge_n(derived.summary_pairs(table(spark, d, "benchmark")))


LCS_CTES = """
dp AS (
  SELECT item_id, CAST(0 AS BIGINT) AS i, list_transform(tp, lambda w: CAST(0 AS BIGINT)) AS r FROM toks
  UNION ALL
  SELECT item_id, i + 1, list_transform(range(1, len(c) + 1), lambda j: list_max(c[1:j])) FROM (
    SELECT d.item_id, d.i, list_transform(t.tp, lambda w, j: CAST(greatest(d.r[j],
             CASE WHEN j > 1 THEN d.r[j - 1] ELSE 0 END + CASE WHEN w = t.tr[d.i + 1] THEN 1 ELSE 0 END) AS BIGINT)) AS c
    FROM dp d JOIN toks t ON d.item_id = t.item_id WHERE d.i < len(t.tr))
),
l AS (SELECT d.item_id, coalesce(list_max(d.r), 0) / greatest(len(t.tp), 1) AS pr, coalesce(list_max(d.r), 0) / greatest(len(t.tr), 1) AS rc
      FROM dp d JOIN toks t ON d.item_id = t.item_id AND d.i = len(t.tr))"""


@register("rouge_lcs", f"""
WITH RECURSIVE {_PAIRS_SQL}{LCS_CTES}
SELECT item_id, round(CASE WHEN pr + rc > 0 THEN 2.0 * pr * rc / (pr + rc) ELSE 0.0 END, 6) AS "rougeL" FROM l""")
def q_rouge_lcs(spark, d):
    return evaluation.rouge_l_scores(derived.summary_pairs(table(spark, d, "benchmark"))).select("item_id", "rougeL")


@register("rouge_l")
def q_rouge_l(spark, d):
    # rougeL has its SQL check in rouge_lcs; rougeLsum (union of subsequences) is checked against plain Python in tests.
    return evaluation.rouge_l_scores(derived.summary_pairs(table(spark, d, "benchmark")))


_NGRAM_SQL = f"""WITH {sql.prepared_ctes()},
{_bigram_sql("(SELECT text FROM prepared WHERE split = 'train')", 'tb')},
bi AS (SELECT prev, word, count(*) AS c_bi FROM tb GROUP BY prev, word),
ctx AS (SELECT prev, count(*) AS c_ctx FROM tb GROUP BY prev),
v AS (SELECT count(DISTINCT word) + 1 AS vsize FROM tb),
held AS (SELECT doc_id, lang, text FROM prepared WHERE split <> 'train'),
{_bigram_sql('held', 'eb', 'doc_id, lang,')},
nll AS (
  SELECT e.doc_id, e.lang,
         round(sum(-ln((coalesce(b.c_bi, 0) + 0.5) / (coalesce(c.c_ctx, 0) + 0.5 * (SELECT vsize FROM v)))) / count(*), 6) AS nll,
         count(*) AS n
  FROM eb e LEFT JOIN bi b ON e.prev = b.prev AND e.word = b.word LEFT JOIN ctx c ON e.prev = c.prev
  GROUP BY e.doc_id, e.lang
)
"""


def _ngram_losses(spark, d):
    # held out: the validation and test splits, which share no text with train
    prepared = split_documents(_docs(spark, d))
    bigrams, contexts, vsize = evaluation.bigram_model(prepared.where(F.col("split") == "train"))
    return evaluation.ngram_nll(prepared.where(F.col("split") != "train"), bigrams, contexts, vsize)


@register("ngram_nll", _NGRAM_SQL + "SELECT doc_id, lang, nll, n FROM nll")
def q_ngram_nll(spark, d):
    return _ngram_losses(spark, d)


_PPL = ("CAST(sum(n) AS BIGINT) AS n_tokens, round(sum(nll * n) / greatest(sum(n), 1), 6) AS avg_loss, "
        "round(exp(least(sum(nll * n) / greatest(sum(n), 1), 20)), 6) AS perplexity")


@register("perplexity_weighted", _NGRAM_SQL + f"SELECT {_PPL} FROM nll")
def q_perplexity_weighted(spark, d):
    return evaluation.perplexity(_ngram_losses(spark, d))


@register("perplexity_by_lang", _NGRAM_SQL + f"SELECT coalesce(lang, 'ALL') AS lang, {_PPL} FROM nll GROUP BY ROLLUP (lang)")
def q_perplexity_by_lang(spark, d):
    return evaluation.perplexity_by(_ngram_losses(spark, d))


_REQUESTED = ["indommlu", "indonlg", "nusax", "indo4b", "unknown-benchmark"]


@register("eval_results", _NGRAM_SQL.rstrip().replace("WITH ", "WITH RECURSIVE ", 1) + ",\n" + _ACC_SQL.strip().removeprefix("WITH RECURSIVE ") + ",\n" + _ROUGE_CTES + """,
ppl AS (SELECT sum(nll * n) / greatest(sum(n), 1) AS a FROM nll)
SELECT benchmark, 'accuracy' AS metric, round(correct / greatest(total, 1), 6) AS value, NULL AS error FROM acc
UNION ALL SELECT benchmark, 'correct', CAST(correct AS DOUBLE), NULL FROM acc
UNION ALL SELECT benchmark, 'total', CAST(total AS DOUBLE), NULL FROM acc
UNION ALL SELECT 'indonlg', metric, value, NULL FROM (""" + _rouge_metric_sql(1) + " UNION ALL " + _rouge_metric_sql(2) + """)
UNION ALL SELECT 'perplexity', 'perplexity', round(exp(least(a, 20)), 6), NULL FROM ppl
UNION ALL SELECT 'perplexity', 'avg_loss', round(a, 6), NULL FROM ppl
UNION ALL SELECT 'indo4b', NULL, NULL, 'dataset not available: indonlp/indo4b'""")
def q_eval_results(spark, d):
    return _eval_results(spark, d)


def _eval_results(spark, d):
    """EV8 + EV9: run the requested benchmarks that exist; one long result table."""
    chosen = {r["name"]: r for r in evaluation.select_benchmarks(
        evaluation.benchmark_registry(spark), _REQUESTED).collect()}  # registry rows: a handful
    acc = _accuracy(spark, d)
    parts = []
    for name in ("indommlu", "nusax"):
        if name in chosen:
            one = acc.where(F.col("benchmark") == name)
            parts.append(evaluation.result_rows(name, one.select("accuracy", "correct", "total")))
    if "indonlg" in chosen:
        r = evaluation.rouge_n(derived.summary_pairs(table(spark, d, "benchmark")))
        parts.append(r.select(F.lit("indonlg").alias("benchmark"), "metric", "value",
                              F.lit(None).cast("string").alias("error")))
    if "indo4b" in chosen:
        parts.append(evaluation.error_row(spark, "indo4b", f"dataset not available: {chosen['indo4b']['dataset']}"))
    ppl = evaluation.perplexity(_ngram_losses(spark, d))
    parts.append(evaluation.result_rows("perplexity", ppl.select("perplexity", "avg_loss")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- prompts --
_BLOCK = "'<|' || upper(substr(role, 1, 1)) || lower(substr(role, 2)) || '|>' || chr(10) || text || chr(10)"


@register("chat_prompt", f"""
SELECT conv_id, string_agg({_BLOCK}, '' ORDER BY turn) || '<|Assistant|>' || chr(10) AS prompt
FROM conversations GROUP BY conv_id""")
def q_chat_prompt(spark, d):
    return prompts.chat_prompt(table(spark, d, "conversations"))


@register("frame_conversation", f"""
SELECT conv_id, turn, role, text FROM conversations
UNION ALL
SELECT conv_id, CAST(-1 AS BIGINT), 'system', {_lit(prompts.DEFAULT_SYSTEM)} FROM conversations
GROUP BY conv_id HAVING max(CAST(lower(role) = 'system' AS INTEGER)) = 0""")
def q_frame_conversation(spark, d):
    return prompts.frame_conversation(table(spark, d, "conversations"))


@register("request_payloads", f"""
WITH p AS (SELECT conv_id, string_agg({_BLOCK}, '' ORDER BY turn) || '<|Assistant|>' || chr(10) AS prompt,
                  list(struct_pack(role := role, content := text) ORDER BY turn) AS messages
           FROM conversations GROUP BY conv_id)
SELECT conv_id,
  CAST(to_json(struct_pack(model := '{SERVED_MODEL}', prompt := prompt, max_tokens := 1024, temperature := 0.7,
                           stream := false)) AS VARCHAR) AS completion_payload,
  CAST(to_json(struct_pack(model := '{SERVED_MODEL}', messages := messages, temperature := 0.7,
                           max_tokens := 1024)) AS VARCHAR) AS chat_payload
FROM p""")
def q_request_payloads(spark, d):
    conv = table(spark, d, "conversations")
    comp = prompts.chat_prompt(conv).select("conv_id", prompts.completion_payload(F.col("prompt")).alias("completion_payload"))
    return comp.join(prompts.chat_payloads(conv), "conv_id")


_STREAM_SQL = """
WITH lines AS (
  SELECT conv_id AS request_id, turn AS seq,
         'data: ' || CAST(to_json(struct_pack(choices := [struct_pack(text := text)])) AS VARCHAR) AS line
  FROM conversations
  UNION ALL SELECT conv_id, max(turn) + 1, '' FROM conversations GROUP BY conv_id
  UNION ALL SELECT conv_id, max(turn) + 2, 'data: [DONE]' FROM conversations GROUP BY conv_id
),
parsed AS (
  SELECT request_id, seq, regexp_replace(regexp_replace(line, '^data: ', ''), '^[ \\t\\n\\r\\f]+|[ \\t\\n\\r\\f]+$', '', 'g') AS data
  FROM lines
)
SELECT request_id, string_agg(coalesce(json_extract_string(data, '$.choices[0].text'), ''), '' ORDER BY seq) AS text
FROM parsed WHERE data <> '' AND data <> '[DONE]' GROUP BY request_id"""


@register("stream_reassembly", _STREAM_SQL)
def q_stream_reassembly(spark, d):
    return prompts.reassemble(derived.stream_log(table(spark, d, "conversations")))


@register("response_extract", f"""
WITH r AS (
  SELECT conv_id, turn,
    CAST(to_json(struct_pack(choices := [struct_pack(text := ' ' || text || ' ')])) AS VARCHAR) AS completion_body,
    CAST(to_json(struct_pack(choices := [struct_pack(message := struct_pack(content := text))])) AS VARCHAR) AS chat_body
  FROM conversations WHERE role = 'assistant'
)
SELECT conv_id, turn,
  {_strip("coalesce(json_extract_string(completion_body, '$.choices[0].text'), '')")} AS completion_text,
  coalesce(json_extract_string(chat_body, '$.choices[0].message.content'), '') AS chat_text
FROM r""")
def q_response_extract(spark, d):
    conv = table(spark, d, "conversations").where(F.col("role") == "assistant")
    bodies = conv.select(
        "conv_id", "turn",
        F.to_json(F.struct(F.array(F.struct(F.concat(F.lit(" "), F.col("text"), F.lit(" ")).alias("text")))
                           .alias("choices"))).alias("completion_body"),
        F.to_json(F.struct(F.array(F.struct(F.struct(F.col("text").alias("content")).alias("message")))
                           .alias("choices"))).alias("chat_body"))
    return bodies.select("conv_id", "turn", prompts.completion_text(F.col("completion_body")).alias("completion_text"),
                         prompts.chat_text(F.col("chat_body")).alias("chat_text"))


# ---------------------------------------------------------------- run log --
_LOG = """
WITH rl AS (SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step,
                   ts, value AS loss FROM events),
log AS (SELECT *, CASE WHEN step % 5 = 0 THEN loss END AS eval_loss FROM rl)
"""
CADENCE_EVAL, CADENCE_SAVE, RETAIN = 5, 20, 5


def _log(spark, d):
    return derived.run_log(table(spark, d, "events"))


@register("loss_every_n", _LOG + """
SELECT run_id, (b + 1) * 10 AS step, round(sum(loss) / 10, 6) AS mean_loss
FROM (SELECT run_id, (step - 1) // 10 AS b, loss FROM log) GROUP BY run_id, b HAVING count(*) = 10""")
def q_loss_every_n(spark, d):
    return runlog.loss_every_n(_log(spark, d))


@register("running_best", _LOG + """
SELECT run_id, step, eval_loss,
  coalesce(eval_loss < min(eval_loss) OVER (PARTITION BY run_id ORDER BY step
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS new_best
FROM log WHERE eval_loss IS NOT NULL""")
def q_running_best(spark, d):
    return runlog.running_best(_log(spark, d))


@register("throughput", _LOG + """
SELECT run_id, step, round(secs, 6) AS elapsed_sec, round(CASE WHEN secs > 0 THEN step * 32 / secs END, 6) AS samples_per_sec
FROM (SELECT run_id, step, (epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY run_id))) / 1e6 AS secs FROM log)
WHERE step % 10 = 0""")
def q_throughput(spark, d):
    return runlog.throughput(_log(spark, d))


@register("cadence", _LOG + f"""
SELECT run_id, step, step % {CADENCE_EVAL} = 0 AS is_eval, step % {CADENCE_SAVE} = 0 AS is_save FROM log
WHERE step % {CADENCE_EVAL} = 0 OR step % {CADENCE_SAVE} = 0""")
def q_cadence(spark, d):
    return runlog.cadence(_log(spark, d), CADENCE_EVAL, CADENCE_SAVE)


@register("retention_topk", _LOG + f"""
SELECT run_id, step, newest_rank FROM (
  SELECT run_id, step, row_number() OVER (PARTITION BY run_id ORDER BY step DESC) - 1 AS newest_rank
  FROM log WHERE step % {CADENCE_SAVE} = 0) WHERE newest_rank < {RETAIN}""")
def q_retention_topk(spark, d):
    return runlog.retention(_log(spark, d), CADENCE_SAVE, RETAIN)


@register("validation_perplexity", _LOG + """
SELECT run_id, eval_step, count(*) AS batches, round(avg(loss), 6) AS eval_loss,
       round(exp(least(avg(loss), 20)), 6) AS eval_perplexity
FROM (SELECT run_id, CAST(ceil(step / 5) * 5 AS BIGINT) AS eval_step, loss FROM log) GROUP BY run_id, eval_step""")
def q_validation_perplexity(spark, d):
    return runlog.validation_perplexity(runlog.eval_batches(_log(spark, d)))


@register("run_summary", _LOG + """
SELECT run_id, max(step) AS total_steps, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 3.6e9, 6) AS total_time_hours,
       min(eval_loss) AS best_eval_loss
FROM log GROUP BY run_id""")
def q_run_summary(spark, d):
    return runlog.run_summary(_log(spark, d))


# ----------------------------------------------------------- decode / LIM2 --
@register("decode", sql.with_encoded() + f"""
SELECT doc_id, array_to_string({_WORDS}, ' ') AS text FROM prepared""")
def q_decode(spark, d):
    prep = _unranked(spark, d)
    return encoding.decode(prep.encoded, prep.vocab)


@register("eval_subset", f"""
WITH {sql.prepared_ctes()}
SELECT doc_id, shuffle_rank FROM prepared WHERE split = 'train' ORDER BY shuffle_rank LIMIT 500""")
def q_eval_subset(spark, d):
    train = prepared_documents(_docs(spark, d)).where(F.col("split") == "train")
    return ordinal.eval_subset(train.select("doc_id", "shuffle_rank"), ["shuffle_rank"], 500)


# -------------------------------------------------------------- streaming --
@register("stream_intake", f"""
WITH {sql.ranked_cte()},
filtered AS (SELECT * FROM ranked WHERE ({sql.reason_sql('text', PLAN_QUALITY)}) IS NULL),
w AS (SELECT lang, min(ord) AS ord FROM filtered GROUP BY lang, {sql.key_sql('text', None)})
SELECT f.doc_id, f.lang, f.source, CAST(0 AS BIGINT) AS batch_id FROM filtered f JOIN w ON f.ord = w.ord""")
def q_stream_intake(spark, d):
    docs = table(spark, d, "documents")
    out = stream_intake.incremental_intake(spark, f"{d.rstrip('/')}/documents.parquet", docs.schema,
                                           reg.registry_from_table(docs))
    return out.select("doc_id", "lang", "source", "batch_id")


ROLLUP_WINDOW_US = 3600 * 1_000_000


@register("stream_runlog_rollup", f"""
WITH e AS (SELECT user_id AS run_id, ts, value AS loss, epoch_us(ts) // {ROLLUP_WINDOW_US} * {ROLLUP_WINDOW_US} AS ws FROM events),
a AS (SELECT run_id, ws, count(*) AS records, round(avg(loss), 6) AS mean_loss,
             (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS span FROM e GROUP BY run_id, ws)
SELECT run_id, make_timestamp(ws) AS window_start, make_timestamp(ws + {ROLLUP_WINDOW_US}) AS window_end, records, mean_loss,
       round(CASE WHEN span > 0 THEN records / span END, 6) AS records_per_sec
FROM a""")
def q_stream_runlog_rollup(spark, d):
    events = table(spark, d, "events")

    def to_log(s):
        return s.select(F.col("user_id").alias("run_id"), ntz_to_instant(F.col("ts")).alias("ts"),
                        F.col("value").alias("loss"))

    out = stream_runlog.live_rollup(spark, f"{d.rstrip('/')}/events.parquet", events.schema, "1 hour", "2 hours", to_log)
    return out.select("run_id", instant_to_ntz(F.col("window_start")).alias("window_start"),
                      instant_to_ntz(F.col("window_end")).alias("window_end"),
                      "records", "mean_loss", "records_per_sec")


@register("stream_reassembly_live", _STREAM_SQL.replace(
    "AS text\nFROM parsed", "AS text, true AS complete\nFROM parsed"))
def q_stream_reassembly_live(spark, d):
    # The stream log is derived from ``conversations`` by Spark and written as files, then streamed.
    folder = stream_common.work_dir(spark, "stream-log-source")
    log = derived.stream_log(table(spark, d, "conversations"))
    log.write.parquet(folder)
    return stream_completions.live_reassembly(spark, folder, log.schema)


@register("synthetic_split", "WITH syn AS (" + _synthetic_sql() + """),
shuf AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS shuffle_rank,
                count(*) OVER () AS _n FROM syn)
SELECT doc_id, text, shuffle_rank,
  CASE WHEN shuffle_rank < ((_n + 99) // 100 + 1) // 2 THEN 'test'
       WHEN shuffle_rank < (_n + 99) // 100 THEN 'validation' ELSE 'train' END AS split
FROM shuf""")
def q_synthetic_split(spark, d):
    # SRC5: one synthetic row per documents row, split exactly, raw text kept.
    from .prepare import synthetic_only
    return synthetic_only(_docs(spark, d)).select("doc_id", "text", "shuffle_rank", "split")


@register("approx_split", """
SELECT doc_id, CASE WHEN b < 50 THEN 'test' WHEN b < 100 THEN 'validation' ELSE 'train' END AS split
FROM (SELECT doc_id, CAST(('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 10000 AS BIGINT) AS b
      FROM documents)""")
def q_approx_split(spark, d):
    return ordinal.approximate_split(_docs(spark, d).select("doc_id"))


@register("pad_to_batch_max", sql.with_encoded() + f"""
SELECT split, doc_id, batch_id,
       CAST(list_resize(input_ids, max(len(input_ids)) OVER (PARTITION BY split, batch_id), {DEFAULT_IDS.pad_id}) AS INTEGER[]) AS input_ids
FROM ({_batch_sql('doc_id', 'encoded')})""")
def q_pad_to_batch_max(spark, d):
    enc = _unranked(spark, d).encoded.select("split", "doc_id", "input_ids")
    return batches.pad_to_batch_max(batches.assign_batches(enc, "doc_id")).select("split", "doc_id", "batch_id", "input_ids")
