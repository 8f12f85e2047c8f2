"""End-to-end corpus preparation: raw documents -> quality -> dedup -> cap -> shuffle/split -> encode.

Decisions are made on narrow key tables and the wide text joins back once:

* quality rules are a narrow filter next to the scan;
* dedup aggregates (lang, sha2(prefix), ord) only;
* the per-language cap and the seeded shuffle/split each use the distributed
  ordinal on (lang, ord) / (md5 key, doc_id) — a few BIGINT/STRING columns;
* the text joins the decision table once on ``ord`` (unique key).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_IDS, PLAN_QUALITY, SEED, QualityParams, SpecialIds
from ..functions.text import text_key
from ..operators import encoding, profile
from ..operators.dedup import order_key
from ..operators.ordinal import head_per_group, seeded_shuffle, three_way_split
from ..operators.quality import length_ok, quality_keep
from ..operators.selection import selection_key, split_bounds, split_by_bounds
from ..session import reliable_checkpoint, staged_parquet
from ..sources.registry import docs_with_rank, registry_from_table

#: Row numbers of later copies that are broadcast at most (16 MB); more are joined by shuffle.
LOSER_ROWS = 2_000_000
#: Registry rows (one a source) that are broadcast at most; more are joined by shuffle.
SOURCE_ROWS = 100_000


@dataclass(frozen=True)
class PrepareParams:
    quality: QualityParams = PLAN_QUALITY
    prefix_chars: int | None = None  # duplicate key: the whole text
    lang_cap: int | None = None      # rows per language: all
    seed: int = SEED
    max_length: int | None = None    # words per document: all
    ids: SpecialIds = DEFAULT_IDS
    vocab_size: int | None = None
    filter_synthetic: bool = False   # synthetic replacement rows skip the quality rules unless asked
    use_registry_cap: bool = False   # cap each language at its registry ``max_samples`` instead
    caps: DataFrame | None = None    # (lang, max_samples) of a configured registry
    ranked: bool = True              # False: no shuffle_rank; the split is a comparison and no text is shuffled
    ranks_apart: bool = False        # with ranked=False: ``shuffle_rank`` in a narrow table ``ranks`` by ``ord``


def ranked_documents(docs: DataFrame, limit: int = SOURCE_ROWS) -> DataFrame:
    """Documents with registry rank and packed order key ``ord``.

    A ``source_rank`` that the documents bring along (from ``load_sources``) is kept.
    The registry is written and counted, so that up to ``limit`` sources are broadcast
    and no text is shuffled for its rank.
    """
    if "source_rank" not in docs.columns:
        registry = staged_parquet(registry_from_table(docs), "registry")
        docs = docs_with_rank(docs, F.broadcast(registry) if registry.count() <= limit else registry)
    return docs.withColumn("ord", order_key())


def decisions(filtered: DataFrame, p: PrepareParams, caps: DataFrame | None = None) -> DataFrame:
    """Narrow (ord, doc_id, lang, shuffle_rank, split) for the kept rows.

    The dedup winners (lang, ord) are checkpointed once, so the range
    sampling and the writes of the later ordinals read that small table
    instead of re-running the quality rules.  The per-language cap runs only
    when asked for.
    """
    winners = reliable_checkpoint(
        filtered.select("lang", text_key(F.col("text"), p.prefix_chars).alias("_key"), "ord")
        .groupBy("lang", "_key").agg(F.min("ord").alias("ord"))
        .select("lang", "ord"))
    if caps is not None:
        # per-language caps: one row per language (registry-sized), broadcast
        ranked = head_per_group(winners, ["lang"], ["ord"], None, out="lang_rank")
        winners = (ranked.join(F.broadcast(caps), "lang", "left")
                   .where(F.col("max_samples").isNull() | (F.col("lang_rank") < F.col("max_samples")))
                   .select("lang", "ord"))
    elif p.lang_cap:
        winners = head_per_group(winners, ["lang"], ["ord"], p.lang_cap, out="lang_rank").drop("lang_rank")
    return three_way_split(winners, "ord", p.seed)  # ids may repeat across sources, ``ord`` does not


def split_documents(docs: DataFrame, p: PrepareParams = PrepareParams(), limit: int = LOSER_ROWS) -> DataFrame:
    """(doc_id, lang, source, text, split) after filter, dedup and split, without a shuffle of the text.

    Rows that pass the quality rules are written once as Parquet (the rules run once); everything is
    decided on its narrow columns.  The split compares the seeded key with two order statistics of the
    winners' keys, and the rows that lose to an earlier copy are left out by their row number: a broadcast of
    at most ``limit`` numbers, beyond it a shuffle join.  Caps need ranks: use ``prepared_documents``.
    """
    return _split(docs, p, limit)[0].drop("ord")


def ranks_apart(docs: DataFrame, p: PrepareParams = PrepareParams(), limit: int = LOSER_ROWS) -> tuple[DataFrame, DataFrame]:
    """``split_documents`` with ``ord``, one row each as in ``prepared_documents``, and the narrow (ord, shuffle_rank)."""
    documents, groups = _split(docs, p, limit, once=True)
    ranks = seeded_shuffle(groups.select(F.col("_first").alias("ord")), "ord", p.seed)
    return documents, ranks.dropDuplicates(["ord"]).select("ord", "shuffle_rank")


def _split(docs: DataFrame, p: PrepareParams, limit: int, once: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents with ``ord``, groups of copies); ``once``: of different texts with one ``ord`` the first row stays."""
    if p.lang_cap or p.caps is not None or p.use_registry_cap:
        raise ValueError("caps need ranks")
    ranked = ranked_documents(docs)
    exempt = F.lit(False) if p.filter_synthetic else F.col("source").eqNullSafe(F.lit("synthetic"))
    kept = (ranked.where(quality_keep(F.col("text"), p.quality) | exempt)
            .select("doc_id", "lang", "source", "text", "ord", text_key(F.col("text"), p.prefix_chars).alias("_key"),
                    F.monotonically_increasing_id().alias("_row")))
    staged = staged_parquet(kept, "kept")
    groups = staged_parquet(staged.groupBy("lang", "_key").agg(F.min("ord").alias("_first"), F.count(F.lit(1)).alias("_n")), "groups")
    bounds = split_bounds(groups.select(selection_key("_first", p.seed).alias("_skey")), "_skey")
    several = groups.where("_n > 1").select(F.col("lang").alias("_lang"), F.col("_key").alias("_k"))
    copies = staged.select("lang", "_key", "ord", "_row").join(several, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("_key").eqNullSafe(F.col("_k")))
    first = copies.groupBy("lang", "_key").agg(F.min_by("_row", F.struct("ord", "_row")).alias("_row"))
    losers = staged_parquet(copies.select("_row").join(first.select("_row"), "_row", "left_anti"), "losers")
    if once:
        repeated = groups.groupBy(F.col("_first").alias("ord")).count().where("count > 1").select("ord")
        rows = staged_parquet(staged.select("ord", "_row").join(repeated, "ord").join(losers, "_row", "left_anti").select("ord", "_row"), "repeated")
        later = rows.join(rows.groupBy("ord").agg(F.min("_row").alias("_row")).select("_row"), "_row", "left_anti").select("_row")
        losers = losers.unionByName(later)
    if losers.count() <= limit:
        losers = F.broadcast(losers)
    rest = staged.join(losers, "_row", "left_anti")
    split = split_by_bounds(selection_key("ord", p.seed), bounds).alias("split")
    return rest.select("doc_id", "lang", "source", "text", split, "ord"), groups


def prepared_documents(docs: DataFrame, p: PrepareParams = PrepareParams()) -> DataFrame:
    """(doc_id, lang, source, text, split, shuffle_rank) after filter, dedup, cap, split.

    The decision table holds only rows that passed the filter, so the text
    joins back from the plain scan: the quality rules run once, inside the
    (checkpointed) decision step.
    """
    ranked = ranked_documents(docs)
    caps = (registry_from_table(docs).groupBy("lang").agg(F.min("max_samples").alias("max_samples"))
            if p.use_registry_cap else p.caps)
    exempt = F.lit(False) if p.filter_synthetic else F.col("source").eqNullSafe(F.lit("synthetic"))
    kept = ranked.where(quality_keep(F.col("text"), p.quality) | exempt)
    keep = decisions(kept, p, caps).select("ord", "split", "shuffle_rank")
    # The length rule is nearly free: rows it rejects never enter the join's shuffle.
    candidates = ranked.where(length_ok(F.col("text"), p.quality) | exempt)
    return (candidates.join(keep, on="ord", how="inner").dropDuplicates(["ord"])  # a repeated row counts once
            .select("doc_id", "lang", "source", "text", "split", "shuffle_rank"))


@dataclass
class Prepared:
    documents: DataFrame
    vocab: DataFrame
    encoded: DataFrame
    vocab_size: int
    max_length: int | None
    ranks: DataFrame | None = None


def prepare(docs: DataFrame, p: PrepareParams = PrepareParams()) -> Prepared:
    """Prepare + encode.  ``encoded`` keeps doc_id, lang, source, split and, if ``ranked``, shuffle_rank (Q21).

    The prepared documents are written once (the reference's prepared-dataset
    step); the vocabulary and the encoder both read that copy instead of each
    repeating the text join.  The encoded ones are written once as well, whatever the
    size of the vocabulary, so no reader encodes again.

    ``ranks_apart``: ``encoded`` has ``ord`` and ``ranks`` is (ord, shuffle_rank).  Readers that
    reduce a document to a few numbers join those to its rank, and no text is shuffled for it.
    """
    keys = ("doc_id", "lang", "source", "split")
    ranks = None
    if p.ranked:
        prepared = staged_parquet(prepared_documents(docs, p), "prepared")
        keys += ("shuffle_rank",)
    elif p.ranks_apart:
        prepared, ranks = ranks_apart(docs, p)
        keys += ("ord",)
    else:
        prepared = split_documents(docs, p)  # narrow over its own written copy
    vocab = encoding.build_vocab(prepared, ids=p.ids, vocab_size=p.vocab_size)
    size = encoding.vocab_size(vocab, p.ids)
    encoded = encoding.encode(prepared, vocab, keys=keys, max_length=p.max_length, ids=p.ids)
    if size - p.ids.count <= encoding.BROADCAST_VOCAB_ROWS:  # a larger vocabulary's result is written already
        encoded = staged_parquet(encoded, "encoded")
    return Prepared(prepared, vocab, encoded, size, p.max_length, ranks)


def profile_prepared(prep: Prepared) -> DataFrame:
    """The flagship report: per-split length profile plus the all-splits row."""
    return profile.length_profile_with_totals(prep.encoded)


def corpus_or_synthetic(docs: DataFrame | None, n: int = 200_000, seed: int = SEED) -> DataFrame:
    """SET3: the corpus, or ``n`` synthetic rows when nothing could be loaded (one cheap emptiness probe)."""
    from ..sources.synthetic import synthetic_corpus
    if docs is not None and not docs.isEmpty():
        return docs
    spark = docs.sparkSession if docs is not None else None
    if spark is None:
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
    return synthetic_corpus(spark, n, seed=seed).withColumn("source_rank", F.lit(0))


def synthetic_only(ids: DataFrame, seed: int = SEED) -> DataFrame:
    """SRC5: synthetic text for each id, split with the exact three-way split; raw text kept."""
    from ..sources.synthetic import synthetic_rows
    rows = synthetic_rows(ids.select("doc_id", "lang"), F.col("lang"), "doc_id", seed)
    return three_way_split(rows, "doc_id", seed)
