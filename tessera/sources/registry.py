"""Corpus registry and source loading.  SRC1 SRC2 SRC3 SRC5 SET1 SET2 SET3

A registry is a short list of ``CorpusSource`` entries (a few rows, bounded by
the number of configured sources).  Loading builds one lazy DataFrame per
path and unions them by name; entries that select rows of the same table
share one scan.  Filters applied later are pushed through the union into
every scan.
"""

from __future__ import annotations

import functools
import json
import logging
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import SEED
from .synthetic import synthetic_rows

log = logging.getLogger(__name__)

READABLE_FORMATS = {"parquet", "json", "orc", "csv", "text"}
# Fixed value: expected size literal of the derived test registry.
DEFAULT_EXPECTED_SIZE = 100_000_000
#: Rank of sources that a registry lacks (the order key holds ranks below 2**23).
UNKNOWN_RANK = (1 << 22)


@dataclass(frozen=True)
class CorpusSource:
    """SRC1: one registry entry.  ``fmt=None`` means "not loadable, skip" (reference ``sources=None``)."""

    lang: str
    source: str
    path: str | None
    rank: int
    fmt: str | None = "parquet"
    where: str | None = None
    expected_size: int = DEFAULT_EXPECTED_SIZE
    max_samples: int | None = None   # no cap
    match: dict | None = None        # column values (null-safe) that select the entry's rows of a shared table
    options: dict = field(default_factory=dict)


@dataclass
class LoadReport:
    loaded: list = field(default_factory=list)
    skipped: list = field(default_factory=list)
    replaced: list = field(default_factory=list)


def read_registry(spark: SparkSession, path: str) -> list[CorpusSource]:
    """SRC1: a configured registry, a JSON list of entries in rank order, from any path Spark reads."""
    entries = json.loads(spark.read.text(path, wholetext=True).first()[0])
    return [CorpusSource(rank=i, **entry) for i, entry in enumerate(entries)]


def language_caps(spark: SparkSession, sources: Sequence[CorpusSource]) -> DataFrame | None:
    """(lang, max_samples): the least limit of each language's entries; None without limits."""
    least: dict = {}
    for s in sources:
        if s.max_samples is not None:
            least[s.lang] = min(s.max_samples, least.get(s.lang, s.max_samples))
    return spark.createDataFrame(list(least.items()), "lang string, max_samples bigint") if least else None


def registry_frame(spark: SparkSession, sources: Sequence[CorpusSource]) -> DataFrame:
    """The registry as a small DataFrame (few rows; broadcast when joined)."""
    rows = [(s.lang, s.source, int(s.rank), int(s.expected_size), s.max_samples) for s in sources]
    return spark.createDataFrame(
        rows, "lang string, source string, source_rank int, expected_size bigint, max_samples bigint")


def registry_from_table(docs: DataFrame) -> DataFrame:
    """Registry derived from a table holding (lang, source): rank = order of (lang, source), nulls first.

    Ranks are unique over all languages, so (rank, doc_id) is too.  The distinct step is a partial+final aggregate: the exchange carries one
    row per (map task, source), so the window after it works on a few rows (one per source).
    """
    distinct = docs.select("lang", "source").distinct()
    w = Window.orderBy(F.col("lang").asc_nulls_first(), F.col("source").asc_nulls_first())
    return distinct.select(
        "lang", "source",
        (F.row_number().over(w) - 1).cast("int").alias("source_rank"),
        F.lit(DEFAULT_EXPECTED_SIZE).cast("bigint").alias("expected_size"),
        F.lit(None).cast("bigint").alias("max_samples"),
    )


def sources_from_registry(rows, path: str) -> list[CorpusSource]:
    """Registry rows (collected: bounded by the number of sources) -> entries over one table."""
    out = []
    for r in rows:
        out.append(CorpusSource(r["lang"], r["source"], path, int(r["source_rank"]), "parquet", None, int(r["expected_size"]),
                                r["max_samples"], match={"lang": r["lang"], "source": r["source"]}))
    return out


def _predicate(s: CorpusSource) -> Column:
    """Rows of a shared table that belong to the entry."""
    out = F.expr(s.where) if s.where else F.lit(True)
    for name, value in (s.match or {}).items():
        out = out & F.col(name).eqNullSafe(F.lit(value))
    return out


def _text(df: DataFrame, s: CorpusSource) -> Column:
    names = [c for c in ("text", "content", "value") if c in df.columns]
    if not names:
        raise ValueError(f"source {s.source!r}: no column text, content or value in {df.columns}")
    return F.coalesce(*[F.col(c) for c in names], F.lit(""))


def _with_ids(df: DataFrame) -> DataFrame:
    """``doc_id`` as given, or else the row's position in order of its text's hash.

    That position is the same however the files are cut into partitions (equal texts are interchangeable) and fits
    the order key.
    """
    if "doc_id" in df.columns:
        return df.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    from ..operators.ordinal import with_ordinal
    return with_ordinal(df.withColumn("_sha", F.sha2("text", 256)), ["_sha"], out="doc_id").drop("_sha")


def _read_one(spark: SparkSession, s: CorpusSource) -> DataFrame:
    reader = spark.read.format(s.fmt).options(**s.options)
    df = reader.load(s.path)
    ids = [F.col("doc_id")] if "doc_id" in df.columns else []
    return _with_ids(df.select(*ids, _text(df, s).alias("text"))).select(
        "doc_id",
        "text",
        F.lit(s.lang).alias("lang"),
        F.lit(s.source).alias("source"),
        F.lit(s.rank).cast("int").alias("source_rank"),
    )


def _replacement(spark: SparkSession, s: CorpusSource, rows: int, seed: int) -> DataFrame:
    """SRC3: synthetic rows standing in for a source that failed to load."""
    ids = spark.range(rows).withColumnRenamed("id", "doc_id")
    return synthetic_rows(ids, s.lang, "doc_id", seed).withColumn("source_rank", F.lit(s.rank).cast("int"))


def _read_shared(spark: SparkSession, group: Sequence[CorpusSource]) -> DataFrame:
    """One scan for several entries over the same table: each row is emitted once per entry whose
    predicate it matches (exact union semantics, duplicates kept), labelled with that entry."""
    first = group[0]
    df = spark.read.format(first.fmt).options(**first.options).load(first.path)
    df = df.withColumn("text", _text(df, first))
    df = _with_ids(df)
    labels = F.array(*[F.when(_predicate(s), F.struct(F.lit(s.lang).alias("lang"), F.lit(s.source).alias("source"),
                                                        F.lit(s.rank).cast("int").alias("source_rank")))
                       for s in group])
    any_match = functools.reduce(Column.__or__, [_predicate(s) for s in group])
    hits = df.where(any_match).select("doc_id", "text",
                                      F.explode(F.filter(labels, lambda x: x.isNotNull())).alias("_l"))
    return hits.select("doc_id", "text", "_l.lang", "_l.source", "_l.source_rank")


def load_sources(spark: SparkSession, sources: Sequence[CorpusSource], replace_failed: bool = False,
                 replacement_rows: int = 100_000, seed: int = SEED,
                 report: LoadReport | None = None) -> DataFrame | None:
    """SRC2/SRC3/SET1/SET2: union of every loadable source, registry order kept in ``source_rank``.

    Unknown formats are skipped and reported.  A missing path raises, unless
    ``replace_failed`` asks for ``replacement_rows`` synthetic rows in its place
    (flagged ``source='synthetic'``); no other error is masked.  Ranks that are not unique
    over the entries are replaced by the entries' order (rank, then place in the list).
    """
    if len({s.rank for s in sources}) < len(sources):
        order = sorted(range(len(sources)), key=lambda i: (sources[i].rank, i))
        place = {i: n for n, i in enumerate(order)}
        sources = [replace(s, rank=place[i]) for i, s in enumerate(sources)]
    report = report if report is not None else LoadReport()
    parts: list[DataFrame] = []
    shared: dict = {}
    for s in sources:
        if s.fmt is None or s.fmt not in READABLE_FORMATS or s.path is None:
            report.skipped.append(s.source)
            continue
        if s.where or s.match:  # entries that select rows of one shared table are read together below
            shared.setdefault((s.path, s.fmt, tuple(sorted(s.options.items()))), []).append(s)
            continue
        try:
            part = _read_one(spark, s)
            report.loaded.append(s.source)
        except AnalysisException as e:
            if not (replace_failed and _missing_path(e)):
                raise
            log.warning("source %s failed (%s); using synthetic rows", s.source, e)
            report.replaced.append(s.source)
            part = _replacement(spark, s, replacement_rows, seed)
        parts.append(part)
    for group in shared.values():
        try:
            parts.append(_read_shared(spark, group))
            report.loaded.extend(s.source for s in group)
        except AnalysisException as e:
            if not (replace_failed and _missing_path(e)):
                raise
            for s in group:
                log.warning("source %s failed (%s); using synthetic rows", s.source, e)
                parts.append(_replacement(spark, s, replacement_rows, seed))
                report.replaced.append(s.source)
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def docs_with_rank(docs: DataFrame, registry: DataFrame) -> DataFrame:
    """Attach ``source_rank`` from a registry (one row per source), null-safe; a row of an unknown source keeps the last rank."""
    r = registry.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "source_rank")
    joined = docs.join(r, docs["lang"].eqNullSafe(r["_lang"]) & docs["source"].eqNullSafe(r["_source"]), "left")
    return joined.withColumn("source_rank", F.coalesce("source_rank", F.lit(UNKNOWN_RANK))).drop("_lang", "_source")


def _missing_path(e: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e)
