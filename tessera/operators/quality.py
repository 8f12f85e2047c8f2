"""Quality rules and text-column fallback.

FLT1 FLT2 FLT3 FLT4 FLT5 FLT6 PRJ1

All rules are native column expressions evaluated in one narrow stage with the
scan.  The rules run in the reference order (length, repetition, printable):
``quality_reason`` is a CASE, so the array/regex work of the later rules is
only done for rows that pass the cheap length rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import QualityParams
from ..functions.text import char_length, distinct_chars, printable_chars, safe_ratio

DEFAULT = QualityParams()


def text_fallback(df: DataFrame, candidates: Sequence[str] = ("text", "content"),
                  out: str = "text") -> DataFrame:
    """PRJ1/FLT5: ``text``, else ``content``, else '' (per row)."""
    present = [F.col(c) for c in candidates if c in df.columns]
    value = F.coalesce(*present, F.lit("")) if present else F.lit("")
    return df.withColumn(out, value)


def length_ok(text: Column, p: QualityParams = DEFAULT) -> Column:
    """FLT1: min_chars <= length <= 4 * max_length (null counts as ''; no max_length: no upper bound)."""
    n = char_length(F.coalesce(text, F.lit("")))
    return n >= F.lit(p.min_chars) if p.max_chars is None else n.between(F.lit(p.min_chars), F.lit(p.max_chars))


def repetition_ratio(text: Column) -> Column:
    """FLT2 measure: distinct characters / max(length, 1)."""
    return safe_ratio(distinct_chars(text), char_length(text))


def printable_ratio(text: Column) -> Column:
    """FLT3 measure: printable characters / max(length, 1)."""
    return safe_ratio(printable_chars(text), char_length(text))


def quality_reason(text: Column, p: QualityParams = DEFAULT) -> Column:
    """FLT4: first failing rule ('length', 'repetition', 'printable') or null when kept."""
    t = F.coalesce(text, F.lit(""))
    return (F.when(~length_ok(t, p), F.lit("length"))
            .when(repetition_ratio(t) < F.lit(p.repetition_min) if p.repetition_min > 0 else F.lit(False), F.lit("repetition"))
            .when(printable_ratio(t) < F.lit(p.printable_min), F.lit("printable")))


def quality_keep(text: Column, p: QualityParams = DEFAULT) -> Column:
    """FLT4 as a filter: all rules pass.  The verdict does not depend on rule
    order, so the cheaper printable rule runs before the repetition rule (junk
    text is rejected without the distinct-character split); ``quality_reason``
    keeps the reference order for reporting."""
    t = F.coalesce(text, F.lit(""))
    return (F.when(~length_ok(t, p), F.lit(False))
            .when(printable_ratio(t) < F.lit(p.printable_min), F.lit(False))
            .otherwise(repetition_ratio(t) >= F.lit(p.repetition_min) if p.repetition_min > 0 else F.lit(True)))


def with_quality(df: DataFrame, p: QualityParams = DEFAULT, text_col: str = "text") -> DataFrame:
    """Adds ``quality_reason`` and ``keep``."""
    return (df.withColumn("quality_reason", quality_reason(F.col(text_col), p))
            .withColumn("keep", F.col("quality_reason").isNull()))


def quality_filter(df: DataFrame, p: QualityParams = DEFAULT, text_col: str = "text") -> DataFrame:
    """FLT4: rows that pass all rules."""
    return df.where(quality_keep(F.col(text_col), p))


def quality_measures(df: DataFrame, p: QualityParams = DEFAULT, text_col: str = "text") -> DataFrame:
    """Per-row measures and verdict (for reports and the oracle)."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(
        "doc_id", "lang", "source",
        char_length(t).alias("n_chars"),
        F.when(length_ok(t, p), F.round(repetition_ratio(t), 6)).alias("repetition_ratio"),
        F.when(length_ok(t, p), F.round(printable_ratio(t), 6)).alias("printable_ratio"),
        quality_reason(t, p).alias("quality_reason"),
    )


def filter_report(df: DataFrame, p: QualityParams = DEFAULT, text_col: str = "text",
                  by: Sequence[str] = ("lang", "source")) -> DataFrame:
    """FLT6: rows in and rows kept per source, one pass (partial aggregation map-side)."""
    keep = quality_keep(F.col(text_col), p)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(keep).cast("bigint").alias("n_kept"),
    )


def reason_counts(df: DataFrame, p: QualityParams = DEFAULT, text_col: str = "text") -> DataFrame:
    """Rows per first failing rule ('kept' for passing rows)."""
    reason = F.coalesce(quality_reason(F.col(text_col), p), F.lit("kept"))
    return df.groupBy(reason.alias("quality_reason")).agg(F.count(F.lit(1)).alias("n_docs"))


def observed_filter(df: DataFrame, sources: Sequence[tuple[str | None, str | None]], p: QualityParams = DEFAULT,
                    text_col: str = "text") -> tuple[DataFrame, Observation]:
    """FLT4 with FLT6 on the side: the rows that pass, and rows in and kept of each (lang, source), observed on the same pass.

    The numbers are there once an action on the rows (say, the write) is done: ``observed_report``.
    ``sources``: the registry's pairs, a handful; each costs two counters.
    """
    seen = Observation()
    keep = quality_keep(F.col(text_col), p)
    marked = df.withColumn("_keep", keep)
    counters = [F.count(F.lit(1)).alias("rows")]
    for i, (lang, source) in enumerate(sources):
        mine = F.col("lang").eqNullSafe(F.lit(lang)) & F.col("source").eqNullSafe(F.lit(source))
        counters += [F.count_if(mine).alias(f"n{i}"), F.count_if(mine & F.col("_keep")).alias(f"k{i}")]
    return marked.observe(seen, *counters).where("_keep").drop("_keep"), seen


def observed_report(spark: SparkSession, sources: Sequence[tuple[str | None, str | None]], seen: Observation) -> DataFrame:
    """(lang, source, n_docs, n_kept) of an observed pass; sources without rows are left out, as in ``filter_report``."""
    got = seen.get
    rows = [(lang, source, got[f"n{i}"], got[f"k{i}"]) for i, (lang, source) in enumerate(sources) if got[f"n{i}"]]
    if sum(r[2] for r in rows) != got["rows"]:
        raise ValueError("rows of a source that is not in the registry")
    return spark.createDataFrame(rows, "lang string, source string, n_docs long, n_kept long")
