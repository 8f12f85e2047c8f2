"""Corpus and token profiles.  AGG1 AGG2 AGG3 AGG4 AGG5 AGG6 AGG7 AGG8 AGG9

All aggregates are partial/final (map-side combine).  The exact median uses
Spark's ``percentile``, whose buffer is a value -> count map: for token
lengths that is at most ``max_length + 1`` entries per group, whatever the row
count.  Profiles read the stored ``n_tokens`` column, never the id arrays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BYTES_PER_TOKEN
from ..session import reliable_checkpoint


def _r6(c: Column) -> Column:
    return F.round(c, 6)


def _median(n: Column, exact: bool) -> Column:
    """Exact median (value -> count buffer) or the sketch-based ``percentile_approx``."""
    return F.percentile(n, 0.5) if exact else F.percentile_approx(n, 0.5, 10000).cast("double")


def _length_aggs(n: Column, exact: bool = True) -> list[Column]:
    return [
        F.count(F.lit(1)).cast("bigint").alias("samples"),
        F.sum(n).cast("bigint").alias("total_tokens"),
        _r6(F.avg(n)).alias("mean_length"),
        _r6(_median(n, exact)).alias("median_length"),
        F.min(n).cast("bigint").alias("min_length"),
        F.max(n).cast("bigint").alias("max_length"),
        _r6(F.stddev_pop(n)).alias("std_length"),
    ]


def length_profile(df: DataFrame, n_col: str = "n_tokens", by: str = "split", exact: bool = True) -> DataFrame:
    """AGG1: per split: samples, tokens, mean, median (exact by default), min, max, population std."""
    return df.groupBy(by).agg(*_length_aggs(F.col(n_col), exact))


def length_profile_with_totals(df: DataFrame, n_col: str = "n_tokens", by: str = "split",
                               exact: bool = True) -> DataFrame:
    """AGG1 + AGG2 in one pass: ``rollup`` adds the all-splits row (``split = 'ALL'``)."""
    out = df.rollup(by).agg(*_length_aggs(F.col(n_col), exact), F.grouping(by).alias("_g"))
    return out.select(F.when(F.col("_g") == 1, F.lit("ALL")).otherwise(F.col(by)).alias(by),
                      *[c for c in out.columns if c not in (by, "_g")])


def corpus_totals(df: DataFrame, n_col: str = "n_tokens") -> DataFrame:
    """AGG2/AGG3: total samples and tokens, size estimates (bytes/token = 4)."""
    tokens = F.sum(F.col(n_col)).cast("bigint")
    agg = df.agg(F.count(F.lit(1)).cast("bigint").alias("total_samples"), tokens.alias("total_tokens"))
    t = F.coalesce(F.col("total_tokens"), F.lit(0)).cast("double")
    return agg.select(
        "total_samples", "total_tokens",
        F.bround(t * F.lit(BYTES_PER_TOKEN) / F.lit(1e9), 2).alias("estimated_training_data_gb"),
        F.bround(t * F.lit(2.0) / F.lit(1e9), 2).alias("tokens_x2_billion"),
    )


def split_counts(df: DataFrame, by: str = "split") -> DataFrame:
    """AGG6: rows per split."""
    return df.groupBy(by).agg(F.count(F.lit(1)).cast("bigint").alias("samples"))


def prepare_stats(encoded: DataFrame, vocab_size: int, max_length: int | None,
                  n_col: str = "n_tokens") -> DataFrame:
    """AGG4: one row; ``total_tokens`` is the real token sum (rows reported separately)."""
    s = F.col("split")
    return encoded.agg(
        F.sum(n_col).cast("bigint").alias("total_tokens"),
        F.count(F.lit(1)).cast("bigint").alias("total_rows"),
        F.count_if(s == "train").cast("bigint").alias("train_samples"),
        F.count_if(s == "validation").cast("bigint").alias("val_samples"),
        F.count_if(s == "test").cast("bigint").alias("test_samples"),
    ).select("*", F.lit(vocab_size).cast("bigint").alias("vocab_size"),
             F.lit(max_length).cast("bigint").alias("max_length"))


def train_summary(df: DataFrame, n_col: str = "n_tokens") -> DataFrame:
    """AGG7: mean, median, max and sum of train lengths (split folder pruned)."""
    n = F.col(n_col)
    return df.where(F.col("split") == "train").agg(
        _r6(F.avg(n)).alias("mean_length"), _r6(F.percentile(n, 0.5)).alias("median_length"),
        F.max(n).cast("bigint").alias("max_length"), F.sum(n).cast("bigint").alias("total_tokens"))


def length_histogram(df: DataFrame, n_col: str = "n_tokens", bins: int = 100) -> DataFrame:
    """AGG5: equal-width bins between min and max, last bin closed, empty bins kept.

    Rows are counted by length once (a few rows per length); bounds (a scalar
    subquery) and bins come from that.  Equal bounds widen by 0.5 on each side
    (numpy's rule); the ``bins``-row grid keeps empty bins.
    """
    df = reliable_checkpoint(df.groupBy(n_col).agg(F.count(F.lit(1)).alias("_rows")))
    n = F.col(n_col).cast("double")
    lo0, hi0 = F.min(n), F.max(n)
    bounds = df.agg(F.struct(
        F.when(lo0 == hi0, lo0 - 0.5).otherwise(lo0).alias("lo"),
        F.when(lo0 == hi0, hi0 + 0.5).otherwise(hi0).alias("hi")).alias("b")).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    width = hi - lo
    idx = F.least(F.floor((n - lo) * F.lit(float(bins)) / width), F.lit(bins - 1)).cast("int")
    counts = df.groupBy(idx.alias("bin")).agg(F.sum("_rows").cast("bigint").alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(counts, "bin", "left")
            .select("bin",
                    _r6(lo + F.col("bin") * width / F.lit(float(bins))).alias("bin_start"),
                    _r6(lo + (F.col("bin") + 1) * width / F.lit(float(bins))).alias("bin_end"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def language_distribution(df: DataFrame, n_col: str = "n_tokens") -> DataFrame:
    """AGG8: rows and tokens per (lang, source) and token share; the share window runs after aggregation."""
    agg = df.groupBy("lang", "source").agg(F.count(F.lit(1)).cast("bigint").alias("n_docs"),
                                           F.sum(n_col).cast("bigint").alias("n_tokens"))
    total = agg.agg(F.sum("n_tokens").alias("t")).scalar()  # over the per-source rows
    return agg.withColumn("token_share", _r6(F.col("n_tokens") / F.greatest(total, F.lit(1))))


def expected_vs_actual(registry: DataFrame, docs: DataFrame) -> DataFrame:
    """AGG9: registry expected size next to the actual rows and characters per source."""
    actual = docs.groupBy("lang", "source").agg(
        F.count(F.lit(1)).cast("bigint").alias("actual_docs"),
        F.sum(F.length("text")).cast("bigint").alias("actual_chars"))
    return (registry.join(actual, ["lang", "source"], "left")
            .select("lang", "source", "expected_size",
                    F.coalesce("actual_docs", F.lit(0)).cast("bigint").alias("actual_docs"),
                    F.coalesce("actual_chars", F.lit(0)).cast("bigint").alias("actual_chars"),
                    _r6(F.coalesce("actual_chars", F.lit(0)) / F.col("expected_size")).alias("fill_ratio")))


def length_sketches(df: DataFrame, by: Sequence[str] = ("source", "split"), n_col: str = "n_tokens", k: int = 400) -> DataFrame:
    """AGG1 at scale: one mergeable quantile sketch (KLL) of the lengths a group, a few KB each.

    Kept next to the data (``write.parquet``), sketches of new groups are added and any roll-up
    (``merged_sketches``) reads them instead of the corpus.
    """
    return df.groupBy(*by).agg(F.count(F.lit(1)).cast("bigint").alias("samples"), F.kll_sketch_agg_bigint(F.col(n_col).cast("bigint"), F.lit(k)).alias("sketch"))


def merged_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of coarser groups from those of finer ones."""
    return sketches.groupBy(*by).agg(F.sum("samples").alias("samples"), F.kll_merge_agg_bigint("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, quantiles: Sequence[float] = (0.5, 0.9, 0.99)) -> DataFrame:
    """One row a sketch and quantile: the groups' columns, samples, quantile, length (rank error about 1 % at k = 400)."""
    keys = [c for c in sketches.columns if c != "sketch"]
    pairs = F.array(*[F.struct(F.lit(float(q)).alias("quantile"), F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(q))).alias("length")) for q in quantiles])
    return sketches.select(*keys, F.explode(pairs).alias("_q")).select(*keys, "_q.quantile", "_q.length")


def rank_errors(df: DataFrame, found: DataFrame, by: Sequence[str], n_col: str = "n_tokens") -> DataFrame:
    """Distance of each sketch quantile from the ranks that its length has in the rows (0: exact).

    ``found`` (of ``sketch_quantiles``) is registry-sized and broadcast.
    """
    f = F.broadcast(found.select(*[F.col(c).alias(f"_{c}") for c in by], "quantile", "length"))
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    near = df.groupBy(*by, n_col).agg(F.count(F.lit(1)).alias("_n")).join(f, on)
    ranks = near.groupBy(*by, "quantile", "length").agg(F.sum(F.when(F.col(n_col) < F.col("length"), F.col("_n")).otherwise(0)).alias("_lo"),
                                                        F.sum(F.when(F.col(n_col) <= F.col("length"), F.col("_n")).otherwise(0)).alias("_hi"), F.sum("_n").alias("_all"))
    lo, hi = F.col("_lo") / F.col("_all"), F.col("_hi") / F.col("_all")
    return ranks.select(*by, "quantile", "length", F.greatest(lo - F.col("quantile"), F.col("quantile") - hi, F.lit(0.0)).alias("rank_error"))
