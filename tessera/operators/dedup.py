"""Keep-first deduplication.

DED1 DED2 DED3 DED4

Plan: the key ``sha2(prefix(text))`` and a BIGINT order key ``ord`` are the
only columns that cross the shuffle: ``groupBy(lang, key).agg(min(ord))`` runs
as partial + final HashAggregate, so a key shared by a third of all rows
collapses to one row per map task before the exchange.  The winners (one
BIGINT each) are semi-joined back on ``ord``, a unique key, so that join
has no hot key either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import PREFIX_CHARS
from ..functions.text import text_key

ORDER_SHIFT = 40  # doc_id < 2**40, source_rank < 2**23


def order_key(rank_col: str = "source_rank", id_col: str = "doc_id") -> Column:
    """Packed (source_rank, doc_id) order as one BIGINT: registry order, then id.

    Unique over all rows, as the rank is unique over the registry and the id within a
    source; an id that does not fit its 40 bits raises an error.
    """
    i = F.col(id_col).cast("bigint")
    fits = i.between(F.lit(0), F.lit((1 << ORDER_SHIFT) - 1))
    checked = F.when(fits, i).otherwise(F.raise_error(F.concat(F.lit("doc_id outside 0 .. 2**40 - 1: "), F.coalesce(i.cast("string"), F.lit("null")))))
    return F.col(rank_col).cast("bigint") * F.lit(1 << ORDER_SHIFT) + checked


def keep_first(df: DataFrame, key: Column, scope: Sequence[str] = ("lang",),
               ord_col: str = "ord") -> DataFrame:
    """Rows whose ``ord`` is the smallest among rows with the same (scope, key)."""
    winners = (df.select(*scope, key.alias("_key"), F.col(ord_col))
               .groupBy(*scope, "_key").agg(F.min(ord_col).alias(ord_col))
               .select(ord_col))
    return df.join(winners, on=ord_col, how="left_semi")


def dedup_prefix(df: DataFrame, prefix_chars: int | None = PREFIX_CHARS,
                 scope: Sequence[str] = ("lang",), text_col: str = "text",
                 ord_col: str = "ord") -> DataFrame:
    """DED2/DED3: keep the first row of each (lang, sha2(first 1,000 chars))."""
    return keep_first(df, text_key(F.col(text_col), prefix_chars), scope, ord_col)


def dedup_exact(df: DataFrame, scope: Sequence[str] = ("lang",), text_col: str = "text",
                ord_col: str = "ord") -> DataFrame:
    """DED1: keep the first row of each (lang, full text)."""
    return dedup_prefix(df, None, scope, text_col, ord_col)


def dedup_report(df: DataFrame, prefix_chars: int | None = None,
                 scope: Sequence[str] = ("lang",), text_col: str = "text") -> DataFrame:
    """DED4: rows before, after and removed per scope (two small aggregations)."""
    per_key = (df.select(*scope, text_key(F.col(text_col), prefix_chars).alias("_key"))
               .groupBy(*scope, "_key").agg(F.count(F.lit(1)).alias("_n")))
    return (per_key.groupBy(*scope)
            .agg(F.sum("_n").cast("bigint").alias("n_before"),
                 F.count(F.lit(1)).cast("bigint").alias("n_after"))
            .withColumn("n_removed", F.col("n_before") - F.col("n_after")))
