"""ORD1 global ordinal and the row-position operators built on it.

ORD1 LIM1 LIM2 SHF1 SPL1

Spark tables have no row order, but the reference's keep-first, head, split
and batch rules all use list positions.  Every position here is derived from
an explicit order key, so results are the same for any input partitioning.

Plan of ``with_ordinal`` (never an un-partitioned ``Window.orderBy``):

1. ``repartitionByRange(n, group, key)`` + ``sortWithinPartitions`` — one
   shuffle; range bounds split a hot group over many partitions.
2. ``spark_partition_id`` and ``monotonically_increasing_id`` tag each row,
   then the table is checkpointed to the shared checkpoint folder so the count
   pass and the use pass see the same partitions even after executor loss.
3. Per (partition, group): row count and first id — at most
   ``partitions × groups`` rows.  A running sum over that small table gives
   each partition's offset inside its group.
4. The offsets join back (broadcast when there is no group column: the table
   then has at most ``n`` rows; otherwise AQE picks by measured size), and
   ``ord = offset + (id - first_id)``.

Callers pass narrow key tables and join the payload afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import HOLDOUT_PERCENT, SEED
from ..functions.hashing import seeded_key
from ..session import reliable_checkpoint, shuffle_partitions


def _cols(xs) -> list:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def with_ordinal(df: DataFrame, order_by: Sequence, group_by: Sequence[str] = (),
                 out: str = "ord", total: str | None = None,
                 num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based dense position ``out`` by ``order_by`` (within ``group_by``).

    ``order_by`` should be unique inside a group (add an id as tie-breaker) so
    the result is deterministic.  ``total`` adds the group's row count.
    """
    spark = df.sparkSession
    n = num_partitions or shuffle_partitions(spark)
    keys = [*_cols(group_by), *_cols(order_by)]
    ranged = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    ranged = reliable_checkpoint(ranged)

    groups = list(group_by)
    stats = ranged.groupBy("_pid", *groups).agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first"))
    before = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    if total:
        offsets = offsets.withColumn(total, F.sum("_cnt").over(Window.partitionBy(*groups)).cast("bigint"))
    offsets = offsets.drop("_cnt")
    if not groups:
        offsets = F.broadcast(offsets)  # at most n rows
    joined = ranged.join(offsets, on=["_pid", *groups], how="inner")
    return (joined.withColumn(out, (F.col("_off") + F.col("_mid") - F.col("_first")).cast("bigint"))
            .drop("_pid", "_mid", "_first", "_off"))


def head_per_group(df: DataFrame, group_by: Sequence[str], order_by: Sequence, cap: int | None,
                   out: str = "group_rank") -> DataFrame:
    """LIM1: first ``cap`` rows of each group in ``order_by`` order (falsy cap = all)."""
    ranked = with_ordinal(df, order_by, group_by, out=out)
    return ranked if not cap else ranked.where(F.col(out) < F.lit(cap))


def eval_subset(df: DataFrame, order_by: Sequence, k: int = 500) -> DataFrame:
    """LIM2: the first ``k`` rows by ``order_by`` (a top-k, bounded by k)."""
    return df.orderBy(*_cols(order_by)).limit(k)


def shuffle_key(id_col: str = "doc_id", seed: int = SEED) -> Column:
    return seeded_key(seed, id_col)


def seeded_shuffle(df: DataFrame, id_col: str = "doc_id", seed: int = SEED,
                   out: str = "shuffle_rank", group_by: Sequence[str] = (),
                   total: str | None = None) -> DataFrame:
    """SHF1: a seeded permutation: position by ``md5('seed:id')`` then id."""
    keyed = df.withColumn("_skey", shuffle_key(id_col, seed))
    return with_ordinal(keyed, ["_skey", id_col], group_by, out=out, total=total).drop("_skey")


def split_sizes(n: int, holdout_pct: int = HOLDOUT_PERCENT) -> tuple[int, int, int]:
    """(train, validation, test) sizes: m = ceil(n*pct/100), t = ceil(m/2), integers only."""
    m = (n * holdout_pct + 99) // 100
    t = (m + 1) // 2
    return n - m, m - t, t


def split_of(rank: Column, n: Column, holdout_pct: int = HOLDOUT_PERCENT) -> Column:
    """Split name for a 0-based shuffled position among n rows (integer arithmetic)."""
    m = F.floor((n * F.lit(holdout_pct) + F.lit(99)) / F.lit(100))
    t = F.floor((m + F.lit(1)) / F.lit(2))
    return (F.when(rank < t, F.lit("test"))
            .when(rank < m, F.lit("validation"))
            .otherwise(F.lit("train")))


def three_way_split(df: DataFrame, id_col: str = "doc_id", seed: int = SEED,
                    holdout_pct: int = HOLDOUT_PERCENT) -> DataFrame:
    """SPL1: exact sizes; the first t shuffled rows are test, the next m-t validation."""
    ranked = seeded_shuffle(df, id_col, seed, out="shuffle_rank", total="_n")
    return ranked.withColumn("split", split_of(F.col("shuffle_rank"), F.col("_n"), holdout_pct)).drop("_n")


def with_running(df: DataFrame, order_by: Sequence[str], value: str, group_by: Sequence[str] = (),
                 op: str = "sum", out: str = "running", num_partitions: int | None = None) -> DataFrame:
    """Exclusive prefix ``sum`` or ``min`` of ``value`` by ``order_by`` within ``group_by``.

    Same plan as ``with_ordinal``: range partitions (a hot group spans many),
    a checkpoint, per-partition partials (a few rows per partition) combined by
    a running window over that small table, and a window inside each partition
    and group.  ``min`` starts from null (nothing before the first row).
    """
    assert op in ("sum", "min")
    spark = df.sparkSession
    n = num_partitions or shuffle_partitions(spark)
    keys = [*group_by, *order_by]
    ranged = reliable_checkpoint(
        df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_pid", F.spark_partition_id()))
    groups = list(group_by)
    agg = F.sum if op == "sum" else F.min
    partial = ranged.groupBy("_pid", *groups).agg(agg(value).alias("_p"))
    before = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    base = partial.select("_pid", *groups, agg("_p").over(before).alias("_base"))
    inside = Window.partitionBy("_pid", *groups).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_local", agg(value).over(inside))
    # without groups: one row per partition; with groups adaptive execution picks the join by measured size
    joined = local.join(base if groups else F.broadcast(base), on=["_pid", *groups])
    vtype = ranged.schema[value].dataType.simpleString()
    if op == "sum":
        res = (F.coalesce("_base", F.lit(0)) + F.coalesce("_local", F.lit(0))).cast(vtype)
    else:
        res = F.least(F.col("_base"), F.col("_local")).cast(vtype)  # least ignores nulls
    return joined.withColumn(out, res).drop("_pid", "_base", "_local")


def approximate_split(df: DataFrame, id_col: str = "doc_id", seed: int = SEED,
                      holdout_pct: int = HOLDOUT_PERCENT, buckets: int = 10_000) -> DataFrame:
    """SPL1, cheap variant: a narrow column expression, no ordinal and no shuffle.

    Each row falls in an md5 bucket of ``buckets``; the lowest ``holdout_pct``
    percent of buckets are held out, half of them as test.  Sizes are
    approximate (binomial), membership is deterministic and stable as rows
    are added.
    """
    from ..functions.hashing import md5_index
    b = md5_index(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), buckets)
    held = buckets * holdout_pct // 100
    return df.withColumn("split", F.when(b < F.lit(held // 2), F.lit("test"))
                         .when(b < F.lit(held), F.lit("validation")).otherwise(F.lit("train")))
