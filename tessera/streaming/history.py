"""Keys of earlier micro-batches behind a blocked Bloom filter per batch (STR1).

Each batch leaves, next to its rows, a filter of its keys: 64-bit blocks, ``BITS`` bits a key in one block, about
``KEYS_A_BLOCK`` keys a block, stored as (block, bits) rows, a tenth of the keys' size.  A new batch joins its own keys
with the blocks that they fall into (a narrow join; its size is the batch's keys times the batches before, as bit tests)
and so learns which earlier batches may hold one of them.  Only those partitions of the sink are read, key columns only,
and compared exactly: a false positive costs a read, never a row.  A batch of new keys reads no history at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 4
KEYS_A_BLOCK = 6


def blocks_for(keys: int) -> int:
    """Blocks of a filter: a power of two, so that there are few sizes."""
    return 1 << max(0, -(-keys // KEYS_A_BLOCK) - 1).bit_length()


def _place(*cols: str) -> Column:
    return F.xxhash64(*cols)


def _mask(*cols: str) -> Column:
    h = F.xxhash64(*cols, F.lit(1))
    bits = [F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(BITS)]
    out = F.lit(0).cast("bigint")
    for b in bits:
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), b))
    return out


def make_filter(keys: DataFrame, cols: list[str], blocks: int) -> DataFrame:
    """(block, bits): the filter of the keys."""
    return keys.groupBy(F.pmod(_place(*cols), F.lit(blocks)).alias("block")).agg(F.bit_or(_mask(*cols)).alias("bits"))


def write_filter(keys: DataFrame, cols: list[str], batch_id: int, path: str, blocks: int | None = None) -> None:
    """The batch's filter as its own partition; a replay overwrites it."""
    n = blocks or blocks_for(keys.count())
    (make_filter(keys, cols, n).withColumn("blocks", F.lit(n).cast("bigint")).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def may_hold(keys: DataFrame, cols: list[str], filters: DataFrame) -> DataFrame:
    """The keys with each ``batch_id`` whose filter holds all their bits."""
    sizes = [r["blocks"] for r in filters.select("blocks").distinct().collect()]  # powers of two
    if not sizes:
        return keys.limit(0).withColumn("batch_id", F.lit(0).cast("bigint"))
    probes = (keys.withColumn("_mask", _mask(*cols)).withColumn("_h", _place(*cols)).withColumn("blocks", F.explode(F.array(*[F.lit(s).cast("bigint") for s in sizes])))
              .withColumn("block", F.pmod("_h", "blocks")))
    hits = probes.join(filters.select("blocks", "block", "bits", "batch_id"), ["blocks", "block"])
    return hits.where(F.col("bits").bitwiseAND(F.col("_mask")) == F.col("_mask")).select(*cols, "batch_id")


def unseen(keys: DataFrame, cols: list[str], spark: SparkSession, sink: str, filters: DataFrame) -> tuple[DataFrame, list[int]]:
    """The rows whose key no earlier batch in ``filters`` has, and the batches that were read to know it."""
    found = may_hold(keys.select(*cols).distinct(), cols, filters)
    batches = sorted(r["batch_id"] for r in found.select("batch_id").distinct().collect())  # at most one number a batch
    if not batches:
        return keys, []
    held = spark.read.parquet(sink).where(F.col("batch_id").isin(batches)).select(*[F.col(c).alias(f"_{c}_") for c in cols])
    same = F.lit(True)
    for c in cols:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}_"))
    return keys.join(held, same, "left_anti"), batches
