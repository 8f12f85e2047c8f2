"""Training-set shaping.  BAT1 BAT2 BAT3 BAT4 BAT5 BAT6

Masks are array higher-order functions (JVM-side).  Batches use the
distributed ordinal: ``batch_id = position div batch_size``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BATCH_SIZE, DEFAULT_IDS, GRAD_ACCUM, LABEL_IGNORE, SEED, SpecialIds
from ..functions.hashing import seeded_key
from .ordinal import with_ordinal


def labels(ids: Column, pad: int) -> Column:
    """BAT1: labels = ids with the pad id replaced by -100."""
    return F.transform(ids, lambda x: F.when(x == F.lit(pad), F.lit(LABEL_IGNORE)).otherwise(x))


def attention_mask(ids: Column, pad: int) -> Column:
    """BAT2: 1 where the id is not the pad id, else 0."""
    return F.transform(ids, lambda x: (x != F.lit(pad)).cast("int"))


def with_masks(df: DataFrame, ids: SpecialIds = DEFAULT_IDS, ids_col: str = "input_ids") -> DataFrame:
    pad = ids.pad_id
    return (df.withColumn("labels", labels(F.col(ids_col), pad))
            .withColumn("attention_mask", attention_mask(F.col(ids_col), pad)))


def _order_key(split: Column, id_col: str, seed: int) -> Column:
    """Train rows in a seeded shuffled order, other splits in id order."""
    return F.when(split == F.lit("train"), seeded_key(seed, id_col)).otherwise(
        F.lpad(F.col(id_col).cast("string"), 20, "0"))


def assign_batches(df: DataFrame, id_col: str = "chunk_id", batch_size: int = BATCH_SIZE,
                   seed: int = SEED, split_col: str = "split") -> DataFrame:
    """BAT3: ``batch_id`` and ``pos`` per split; train shuffled, others ordered; last batch may be short."""
    keyed = df.withColumn("_bkey", _order_key(F.col(split_col), id_col, seed))
    ranked = with_ordinal(keyed, ["_bkey", id_col], [split_col], out="_idx")
    return (ranked.withColumn("batch_id", F.floor(F.col("_idx") / F.lit(batch_size)).cast("bigint"))
            .withColumn("pos", (F.col("_idx") % F.lit(batch_size)).cast("bigint"))
            .drop("_bkey", "_idx"))


def ragged_batches(batched: DataFrame, n_col: str = "n_tokens", split_col: str = "split") -> DataFrame:
    """BAT4: batches whose rows have unequal lengths (cannot be stacked)."""
    per = batched.groupBy(split_col, "batch_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.min(n_col).cast("bigint").alias("min_len"), F.max(n_col).cast("bigint").alias("max_len"))
    return per.where(F.col("min_len") != F.col("max_len"))


def step_plan(batched: DataFrame, grad_accum: int = GRAD_ACCUM, epochs: int = 1,
              max_steps: int | None = None, split: str = "train") -> DataFrame:
    """BAT5: (epoch, batch_id, update_step) for batches that feed an update.

    updates/epoch = batches div accumulation; total = updates × epochs (at most ``max_steps`` if given).
    The batch count (one number) comes from a max aggregate; epochs come from
    ``explode(sequence(0, epochs-1))`` per batch.
    """
    b = batched.where(F.col("split") == split).select("batch_id").distinct()
    last = b.agg(F.max("batch_id")).first()[0]
    s = step_summary_from_batches(0 if last is None else int(last) + 1, grad_accum, epochs, max_steps)
    upe, total = s["updates_per_epoch"], s["total_updates"]
    local = F.floor(F.col("batch_id") / F.lit(grad_accum))
    rows = b.select("batch_id", local.alias("_u"), F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
    step = (F.col("epoch") * F.lit(upe) + F.col("_u") + 1).cast("bigint")
    return (rows.where((F.col("_u") < F.lit(upe)) & (step <= F.lit(total)))
            .select(F.col("epoch").cast("int").alias("epoch"), "batch_id", step.alias("update_step")))


def step_summary_from_batches(batches: int, grad_accum: int = GRAD_ACCUM, epochs: int = 1,
                              max_steps: int | None = None) -> dict:
    upe = batches // grad_accum
    return {"batches": batches, "updates_per_epoch": upe, "total_updates": upe * epochs if max_steps is None else min(max_steps, upe * epochs),
            "unused_batches": batches - upe * grad_accum}


def step_summary(n_rows: int, batch_size: int = BATCH_SIZE, grad_accum: int = GRAD_ACCUM, epochs: int = 1,
                 max_steps: int | None = None) -> dict:
    """BAT5 arithmetic for a known row count."""
    batches = -(-n_rows // batch_size)
    upe = batches // grad_accum
    return {"batches": batches, "updates_per_epoch": upe, "total_updates": upe * epochs if max_steps is None else min(max_steps, upe * epochs),
            "unused_batches": batches - upe * grad_accum, "effective_batch": batch_size * grad_accum}


def length_grouped_batches(df: DataFrame, n_col: str = "n_tokens", id_col: str = "doc_id",
                           batch_size: int = BATCH_SIZE, mega: int = 50, seed: int = SEED,
                           split_col: str = "split") -> DataFrame:
    """BAT6: shuffled mega-batches of ``batch_size*mega`` rows, sorted by length inside, then batched.

    Returns the rows with ``batch_id`` and ``pos``; ``padding_waste`` reports the padding saved.
    """
    shuffled = with_ordinal(df.withColumn("_k", seeded_key(seed, id_col)), ["_k", id_col], [split_col],
                            out="_s").drop("_k")
    grouped = shuffled.withColumn("_mb", F.floor(F.col("_s") / F.lit(batch_size * mega)).cast("bigint"))
    ranked = with_ordinal(grouped, ["_mb", F.col(n_col).desc(), "_s"], [split_col], out="_idx")
    return (ranked.withColumn("batch_id", F.floor(F.col("_idx") / F.lit(batch_size)).cast("bigint"))
            .withColumn("pos", (F.col("_idx") % F.lit(batch_size)).cast("bigint")).drop("_s", "_mb", "_idx"))


def padding_waste(batched: DataFrame, n_col: str = "n_tokens", split_col: str = "split") -> DataFrame:
    """Per batch: rows, longest row, pad tokens needed to stack it."""
    return batched.groupBy(split_col, "batch_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.max(n_col).cast("bigint").alias("max_len"),
        (F.max(n_col) * F.count(F.lit(1)) - F.sum(n_col)).cast("bigint").alias("pad_waste"))


def pad_to_batch_max(batched: DataFrame, ids: SpecialIds = DEFAULT_IDS, ids_col: str = "input_ids",
                     split_col: str = "split") -> DataFrame:
    """BAT4 remedy: right-pad every row to the longest row of its batch (a batch is ``batch_size`` rows)."""
    from pyspark.sql import Window
    longest = F.max(F.size(ids_col)).over(Window.partitionBy(split_col, "batch_id"))
    padded = F.concat(F.col(ids_col), F.array_repeat(F.lit(ids.pad_id), longest - F.size(ids_col)))
    return batched.withColumn(ids_col, padded)
