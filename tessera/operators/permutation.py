"""A new shuffle each epoch without a sort: keyed permutations of [0, n) (BAT3, BAT5).

A Feistel network over pairs (l, r) with l < a, r < b, a * b >= n, is a permutation of
[0, a * b) for any round function; walking its cycle until a value below n comes up
makes it one of [0, n).  With a = ceil(sqrt n) and b = ceil(n / a) fewer than ``a`` values
lie outside, so a walk takes one step almost always and always ends.

Rows keep one dense number (a sort once); every epoch is then a narrow column of it, and
the inverse tells which row stands at a place, so a run resumes in the middle of an epoch
by reading just the rows that are left.  Built-in expressions have no loop and no local
names: unrolled, filters pushed through the rounds multiply them.  So the network
runs on whole Arrow batches of two narrow columns.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..config import BATCH_SIZE, GRAD_ACCUM, SEED
from .batches import step_summary

ROUNDS = 6
MASK = (1 << 31) - 1
#: Odd multipliers and shifts of the round function; products stay below 2^62.
MIX = ((0x45D9F3B, 15), (0x2C1B3C6D, 12))


def sides(n: int) -> tuple[int, int]:
    """(a, b) with a * b >= n and a * b - n < a."""
    a = max(1, int(n ** 0.5))
    while a * a < n:
        a += 1
    return a, max(1, -(-n // a))


def round_key(seed: int, epoch: int, i: int) -> int:
    """31 bits for each round of each epoch."""
    return int(hashlib.md5(f"{seed}:{epoch}:{i}".encode()).hexdigest()[:8], 16) & MASK


def _network(x: np.ndarray, keys: np.ndarray, a: int, b: int, undo: bool) -> np.ndarray:
    """One pass; ``keys``: a row of round keys for each value."""
    left, right = x // b, x % b
    for i in (range(ROUNDS - 1, -1, -1) if undo else range(ROUNDS)):
        v = ((right if i % 2 == 0 else left) + keys[:, i]) & MASK
        for factor, shift in MIX:
            v = (v * factor) & MASK
            v ^= v >> shift
        v = -v if undo else v
        if i % 2 == 0:
            left = (left + v) % a
        else:
            right = (right + v) % b
    return left * b + right


def permute(x: np.ndarray, n: int, epoch: np.ndarray, seed: int = SEED, undo: bool = False) -> np.ndarray:
    """Places of row numbers ``x`` (0 <= x < n) in the shuffles of their epochs; ``undo``: row numbers at places."""
    a, b = sides(n)
    kinds, which = np.unique(epoch, return_inverse=True)
    keys = np.array([[round_key(seed, int(e), i) for i in range(ROUNDS)] for e in kinds], np.int64).reshape(-1, ROUNDS)[which]
    x = _network(x.astype(np.int64), keys, a, b, undo)
    out = np.flatnonzero(x >= n)
    while len(out):
        x[out] = _network(x[out], keys[out], a, b, undo)
        out = out[x[out] >= n]
    return x


def _column(x: Column, n: int, epoch: Column, seed: int, undo: bool) -> Column:
    @pandas_udf("long")
    def run(v: pd.Series, e: pd.Series) -> pd.Series:
        return pd.Series(permute(v.to_numpy(), n, e.to_numpy(), seed, undo))

    return run(x.cast("bigint"), epoch.cast("int"))


def permuted(x: Column, n: int, epoch: Column, seed: int = SEED) -> Column:
    """The place of row number ``x`` (0 <= x < n) in the shuffle of ``epoch``."""
    return _column(x, n, epoch, seed, undo=False)


def row_at(place: Column, n: int, epoch: Column, seed: int = SEED) -> Column:
    """The row number at a place of an epoch's shuffle: the inverse of ``permuted``."""
    return _column(place, n, epoch, seed, undo=True)


def epoch_batches(rows: DataFrame, n: int, epochs: int, number: str = "idx", batch_size: int = BATCH_SIZE, grad_accum: int = GRAD_ACCUM,
                  seed: int = SEED) -> DataFrame:
    """BAT3 + BAT5: each row once an epoch, with epoch, batch_id, pos and update_step (null: its batch feeds no update).

    ``number``: the dense row number, 0 to n - 1.  No shuffle: an epoch is a column of it.
    """
    upe = step_summary(n, batch_size, grad_accum)["updates_per_epoch"]
    out = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    out = out.withColumn("_at", permuted(F.col(number), n, F.col("epoch"), seed))
    out = out.withColumn("batch_id", F.floor(F.col("_at") / F.lit(batch_size)).cast("bigint")).withColumn("pos", F.pmod("_at", F.lit(batch_size)).cast("bigint"))
    update = F.floor(F.col("batch_id") / F.lit(grad_accum)).cast("bigint")
    step = F.when(update < upe, F.col("epoch") * F.lit(upe) + update + 1).cast("bigint")
    return out.withColumn("update_step", step).drop("_at")


def remaining_rows(spark: SparkSession, n: int, epoch: int, step: int, batch_size: int = BATCH_SIZE, grad_accum: int = GRAD_ACCUM, seed: int = SEED) -> DataFrame:
    """(idx, batch_id, pos) still to come in ``epoch`` after ``step`` updates of it: places, turned back into row numbers."""
    first = min(n, step * grad_accum * batch_size)
    at = F.col("id")
    return spark.range(first, n).select(row_at(at, n, F.lit(epoch), seed).alias("idx"), F.floor(at / F.lit(batch_size)).cast("bigint").alias("batch_id"),
                                        F.pmod(at, F.lit(batch_size)).alias("pos"))
