"""Exact order statistics by distributed selection, and the three-way split as a column comparison (SPL1).

The k-th smallest of n hash keys needs no sort: a histogram of the keys' first digits
says which bucket holds it, a histogram inside that bucket says which smaller one, and
so on until a bucket is small enough to look at.  Each pass is one narrow aggregation
with partial counts; ``16 ** DIGITS`` counts a rank reach the driver.  With uniform keys a
bucket shrinks by that factor each pass, so 10 billion rows take two passes and a look.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import HOLDOUT_PERCENT, SEED
from ..functions.hashing import seeded_key
from .ordinal import split_sizes

DIGITS = 3
SMALL = 4_096


def selection_key(id_col: str, seed: int = SEED) -> Column:
    """The seeded shuffle key as hex digits: md5 of the id, then the id (a non-negative long) as tie-breaker."""
    return F.concat(seeded_key(seed, id_col), F.lpad(F.lower(F.hex(F.col(id_col))), 16, "0"))


def order_statistics(keys: DataFrame, col: str, ranks: Sequence[int], digits: int = DIGITS, small: int = SMALL) -> list[str]:
    """The keys (hex strings of one length) at 0-based ``ranks``; equal keys count each."""
    state = {r: ("", r, None) for r in ranks}  # rank -> prefix, rank inside it, rows in it
    out: dict[int, str] = {}
    while state:
        prefixes = sorted({p for p, _, _ in state.values()})
        width = len(prefixes[0]) + digits
        inside = keys.where(F.substring(col, 1, len(prefixes[0])).isin(prefixes)) if prefixes[0] else keys
        counts = inside.groupBy(F.substring(col, 1, width).alias("p")).count().collect()  # 16 ** digits a prefix
        for r, (prefix, left, _) in list(state.items()):
            for p, n in sorted((x["p"], x["count"]) for x in counts if x["p"].startswith(prefix)):
                if left < n:
                    state[r] = (p, left, n)
                    break
                left -= n
            else:
                raise IndexError(f"rank {r} is beyond the keys")
        for p, n in {(p, n) for p, _, n in state.values()}:
            here = [r for r, s in state.items() if s[0] == p]
            if n <= small or len(p) < width:  # few rows, or all digits read: equal keys
                found = ([x[0] for x in keys.where(F.substring(col, 1, len(p)) == p).select(col).orderBy(col).collect()] if n <= small else None)
                for r in here:
                    out[r] = found[state[r][1]] if found else p
                    del state[r]
    return [out[r] for r in ranks]


def split_bounds(keys: DataFrame, col: str, holdout_pct: int = HOLDOUT_PERCENT) -> tuple[str, str]:
    """(largest key of the test split, largest key held out); '' where a split is empty."""
    n = keys.count()
    _, validation, test = split_sizes(n, holdout_pct)
    ranks = sorted({k - 1 for k in (test, test + validation) if k})
    found = dict(zip(ranks, order_statistics(keys, col, ranks)))
    return found.get(test - 1, ""), found.get(test + validation - 1, "")


def split_by_bounds(key: Column, bounds: tuple[str, str]) -> Column:
    """SPL1 as a comparison: the same split as by the rank of the key."""
    return (F.when(key <= F.lit(bounds[0]), F.lit("test")).when(key <= F.lit(bounds[1]), F.lit("validation")).otherwise(F.lit("train")))
