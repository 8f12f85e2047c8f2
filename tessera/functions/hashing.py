"""Deterministic hash helpers that give the same answer in Spark and in SQL engines.

``md5`` text is the portable choice: ``rand(seed)`` and ``xxhash64`` differ
between engines and depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_key(seed: int, *parts) -> Column:
    """``md5('seed:part1:part2…')`` as a hex string — a uniform, portable sort key."""
    pieces = [F.lit(str(seed))]
    for p in parts:
        pieces.append(F.lit(":"))
        pieces.append((F.col(p) if isinstance(p, str) else p).cast("string"))
    return F.md5(F.concat(*pieces))


def md5_index(key: Column, k: int) -> Column:
    """``int(first 8 hex digits of md5(key)) % k`` as BIGINT."""
    head = F.substring(F.md5(key), 1, 8)
    return (F.conv(head, 16, 10).cast("bigint") % F.lit(k)).cast("bigint")
