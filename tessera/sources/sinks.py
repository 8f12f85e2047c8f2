"""Sinks.  SNK1 SNK2 SNK3"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def write_splits(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK1: one folder, one sub-folder per split (later reads prune by split)."""
    df.write.mode(mode).partitionBy("split").parquet(path)


def write_stats(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK2: a small stats DataFrame as JSON in its own folder (next to, not inside, the data)."""
    df.coalesce(1).write.mode(mode).json(path)


def dataset_exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished data set lies at the path; only a missing path counts as absent."""
    try:
        spark.read.parquet(path).schema  # resolves files only
        return True
    except AnalysisException as e:
        if any(x in str(e) for x in ("PATH_NOT_FOUND", "Path does not exist", "UNABLE_TO_INFER_SCHEMA")):
            return False
        raise


def stats_exist(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.text(path).head(1))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return False
        raise


def write_if_absent(df: DataFrame, path: str) -> bool:
    """SNK3: write only when nothing is there yet; returns whether it wrote."""
    if dataset_exists(df.sparkSession, path):
        return False
    write_splits(df, path, mode="ignore")
    return True
