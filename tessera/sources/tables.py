"""Table scans.  SRC6 SRC7 SRC8 SRC10

Readers are lazy; filters and projections applied by callers reach the scan
(``PushedFilters`` / ``ReadSchema``) and split directories are pruned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import py_strip
from ..session import reliable_checkpoint

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


class MissingDatasetError(FileNotFoundError):
    """SRC7: the dataset folder does not exist."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Spread a small input over the cores.

    A Parquet file is read in row-group units: a file with one row group is
    read by one task however many splits it has, and every narrow stage after
    the scan (quality rules, encoding) then runs on one core.  When the scan
    has fewer splits than the default parallelism (so it is smaller than
    about one ``maxPartitionBytes`` per core), rows are redistributed
    (deterministically, by a hash of the first column) over that many
    partitions and written to the checkpoint folder.  Large inputs have many
    row groups and are returned unchanged.  Used for the document table, whose per-row text work is the
    CPU-heavy part; inputs that go straight into a shuffle do not need it.
    """
    sc = df.sparkSession.sparkContext
    target = sc.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    # Written once (small by construction: fewer splits than cores).  The written
    # copy is also an optimizer barrier: later filters would otherwise be pushed
    # below the repartition and run in the scan's single task.
    return reliable_checkpoint(df.repartition(target, F.col(df.columns[0])))


def _guard(fn, path: str):
    try:
        return fn()
    except AnalysisException as e:  # path errors are raised eagerly at resolution
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise MissingDatasetError(path) from e
        raise


def read_splits(spark: SparkSession, path: str, splits: Sequence[str] | None = None) -> DataFrame:
    """SRC6: a saved split dataset; ``splits`` prunes partition folders."""
    df = _guard(lambda: spark.read.parquet(path), path)
    return df if not splits else df.where(F.col("split").isin(list(splits)))


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC8: stripped, non-blank lines of text files (column ``text``)."""
    df = _guard(lambda: spark.read.text(path), path)
    stripped = df.select(py_strip(F.col("value")).alias("text"))
    return stripped.where(F.length("text") > 0)


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """SRC10: stats JSON written by ``write_stats``."""
    return _guard(lambda: spark.read.json(path), path)
