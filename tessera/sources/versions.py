"""Committed versions of a data set (SNK1, SNK3, SRC7): staged data, a manifest published last.

A write puts its files into a new folder of its own and then publishes one small manifest
row: version, folder, parameter fingerprint, rows and content sums a part.  Readers take
the newest manifest's folder, so a write that dies half way, or whose manifest is not there
yet, changes nothing for them, and a running reader keeps the files of its version.
Counts and sums are observed on the writing pass itself (no second scan); ``verify``
compares them with what is stored.

A step is skipped only if the committed version was made with the same fingerprint: the
step's parameters, its schema, and the fingerprints of the versions it read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .tables import MissingDatasetError

MANIFEST = "version long, data string, fingerprint string, params string, rows long, content string, parts array<struct<part:string,rows:long,content:string>>"


def fingerprint(params: dict, schema: str = "", inputs: Sequence[str] = ()) -> str:
    """SHA-256 of the parameters (in any order), the schema and the inputs' fingerprints."""
    return hashlib.sha256(json.dumps([params, schema, list(inputs)], sort_keys=True, default=str).encode()).hexdigest()


def _row_hash(df: DataFrame) -> Column:
    """A hash of all columns by name, in any row or column order."""
    return F.xxhash64(*[F.col(f"`{c}`").cast("string") if t.startswith("map") else F.col(f"`{c}`") for c, t in sorted(df.dtypes)]).cast("decimal(38,0)")


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """All committed versions, oldest first (empty where nothing was committed)."""
    try:
        return spark.read.schema(MANIFEST).json(f"{root.rstrip('/')}/_versions/*/*.json").orderBy("version", "data")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], MANIFEST)
        raise


def latest(spark: SparkSession, root: str):
    """The newest committed manifest, or None."""
    return manifests(spark, root).orderBy(F.desc("version"), F.desc("data")).first()


def publish(df: DataFrame, root: str, params: dict, parts: Sequence[str] = (), partition_by: str = "split", inputs: Sequence[str] = ()) -> int:
    """Write a new version and commit it; returns its number.

    ``parts``: the values of ``partition_by`` whose rows and sums are kept apart (one aggregate each, so a handful).
    """
    spark, root = df.sparkSession, root.rstrip("/")
    last = latest(spark, root)
    version = 1 + (last["version"] if last else 0)
    data = f"{root}/data/{version:06d}-{uuid.uuid4().hex[:12]}"
    h, key = _row_hash(df), F.col(partition_by)
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows"), F.sum(h).alias("content")]
    for i, p in enumerate(parts):
        metrics += [F.count_if(key == p).alias(f"rows{i}"), F.sum(F.when(key == p, h)).alias(f"content{i}")]
    df.observe(seen, *metrics).write.partitionBy(partition_by).parquet(data)
    got = seen.get
    row = (version, data, fingerprint(params, df.schema.simpleString(), inputs), json.dumps(params, sort_keys=True, default=str), got["rows"], str(got["content"] or 0),
           [(p, got[f"rows{i}"], str(got[f"content{i}"] or 0)) for i, p in enumerate(parts)])
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.json(f"{root}/_versions/{data.rsplit('/', 1)[-1]}")  # the commit
    return version


def publish_if_changed(df: DataFrame, root: str, params: dict, parts: Sequence[str] = (), partition_by: str = "split", inputs: Sequence[str] = ()) -> bool:
    """SNK3: write unless the newest committed version has the same fingerprint; returns whether it wrote."""
    last = latest(df.sparkSession, root)
    if last and last["fingerprint"] == fingerprint(params, df.schema.simpleString(), inputs):
        return False
    publish(df, root, params, parts, partition_by, inputs)
    return True


def read_committed(spark: SparkSession, root: str, version: int | None = None, parts: Sequence[str] | None = None, partition_by: str = "split") -> DataFrame:
    """The newest committed version (or ``version``), pruned to ``parts``; MissingDatasetError if there is none."""
    found = manifests(spark, root)
    row = found.where(F.col("version") == version).first() if version else latest(spark, root)
    if row is None:
        raise MissingDatasetError(root)
    df = spark.read.parquet(row["data"])
    return df.where(F.col(partition_by).isin(list(parts))) if parts else df


def verify(spark: SparkSession, root: str, version: int | None = None) -> bool:
    """Whether the stored rows have the committed count and content sum."""
    row = manifests(spark, root).where(F.col("version") == version).first() if version else latest(spark, root)
    if row is None:
        raise MissingDatasetError(root)
    df = spark.read.parquet(row["data"])
    got = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_hash(df)).alias("s")).first()
    return got["n"] == row["rows"] and str(got["s"] or 0) == row["content"]
