"""Session helpers: a local session for tests/bench and a reliable checkpoint.

On a cluster the session is built by the launcher; we only read its settings.
``spark.checkpoint.dir`` must name a shared (HDFS/S3/ABFS) folder there.  A
private temporary folder is chosen only when the setting is unset, which is the
case in local tests.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Size of a row group (before compression) in staged Parquet: what one task reads at least.
STAGED_GROUP_BYTES = 16 << 20


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "tessera") -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on, UTC)."""
    n = shuffle_partitions or (8 if cores == "*" else max(2, int(cores) * 2))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEM", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting a private one only if none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # not set
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (HDFS/S3/ABFS)")
        # Local mode only (tests, bench): nothing configured, so take a fresh private folder.
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage by writing to the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged_parquet(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing Parquet to the shared checkpoint folder and reading it back.

    Unlike a checkpoint of rows the copy is compressed, and later reads take only the columns they need.
    Row groups are small, so that a file of a large partition is read by several tasks.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("parquet.block.size", STAGED_GROUP_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let the driver forget finished steps: plans and broadcasts that nothing refers to any more.

    Spark's context cleaner removes the broadcasts and shuffle files of objects that the JVM has collected; a long
    job with a roomy heap may not collect for a long time.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by Python workers (the in-code form of ``--py-files``).

    Functions defined at module level (pandas UDFs, Arrow mappers) are pickled
    by reference, so executors must be able to import ``tessera``.  The package
    is zipped once per SparkContext on the driver and shipped with
    ``addPyFile``; Spark copies it to every executor.
    """
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out_dir = tempfile.mkdtemp(prefix="tessera-pkg-")  # driver-side staging; Spark ships the file
    path = os.path.join(out_dir, "tessera.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(key)
