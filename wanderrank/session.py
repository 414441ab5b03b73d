"""Spark session helpers.

The library never builds a session itself; jobs receive one. ``local_session``
exists for tests, the benchmark and the command line only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job relies on: UTC wall clock so that timestamp_ntz columns,
# windows and watermarks agree with the oracle, and AQE for runtime
# coalescing / skew-join splitting.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def _driver_memory() -> str:
    """Half of the machine's memory, at most 8 GiB (local mode: one JVM)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(1, min(8, int(total / 2**30 / 2)))}g"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "wanderrank") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", _driver_memory())
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="wr-wh-"))
    )
    for k, v in CORE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is set by the operator (a shared file system);
    it is read from the session and never replaced. Only when it is unset on a
    local master (tests, a laptop) a fresh local folder is chosen; on a
    cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(path)
        return path
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                           "(a machine-local folder does not survive executor loss)")
    path = tempfile.mkdtemp(prefix="wr-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of written intermediates, on whatever file system it is."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the cluster's shared checkpoint folder and
    read it back: cuts the lineage, survives lost executors, stays columnar (later
    readers prune columns and see sizes). ``release`` removes the files once the
    last reader is done."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{spark.sparkContext.applicationId}-{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._scratch = path
    return back


def saved(df: DataFrame) -> DataFrame:
    """``materialise`` for ``DataFrame.transform``."""
    return materialise(df, "saved")


def release(*frames: DataFrame) -> None:
    """Remove the files of ``materialise`` results that nothing reads any more."""
    for df in frames:
        if path := getattr(df, "_scratch", None):
            delete_path(df.sparkSession, path)
            df._scratch = None


# Largest table that a query may broadcast. Callers count rows first.
BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when the counted ``rows`` are within ``limit``;
    a larger side is joined by a shuffle."""
    return F.broadcast(df) if rows <= limit else df


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the Python workers that run pandas-UDF
    tasks: zip its modules once per application and ``addPyFile`` it (Spark
    ships the file to every executor). Harmless when the package is already
    installed on the workers or passed with ``--py-files``."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    pkg = os.path.join(root, "wanderrank")
    zpath = os.path.join(tempfile.mkdtemp(prefix="wr-pyfiles-"), "wanderrank.zip")
    with zipfile.ZipFile(zpath, "w") as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)
