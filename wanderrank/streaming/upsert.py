"""Last write wins per key for a stream, in key-hash buckets.

The table is ``data/upsert_bucket=<b>/upsert_version=<batch>``. A micro-batch reads and rewrites only
the buckets of its own keys (dynamic partition overwrite), then writes a map of
``buckets`` rows, bucket -> version, as its commit. Readers follow the newest map,
so they never see half a batch, and a batch replayed after a failure starts from
the map before it and overwrites its own versions: the result is exactly-once.
The last ``keep`` maps and the versions they name stay; older ones are removed.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wanderrank.session import delete_path
from wanderrank.sources.keyvalue import expire_ttl, upsert_by_key

BUCKETS = 64
KEEP = 2
BUCKET, VERSION = "upsert_bucket", "upsert_version"  # partition columns; a stream must not have them


def _commits(spark: SparkSession, path: str, before: int | None = None) -> dict[int, dict[int, int]]:
    """commit -> (bucket -> version); at most a few maps of ``buckets`` rows."""
    try:
        df = spark.read.schema("bucket int, version long, batch long").parquet(os.path.join(path, "commits"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    out: dict[int, dict[int, int]] = {}
    for r in df.collect():
        if before is None or r["batch"] < before:
            out.setdefault(r["batch"], {})[r["bucket"]] = r["version"]
    return out


def _read(spark: SparkSession, path: str, where: dict[int, int], schema=None) -> DataFrame:
    """The rows of the given bucket versions: a filter on partition columns only."""
    by_version: dict[int, list[int]] = {}
    for bucket, v in where.items():
        by_version.setdefault(v, []).append(bucket)
    keep = F.lit(False)
    for v, buckets in by_version.items():
        keep |= (F.col(VERSION) == v) & F.col(BUCKET).isin(buckets)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(os.path.join(path, "data")).where(keep).drop(BUCKET, VERSION)


def current_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as of the newest commit, or None before the first."""
    commits = _commits(spark, path)
    return _read(spark, path, commits[max(commits)]) if commits else None


def upsert_batch(batch: DataFrame, batch_id: int, path: str, key: list[str], order: list[str],
                 ttl: tuple[str, str] | None = None, buckets: int = BUCKETS, keep: int = KEEP) -> list[int]:
    """Merge one micro-batch; returns the buckets that were rewritten."""
    spark = batch.sparkSession
    if clash := {BUCKET, VERSION} & set(batch.columns):
        raise ValueError(f"reserved column names: {sorted(clash)}")
    rows = batch.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")).persist()
    try:
        touched = sorted(r[BUCKET] for r in rows.select(BUCKET).distinct().collect())  # at most ``buckets``
        commits = _commits(spark, path, before=batch_id)
        current = commits[max(commits)] if commits else {}
        prior = {b: current[b] for b in touched if b in current}
        new = rows.drop(BUCKET)
        if prior:
            new = _read(spark, path, prior, T.StructType([*rows.schema.fields, T.StructField(VERSION, T.LongType())])).unionByName(new)
        out = upsert_by_key(new, key, order)
        if ttl:
            out = expire_ttl(out, ttl[1], ttl_col=ttl[0])
        if touched:
            (out.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
             .withColumn(VERSION, F.lit(batch_id).cast("long"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(BUCKET, VERSION).parquet(os.path.join(path, "data")))
        current = current | {b: batch_id for b in touched}
        spark.createDataFrame([(b, v) for b, v in current.items()], "bucket int, version long") \
            .coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "commits", f"batch={batch_id}"))
    finally:
        rows.unpersist()
    commits = {**commits, batch_id: current}
    kept = sorted(commits)[-keep:]
    live = {(b, v) for c in kept for b, v in commits[c].items()}
    for c in set(commits) - set(kept):
        for b, v in set(commits[c].items()) - live:
            delete_path(spark, os.path.join(path, "data", f"{BUCKET}={b}", f"{VERSION}={v}"))
        delete_path(spark, os.path.join(path, "commits", f"batch={c}"))
    return touched


def start_upsert_stream(spark: SparkSession, stream: DataFrame, path: str, key: list[str], order: list[str],
                        checkpoint_dir: str, ttl: tuple[str, str] | None = None, available_now: bool = True,
                        buckets: int = BUCKETS, keep: int = KEEP) -> StreamingQuery:
    """upsert_by_key for a stream: every micro-batch through ``upsert_batch`` (and
    ``expire_ttl`` of the touched buckets when ``ttl=(ttl_col, as_of)``)."""
    w = stream.writeStream.foreachBatch(
        lambda batch, i: upsert_batch(batch, i, path, key, order, ttl, buckets, keep) and None)
    w = w.option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
