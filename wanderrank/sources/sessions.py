"""The conversation store as a bucketed, sorted table: one session is one bucket, so a
session's range is read without a shuffle and a lookup opens one file group."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderrank.sources.keyvalue import RANGE_LIMIT, range_by_key

SESSION_BUCKETS = 64


def write_sessions(turns: DataFrame, table: str, path: str | None = None, buckets: int = SESSION_BUCKETS,
                   key: str = "session_id", order: str = "turn", mode: str = "overwrite") -> None:
    """Save ``turns`` as ``table``, bucketed by ``key`` and sorted by ``order`` inside a
    bucket. One task writes a bucket, so it is one file."""
    w = (turns.repartition(buckets, key).write.mode(mode).format("parquet")
         .bucketBy(buckets, key).sortBy(key, order))
    (w.option("path", path) if path else w).saveAsTable(table)


def session_range(spark: SparkSession, table: str, limit: int = RANGE_LIMIT, ascending: bool = True,
                  key: str = "session_id", order: str = "turn") -> DataFrame:
    """range_by_key of every session; the table's buckets take the place of a shuffle."""
    return range_by_key(spark.table(table), key, [order], limit, ascending)


def one_session(spark: SparkSession, table: str, session, key: str = "session_id") -> DataFrame:
    """The rows of one session: the filter selects its bucket."""
    return spark.table(table).where(F.col(key) == F.lit(session))
