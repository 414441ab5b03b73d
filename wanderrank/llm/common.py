"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderrank.session import BROADCAST_ROWS, broadcast_if_small, materialise, release, ship_package  # noqa: F401

# A word is a maximal run of characters outside space and \t \n \v \f \r.
WORD_JAVA = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# Rows of an Arrow batch at most: texts can be long, and an executor's memory
# holds a batch per Python worker more than once.
ARROW_ROWS = 2_000


def with_package(spark: SparkSession) -> None:
    """Before a stage with Python: workers must be able to import this package,
    and batches stay small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, str(min(ARROW_ROWS, int(spark.conf.get(key)))))
    ship_package(spark)


def trim_memory() -> None:
    """In a Python worker: give memory that Arrow and the C heap keep for later
    back, as the worker outlives its stage and shares the executor's memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def span_text(spans: Column) -> Column:
    """array<struct<kind, start, end>> -> 'kind:start:end,...'."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                 s["end"].cast("string"))), ",")
