"""Sinks: Parquet tables, the metric/value summary, model metadata."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sink_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a Parquet folder (optionally partitioned)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def summary_frame(spark: SparkSession, metrics: list[tuple[str, object]]) -> DataFrame:
    """Two string columns (metric, value) from already computed scalars."""
    return spark.createDataFrame([(k, str(v)) for k, v in metrics], "metric string, value string")


def sink_summary(df: DataFrame, path: str) -> None:
    """The summary table as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def sink_metadata(spark: SparkSession, path: str, metadata: dict) -> None:
    """Model metadata (version, trained_at, metrics, counts, algorithms) as
    one JSON record."""
    df = spark.createDataFrame([(json.dumps(metadata, sort_keys=True),)], "value string")
    df.coalesce(1).write.mode("overwrite").text(path)


def summary_counts(named: dict[str, DataFrame]) -> DataFrame:
    """(metric, value) rows counting each frame, as one union of aggregates
    (one job)."""
    parts = [df.select(F.lit(name).alias("metric"), F.count(F.lit(1)).cast("string").alias("value"))
             for name, df in named.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
