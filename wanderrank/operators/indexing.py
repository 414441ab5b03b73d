"""Positions and running totals in an order, computed in parallel.

A window without ``partitionBy`` would move every row into one task, and one per
key would move a hot key there. Here the frame is range-partitioned by key and
order (a distributed sort), each row gets ``monotonically_increasing_id`` inside
its partition, and one small table of totals (one row per partition and key)
turns that into a position. The sorted frame is written to the shared checkpoint
folder first, so all passes read the same, already sorted rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wanderrank.session import broadcast_if_small, materialise


def index_by(df: DataFrame, *order_cols, out: str = "pos") -> DataFrame:
    """Add ``out`` = 1..n following ``order_cols`` (names or sort columns; must be
    a total order)."""
    tagged = materialise(df.orderBy(*order_cols)
                         .withColumn("_pid", F.spark_partition_id())
                         .withColumn("_mid", F.monotonically_increasing_id()), "ordered")
    parts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"), F.min("_mid").alias("_m0"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_pid", "_m0", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off"))
    # broadcast: one row per partition of ``tagged`` (bounded by the partition count)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_off") + (F.col("_mid") - F.col("_m0")) + 1)
            .drop("_pid", "_mid", "_m0", "_off"))


def running_total(df: DataFrame, keys: list[str], order: list[str], weight: Column, out: str) -> DataFrame:
    """Add ``out``: the sum of ``weight`` over the key's rows up to and including
    this one, in ``order`` (ascending, nulls first; a total order). A key's rows
    are summed per range partition, so a hot key is shared by many tasks."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialise(df.withColumn("_w", weight).repartitionByRange(parts, *keys, *order)
                       .sortWithinPartitions(*keys, *order)
                       .withColumn("_part", F.spark_partition_id())
                       .withColumn("_seq", F.monotonically_increasing_id()), "running")
    runs = rows.groupBy("_part", *keys).agg(F.sum("_w").alias("_t"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(F.col("_part").alias("_p"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                          F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    on = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        on &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = Window.partitionBy("_part", *keys).orderBy("_seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.withColumn("_in", F.sum("_w").over(inside))
    return (summed.join(broadcast_if_small(offsets, runs.count()), on)
            .withColumn(out, F.col("_off") + F.col("_in")).select(*df.columns, out))
