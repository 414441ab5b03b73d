"""Balanced contiguous shards from global byte-size prefix sums (native).

Rows are range-partitioned by a total order. One total per partition, summed
over the partitions before it, turns a row's offset inside its partition into
its offset in the whole corpus. Equal byte targets cut that global axis, so a
shard is a contiguous run of the order and all shards hold nearly the same
number of bytes, whatever the size distribution. Only one row per partition
passes a single task; no group of rows does.

Defined results: a null size counts as 0; a row goes to the shard that holds
its middle byte, so a shard misses its target by at most one row on each side;
rows that tie on every order column are equal for the result; an empty table
gives no rows; other columns are carried through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wanderrank.llm.common import materialise, shuffle_partitions

ROW_OVERHEAD_BYTES = 8


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus the fixed row overhead."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(ROW_OVERHEAD_BYTES)).cast("long")


def byte_shards(df: DataFrame, n_shards: int, size: str, order: list[str]) -> DataFrame:
    """``df`` plus ``shard`` (0 .. n_shards-1) and ``slot`` (gapless from 0 in
    each shard, in ``order``); columns of these names are replaced. Names
    starting with ``_bs_`` are reserved."""
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    df = df.drop(*[c for c in ("shard", "slot") if c not in (size, *order)])
    parts = shuffle_partitions(df.sparkSession)
    ordered = (df.withColumn("_bs_tie", F.monotonically_increasing_id())
               .repartitionByRange(parts, *order, "_bs_tie")
               .sortWithinPartitions(*order, "_bs_tie")
               .drop("_bs_tie")
               .withColumn("_bs_part", F.spark_partition_id())
               .withColumn("_bs_seq", F.monotonically_increasing_id()))
    rows = materialise(ordered, "byte-shards")
    weight = F.coalesce(F.col(size), F.lit(0)).cast("long")
    # one row per partition
    before = Window.orderBy("_bs_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_bs_part").rowsBetween(Window.unboundedPreceding,
                                                        Window.unboundedFollowing)
    totals = (rows.groupBy("_bs_part")
              .agg(F.sum(weight).alias("_bs_b"), F.count(F.lit(1)).alias("_bs_n")))
    offsets = totals.select(
        "_bs_part",
        F.coalesce(F.sum("_bs_b").over(before), F.lit(0)).alias("_bs_b0"),
        F.coalesce(F.sum("_bs_n").over(before), F.lit(0)).alias("_bs_n0"),
        F.sum("_bs_b").over(everything).alias("_bs_total"))
    inside = Window.partitionBy("_bs_part").orderBy("_bs_seq")
    placed = (rows
              .withColumn("_bs_in", F.coalesce(F.sum(weight).over(
                  inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("_bs_rn", F.row_number().over(inside) - 1)
              .join(F.broadcast(offsets), "_bs_part")
              .withColumn("_bs_mid", 2 * (F.col("_bs_b0") + F.col("_bs_in")) + weight)
              .withColumn("shard", F.least(
                  F.lit(n_shards - 1),
                  F.expr(f"(_bs_mid * {n_shards}L) div greatest(2L * _bs_total, 1L)")).cast("int"))
              .withColumn("_bs_at", F.col("_bs_n0") + F.col("_bs_rn")))
    first = placed.groupBy("shard").agg(F.min("_bs_at").alias("_bs_first"))  # n_shards rows
    out = (placed.join(F.broadcast(first), "shard")
           .withColumn("slot", (F.col("_bs_at") - F.col("_bs_first")).cast("long")))
    return out.select(*df.columns, "shard", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order."""
    n = sharded.sparkSession.conf.get("spark.sql.shuffle.partitions")
    (sharded.repartitionByRange(int(n), "shard", "slot")
     .sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def shard_documents(documents: DataFrame, n_shards: int = 24) -> DataFrame:
    """Digest rows of ``op6_byte_shards`` (the order is doc_id)."""
    text = F.col("text")
    narrow = documents.select(
        "doc_id", text_bytes(text).alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).cast("long").alias("text_crc32"))
    out = byte_shards(narrow, n_shards, "size", ["doc_id", "size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
