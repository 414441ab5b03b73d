"""Tracked-interaction ingest and running counts (Structured Streaming).

Every transformation here is a plain row or aggregate operator, so the same
function runs on a static DataFrame (batch, oracle-checked) and on a
streaming one (``readStream``). The streaming drivers add what a stream
needs: a watermark, de-duplication on the event id within it, and an
idempotent sink (``foreachBatch`` writes each micro-batch to its own folder,
so a replayed batch overwrites itself instead of duplicating rows).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wanderrank.sources.keyvalue import TTL_INTERACTIONS_DAYS, upsert_by_key

# ---- fixed values of the tracking endpoint ------------------------------------
DEFAULT_KIND = "view"
DEFAULT_SCORE = "0.2"
PLATFORM = "WebApp"


def _present(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c.cast("string")) != "")


def track_ingest(events: DataFrame, ts_col: str = "ts") -> tuple[DataFrame, DataFrame]:
    """Validate and normalise tracked interactions.

    Input columns: user_id, item_id, kind, score (text or number), ts.
    Accepted rows have user and item present; kind defaults to "view", score
    to 0.2 (text is parsed with ``try_cast``: bad text -> null); platform is
    stamped and ttl = ts + 30 days (epoch seconds). Rejected rows keep their
    columns plus a ``reason``.
    """
    ok = _present(F.col("user_id")) & _present(F.col("item_id"))
    score_txt = F.coalesce(F.col("score").cast("string"), F.lit(DEFAULT_SCORE))
    accepted = events.filter(ok).select(
        "user_id", "item_id",
        F.coalesce(F.col("kind"), F.lit(DEFAULT_KIND)).alias("kind"),
        score_txt.try_cast("double").alias("score"),
        F.col(ts_col).alias("ts"),
        F.lit(PLATFORM).alias("platform"),
        (F.unix_timestamp(F.col(ts_col).cast("timestamp"))
         + F.lit(TTL_INTERACTIONS_DAYS * 86400)).alias("ttl"),
    )
    rejected = events.filter(~ok).withColumn(
        "reason", F.when(~_present(F.col("user_id")), F.lit("missing user_id"))
        .otherwise(F.lit("missing item_id")))
    return accepted, rejected


def user_counts(interactions: DataFrame, window: str = "1 day", exact: bool = True) -> DataFrame:
    """stream_user_counts (batch form): per tumbling window and user, number
    of interactions and distinct items."""
    distinct = F.count_distinct("item_id") if exact else F.approx_count_distinct("item_id")
    return (interactions.groupBy(F.window("ts", window).alias("w"), "user_id")
            .agg(F.count(F.lit(1)).alias("n_interactions"), distinct.alias("n_items"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "user_id", "n_interactions", "n_items"))


def item_counts(interactions: DataFrame, window: str = "1 day", exact: bool = True) -> DataFrame:
    """Per tumbling window and item: number of interactions and distinct users."""
    distinct = F.count_distinct("user_id") if exact else F.approx_count_distinct("user_id")
    return (interactions.groupBy(F.window("ts", window).alias("w"), "item_id")
            .agg(F.count(F.lit(1)).alias("n_interactions"), distinct.alias("n_users"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "item_id", "n_interactions", "n_users"))


def stream_item_counts(stream: DataFrame, window: str = "1 day", watermark: str = "1 hour",
                       id_col: str = "interaction_id") -> DataFrame:
    """Streaming form of ``item_counts`` (as ``stream_user_counts``)."""
    s = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    return item_counts(s.dropDuplicatesWithinWatermark([id_col]), window, exact=False)


def stream_user_counts(stream: DataFrame, window: str = "1 day", watermark: str = "1 hour",
                       id_col: str = "interaction_id") -> DataFrame:
    """Streaming form: events later than the watermark are dropped (and
    reported in the query progress), repeats of an event id within the
    watermark are dropped, windows are emitted once final (append mode)."""
    s = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    s = s.dropDuplicatesWithinWatermark([id_col])
    return (s.groupBy(F.window("ts", window).alias("w"), "user_id")
            .agg(F.count(F.lit(1)).alias("n_interactions"),
                 F.approx_count_distinct("item_id").alias("n_items"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "user_id", "n_interactions", "n_items"))


def start_track_stream(spark: SparkSession, source_dir: str, schema, sink_dir: str,
                       checkpoint_dir: str, available_now: bool = True) -> StreamingQuery:
    """File source -> track_ingest -> Parquet (accepted) + Parquet (rejected).

    Each micro-batch is written to ``batch=<id>`` with overwrite: a batch
    replayed after a failure replaces its own output (exactly-once result)."""
    src = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(source_dir)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read by both writes
        acc, rej = track_ingest(batch)
        # the store overwrites on (user, timestamp): one row per key and batch
        acc = upsert_by_key(acc, ["user_id", "ts"], ["item_id", "kind", "score"])
        acc.write.mode("overwrite").parquet(os.path.join(sink_dir, "accepted", f"batch={batch_id}"))
        rej.write.mode("overwrite").parquet(os.path.join(sink_dir, "rejected", f"batch={batch_id}"))
        batch.unpersist()

    w = src.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
