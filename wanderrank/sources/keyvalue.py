"""Key-value table semantics on DataFrames: upsert, TTL, per-key ranges.

The source system keeps interactions, predictions and chat turns in a
key-value store (hash key + optional range key, TTL). Here those tables are
plain DataFrames / Parquet tables and the store's rules become relational
operators that run for all keys at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wanderrank.functions.scalar import key_concat

# ---- fixed values of the store ------------------------------------------
TTL_INTERACTIONS_DAYS = 30
TTL_PREDICTIONS_SECONDS = 86400
TTL_TURNS_DAYS = 7
RANGE_LIMIT = 20
LOGGED_RECS = 5
CATALOGUE_COLUMNS = ["item_id", "name", "category", "province", "rating", "price", "visit_hours"]


def upsert_by_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Put by primary key, last write wins: per key keep the row that is last
    in ``order`` (all descending; add a tie column to make it total).

    ``row_number() = 1`` gets a partial WindowGroupLimit before the shuffle, so
    a hot key ships one row per map task."""
    w = Window.partitionBy(*key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def expire_ttl(df: DataFrame, as_of: str, ts_col: str | None = None, days: float | None = None,
               ttl_col: str | None = None) -> DataFrame:
    """Drop rows whose expiry is before ``as_of`` (a row expiring exactly at
    ``as_of`` is kept, as the store deletes items whose ttl is older than now).

    Expiry is either an epoch-seconds ``ttl_col`` or ``ts_col + days``.
    """
    now = F.to_timestamp(F.lit(as_of))
    if ttl_col:
        return df.filter(F.col(ttl_col) >= F.unix_timestamp(now))
    secs = int(round(days * 86400))
    expiry = F.col(ts_col).cast("timestamp") + F.make_dt_interval(secs=F.lit(secs))
    return df.filter(expiry >= now)


def range_by_key(df: DataFrame, key: str, sort: list[str], limit: int = RANGE_LIMIT,
                 ascending: bool = True) -> DataFrame:
    """Rows of each key in sort-key order, first ``limit`` (for all keys at once)."""
    cols = [F.col(c).asc() if ascending else F.col(c).desc() for c in sort]
    w = Window.partitionBy(key).orderBy(*cols)
    return df.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= limit)


def catalogue_list(items: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Project the available catalogue columns; null text -> "" (numbers stay null)."""
    cols = [c for c in (columns or CATALOGUE_COLUMNS) if c in items.columns]
    df = items.select(*cols)
    text = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    return df.fillna("", subset=text) if text else df


LOGGED_FIELDS = ["rank", "item_id", "name", "category", "province", "rating", "price",
                 "hybrid_score", "cf_score", "cb_score", "weights"]


def prediction_log(recs: DataFrame, as_of: str, k: int = LOGGED_RECS,
                   ttl_seconds: int = TTL_PREDICTIONS_SECONDS,
                   latency_ms: Column | None = None) -> DataFrame:
    """One log row per user: ``user-epochsecond`` key, the first ``k``
    recommendations as JSON text (all eleven fields of a record), the stamp,
    the latency (text; null unless given) and a ttl.

    Two logs of one user in the same second share a key; ``upsert_by_key``
    keeps the latest."""
    epoch = F.unix_timestamp(F.to_timestamp(F.lit(as_of)))
    first = recs.filter(F.col("rank") <= k)
    weights = F.struct(F.col("w_cf").alias("cf"), F.col("w_cb").alias("cb")).alias("weights")
    entry = F.struct(*[weights if c == "weights" else F.col(c) for c in LOGGED_FIELDS])
    latency = F.lit(None) if latency_ms is None else latency_ms
    return (first.groupBy("user_id")
            .agg(F.array_sort(F.collect_list(entry)).alias("_recs"))
            .select(key_concat(F.col("user_id"), epoch).alias("prediction_id"),
                    "user_id",
                    F.to_json(F.col("_recs")).alias("recommendations"),
                    F.lit(as_of).alias("timestamp"),
                    latency.cast("string").alias("latency_ms"),
                    (epoch + F.lit(ttl_seconds)).alias("ttl")))
