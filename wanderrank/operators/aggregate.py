"""Aggregations and the user x item score matrix.

All aggregates are plain ``groupBy().agg()`` so Spark plans a partial
(map-side) aggregate before the shuffle: a hot user or item is collapsed to
one buffer per map task before it moves. Conditional counts are
``sum(when ... otherwise 0)`` and share one aggregate with the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanderrank import schemas
from wanderrank.functions.scalar import exact_avg


def _count_kind(kind: str):
    return F.sum(F.when(F.col("kind") == kind, 1).otherwise(0))


def agg_user_interactions(interactions: DataFrame) -> DataFrame:
    """Per user: count, mean score, book/review/like counts, distinct items,
    last interaction time."""
    return interactions.groupBy("user_id").agg(
        F.count("interaction_id").alias("total_interactions"),
        exact_avg(F.col("score")).alias("avg_score"),
        _count_kind("book").alias("total_book"),
        _count_kind("review").alias("total_review"),
        _count_kind("like").alias("total_like"),
        F.count_distinct("item_id").alias("unique_items"),
        F.max("ts").alias("last_interaction"),
    )


def agg_user_transactions(transactions: DataFrame, id_col: str = "txn_id") -> DataFrame:
    """Per user: count, mean / max spend, mean rating after visit, mean stay,
    completed count."""
    return transactions.groupBy("user_id").agg(
        F.count(id_col).alias("total_transactions"),
        exact_avg(F.col("paid")).alias("avg_spend"),
        F.max("paid").cast("double").alias("max_spend"),
        exact_avg(F.col("rating_after")).alias("avg_rating_given"),
        exact_avg(F.col("stay_nights")).alias("avg_stay"),
        F.sum("is_completed").alias("completed_transactions"),
    )


def agg_item_popularity(interactions: DataFrame) -> DataFrame:
    """Per item: views, mean score, distinct users, bookings, mean review
    rating (``when`` without ``otherwise``: non-review rows are ignored)."""
    return interactions.groupBy("item_id").agg(
        F.count("interaction_id").alias("total_views"),
        exact_avg(F.col("score")).alias("avg_interaction_score"),
        F.count_distinct("user_id").alias("unique_visitors"),
        _count_kind("book").alias("total_bookings"),
        exact_avg(F.when(F.col("kind") == "review", F.col("rating_given"))).alias("avg_user_rating"),
    )


def agg_item_revenue(transactions: DataFrame, id_col: str = "txn_id",
                     completed: str = schemas.COMPLETED) -> DataFrame:
    """Per item over completed bookings: revenue, count, mean value."""
    return (transactions.filter(F.col("status") == completed)
            .groupBy("item_id").agg(
                F.sum("paid").cast("double").alias("total_revenue"),
                F.count(id_col).alias("total_completed_bookings"),
                exact_avg(F.col("paid")).alias("avg_transaction_value"),
            ))


def union_all_signals(interactions: DataFrame, transactions: DataFrame,
                      completed: str = schemas.COMPLETED) -> DataFrame:
    """Interactions plus completed bookings as score 1.0, duplicates kept."""
    score_type = interactions.schema["score"].dataType
    a = interactions.select("user_id", "item_id", "score")
    b = (transactions.filter(F.col("status") == completed)
         .select("user_id", "item_id", F.lit(1.0).cast(score_type).alias("score")))
    return a.unionByName(b)


def interaction_matrix(signals: DataFrame, cap: float = 5.0) -> DataFrame:
    """Sparse user x item triples: summed score, signal count, score capped at 5."""
    return (signals.groupBy("user_id", "item_id")
            .agg(F.sum("score").alias("_total"), F.count(F.lit(1)).alias("interaction_count"))
            .select("user_id", "item_id",
                    F.col("_total").cast("double").alias("total_score"),
                    "interaction_count",
                    F.least(F.col("_total").cast("double"), F.lit(cap)).alias("final_score")))


def agg_user_counts(interactions: DataFrame) -> DataFrame:
    """Interactions (rows) per user: the ``n`` of the adaptive weights."""
    return interactions.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_interactions"))
