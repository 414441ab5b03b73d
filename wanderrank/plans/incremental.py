"""The ETL's aggregates as mergeable states, so a weekly run reads only its new rows.

A state holds sums, counts and maxima per key, and (user, item) pairs; counts of
distinct items or users are counts of pairs. States of a new run's rows are
folded into the stored ones (a grouped sum of small rows); old raw data is not
read again. ``finish`` gives the same tables as ``operators.aggregate``. An id that
was folded must not come again in a later run: ``new_rows`` drops such rows, the
first version stays.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanderrank import schemas
from wanderrank.operators import aggregate as A

KEYS = {"user_events": ["user_id"], "item_events": ["item_id"], "pairs": ["user_id", "item_id"],
        "user_payments": ["user_id"], "item_payments": ["item_id"]}
MAXIMA = {"last_interaction", "max_spend"}  # everything else is added


def _sum(df: DataFrame, c: str, of: Column | None = None) -> Column:
    """A sum whose type does not grow when sums are added again."""
    t = df.schema[c].dataType
    s = F.sum(F.col(c) if of is None else of)
    return s.cast(T.DecimalType(38, t.scale)) if isinstance(t, T.DecimalType) else s


def partial_states(interactions: DataFrame, transactions: DataFrame, txn_id: str = "txn_id",
                   completed: str = schemas.COMPLETED) -> dict[str, DataFrame]:
    """The states of one run's cleaned rows."""
    i, t = interactions, transactions
    kind = lambda k: F.sum((F.col("kind") == k).cast("long"))
    review = F.when(F.col("kind") == "review", F.col("rating_given"))
    done = t.where(F.col("status") == completed)
    signals = A.union_all_signals(i, t, completed)
    events = i.select("user_id", "item_id", F.lit(0).cast(i.schema["score"].dataType).alias("score"),
                      F.lit(0).alias("s"), F.lit(1).alias("e"))
    pairs = signals.select("user_id", "item_id", "score", F.lit(1).alias("s"), F.lit(0).alias("e")).unionByName(events)
    return {
        "user_events": i.groupBy("user_id").agg(
            F.count("interaction_id").alias("n"), _sum(i, "score").alias("score"), F.count("score").alias("score_n"),
            kind("book").alias("book"), kind("review").alias("review"), kind("like").alias("like"),
            F.max("ts").alias("last_interaction")),
        "item_events": i.groupBy("item_id").agg(
            F.count("interaction_id").alias("n"), _sum(i, "score").alias("score"), F.count("score").alias("score_n"),
            kind("book").alias("book"), _sum(i, "rating_given", review).alias("rating"), F.count(review).alias("rating_n")),
        "pairs": pairs.groupBy("user_id", "item_id").agg(
            _sum(pairs, "score").alias("score"), F.sum("s").alias("signals"), F.sum("e").alias("events")),
        "user_payments": t.groupBy("user_id").agg(
            F.count(txn_id).alias("n"), _sum(t, "paid").alias("paid"), F.count("paid").alias("paid_n"),
            F.max("paid").alias("max_spend"), _sum(t, "rating_after").alias("rating"), F.count("rating_after").alias("rating_n"),
            F.sum("stay_nights").alias("stay"), F.count("stay_nights").alias("stay_n"), F.sum("is_completed").alias("completed")),
        "item_payments": done.groupBy("item_id").agg(
            _sum(done, "paid").alias("paid"), F.count("paid").alias("paid_n"), F.count(txn_id).alias("n")),
    }


def fold(old: dict[str, DataFrame] | None, new: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Stored states and those of a new run, added per key."""
    if old is None:
        return new
    out = {}
    for name, keys in KEYS.items():
        both = old[name].unionByName(new[name])
        out[name] = both.groupBy(*keys).agg(*[
            (F.max(c) if c in MAXIMA else _sum(both, c)).alias(c) for c in both.columns if c not in keys])
    return out


def _mean(total: str, n: str) -> Column:
    return F.when(F.col(n) > 0, F.col(total).cast("double") / F.col(n))


def finish(states: dict[str, DataFrame], cap: float = 5.0) -> dict[str, DataFrame]:
    """States -> the aggregate tables and the matrix of ``operators.aggregate``."""
    pairs = states["pairs"]
    seen = pairs.where("events > 0")
    of_user = seen.groupBy("user_id").agg(F.count("item_id").alias("unique_items"))
    of_item = seen.groupBy("item_id").agg(F.count("user_id").alias("unique_visitors"))
    total = F.col("score").cast("double")
    return {
        "agg_user_interactions": states["user_events"].join(of_user, "user_id", "left").select(
            "user_id", F.col("n").alias("total_interactions"), _mean("score", "score_n").alias("avg_score"),
            F.col("book").alias("total_book"), F.col("review").alias("total_review"), F.col("like").alias("total_like"),
            F.coalesce("unique_items", F.lit(0).cast("long")).alias("unique_items"), "last_interaction"),
        "agg_item_popularity": states["item_events"].join(of_item, "item_id", "left").select(
            "item_id", F.col("n").alias("total_views"), _mean("score", "score_n").alias("avg_interaction_score"),
            F.coalesce("unique_visitors", F.lit(0).cast("long")).alias("unique_visitors"),
            F.col("book").alias("total_bookings"), _mean("rating", "rating_n").alias("avg_user_rating")),
        "agg_user_transactions": states["user_payments"].select(
            "user_id", F.col("n").alias("total_transactions"), _mean("paid", "paid_n").alias("avg_spend"),
            F.col("max_spend").cast("double").alias("max_spend"), _mean("rating", "rating_n").alias("avg_rating_given"),
            _mean("stay", "stay_n").alias("avg_stay"), F.col("completed").alias("completed_transactions")),
        "agg_item_revenue": states["item_payments"].select(
            "item_id", F.col("paid").cast("double").alias("total_revenue"), F.col("n").alias("total_completed_bookings"),
            _mean("paid", "paid_n").alias("avg_transaction_value")),
        "interaction_matrix": pairs.where("signals > 0").select(
            "user_id", "item_id", total.alias("total_score"), F.col("signals").alias("interaction_count"),
            F.least(total, F.lit(cap)).alias("final_score")),
    }


def new_rows(rows: DataFrame, folded_ids: DataFrame, key: list[str]) -> DataFrame:
    """The rows whose id no earlier run has folded."""
    return rows.join(folded_ids.select(*key), key, "left_anti")


def run_increment(spark: SparkSession, path: str, run: int, interactions: DataFrame, transactions: DataFrame,
                  txn_key: list[str]) -> dict[str, DataFrame]:
    """One weekly run: fold the new cleaned rows into the states of the newest
    earlier run under ``path`` and write them, with the ids folded so far, as
    ``run=<run>``. A run done again starts from the run before it and overwrites
    its own folder, so it counts once."""
    p = lambda n, r: os.path.join(path, f"run={r}", n)
    earlier = [r["run"] for r in _runs(spark, path).where(F.col("run") < run).collect()]  # one small row per run
    old = None
    i_new, t_new = interactions, transactions
    if earlier:
        last = max(earlier)
        old = {name: spark.read.parquet(p(name, last)) for name in KEYS}
        i_new = new_rows(interactions, spark.read.parquet(*[p("interaction_ids", r) for r in sorted(earlier)]), ["interaction_id"])
        t_new = new_rows(transactions, spark.read.parquet(*[p("transaction_ids", r) for r in sorted(earlier)]), txn_key)
    states = fold(old, partial_states(i_new, t_new, txn_key[0]))
    i_new.select("interaction_id").write.mode("overwrite").parquet(p("interaction_ids", run))
    t_new.select(*txn_key).write.mode("overwrite").parquet(p("transaction_ids", run))
    out = {}
    for name, df in states.items():
        df.write.mode("overwrite").parquet(p(name, run))
        out[name] = spark.read.parquet(p(name, run))
    spark.range(1).select(F.lit(run).cast("long").alias("run")).coalesce(1).write.mode("overwrite") \
        .parquet(os.path.join(path, "done", str(run)))
    return out


def _runs(spark: SparkSession, path: str) -> DataFrame:
    """The runs that were written to their end."""
    from wanderrank.sources.files import scan_parquet_dir
    return scan_parquet_dir(spark, os.path.join(path, "done"), T.StructType([T.StructField("run", T.LongType())]), recurse=True)
