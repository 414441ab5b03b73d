"""Offline evaluation: precision@k and catalogue coverage over sampled users.

The reference samples up to 50 users at random, recommends 5 for each with no
preferences and compares them with the user's 5 highest-scored interactions.
As recommendations exclude seen items while the truth *is* seen items, the
precision is 0 by construction (``holdout="none"``, the regression check).
``holdout="last"`` removes each sampled user's last k interactions (by time)
from training and uses them as the truth, which gives a usable number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wanderrank.functions.scalar import first_present
from wanderrank.operators import ranking as R
from wanderrank.operators.collaborative import SCORE_CANDIDATES
from wanderrank.session import saved


def sample_users(train: DataFrame, n: int = 50, seed: int = 42) -> DataFrame:
    """Deterministic pseudo-random sample of distinct users: order by
    ``md5("<user>:<seed>")`` and keep ``n`` (a global top-n, merged from
    per-partition top-n's, never the whole user list in one task)."""
    key = F.md5(F.concat(F.col("user_id").cast("string"), F.lit(f":{seed}")))
    return (train.select("user_id").distinct().withColumn("_h", key)
            .orderBy("_h", "user_id").limit(n).drop("_h"))


def nlargest_true(train: DataFrame, users: DataFrame, k: int = 5,
                  score_col: str | None = None) -> DataFrame:
    """Items of the k highest-scored interaction rows per user (score desc,
    item id asc), as distinct (user_id, item_id)."""
    col = score_col or first_present(train, SCORE_CANDIDATES)
    w = Window.partitionBy("user_id").orderBy(F.col(col).desc(), F.col("item_id").asc())
    rows = train.join(users, "user_id", "left_semi").withColumn("_r", F.row_number().over(w))
    return rows.filter(F.col("_r") <= k).select("user_id", "item_id").distinct()


def intersect_hits(recs: DataFrame, truth: DataFrame) -> DataFrame:
    """join_self_hits: per user, number of recommended items in the truth set."""
    return (recs.select("user_id", "item_id").distinct()
            .join(truth, ["user_id", "item_id"], "inner")
            .groupBy("user_id").agg(F.count(F.lit(1)).alias("hits")))


def eval_precision_coverage(train: DataFrame, items: DataFrame, sample: int | None = 50, seed: int = 42,
                            k: int = 5, holdout: str = "none") -> DataFrame:
    """One row: precision_at_5, coverage (distinct recommended / catalogue
    rows), users_evaluated (rounded 4). ``sample=None``: every user (the
    source system takes 50)."""
    users = (train.select("user_id").distinct() if sample is None
             else sample_users(train, sample, seed)).transform(saved)
    if holdout == "last":
        ids = [F.col("interaction_id").desc()] if "interaction_id" in train.columns else []
        tw = Window.partitionBy("user_id").orderBy(F.col("ts").desc(), F.col("item_id").desc(), *ids)
        tagged = train.withColumn("_last", F.row_number().over(tw))
        held = tagged.join(users, "user_id", "left_semi").filter(F.col("_last") <= k)
        truth = held.select("user_id", "item_id").distinct()
        train = tagged.join(held.select("user_id", "_last"), ["user_id", "_last"], "left_anti").drop("_last")
    else:
        truth = nlargest_true(train, users, k)
    # read twice below: written once
    recs = R.recommend_batch(users.withColumn("top_n", F.lit(k)), train, items, max_top_n=None) \
        .select("user_id", "item_id").transform(saved)
    hits = intersect_hits(recs, truth)
    n_cat = items.select(F.count(F.lit(1))).scalar()
    per_user = users.join(hits, "user_id", "left").select(
        (F.coalesce("hits", F.lit(0)) / F.lit(float(k))).alias("p"))
    prec = per_user.agg(F.avg("p").alias("precision_at_5"), F.count(F.lit(1)).alias("users_evaluated"))
    n_rec = recs.select(F.count_distinct("item_id")).scalar()
    return prec.select(
        F.round(F.coalesce("precision_at_5", F.lit(0.0)), 4).alias("precision_at_5"),
        F.round(n_rec / F.greatest(n_cat, F.lit(1)), 4).alias("coverage"), "users_evaluated")
