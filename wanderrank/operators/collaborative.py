"""Collaborative scores: user mean (the shipped default) and factorization.

The training table is any ``(user_id, item_id, <score>)`` frame; the score
column is the first present of ``final_score``, ``score``, ``total_score``
(1.0 when none is). Ratings are clipped to [0, 5] and a null rating counts
as 1.0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanderrank.functions.scalar import clip_rating, exact_avg, first_present
from wanderrank.operators.indexing import index_by
from wanderrank.operators.innerproduct import top_inner_products

SCORE_CANDIDATES = ["final_score", "score", "total_score"]


def ratings(train: DataFrame, keep: dict | None = None) -> DataFrame:
    """``(user_id, item_id, rating)`` with the clipped rating (plus the columns
    of ``keep``)."""
    col = first_present(train, SCORE_CANDIDATES)
    raw = F.col(col) if col else F.lit(1.0)
    t = train.schema[col].dataType if col else None
    dtype = t.simpleString() if isinstance(t, T.DecimalType) else None
    return train.select("user_id", "item_id", clip_rating(raw, dtype=dtype).alias("rating"),
                        *[c.alias(n) for n, c in (keep or {}).items()])


def agg_user_mean(rated: DataFrame) -> DataFrame:
    """Per user: mean rating and number of rows (the weight count)."""
    return rated.groupBy("user_id").agg(exact_avg(F.col("rating")).alias("user_mean"),
                                        F.count(F.lit(1)).alias("n_interactions"))


def global_mean(rated: DataFrame):
    """Global mean rating as a scalar subquery (one aggregate row)."""
    return rated.select(exact_avg(F.col("rating"))).scalar()


def _round_mean(total, n, places: int):
    """Mean rounded half up to ``places`` decimals, exactly, for a decimal
    ``total`` whose scale is at most ``places``: integer arithmetic only."""
    units = (total * F.lit(10 ** places)).cast("long")
    a, b = F.lit(2) * units + n, F.lit(2) * n
    # (a - a mod b) is a multiple of b, so the division below is exact
    return ((a - F.pmod(a, b)) / b) / F.lit(10.0 ** places)


def cf_user_mean(users: DataFrame, train: DataFrame, places: int = 4) -> DataFrame:
    """Predicted score per user: own mean, else the global mean (rounded 4).

    With exact decimal ratings the mean is rounded half up on its exact value
    (integer arithmetic), so ties do not depend on floating-point noise; with
    double ratings it is ``round(mean, 4)``.
    """
    rated = ratings(train)
    t = rated.schema["rating"].dataType
    if isinstance(t, T.DecimalType) and t.scale <= places:
        um = rated.groupBy("user_id").agg(F.sum("rating").alias("_s"), F.count("rating").alias("_n"))
        g = rated.select(F.struct(F.sum("rating").alias("s"), F.count("rating").alias("n"))).scalar()
        j = users.select("user_id").join(um, "user_id", "left")
        own = _round_mean(F.col("_s"), F.col("_n"), places)
        glob = _round_mean(g.getField("s"), g.getField("n"), places)
        return j.select("user_id", F.when(F.col("_n") > 0, own).otherwise(glob).alias("cf_score"))
    um = agg_user_mean(rated)
    g = global_mean(rated)
    return (users.select("user_id").join(um, "user_id", "left")
            .select("user_id", F.round(F.coalesce(F.col("user_mean"), g), places).alias("cf_score")))


# ---------------------------------------------------------------- factorization

BIAS_SHRINK = 10.0


def in_test(df: DataFrame, fraction: float = 0.2, id_col: str | None = None, salt: str = "split"):
    """Held-out flag from a hash of the row's keys: the same rows whatever the
    partitioning, in every branch of a plan. The fraction is met in steps of
    1/256."""
    keys = [F.col(c).cast("string") for c in ("user_id", "item_id", *( [id_col] if id_col else []))]
    digest = F.md5(F.concat_ws(":", *[F.coalesce(k, F.lit("")) for k in keys], F.lit(salt)))
    return F.left(digest, F.lit(2)) < F.lit(f"{int(fraction * 256):02x}")


def bias_model(tr: DataFrame, shrink: float = BIAS_SHRINK) -> dict:
    """Global mean and shrunk biases: sum(residual) / (n + shrink), users first."""
    g = tr.select(exact_avg(F.col("rating"))).first()[0]
    g = 0.0 if g is None else g
    r = F.col("rating").cast("double")
    bu = tr.groupBy("user_id").agg((F.sum(r - g) / (F.count(F.lit(1)) + F.lit(shrink))).alias("b_u"))
    bi = (tr.join(bu, "user_id").groupBy("item_id")
          .agg((F.sum(r - g - F.col("b_u")) / (F.count(F.lit(1)) + F.lit(shrink))).alias("b_i")))
    return {"global": g, "b_u": bu, "b_i": bi}


def predict_bias(parts: dict, pairs: DataFrame) -> DataFrame:
    """``pairs`` plus ``prediction``: global + b_u + b_i, clipped to 0..5."""
    p = pairs.join(parts["b_u"], "user_id", "left").join(parts["b_i"], "item_id", "left")
    raw = F.lit(parts["global"]) + F.coalesce("b_u", F.lit(0.0)) + F.coalesce("b_i", F.lit(0.0))
    return p.withColumn("prediction", F.least(F.greatest(raw, F.lit(0.0)), F.lit(5.0))).drop("b_u", "b_i")


def split_ratings(train: DataFrame, test_fraction: float = 0.2, id_col: str | None = None):
    """(training part, held-out part) of the rated rows."""
    if id_col is None and "interaction_id" in train.columns:
        id_col = "interaction_id"
    flagged = ratings(train.filter(F.col("item_id").isNotNull()),
                      keep={"_test": in_test(train, test_fraction, id_col)})
    return flagged.filter(~F.col("_test")).drop("_test"), flagged.filter("_test").drop("_test")


def cf_factorization(train: DataFrame, rank: int = 50, max_iter: int = 20, reg: float = 0.3,
                     test_fraction: float = 0.2, seed: int = 42, blocks: int | None = None,
                     shrink: float = BIAS_SHRINK):
    """Matrix factorization on (global + shrunk user + item bias) residuals.

    Biases are plain aggregates; the residual is fit by MLlib ALS (explicit
    feedback). Prediction = global + b_user + b_item + u.v, clipped to [0, 5].
    Returns ``(model_dict, rmse)``. Held-out rows (``split_ratings``) give the
    RMSE; None when there are none. ``blocks``: ALS user and item blocks
    (default: the cluster's parallelism, 10 at least). A training part without
    rows gives the bias model of that part, all zeros: every score is equal.
    """
    from pyspark.ml.recommendation import ALS

    tr, te = split_ratings(train, test_fraction)
    tr, te = (x.withColumn("rating", F.col("rating").cast("double")) for x in (tr, te))
    parts = bias_model(tr, shrink)
    g, bu, bi = parts["global"], parts["b_u"], parts["b_i"]
    # ALS needs int ids: consecutive positions of the distinct ids (no hashing,
    # so no collisions).
    uid = index_by(tr.select("user_id").distinct(), "user_id", out="u_ix").withColumn(
        "u_ix", F.col("u_ix").cast("int"))
    iid = index_by(tr.select("item_id").distinct(), "item_id", out="i_ix").withColumn(
        "i_ix", F.col("i_ix").cast("int"))
    parts |= {"users": uid, "items": iid, "rank": rank, "als": None}
    resid = (tr.join(bu, "user_id").join(bi, "item_id").join(uid, "user_id").join(iid, "item_id")
             .select("u_ix", "i_ix", (F.col("rating") - g - F.col("b_u") - F.col("b_i")).alias("r")))
    if not tr.isEmpty():
        n = blocks or max(10, train.sparkSession.sparkContext.defaultParallelism)
        als = ALS(rank=rank, maxIter=max_iter, regParam=reg, userCol="u_ix", itemCol="i_ix",
                  ratingCol="r", coldStartStrategy="nan", seed=seed, checkpointInterval=5,
                  numUserBlocks=n, numItemBlocks=n)
        parts["als"] = als.fit(resid)
    return parts, eval_rmse(predict_factorized(parts, te), "rating", "prediction")


def _factors(parts: dict, side: str, ix: str, out: str) -> DataFrame:
    """(ix, out): the factors of one side; none without a fitted model."""
    model = parts["als"]
    if model is None:
        spark = parts["users"].sparkSession
        return spark.createDataFrame([], f"{ix} int, {out} array<float>")
    table = model.userFactors if side == "user" else model.itemFactors
    return table.select(F.col("id").alias(ix), F.col("features").alias(out))


def save_model(parts: dict, path: str) -> None:
    """Write the model as tables: vectors of users and items, and the scalars."""
    import os
    users, items = _augmented(parts)
    users.write.mode("overwrite").parquet(os.path.join(path, "users"))
    items.write.mode("overwrite").parquet(os.path.join(path, "items"))
    spark = users.sparkSession
    spark.createDataFrame([(float(parts["global"]), int(parts["rank"]))], "global double, rank int") \
        .coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "scalars"))


def load_model(spark, path: str) -> dict:
    """The tables of ``save_model``, as recommend_* take them."""
    import os
    s = spark.read.parquet(os.path.join(path, "scalars")).first()
    return {"global": s["global"], "rank": s["rank"],
            "vectors": (spark.read.parquet(os.path.join(path, "users")),
                        spark.read.parquet(os.path.join(path, "items")))}


def predict_factorized(parts: dict, pairs: DataFrame) -> DataFrame:
    """Prediction for ``(user_id, item_id)`` pairs; unknown ids fall back to
    the biases that exist (global at least)."""
    uf, itf = _factors(parts, "user", "u_ix", "uf"), _factors(parts, "item", "i_ix", "if")
    dot = F.aggregate(F.zip_with("uf", "if", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    p = (pairs.join(parts["b_u"], "user_id", "left").join(parts["b_i"], "item_id", "left")
         .join(parts["users"], "user_id", "left").join(parts["items"], "item_id", "left")
         .join(uf, "u_ix", "left").join(itf, "i_ix", "left"))
    raw = (F.lit(parts["global"]) + F.coalesce("b_u", F.lit(0.0)) + F.coalesce("b_i", F.lit(0.0))
           + F.coalesce(dot, F.lit(0.0)))
    return p.withColumn("prediction", F.least(F.greatest(raw, F.lit(0.0)), F.lit(5.0))).drop(
        "u_ix", "i_ix", "uf", "if", "b_u", "b_i")


def eval_rmse(pred: DataFrame, label: str = "rating", prediction: str = "prediction"):
    """Root mean squared error (a driver-side float from one aggregate row)."""
    return pred.select(F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), 2)))).first()[0]


# ---------------------------------------------------------------- factorized top-n

def _augmented(parts: dict):
    """User vector [g + b_u, 1, u...] and item vector [1, b_i, v...]: their
    dot product is the full prediction g + b_u + b_i + u.v."""
    if "vectors" in parts:
        return parts["vectors"]
    g, zeros = parts["global"], F.array_repeat(F.lit(0.0), parts["rank"])
    uf, itf = _factors(parts, "user", "u_ix", "f"), _factors(parts, "item", "i_ix", "f")
    users = (parts["users"].join(parts["b_u"], "user_id", "left").join(uf, "u_ix", "left")
             .select("user_id", F.concat(F.array(F.lit(g) + F.coalesce("b_u", F.lit(0.0)), F.lit(1.0)),
                                         F.coalesce(F.col("f").cast("array<double>"), zeros)).alias("vec")))
    items = (parts["items"].join(parts["b_i"], "item_id", "left").join(itf, "i_ix", "left")
             .select("item_id", F.concat(F.array(F.lit(1.0), F.coalesce("b_i", F.lit(0.0))),
                                         F.coalesce(F.col("f").cast("array<double>"), zeros)).alias("vec")))
    return users, items


def cf_recommend_factorized(parts: dict, requests: DataFrame, items: DataFrame, train: DataFrame,
                            block_rows: int = 4096) -> DataFrame:
    """cf_recommend with a factor model: per request the ``top_n`` unseen
    catalogue items by predicted score (clipped to 0..5, ties by item id),
    ``cf_score`` rounded to 4. Exact; a user meets only item blocks whose bound
    reaches its ``top_n``-th score (``operators.innerproduct``)."""
    zeros = F.array_repeat(F.lit(0.0), parts["rank"])
    uvec, ivec = _augmented(parts)
    users = (requests.select("user_id", "top_n").join(uvec, "user_id", "left").select(
        "user_id", "top_n", F.coalesce("vec", F.concat(F.array(F.lit(parts["global"]), F.lit(1.0)), zeros)).alias("vec")))
    cat = (items.select("item_id").join(ivec, "item_id", "left").select(
        "item_id", F.coalesce("vec", F.concat(F.array(F.lit(1.0), F.lit(0.0)), zeros)).alias("vec")))
    top = top_inner_products(users, cat, train.select("user_id", "item_id").distinct(), block_rows)
    return top.select("user_id", "rank", "item_id", F.round("pred", 4).alias("cf_score"))
