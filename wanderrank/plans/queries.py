"""Registered queries over the driver tables: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the whole driver tables through the role adapters, so its
work grows with the data. The DuckDB twin of each query lives in
``wanderrank.plans.oracle_queries``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wanderrank.operators import aggregate as A
from wanderrank.operators import clean as C
from wanderrank.operators import features as FE
from wanderrank.plans.roles import Roles, driver_roles
from wanderrank.session import materialise


class Cleaned:
    """Cleaned role tables of one query. Each is written once, as Parquet, to the
    shared checkpoint folder on first use and read back from there, so a query that
    uses a table in several branches (or around an eager step) does not
    re-run its scan, join and de-duplication."""

    def __init__(self, roles: Roles, reuse: bool = False):
        self.roles = roles
        self.reuse = reuse
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name: str, build) -> DataFrame:
        if name not in self._cache:
            df = build()
            if self.reuse:
                df = materialise(df, name)
            self._cache[name] = df
        return self._cache[name]

    @property
    def users(self) -> DataFrame:
        return self._get("users", lambda: C.clean_users(self.roles.users))

    @property
    def items(self) -> DataFrame:
        return self._get("items", lambda: C.clean_items(self.roles.items))

    @property
    def interactions(self) -> DataFrame:
        return self._get("interactions", lambda: C.clean_interactions(self.roles.interactions))

    @property
    def transactions(self) -> DataFrame:
        return self._get("transactions",
                         lambda: C.clean_transactions(self.roles.transactions, key=self.roles.txn_key))

    @property
    def txn_id(self) -> str:
        return self.roles.txn_key[0]


def cleaned(spark: SparkSession, sf_dir: str, reuse: bool = False) -> Cleaned:
    """``reuse=True`` for queries that read a cleaned table more than once."""
    return Cleaned(driver_roles(spark, sf_dir), reuse)


def matrix(c: Cleaned) -> DataFrame:
    return A.interaction_matrix(A.union_all_signals(c.interactions, c.transactions))


# ---------------------------------------------------------------- cleaning

def q_clean_users(spark, sf_dir):
    return cleaned(spark, sf_dir).users


def q_clean_items(spark, sf_dir):
    return cleaned(spark, sf_dir).items


def q_clean_interactions(spark, sf_dir):
    return cleaned(spark, sf_dir).interactions


def q_clean_transactions(spark, sf_dir):
    return cleaned(spark, sf_dir).transactions


# ---------------------------------------------------------------- aggregates

def q_union_all_signals(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    return A.union_all_signals(c.interactions, c.transactions).withColumn(
        "score", F.col("score").cast("double"))


def q_interaction_matrix(spark, sf_dir):
    return matrix(cleaned(spark, sf_dir))


def q_agg_user_interactions(spark, sf_dir):
    return A.agg_user_interactions(cleaned(spark, sf_dir).interactions)


def q_agg_user_transactions(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    return A.agg_user_transactions(c.transactions, c.txn_id)


def q_agg_item_popularity(spark, sf_dir):
    return A.agg_item_popularity(cleaned(spark, sf_dir).interactions)


def q_agg_item_revenue(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    return A.agg_item_revenue(c.transactions, c.txn_id)


def q_agg_user_counts(spark, sf_dir):
    return A.agg_user_counts(cleaned(spark, sf_dir).interactions)


# ---------------------------------------------------------------- features

def q_user_features(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    out = FE.user_features(c.users, c.interactions, c.transactions, c.txn_id)
    # 10 places: what is shown does not depend on which libm computed the log
    return out.withColumn("budget_log", F.round("budget_log", 10))


def q_item_features(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    return FE.item_features(c.items, c.interactions, c.transactions, c.roles.facilities, c.txn_id)


def q_window_minmax_price(spark, sf_dir):
    items = cleaned(spark, sf_dir).items
    return FE.group_minmax(items, "category", "price", "price_normalized").select(
        "item_id", "category", "price", "price_normalized")


def q_index_category(spark, sf_dir):
    items = cleaned(spark, sf_dir).items
    df = FE.index_category(items, "category", "category_idx")
    df = FE.index_category(df, "province", "province_idx")
    return df.select("item_id", "category", "category_idx", "province", "province_idx")


def q_label_encode(spark, sf_dir):
    items = cleaned(spark, sf_dir).items
    df = FE.label_encode(items, "category", "category_code", default="ECONOMY")
    df = FE.label_encode(df, "province", "province_code", default="Brand#1")
    return df.select("item_id", "category_code", "province_code")


QUERIES = {
    "clean_users": q_clean_users,
    "clean_items": q_clean_items,
    "clean_interactions": q_clean_interactions,
    "clean_transactions": q_clean_transactions,
    "union_all_signals": q_union_all_signals,
    "interaction_matrix": q_interaction_matrix,
    "agg_user_interactions": q_agg_user_interactions,
    "agg_user_transactions": q_agg_user_transactions,
    "agg_item_popularity": q_agg_item_popularity,
    "agg_item_revenue": q_agg_item_revenue,
    "agg_user_counts": q_agg_user_counts,
    "user_features": q_user_features,
    "item_features": q_item_features,
    "window_minmax_price": q_window_minmax_price,
    "index_category": q_index_category,
    "label_encode": q_label_encode,
}


# ---------------------------------------------------------------- similarity

from wanderrank.operators import collaborative as CFM  # noqa: E402
from wanderrank.operators import ranking as R  # noqa: E402
from wanderrank.operators import similarity as SIM  # noqa: E402


def item_vectors(c: Cleaned) -> DataFrame:
    feats = FE.item_features(c.items, c.interactions, c.transactions, c.roles.facilities, c.txn_id)
    return SIM.build_item_vectors(feats)


def q_build_item_vectors(spark, sf_dir):
    v = item_vectors(cleaned(spark, sf_dir))
    return v.select("item_id", F.posexplode("features").alias("dim", "value"))


def q_cosine_topk(spark, sf_dir):
    nb = SIM.cosine_topk(item_vectors(cleaned(spark, sf_dir)), k=5)
    return nb.select("src", "dst", F.round("score", 4).alias("score"), "rank")


def q_cosine_topk_embeddings(spark, sf_dir):
    vec = driver_roles(spark, sf_dir).vectors
    nb = SIM.cosine_topk(vec, k=5)
    return nb.select("src", "dst", F.round("score", 4).alias("score"), "rank")


def favourite_requests(c: Cleaned, k_fav: int = 2) -> DataFrame:
    """Requests derived from the data: every cleaned user, top_n 10, the
    user's ``k_fav`` best matrix items as favourites, the category of the best
    one as the category preference, the budget as ``max_budget``."""
    m = matrix(c)
    w = Window.partitionBy("user_id").orderBy(F.col("final_score").desc(), F.col("item_id").asc())
    best = (m.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k_fav)
            .join(c.items.select("item_id", "category"), "item_id", "left"))
    favs = best.groupBy("user_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_r", "item_id", "category"))),
                    lambda s: s["item_id"]).alias("favorites"),
        F.min_by("category", "_r").alias("top_category"))
    return (c.users.select("user_id", "budget").join(favs, "user_id", "left").select(
        "user_id", F.lit(10).alias("top_n"),
        F.coalesce("favorites", F.array().cast("array<bigint>")).alias("favorites"),
        F.when(F.col("top_category").isNotNull(), F.array("top_category"))
         .otherwise(F.array().cast("array<string>")).alias("categories"),
        F.col("budget").cast("double").alias("max_budget"),
        F.lit(None).cast("string").alias("province")))


def q_recommend_batch(spark, sf_dir):
    c = cleaned(spark, sf_dir, reuse=True)
    req = c.users.select("user_id", F.lit(10).alias("top_n"))
    return R.recommend_batch(req, c.interactions, c.items)


def q_recommend_prefs(spark, sf_dir):
    c = cleaned(spark, sf_dir, reuse=True)
    req = materialise(favourite_requests(c), "favourites")
    favs = req.select(F.explode("favorites").alias("item_id"))
    # neighbours are needed for the favourites only (exact: candidates are all items)
    nb = SIM.cosine_topk(item_vectors(c), k=R.CB_NEIGHBOURS, queries=favs)
    return R.recommend_batch(req, c.interactions, c.items, nb)


def q_cf_user_mean(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    return CFM.cf_user_mean(c.users, c.interactions)


def q_adaptive_weights(spark, sf_dir):
    from wanderrank.functions.scores import adaptive_weights
    c = cleaned(spark, sf_dir)
    n = A.agg_user_counts(c.interactions)
    w_cf, w_cb = adaptive_weights(F.col("n_interactions"))
    return (c.users.select("user_id").join(n, "user_id", "left")
            .select("user_id", F.coalesce("n_interactions", F.lit(0)).alias("n_interactions"),
                    w_cf.alias("w_cf"), w_cb.alias("w_cb")))


QUERIES.update({
    "build_item_vectors": q_build_item_vectors,
    "cosine_topk": q_cosine_topk,
    "cosine_topk_embeddings": q_cosine_topk_embeddings,
    "cf_user_mean": q_cf_user_mean,
    "adaptive_weights": q_adaptive_weights,
    "recommend_batch": q_recommend_batch,
    "recommend_prefs": q_recommend_prefs,
})


# ---------------------------------------------------------------- evaluation

from wanderrank.operators import evaluate as EV  # noqa: E402


def q_eval_precision_coverage(spark, sf_dir):
    c = cleaned(spark, sf_dir, reuse=True)
    return EV.eval_precision_coverage(c.interactions, c.items)


def q_nlargest_true(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    users = c.interactions.select("user_id").distinct()
    return EV.nlargest_true(c.interactions, users, 5)


def q_similar_items(spark, sf_dir):
    c = cleaned(spark, sf_dir, reuse=True)
    ids = c.interactions.select("item_id")
    nb = SIM.cosine_topk(item_vectors(c), k=5, queries=ids)
    return SIM.similar_items(nb, ids, 5, catalogue=c.items).select(
        "src", "dst", F.round("score", 4).alias("score"), "rank", "name", "category", "rating")


def q_agg_best_similarity(spark, sf_dir):
    c = cleaned(spark, sf_dir, reuse=True)
    req = materialise(R.normalize_requests(favourite_requests(c)), "requests")
    nb = SIM.cosine_topk(item_vectors(c), k=R.CB_NEIGHBOURS,
                         queries=req.select(F.explode("favorites").alias("item_id")))
    return R.cb_scores(req, nb).select("user_id", "item_id", "cb", "cb_norm")


def q_join_anti_seen(spark, sf_dir):
    """CB candidates of each user that the user has not interacted with."""
    c = cleaned(spark, sf_dir, reuse=True)
    req = materialise(R.normalize_requests(favourite_requests(c)), "requests")
    nb = SIM.cosine_topk(item_vectors(c), k=R.CB_NEIGHBOURS,
                         queries=req.select(F.explode("favorites").alias("item_id")))
    cb = R.cb_scores(req, nb).select("user_id", "item_id")
    return cb.join(c.interactions.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


QUERIES.update({
    "eval_precision_coverage": q_eval_precision_coverage,
    "nlargest_true": q_nlargest_true,
    "similar_items": q_similar_items,
    "agg_best_similarity": q_agg_best_similarity,
    "join_anti_seen": q_join_anti_seen,
})


# ---------------------------------------------------------------- key-value tables, chat

from wanderrank.operators import chat as CH  # noqa: E402
from wanderrank.sources import keyvalue as KV  # noqa: E402

AS_OF = "2024-02-01 00:00:00"


def q_upsert_by_key(spark, sf_dir):
    x = driver_roles(spark, sf_dir).interactions
    return KV.upsert_by_key(x, ["user_id", "item_id"], ["ts", "interaction_id"])


def q_expire_ttl(spark, sf_dir):
    x = driver_roles(spark, sf_dir).interactions
    return KV.expire_ttl(x, "2024-02-15 00:00:00", ts_col="ts",
                         days=KV.TTL_INTERACTIONS_DAYS).select("interaction_id", "user_id", "item_id", "ts")


def q_range_by_key(spark, sf_dir):
    x = cleaned(spark, sf_dir).interactions
    return KV.range_by_key(x, "user_id", ["ts", "interaction_id"]).select(
        "interaction_id", "user_id", "item_id", "ts", "pos")


def q_catalogue_list(spark, sf_dir):
    return KV.catalogue_list(cleaned(spark, sf_dir).items)


def q_prediction_log(spark, sf_dir):
    c = cleaned(spark, sf_dir, reuse=True)
    recs = R.recommend_batch(c.users.select("user_id", F.lit(10).alias("top_n")), c.interactions, c.items)
    return KV.prediction_log(recs, AS_OF)


def session_messages(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per session: the last user turn as the message, earlier turns as history."""
    w = Window.partitionBy("session_id").orderBy(F.col("turn").desc())
    msg = (turns.filter(F.col("role") == "user").withColumn("_r", F.row_number().over(w))
           .filter("_r = 1").select("session_id", "user_id", F.col("turn").alias("_mturn"),
                                    F.col("content").alias("message")))
    earlier = (turns.join(msg.select("session_id", "_mturn"), "session_id")
               .filter(F.col("turn") < F.col("_mturn")).drop("_mturn"))
    return msg.drop("_mturn"), earlier


def q_chat_history(spark, sf_dir):
    return CH.chat_history(driver_roles(spark, sf_dir).turns)


def q_chat_context(spark, sf_dir):
    c = cleaned(spark, sf_dir, reuse=True)
    msg, earlier = session_messages(c.roles.turns)
    req = msg.select("user_id").distinct().withColumn("top_n", F.lit(5))
    recs = R.recommend_batch(req, c.interactions, c.items)
    return CH.chat_context(msg, recs, CH.chat_history(earlier))


def q_chat_append(spark, sf_dir):
    t = driver_roles(spark, sf_dir).turns
    w = Window.partitionBy("session_id").orderBy(F.col("turn").desc())
    t = t.withColumn("_r", F.row_number().over(w))
    return CH.chat_append(t.filter("_r > 2"), t.filter("_r <= 2"), AS_OF)


QUERIES.update({
    "upsert_by_key": q_upsert_by_key,
    "expire_ttl": q_expire_ttl,
    "range_by_key": q_range_by_key,
    "catalogue_list": q_catalogue_list,
    "prediction_log": q_prediction_log,
    "chat_history": q_chat_history,
    "chat_context": q_chat_context,
    "chat_append": q_chat_append,
})


# ---------------------------------------------------------------- streaming and metrics

from wanderrank.plans.roles import read_table  # noqa: E402
from wanderrank.streaming import ingest as ING  # noqa: E402
from wanderrank.streaming import metrics as MET  # noqa: E402


def q_track_ingest(spark, sf_dir):
    x = driver_roles(spark, sf_dir).interactions
    accepted, _ = ING.track_ingest(x.select("user_id", "item_id", "kind",
                                            F.col("score").cast("string").alias("score"), "ts"))
    return accepted


def q_stream_user_counts(spark, sf_dir):
    return ING.user_counts(cleaned(spark, sf_dir).interactions)


def _log(spark, sf_dir):
    driver_roles(spark, sf_dir)  # session settings
    return MET.log_from_events(read_table(spark, sf_dir, "events"))


def _windows(spark, sf_dir):
    # p99 shown to 6 places: the exact value has at most 4, so the rounding
    # removes only interpolation noise
    w = MET.metric_windows(_log(spark, sf_dir))
    return w.withColumn("p99_duration_ms", F.round("p99_duration_ms", 6))


def q_metric_windows(spark, sf_dir):
    return _windows(spark, sf_dir)


def q_metric_sketch_rollup(spark, sf_dir):
    """Five-minute sketches merged to hours: counts are exact, and the sketched
    percentile's rank among the hour's durations is within the stated error."""
    log = _log(spark, sf_dir)
    hours = MET.merge_sketches(materialise(MET.metric_sketches(log), "sketches"), "1 hour")
    est = MET.sketch_windows(hours).select("name", F.col("window_start").alias("hour"), "p99_duration_ms")
    at = log.withColumn("hour", F.date_trunc("hour", "ts")).join(est, ["name", "hour"])
    d, q = F.col("duration_ms").cast("double"), F.col("p99_duration_ms")
    ranks = at.groupBy("name", "hour").agg(F.count(F.lit(1)).alias("n"), F.avg((d < q).cast("double")).alias("_lo"),
                                           F.avg((d <= q).cast("double")).alias("_hi"),
                                           F.sum("errors").alias("errors"))
    e = F.lit(MET.rank_error()) + 1 / F.col("n")
    return ranks.select("name", "hour", "n", "errors", ((F.col("_lo") <= 0.99 + e) & (F.col("_hi") >= 0.99 - e)).alias("within"))


def q_alarm_eval(spark, sf_dir):
    return MET.alarm_eval(_windows(spark, sf_dir))


def q_quota_usage(spark, sf_dir):
    return MET.quota_usage(driver_roles(spark, sf_dir).interactions)


QUERIES.update({
    "track_ingest": q_track_ingest,
    "stream_user_counts": q_stream_user_counts,
    "metric_windows": q_metric_windows,
    "alarm_eval": q_alarm_eval,
    "metric_sketch_rollup": q_metric_sketch_rollup,
    "quota_usage": q_quota_usage,
})


# ---------------------------------------------------------------- sources and summary

from wanderrank.plans import etl as ETL  # noqa: E402
from wanderrank.sources import files as IO  # noqa: E402

RAW_TABLES = ["customer", "part", "events", "orders", "lineitem"]


KEY_COLUMN = {"customer": "c_custkey", "part": "p_partkey", "events": "event_id",
              "orders": "o_orderkey", "lineitem": "l_orderkey"}


def q_scan_catalog(spark, sf_dir):
    """The raw tables as external tables of a catalog database, read back by
    name; per table the rows and a checksum of a key column (so rows are read)."""
    import hashlib
    db = "wr_raw_" + hashlib.md5(sf_dir.encode()).hexdigest()[:12]
    IO.register_catalog(spark, db, {t: f"{sf_dir.rstrip('/')}/{t}.parquet" for t in RAW_TABLES})
    tables = IO.scan_catalog(spark, db, RAW_TABLES)
    parts = [tables[t].select(F.lit(t).alias("table_name"), F.count(KEY_COLUMN[t]).alias("row_count"),
                              F.sum(KEY_COLUMN[t]).alias("key_sum"))
             for t in RAW_TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_etl_summary(spark, sf_dir):
    c = cleaned(spark, sf_dir, reuse=True)
    return ETL.etl_summary(c.users, c.items, matrix(c), c.transactions, AS_OF)


QUERIES.update({
    "scan_catalog": q_scan_catalog,
    "etl_summary": q_etl_summary,
})


# ---------------------------------------------------------------- factorization (rows-only)

def _factor_model(c: Cleaned):
    return CFM.cf_factorization(c.interactions, rank=50, max_iter=20)


def q_cf_factorization(spark, sf_dir):
    """One row: held-out RMSE of the factor model and of the global mean."""
    c = cleaned(spark, sf_dir, reuse=True)
    parts, rmse = _factor_model(c)
    te = CFM.split_ratings(c.interactions)[1].withColumn("rating", F.col("rating").cast("double"))
    base = te.select(F.sqrt(F.avg(F.pow(F.col("rating") - parts["global"], 2)))).first()[0]
    return spark.range(1).select(F.lit(rmse).alias("rmse"), F.lit(base).alias("rmse_global_mean"))


def q_cf_recommend(spark, sf_dir):
    c = cleaned(spark, sf_dir, reuse=True)
    parts, _ = _factor_model(c)
    req = c.users.select("user_id", F.lit(10).alias("top_n"))
    return CFM.cf_recommend_factorized(parts, req, c.items, c.interactions)


QUERIES.update({
    "cf_factorization": q_cf_factorization,
    "cf_recommend": q_cf_recommend,
})


# ---------------------------------------------------------------- single-rule views

def q_dedup_by_key(spark, sf_dir):
    """The survivor rule alone: one transaction line per (order, line) key."""
    r = driver_roles(spark, sf_dir)
    return C.dedup_by_key(r.transactions, r.txn_key)


def q_distinct_items(spark, sf_dir):
    """The set of all recommended items (the numerator of coverage)."""
    c = cleaned(spark, sf_dir, reuse=True)
    recs = R.recommend_batch(c.users.select("user_id", F.lit(10).alias("top_n")), c.interactions, c.items)
    return recs.select("item_id").distinct()


QUERIES.update({"dedup_by_key": q_dedup_by_key, "distinct_items": q_distinct_items})


def q_recommend_factorized(spark, sf_dir):
    """Hybrid recommendations with the factor model as CF (rows-only: ALS)."""
    c = cleaned(spark, sf_dir, reuse=True)
    parts, _ = _factor_model(c)
    req = materialise(favourite_requests(c), "favourites")
    nb = SIM.cosine_topk(item_vectors(c), k=R.CB_NEIGHBOURS,
                         queries=req.select(F.explode("favorites").alias("item_id")))
    return R.recommend_batch_factorized(req, c.interactions, c.items, parts, nb)


QUERIES["recommend_factorized"] = q_recommend_factorized


# ---------------------------------------------------------------- rules that the plain queries do not reach

import uuid  # noqa: E402

from wanderrank.functions import scalar as S  # noqa: E402
from wanderrank.session import scratch_path  # noqa: E402
from wanderrank.sources import sinks as OUT  # noqa: E402


def q_recommend_multi(spark, sf_dir):
    """Two requests of every user: favourites and category, a province for a
    third of them, no budget; and a plain one with the budget for half."""
    c = cleaned(spark, sf_dir, reuse=True)
    base = materialise(favourite_requests(c), "favourites")
    u = F.col("user_id")
    first = base.select((u * 2).alias("request_id"), "user_id", F.lit(3).alias("top_n"), "favorites", "categories",
                        F.lit(None).cast("double").alias("max_budget"),
                        F.when(u % 3 == 0, F.concat(F.lit("Brand#"), (u % 25 + 1).cast("string"))).alias("province"))
    second = base.select((u * 2 + 1).alias("request_id"), "user_id", F.lit(5).alias("top_n"),
                         F.array().cast("array<bigint>").alias("favorites"),
                         F.array().cast("array<string>").alias("categories"),
                         F.when(u % 2 == 0, F.col("max_budget")).alias("max_budget"),
                         F.lit(None).cast("string").alias("province"))
    favs = base.select(F.explode("favorites").alias("item_id"))
    nb = SIM.cosine_topk(item_vectors(c), k=R.CB_NEIGHBOURS, queries=favs)
    return R.recommend_batch(first.unionByName(second), c.interactions, c.items, nb)


def q_eval_all_users(spark, sf_dir):
    """Precision and coverage over every user instead of the reference's 50."""
    c = cleaned(spark, sf_dir, reuse=True)
    return EV.eval_precision_coverage(c.interactions, c.items, sample=None)


def q_adaptive_weights_recent(spark, sf_dir):
    """Weights from the last five days of events: all three bands occur."""
    from wanderrank.functions.scores import adaptive_weights
    x = cleaned(spark, sf_dir).interactions
    last = x.select(F.max("ts")).scalar()
    n = A.agg_user_counts(x.filter(F.col("ts") > last - F.expr("INTERVAL 3 DAYS")))
    w_cf, w_cb = adaptive_weights(F.col("n_interactions"))
    return (cleaned(spark, sf_dir).users.select("user_id").join(n, "user_id", "left")
            .select("user_id", F.coalesce("n_interactions", F.lit(0)).alias("n_interactions"),
                    w_cf.alias("w_cf"), w_cb.alias("w_cb")))


def q_matrix_cap(spark, sf_dir):
    """interaction_matrix with a cap that totals reach."""
    c = cleaned(spark, sf_dir)
    return A.interaction_matrix(A.union_all_signals(c.interactions, c.transactions), cap=1.0)


def q_quota_usage_low(spark, sf_dir):
    return MET.quota_usage(driver_roles(spark, sf_dir).interactions, quota=60)


LOW_ALARMS = [MET.Alarm("errors", "errors", 0, 2), MET.Alarm("server_errors", "errors", 1, 1, level="all"),
              MET.Alarm("latency_p99", "p99_duration_ms", 60, 2)]


def q_alarm_eval_low(spark, sf_dir):
    """Thresholds that the log exceeds, so alarms are raised."""
    return MET.alarm_eval(_windows(spark, sf_dir), LOW_ALARMS)


def q_dedup_events(spark, sf_dir):
    """Events with altered copies under the same id: one survivor per id."""
    x = driver_roles(spark, sf_dir).interactions
    copies = x.filter(F.col("interaction_id") % 5 == 0).withColumn(
        "score", (F.col("score") / 2).cast(x.schema["score"].dataType))
    return C.dedup_by_key(x.unionByName(copies), "interaction_id")


def q_clean_dirty(spark, sf_dir):
    """Interactions with missing keys, scores out of range and text times
    (some broken) through clean_interactions."""
    x = driver_roles(spark, sf_dir).interactions
    i = F.col("interaction_id")
    dirty = x.withColumns({
        "user_id": F.when(i % 7 != 0, F.col("user_id")),
        "score": F.when(i % 11 == 0, -F.col("score")).otherwise(F.col("score")).cast(x.schema["score"].dataType),
        "ts": F.when(i % 13 == 0, F.lit("not a time")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))})
    return C.clean_interactions(dirty).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def q_clean_transactions_dirty(spark, sf_dir):
    """Transactions with text dates (some broken or impossible), unknown and
    missing statuses and payments of nothing through clean_transactions."""
    x = driver_roles(spark, sf_dir).transactions
    k = F.col("order_key")
    text = lambda c, n: F.when(k % n == 0, F.lit("2024-02-31")).when(k % n == 1, F.lit("soon")).otherwise(
        F.date_format(c, "yyyy-MM-dd"))
    dirty = x.withColumns({
        "status": F.when(k % 6 == 0, F.lit("pending")).when(k % 6 == 1, F.lit(None)).otherwise(F.col("status")),
        "paid": F.when(k % 10 == 3, F.lit(0)).otherwise(F.col("paid")).cast(x.schema["paid"].dataType),
        "txn_date": text("txn_date", 7), "check_in": text("check_in", 11), "check_out": text("check_out", 13)})
    return C.clean_transactions(dirty, key=driver_roles(spark, sf_dir).txn_key).select(
        "order_key", "line_number", "status", "paid", "txn_date", "check_in", "stay_nights", "is_completed")


def q_label_encode_nulls(spark, sf_dir):
    """Frequency and alphabetical codes of a column with nulls."""
    items = cleaned(spark, sf_dir).items.select(
        "item_id", F.when(F.col("item_id") % 4 != 0, F.col("category")).alias("category"))
    df = FE.index_category(items, "category", "category_idx")
    return FE.label_encode(df, "category", "category_code", default="LARGE").select(
        "item_id", "category_idx", "category_code")


def q_track_ingest_dirty(spark, sf_dir):
    """Rows with missing ids, kinds and scores: accepted and rejected ones."""
    x = driver_roles(spark, sf_dir).interactions
    i = F.col("interaction_id")
    dirty = x.select(
        F.when(i % 7 == 0, F.lit(None)).when(i % 7 == 1, F.lit(" ")).otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(i % 11 == 0, F.lit("")).otherwise(F.col("item_id").cast("string")).alias("item_id"),
        F.when(i % 3 != 0, F.col("kind")).alias("kind"),
        F.when(i % 5 == 0, F.lit(None)).when(i % 5 == 1, F.lit("much")).otherwise(F.col("score").cast("string")).alias("score"),
        "ts")
    accepted, rejected = ING.track_ingest(dirty)
    a = accepted.select("user_id", "item_id", "kind", F.col("score"), "ts", F.lit(None).cast("string").alias("reason"))
    r = rejected.select("user_id", "item_id", "kind", F.lit(None).cast("double").alias("score"), "ts", "reason")
    return a.unionByName(r)


def q_chat_append_ttl(spark, sf_dir):
    """A store whose rows have a ttl of their own: some expire, one exactly now."""
    t = driver_roles(spark, sf_dir).turns
    now = F.unix_timestamp(F.to_timestamp(F.lit(AS_OF)))
    w = Window.partitionBy("session_id").orderBy(F.col("turn").desc())
    t = t.withColumn("_r", F.row_number().over(w))
    store = t.filter("_r > 1").withColumn("ttl", now + (F.col("turn") - 2) * 3600)
    return CH.chat_append(store, t.filter("_r = 1"), AS_OF, chars=50)


def q_chat_context_short(spark, sf_dir):
    """The short prompt; every fifth session is anonymous."""
    c = cleaned(spark, sf_dir, reuse=True)
    msg, earlier = session_messages(c.roles.turns)
    req = msg.select("user_id").distinct().withColumn("top_n", F.lit(5))
    recs = R.recommend_batch(req, c.interactions, c.items)
    msg = msg.withColumn("user_id", F.when(F.col("user_id") % 5 != 0, F.col("user_id")))
    return CH.chat_context(msg, recs, CH.chat_history(earlier), short=True)


def q_stream_item_counts(spark, sf_dir):
    return ING.item_counts(cleaned(spark, sf_dir).interactions)


def _bias(c: Cleaned):
    tr, te = CFM.split_ratings(c.interactions)
    return CFM.bias_model(tr), te


def q_eval_rmse(spark, sf_dir):
    """Held-out error of the bias model and of the global mean (6 places)."""
    parts, te = _bias(cleaned(spark, sf_dir, reuse=True))
    p = CFM.predict_bias(parts, te).withColumn("rating", F.col("rating").cast("double"))
    sq = lambda c: F.round(F.sqrt(F.avg(F.pow(F.col("rating") - c, 2))), 6)
    return p.select(sq(F.col("prediction")).alias("rmse"), sq(F.lit(parts["global"])).alias("rmse_global_mean"),
                    F.count(F.lit(1)).alias("n_test"))


def q_cf_bias_recommend(spark, sf_dir):
    """Top ten unseen items per user by the bias model. A user's order of items
    is the items' bias order, so only its first 10 + seen positions are read."""
    c = cleaned(spark, sf_dir, reuse=True)
    parts, _ = _bias(c)
    score = F.round(F.coalesce("b_i", F.lit(0.0)), 9)
    from wanderrank.operators.indexing import index_by
    pos = index_by(c.items.select("item_id").join(parts["b_i"], "item_id", "left")
                   .select("item_id", (-score).alias("_o")), "_o", "item_id")
    seen = c.interactions.select("user_id", "item_id").distinct()
    n = seen.groupBy("user_id").agg(F.count(F.lit(1)).alias("_s"))
    users = c.users.select("user_id").join(n, "user_id", "left").join(parts["b_u"], "user_id", "left")
    cand = (users.withColumn("pos", F.explode(F.sequence(F.lit(1), F.lit(10) + F.coalesce("_s", F.lit(0)))))
            .join(pos, "pos").join(seen, ["user_id", "item_id"], "left_anti"))
    w = Window.partitionBy("user_id").orderBy("pos")
    raw = F.lit(parts["global"]) + F.coalesce("b_u", F.lit(0.0)) - F.col("_o")
    return (cand.withColumn("rank", F.row_number().over(w)).filter("rank <= 10")
            .select("user_id", "rank", "item_id",
                    F.round(F.least(F.greatest(raw, F.lit(0.0)), F.lit(5.0)), 4).alias("cf_score")))


def _fixed_factors(users: DataFrame, items: DataFrame) -> dict:
    """A factor model that follows from the ids alone, in exact binary fractions, so
    its top-N has an engine-independent answer. Norms fall with the item number."""
    u, i = F.col("user_id"), F.col("item_id")
    return {"global": 2.5, "rank": 2, "vectors": (
        users.where(u % 11 != 0).select("user_id", F.array(
            2.5 + (u % 9 - 4) / 8, F.lit(1.0), (u * 7 % 11 - 5) / 8, (u * 3 % 13 - 6) / 8).alias("vec")),
        items.where(i % 13 != 0).select("item_id", F.array(
            F.lit(1.0), (i % 17 - 8) / 64, *[c / F.pow(F.lit(2.0), F.least(F.expr("item_id div 128"), F.lit(4)))
                                             for c in ((i * 5 % 19 - 9) / 16, (i * 11 % 23 - 11) / 16)]).alias("vec")))}


def q_cf_recommend_fixed(spark, sf_dir):
    """cf_recommend with the fixed factor table: every user, all items."""
    c = cleaned(spark, sf_dir, reuse=True)
    req = c.users.select("user_id", F.lit(10).alias("top_n"))
    return CFM.cf_recommend_factorized(_fixed_factors(c.users, c.items), req, c.items, c.interactions, block_rows=256)


def _invariants(recs: DataFrame, c: Cleaned, score: str, top: float) -> DataFrame:
    """Per user what any correct model must give: as many rows as asked or
    unseen, ranks without gaps, no seen item, no item twice, scores in range."""
    seen = c.interactions.select("user_id", "item_id").distinct().withColumn("_seen", F.lit(1))
    return (recs.join(seen, ["user_id", "item_id"], "left").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("rank").cast("long").alias("last_rank"),
        F.count_distinct("item_id").alias("n_items"), F.count("_seen").alias("n_seen"),
        F.min((F.col(score) >= 0) & (F.col(score) <= top)).alias("in_range")))


def q_cf_recommend_invariants(spark, sf_dir):
    c = cleaned(spark, sf_dir, reuse=True)
    parts, _ = _factor_model(c)
    req = c.users.select("user_id", F.lit(10).alias("top_n"))
    return _invariants(CFM.cf_recommend_factorized(parts, req, c.items, c.interactions), c, "cf_score", 5.0)


def q_recommend_factorized_invariants(spark, sf_dir):
    """Plain requests (no favourites, no filter): ten unseen items each."""
    c = cleaned(spark, sf_dir, reuse=True)
    parts, _ = _factor_model(c)
    req = c.users.select("user_id", F.lit(10).alias("top_n"))
    return _invariants(R.recommend_batch_factorized(req, c.interactions, c.items, parts), c, "hybrid_score", 1.0)


def _round_trip(spark, name: str) -> str:
    return scratch_path(spark, f"{spark.sparkContext.applicationId}-{name}-{uuid.uuid4().hex[:12]}")


def q_sink_scan_parquet(spark, sf_dir):
    """Written by partition and read back: the partition column survives."""
    path = _round_trip(spark, "parquet")
    items = cleaned(spark, sf_dir).items.select("item_id", "price", "category")
    OUT.sink_parquet(items, path, partition_by=["category"])
    return IO.scan_parquet_dir(spark, path).select("item_id", "price", "category")


def q_scan_inferred(spark, sf_dir):
    """Written as CSV with a header and read back with inferred types."""
    path = _round_trip(spark, "csv")
    cleaned(spark, sf_dir).items.select("item_id", "name", "price", "visit_hours").write.option("header", True).csv(path)
    return IO.scan_inferred(spark, path).select(
        F.col("item_id").cast("bigint").alias("item_id"), "name", "price", "visit_hours")


def q_scan_csv_fallback(spark, sf_dir):
    """No Parquet folder: the named CSV is read; with the folder it is not."""
    path = _round_trip(spark, "fallback")
    users = cleaned(spark, sf_dir).users.select("user_id", "segment", "budget")
    schema = users.schema
    users.filter("user_id % 2 = 0").write.option("header", True).csv(f"{path}/csv")
    OUT.sink_parquet(users.filter("user_id % 2 = 1"), f"{path}/there")
    absent = IO.scan_csv_fallback(spark, f"{path}/absent", f"{path}/csv", schema)
    there = IO.scan_csv_fallback(spark, f"{path}/there", f"{path}/csv", schema)
    return absent.select(F.lit("csv").alias("origin"), "*").unionByName(there.select(F.lit("parquet").alias("origin"), "*"))


def q_row_counts(spark, sf_dir):
    """Counts observed on the writes of the cleaned tables, as the summary sink
    writes and the reader sees them."""
    c = cleaned(spark, sf_dir)
    path = _round_trip(spark, "counts")
    tables = {"users": c.users, "items": c.items, "interactions": c.interactions, "transactions": c.transactions}
    IO.require_nonempty(tables)
    counts = []
    for name, df in tables.items():
        seen, obs = IO.row_counts(df, name)
        OUT.sink_parquet(seen, f"{path}/{name}")
        counts.append((name, obs.get["rows"]))
    OUT.sink_summary(OUT.summary_frame(spark, counts), f"{path}/summary")
    return spark.read.option("header", True).schema("metric string, value string").csv(f"{path}/summary")


def q_sink_metadata(spark, sf_dir):
    """Metadata written as one JSON record and read back by field."""
    c = cleaned(spark, sf_dir)
    path = _round_trip(spark, "metadata")
    n = {"n_users": c.users.count(), "n_items": c.items.count()}
    OUT.sink_metadata(spark, path, {"version": ETL.MODEL_VERSION, **n})
    j = spark.read.text(path)
    return j.select(F.get_json_object("value", "$.version").alias("version"),
                    *[F.get_json_object("value", f"$.{k}").cast("bigint").alias(k) for k in n])


QUERIES.update({
    "recommend_multi": q_recommend_multi,
    "eval_all_users": q_eval_all_users,
    "adaptive_weights_recent": q_adaptive_weights_recent,
    "matrix_cap": q_matrix_cap,
    "quota_usage_low": q_quota_usage_low,
    "alarm_eval_low": q_alarm_eval_low,
    "dedup_events": q_dedup_events,
    "clean_dirty": q_clean_dirty,
    "label_encode_nulls": q_label_encode_nulls,
    "track_ingest_dirty": q_track_ingest_dirty,
    "chat_append_ttl": q_chat_append_ttl,
    "chat_context_short": q_chat_context_short,
    "stream_item_counts": q_stream_item_counts,
    "eval_rmse": q_eval_rmse,
    "cf_bias_recommend": q_cf_bias_recommend,
    "cf_recommend_fixed": q_cf_recommend_fixed,
    "clean_transactions_dirty": q_clean_transactions_dirty,
    "cf_recommend_invariants": q_cf_recommend_invariants,
    "recommend_factorized_invariants": q_recommend_factorized_invariants,
    "sink_scan_parquet": q_sink_scan_parquet,
    "scan_inferred": q_scan_inferred,
    "scan_csv_fallback": q_scan_csv_fallback,
    "row_counts": q_row_counts,
    "sink_metadata": q_sink_metadata,
})
