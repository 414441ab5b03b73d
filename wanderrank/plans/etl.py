"""The batch jobs: ETL (clean -> features -> matrix -> Parquet + summary) and
training (vectors -> neighbours -> CF statistics -> evaluation -> metadata).

Compared with the source job, which recomputed the shared lineage for each
of its ~22 actions, each output here is written once, row counts come from
``observe`` on the writes, and the cleaned tables are written once and read
back, so every later stage starts from a short lineage that survives the loss
of an executor.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderrank.operators import aggregate as A
from wanderrank.operators import clean as C
from wanderrank.operators import collaborative as CF
from wanderrank.operators import evaluate as EV
from wanderrank.operators import features as FE
from wanderrank.operators import similarity as SIM
from wanderrank.plans.roles import Roles
from wanderrank.sources import files as IO
from wanderrank.sources import sinks as OUT

ETL_JOB = "wanderrank-etl"
MODEL_VERSION = "1.0.0"


def _write_and_reload(spark: SparkSession, df: DataFrame, path: str, name: str,
                      counts: dict[str, int]) -> DataFrame:
    observed, obs = IO.row_counts(df, name)
    OUT.sink_parquet(observed, path)
    counts[name] = obs.get["rows"]
    return spark.read.parquet(path)


def run_etl(spark: SparkSession, roles: Roles, out_dir: str, as_of: str | None = None,
            job_name: str = ETL_JOB) -> dict[str, int]:
    """Write user_features, destination_features, interaction_matrix,
    transactions_clean and metadata/etl_summary under ``out_dir``."""
    counts: dict[str, int] = {}
    p = lambda name: os.path.join(out_dir, name)
    users = _write_and_reload(spark, C.clean_users(roles.users, as_of), p("stage/users_clean"),
                              "users_clean", counts)
    items = _write_and_reload(spark, C.clean_items(roles.items), p("stage/items_clean"),
                              "items_clean", counts)
    inter = _write_and_reload(spark, C.clean_interactions(roles.interactions),
                              p("stage/interactions_clean"), "interactions_clean", counts)
    txn = _write_and_reload(spark, C.clean_transactions(roles.transactions, key=roles.txn_key),
                            p("transactions_clean"), "transactions_clean", counts)
    tid = roles.txn_key[0]
    _write_and_reload(spark, FE.user_features(users, inter, txn, tid), p("user_features"),
                      "user_features", counts)
    _write_and_reload(spark, FE.item_features(items, inter, txn, roles.facilities, tid),
                      p("destination_features"), "destination_features", counts)
    _write_and_reload(spark, A.interaction_matrix(A.union_all_signals(inter, txn)),
                      p("interaction_matrix"), "interaction_matrix", counts)
    stamp = as_of or dt.datetime.now().isoformat(sep=" ")
    summary = OUT.summary_frame(spark, [
        ("total_users", counts["user_features"]),
        ("total_destinations", counts["destination_features"]),
        ("total_interactions", counts["interaction_matrix"]),
        ("total_transactions", counts["transactions_clean"]),
        ("etl_timestamp", stamp),
        ("etl_job", job_name),
    ])
    OUT.sink_summary(summary, p("metadata/etl_summary"))
    return counts


def etl_summary(users: DataFrame, items: DataFrame, matrix: DataFrame, transactions: DataFrame,
                as_of: str, job_name: str = ETL_JOB) -> DataFrame:
    """The summary table as one distributed query (four counts + two stamps)."""
    spark = users.sparkSession
    counts = OUT.summary_counts({"total_users": users, "total_destinations": items,
                                 "total_interactions": matrix, "total_transactions": transactions})
    stamps = spark.range(1).select(
        F.explode(F.array(F.struct(F.lit("etl_timestamp").alias("metric"), F.lit(as_of).alias("value")),
                          F.struct(F.lit("etl_job").alias("metric"), F.lit(job_name).alias("value"))))
        .alias("s")).select("s.metric", "s.value")
    return counts.unionByName(stamps)


def training_metadata(items: DataFrame, interactions: DataFrame, n_users: int | None, rmse: float | None = None,
                      factorize: bool = False, trained_at: str | None = None, sample: int | None = 50) -> dict:
    """The record of one training run: version, stamp, metrics, sizes, algorithms."""
    m = EV.eval_precision_coverage(interactions, items, sample=sample).first()
    return {
        "version": MODEL_VERSION,
        "trained_at": trained_at or dt.datetime.now().isoformat(),
        "metrics": {"precision_at_5": m["precision_at_5"], "coverage": m["coverage"],
                    "users_evaluated": m["users_evaluated"], "rmse": rmse},
        "n_users": n_users,
        "n_destinations": items.count(),
        "n_interactions": interactions.count(),
        "algorithm": "Hybrid CF+CB",
        "cf_algorithm": "Factorization" if factorize else "UserAverage",
        "cb_algorithm": "Cosine Similarity",
    }


def run_training(spark: SparkSession, out_dir: str, items_features: DataFrame,
                 interactions: DataFrame, n_users: int | None = None, k: int = 20,
                 factorize: bool = False, trained_at: str | None = None) -> dict:
    """Neighbour table (top-k cosine), CF statistics, evaluation and metadata."""
    p = lambda name: os.path.join(out_dir, name)
    IO.require_nonempty({"items": items_features, "interactions": interactions})
    nb = SIM.cosine_topk(SIM.build_item_vectors(items_features), k=k)
    OUT.sink_parquet(nb, p("neighbours"))
    rated = CF.ratings(interactions)
    OUT.sink_parquet(CF.agg_user_mean(rated), p("user_stats"))
    rmse = None
    if factorize:
        parts, rmse = CF.cf_factorization(interactions)
        CF.save_model(parts, p("factors"))
    meta = training_metadata(items_features, interactions, n_users, rmse, factorize, trained_at)
    OUT.sink_metadata(spark, p("model_metadata"), meta)
    return meta
