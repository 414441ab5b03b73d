"""Registered queries of repeated runs: incremental states, the bucketed session store,
drifting raw files, live alarms and the whole training record. Each reads whole
driver tables (or files derived from them) and has a DuckDB twin."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderrank.operators import chat as CH
from wanderrank.plans import etl as ETL
from wanderrank.plans import incremental as INC
from wanderrank.plans import queries as Q
from wanderrank.plans.roles import driver_roles, read_table
from wanderrank.sources import drift as DR
from wanderrank.sources import sessions as SES
from wanderrank.sources import sinks as OUT
from wanderrank.streaming import metrics as MET
from wanderrank.streaming import state as ST


# ---------------------------------------------------------------- incremental aggregates

def _increments(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The cleaned rows in three runs; the last one meets all rows of the second again."""
    c = Q.cleaned(spark, sf_dir, reuse=True)
    path = Q._round_trip(spark, "increments")
    third = lambda df, key, k: df.where(F.col(key) % 3 == k)
    states = None
    for run, parts in enumerate([(0,), (1,), (1, 2)]):
        i, t = (None, None)
        for k in parts:
            x, y = third(c.interactions, "interaction_id", k), third(c.transactions, c.txn_id, k)
            i, t = (x, y) if i is None else (i.unionByName(x), t.unionByName(y))
        states = INC.run_increment(spark, path, run, i, t, c.roles.txn_key)
    return INC.finish(states)


def _increment(table: str):
    return lambda spark, sf_dir: _increments(spark, sf_dir)[table]


# ---------------------------------------------------------------- sessions

def _session_table(spark: SparkSession, sf_dir: str) -> str:
    spark.sql("CREATE DATABASE IF NOT EXISTS wr_sessions")
    path = Q._round_trip(spark, "sessions")
    table = f"wr_sessions.turns_{os.path.basename(path).replace('-', '_')}"
    SES.write_sessions(driver_roles(spark, sf_dir).turns, table, path)
    return table


def q_chat_history_store(spark, sf_dir):
    """chat_history from the bucketed session table."""
    return CH.chat_history(spark.table(_session_table(spark, sf_dir)))


def q_session_range(spark, sf_dir):
    """The newest five turns of every session from the bucketed table."""
    return SES.session_range(spark, _session_table(spark, sf_dir), limit=5, ascending=False).select(
        "session_id", "turn", "role", "pos")


# ---------------------------------------------------------------- raw files with drift

def q_scan_drift(spark, sf_dir):
    """Three CSV drops of the catalogue: whole prices; an added column and decimal
    prices in another column order; text in a column that held numbers."""
    c = Q.cleaned(spark, sf_dir)
    path = Q._round_trip(spark, "drift")
    i = F.col("item_id")
    items = c.items.select("item_id", "province", F.col("price").cast("double").alias("price"))
    drops = [items.where(i % 3 == 0).select("item_id", F.floor("price").alias("price"), (i % 10).alias("code")),
             items.where(i % 3 == 1).select("price", "province", "item_id", (i % 10).alias("code")),
             items.where(i % 3 == 2).select("item_id", "price", F.concat(F.lit("x"), (i % 10).cast("string")).alias("code"))]
    for k, df in enumerate(drops):
        df.write.option("header", True).csv(os.path.join(path, f"week={k}"))
    out = DR.scan_drifting(spark, path)
    kinds = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in sorted(out.schema, key=lambda f: f.name) if f.name != "item_id")
    return out.select(F.col("item_id").cast("bigint").alias("item_id"), "price", "code", "province", F.lit(kinds).alias("types"))


# ---------------------------------------------------------------- live alarms

STREAM_ALARMS = [MET.Alarm("errors", "errors", 0, 2), MET.Alarm("server_errors", "errors", 1, 1, level="all")]


def q_alarm_stream(spark, sf_dir):
    """The event log replayed as a stream through the alarm state: every final period,
    up to each name's last one."""
    driver_roles(spark, sf_dir)
    raw = read_table(spark, sf_dir, "events")
    src = os.path.join(Q._round_trip(spark, "events"), "in")
    ordered = MET.log_from_events(raw).withColumn("ts", F.col("ts").cast("timestamp"))
    ordered.repartitionByRange(6, "ts").write.parquet(src)
    log = spark.readStream.schema(ordered.schema).parquet(src)
    out = Q._round_trip(spark, "alarms")
    q = ST.start_stateful(ST.stream_alarms(log, STREAM_ALARMS), lambda w: w.format("parquet").option("path", out + "/rows"),
                          out + "/state")
    q.awaitTermination()
    told = spark.read.parquet(out + "/rows")
    last = told.where("value is not null").groupBy("alarm", "name").agg(F.max("window_start").alias("_last"))
    return (told.join(last, ["alarm", "name"]).where("window_start <= _last").drop("_last")
            .withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))


# ---------------------------------------------------------------- training record

def q_sink_metadata_all(spark, sf_dir):
    """The whole record of a training run, written as JSON and read back by field."""
    c = Q.cleaned(spark, sf_dir, reuse=True)
    path = Q._round_trip(spark, "metadata")
    meta = ETL.training_metadata(c.items, c.interactions, c.users.count(), trained_at=str(dt.date(2024, 2, 1)), sample=None)
    OUT.sink_metadata(spark, path, meta)
    j = spark.read.text(path)
    get = lambda k, t: F.get_json_object("value", f"$.{k}").cast(t)
    return j.select(*[get(k, "string").alias(k) for k in ("version", "trained_at", "algorithm", "cf_algorithm", "cb_algorithm")],
                    *[get(k, "bigint").alias(k) for k in ("n_users", "n_destinations", "n_interactions")],
                    get("metrics.precision_at_5", "double").alias("precision_at_5"),
                    get("metrics.coverage", "double").alias("coverage"),
                    get("metrics.users_evaluated", "bigint").alias("users_evaluated"))


QUERIES = {
    **Q.QUERIES,
    "incremental_matrix": _increment("interaction_matrix"),
    "incremental_user_interactions": _increment("agg_user_interactions"),
    "incremental_user_transactions": _increment("agg_user_transactions"),
    "incremental_item_popularity": _increment("agg_item_popularity"),
    "incremental_item_revenue": _increment("agg_item_revenue"),
    "chat_history_store": q_chat_history_store,
    "session_range": q_session_range,
    "scan_drift": q_scan_drift,
    "alarm_stream": q_alarm_stream,
    "sink_metadata_all": q_sink_metadata_all,
}
