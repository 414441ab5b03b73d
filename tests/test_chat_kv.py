"""Conversation context and key-value table semantics."""

import json

from pyspark.sql import functions as F
from wanderrank.operators import chat as CH
from wanderrank.sources import keyvalue as KV


def test_history_cap_oldest_then_last_four(spark):
    turns = spark.createDataFrame(
        [("s", t, "user" if t % 2 == 0 else "assistant", ("x" * 250) if t == 18 else f"m{t}")
         for t in range(25)], "session_id string, turn int, role string, content string")
    h = CH.chat_history(turns).first().history
    lines = h.rstrip("\n").split("\n")
    # oldest 20 turns are 0..19; the last four of those are 16..19
    assert lines[0] == "Pengguna: m16" and lines[1] == "Asisten: m17"
    assert lines[2] == "Pengguna: " + "x" * 200 and lines[3] == "Asisten: m19"
    newest = CH.chat_history(turns, cap_mode="newest").first().history
    assert newest.split("\n")[0] == "Asisten: m21"


def test_context_anonymous_has_no_recs(spark):
    sessions = spark.createDataFrame([("s1", "anonymous", "hi"), ("s2", "u1", "hello")],
                                     "session_id string, user_id string, message string")
    recs = spark.createDataFrame(
        [(u, r, f"n{r}", "C", "P", 4.5, 150000) for u in ("anonymous", "u1") for r in (1, 2, 3, 4, 5, 6)],
        "user_id string, rank int, name string, category string, province string, rating double, price long")
    hist = spark.createDataFrame([("s2", "Pengguna: a\n")], "session_id string, history string")
    out = {r.session_id: r.prompt for r in CH.chat_context(sessions, recs, hist, intro="I").collect()}
    assert out["s1"] == "I\n\nRiwayat percakapan:\n\nPengguna: hi\nAsisten:"
    p = out["s2"]
    assert "\n\nRekomendasi destinasi wisata untuk user ini:\n1. n1 (C, P) - Rating: 4.5 - Harga: Rp150,000\n" in p
    assert "5. n5" in p and "6. n6" not in p
    assert p.endswith("Riwayat percakapan:\nPengguna: a\n\nPengguna: hello\nAsisten:")


def test_append_truncates_and_expires(spark):
    store = spark.createDataFrame([("s", 0, "user", "old", 100)],
                                  "session_id string, turn int, role string, content string, ttl long")
    new = spark.createDataFrame([("s", 1, "assistant", "y" * 2500)],
                                "session_id string, turn int, role string, content string")
    out = CH.chat_append(store, new, "2024-01-01 00:00:00").collect()
    assert len(out) == 1 and len(out[0].content) == 2000


def test_ttl_boundary_kept(spark):
    df = spark.createDataFrame([(1, 1704067200), (2, 1704067199)], "id int, ttl long")
    kept = [r.id for r in KV.expire_ttl(df, "2024-01-01 00:00:00", ttl_col="ttl").collect()]
    assert kept == [1]


def test_upsert_latest_wins_and_range(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("j", 1, "c")], "key string, ts int, v string")
    got = {r.key: r.v for r in KV.upsert_by_key(df, ["key"], ["ts"]).collect()}
    assert got == {"k": "b", "j": "c"}
    rows = spark.createDataFrame([("k", i) for i in range(30)], "key string, ts int")
    r = KV.range_by_key(rows, "key", ["ts"]).collect()
    assert len(r) == 20 and max(x.ts for x in r) == 19


def test_prediction_log_json_and_key(spark):
    recs = spark.createDataFrame([(7, r, r * 10, "n", "c", "p", 4.5, 100.0, 0.5, 0.4, 0.3, 0.2, 0.8) for r in range(1, 8)],
                                 "user_id long, rank int, item_id long, name string, category string, "
                                 "province string, rating double, price double, hybrid_score double, "
                                 "cf_score double, cb_score double, w_cf double, w_cb double")
    row = KV.prediction_log(recs, "2024-02-01 00:00:00").first()
    assert row.prediction_id == "7-1706745600" and row.ttl == 1706745600 + 86400
    assert row.recommendations.count('"rank"') == 5 and row.latency_ms is None
    assert list(json.loads(row.recommendations)[0]) == KV.LOGGED_FIELDS
    timed = KV.prediction_log(recs.withColumn("ms", F.lit(12)), "2024-02-01 00:00:00", latency_ms=F.lit(38)).first()
    assert timed.latency_ms == "38"
