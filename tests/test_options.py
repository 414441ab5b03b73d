"""Options of the operators: exact-token flags, small-data CF, reject mode, short context."""

import pytest
from pyspark.sql import functions as F

from wanderrank.functions.scalar import contains_flag
from wanderrank.operators import chat as CH
from wanderrank.operators import collaborative as CFM
from wanderrank.operators import ranking as R


def test_contains_substring_vs_exact_token(spark):
    df = spark.createDataFrame([("guided tour, wifi",), ("guide,parkir",)], "f string")
    sub = [r.x for r in df.select(contains_flag(F.col("f"), "guide").alias("x")).collect()]
    tok = [r.x for r in df.select(contains_flag(F.col("f"), "guide", exact_token=True).alias("x")).collect()]
    assert sub == [1, 1] and tok == [0, 1]


@pytest.mark.parametrize("n", [0, 1, 50, 51])
def test_factor_model_of_any_size_recommends(spark, n):
    few = spark.createDataFrame([(k % 7, k % 9 + 1, 0.5) for k in range(n)], "user_id long, item_id long, score double")
    items = spark.createDataFrame([(i, "x", "A", "P", 1.0) for i in range(1, 15)],
                                  "item_id long, name string, category string, province string, price double")
    parts, rmse = CFM.cf_factorization(few, rank=2, max_iter=1)
    assert rmse is None or rmse >= 0
    req = spark.createDataFrame([(1, 3), (99, 3)], "user_id long, top_n int")
    got = CFM.cf_recommend_factorized(parts, req, items, few).groupBy("user_id").count().collect()
    assert {r.user_id: r["count"] for r in got} == {1: 3, 99: 3}


def test_requests_of_one_user_do_not_mix(spark):
    items = spark.createDataFrame([(i, "x", "AB"[i % 2], "P", 1.0) for i in range(1, 30)],
                                  "item_id long, name string, category string, province string, price double")
    tr = spark.createDataFrame([(1, 1, 0.5)], "user_id long, item_id long, score double")
    rows = [(1, 3, ["A"]), (1, 5, ["B"]), (1, 30, None)]
    req = spark.createDataFrame(rows, "user_id long, top_n int, categories array<string>")
    got = sorted((r["rank"], r.item_id) for r in R.recommend_batch(req, tr, items, max_top_n=None).collect())
    want = [(k + 1, i) for ids in ([2, 4, 6], [3, 5, 7, 9, 11], range(2, 30)) for k, i in enumerate(ids)]
    assert got == sorted(want)
    keyed = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)],
                                  "request_id long, user_id long, top_n int, categories array<string>")
    out = R.recommend_batch(keyed, tr, items)
    assert out.columns == ["request_id", *R.OUTPUT_COLUMNS]
    assert sorted(r.request_id for r in out.collect()) == [0] * 3 + [1] * 5 + [2] * 20
    flags = R.normalize_requests(keyed.drop("request_id")).collect()
    assert sorted((r.top_n, r.clamped) for r in flags) == [(3, False), (5, False), (20, True)]


def test_similarity_copies_candidates_per_query_block(spark):
    from wanderrank.operators.similarity import block_copies
    v = spark.createDataFrame([(i, [1.0]) for i in range(100)], "item_id long, u array<double>")
    q, c = block_copies(v.filter("item_id < 5"), v, 10)
    assert c.count() == 100 and q.count() == 5 * 10
    q, c = block_copies(v.filter("item_id < 25"), v, 10)
    assert c.count() == 100 * 3


def test_reject_mode_drops_out_of_range_requests(spark):
    items = spark.createDataFrame([(i, "x", "A", "P", 1.0) for i in range(1, 30)],
                                  "item_id long, name string, category string, province string, price double")
    tr = spark.createDataFrame([(1, 1, 0.5)], "user_id long, item_id long, score double")
    req = spark.createDataFrame([(1, 0), (2, 21), (3, 20), (4, None)], "user_id long, top_n int")
    got = R.recommend_batch(req, tr, items, mode="reject").groupBy("user_id").count().collect()
    assert {r.user_id: r["count"] for r in got} == {3: 20, 4: 10}
    clamp = R.recommend_batch(req, tr, items).groupBy("user_id").count().collect()
    assert {r.user_id: r["count"] for r in clamp} == {2: 20, 3: 20, 4: 10}


def test_short_context_has_three_lines(spark):
    sessions = spark.createDataFrame([("s", "u", "hi")], "session_id string, user_id string, message string")
    recs = spark.createDataFrame([("u", r, f"n{r}", "C", "P", 0.0, 1.0) for r in range(1, 6)],
                                 "user_id string, rank int, name string, category string, province string, "
                                 "rating double, price double")
    hist = spark.createDataFrame([], "session_id string, history string")
    p = CH.chat_context(sessions, recs, hist, intro="I", short=True).first().prompt
    assert p == "I\n\nRekomendasi untuk user ini:\n1. n1 (C)\n2. n2 (C)\n3. n3 (C)\n\n\nPengguna: hi\nAsisten:"
