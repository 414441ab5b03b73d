"""Aggregates and feature tables on inline rows (FIXTURES edge cases)."""

import datetime as dt

from wanderrank.operators import aggregate as A
from wanderrank.operators import features as FE

T0 = dt.datetime(2024, 1, 1)


def _inter(spark, rows):
    return spark.createDataFrame(
        rows, "interaction_id long, user_id string, item_id string, kind string, score double, "
              "ts timestamp, rating_given double")


def _txn(spark, rows):
    return spark.createDataFrame(
        rows, "txn_id string, user_id string, item_id string, paid long, status string, "
              "stay_nights int, is_completed int, rating_after double")


def test_matrix_caps_total_at_five(spark):
    x = _inter(spark, [(i, "u", "d", "view", 0.9, T0, None) for i in range(4)])
    t = _txn(spark, [(f"t{i}", "u", "d", 10, "completed", 1, 1, None) for i in range(3)]
             + [("t9", "u", "d", 10, "cancelled", 1, 0, None)])
    m = A.interaction_matrix(A.union_all_signals(x, t)).first()
    assert (round(m.total_score, 6), m.interaction_count, m.final_score) == (6.6, 7, 5.0)


def test_review_rating_average_ignores_other_kinds(spark):
    x = _inter(spark, [(1, "u", "d", "review", 0.5, T0, 4.0), (2, "u", "d", "review", 0.5, T0, None),
                       (3, "u", "d", "like", 0.5, T0, 1.0)])
    r = A.agg_item_popularity(x).first()
    assert r.avg_user_rating == 4.0 and r.total_views == 3 and r.unique_visitors == 1


def test_user_and_item_without_activity_get_fills(spark):
    users = spark.createDataFrame([("u1", 100), ("u2", 50)], "user_id string, budget long")
    items = spark.createDataFrame([("d1", "A", "P", 10.0, "wifi"), ("d2", "B", "P", 20.0, None)],
                                  "item_id string, category string, province string, price double, "
                                  "facilities string")
    x = _inter(spark, [(1, "u1", "d1", "book", 0.5, T0, None)])
    t = _txn(spark, [("t1", "u1", "d1", 100, "completed", 2, 1, 5.0)])
    uf = {r.user_id: r for r in FE.user_features(users, x, t).collect()}
    assert uf["u2"].total_interactions == 0 and uf["u2"].avg_spend == 0.0
    assert uf["u2"].last_interaction is None and uf["u2"].max_spend is None
    assert abs(uf["u1"].engagement_score - 9 / 13) < 1e-12
    itf = {r.item_id: r for r in FE.item_features(items, x, t, ["wifi"]).collect()}
    assert itf["d2"].total_revenue == 0 and itf["d2"].total_completed_bookings is None
    assert itf["d2"].avg_interaction_score is None and itf["d2"].has_wifi == 0
    # one-item categories: (x - min) / (max - min + 1) = 0
    assert itf["d1"].price_normalized == 0.0 and itf["d2"].price_normalized == 0.0


def test_index_null_bucket_and_label_default(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("b", None), (None, "z")], "id string, c string")
    # frequencies all 1: alphabetical x, y, z -> 0, 1, 2; null -> extra bucket 3
    key = lambda t: (t[0] is not None, t[0] or "")
    rows = sorted(((r.c, r.i) for r in FE.index_category(df, "c", "i").collect()), key=key)
    assert rows == [(None, 3.0), ("x", 0.0), ("y", 1.0), ("z", 2.0)]
    enc = sorted(((r.c, r.e) for r in FE.label_encode(df, "c", "e", default="y").collect()), key=key)
    assert enc == [(None, 1.0), ("x", 0.0), ("y", 1.0), ("z", 2.0)]


def test_many_labels_are_numbered_by_a_distributed_sort(spark, monkeypatch):
    rows = [(i, None if i % 7 == 0 else f"l{i % 13:02d}") for i in range(200)]
    df = spark.createDataFrame(rows, "item_id long, category string")
    out = []
    for small in (100_000, 3):
        monkeypatch.setattr(FE, "SMALL_ROWS", small)
        a = FE.index_category(df, "category", "c")
        out.append(sorted((r.item_id, r.c, r.d) for r in FE.label_encode(a, "category", "d", default="l00").collect()))
    assert out[0] == out[1]
