"""Cleaning operators on inline rows with hand-computed answers."""

from pyspark.sql import functions as F

from wanderrank.operators import clean as C


def test_dedup_then_filter_drops_id_whose_survivor_is_invalid(spark):
    # the survivor is the smallest row by the other columns: (age 11) < (age 30)
    users = spark.createDataFrame(
        [("u1", 11, 100), ("u1", 30, 100), ("u2", 30, 100)], "user_id string, age int, budget long")
    out = C.clean_users(users)
    assert [r.user_id for r in out.collect()] == ["u2"]


def test_user_age_bounds_budget_and_null_key(spark):
    users = spark.createDataFrame(
        [("a", 11, 1), ("b", 12, 1), ("c", 80, 1), ("d", 81, 1), (None, 30, 1), ("e", 30, 0),
         ("f", None, 5)],
        "user_id string, age int, budget long")
    got = sorted(r.user_id for r in C.clean_users(users).collect())
    assert got == ["b", "c"]


def test_user_dates_and_defaults(spark):
    users = spark.createDataFrame(
        [("a", 30, 10, "2024-01-01", None), ("b", 30, 10, "not a date", False)],
        "user_id string, age int, budget long, member_since string, is_active boolean")
    rows = {r.user_id: r for r in C.clean_users(users, as_of="2024-01-11").collect()}
    assert rows["a"].days_since_join == 10 and rows["a"].is_active is True
    assert rows["b"].member_since is None and rows["b"].days_since_join is None
    assert rows["b"].is_active is False


def test_interaction_score_range_and_parts(spark):
    x = spark.createDataFrame(
        [(1, "u", "i", "view", -0.1, "2024-01-07 13:05:00"),
         (2, "u", "i", "view", 0.0, "2024-01-07 13:05:00"),
         (3, "u", "i", "view", 1.0, "2024-01-07 13:05:00"),
         (4, "u", "i", "view", 1.1, "2024-01-07 13:05:00"),
         (5, "u", None, "view", 0.5, "2024-01-07 13:05:00"),
         (6, "u", "i", "view", 0.5, "bad")],
        "interaction_id long, user_id string, item_id string, kind string, score double, ts string")
    rows = {r.interaction_id: r for r in C.clean_interactions(x).collect()}
    assert sorted(rows) == [2, 3, 6]
    # 2024-01-07 is a Sunday: day_of_week 1
    assert (rows[2].hour, rows[2].day_of_week, rows[2].month) == (13, 1, 1)
    assert rows[6].ts is None and rows[6].hour is None


def test_transactions_filters_stay_and_flag(spark):
    t = spark.createDataFrame(
        [("t1", "u", "i", 100, "completed", "2024-01-01", "2024-01-03"),
         ("t2", "u", "i", 0, "completed", "2024-01-01", "2024-01-03"),
         ("t3", "u", "i", 100, "refunded", "2024-01-01", "2024-01-03"),
         ("t4", None, "i", 100, "cancelled", "2024-01-01", "2024-01-03"),
         ("t5", "u", "i", 50, "cancelled", "2024-01-05", "oops")],
        "txn_id string, user_id string, item_id string, paid long, status string, "
        "check_in string, check_out string").withColumn("txn_date", F.col("check_in"))
    rows = {r.txn_id: r for r in C.clean_transactions(t).collect()}
    assert sorted(rows) == ["t1", "t5"]
    assert rows["t1"].stay_nights == 2 and rows["t1"].is_completed == 1
    assert rows["t5"].stay_nights is None and rows["t5"].is_completed == 0


def test_dedup_is_deterministic_under_shuffled_input(spark):
    rows = [("k", i % 3, f"v{i}") for i in range(30)]
    a = spark.createDataFrame(rows, "id string, x int, y string")
    b = spark.createDataFrame(list(reversed(rows)), "id string, x int, y string").repartition(7)
    assert C.dedup_by_key(a, "id").collect() == C.dedup_by_key(b, "id").collect()
    assert C.dedup_by_key(a, "id").first().y == "v0"
