"""Dyadic price blocks and packed id rows against a direct reading of the filter."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wanderrank.operators import filtered as FI
from wanderrank.operators import ranking as R
from wanderrank.operators import salted
from wanderrank.operators.indexing import running_total

REQ = "user_id long, limit long, top_n int, categories array<string>, max_budget double, province string"
ITEM = "item_id long, category string, province string, price double"


def catalogue(seed, n):
    rnd = random.Random(seed)
    prices = [None, 0.0, 5.0, 5.0, 7.5, 20.0, float("nan"), float("inf")] + [float(x) for x in range(10, 300, 7)]
    return [(i, rnd.choice(["A", "A", "A", "B", None]) if i % 97 else "rare", rnd.choice(["P", "Q", None]), rnd.choice(prices))
            for i in rnd.sample(range(10 * n), n)]


def ok(item, cats, budget, prov):
    _, c, p, price = item
    above = price is not None and budget is not None and (
        (math.isnan(price) and not math.isnan(budget)) or (not math.isnan(budget) and price > budget))
    return (not cats or c in [x for x in cats if x is not None]) and not above and (prov is None or p == prov)


def requests(seed, n):
    rnd = random.Random(seed)
    out = []
    for u in range(n):
        k = rnd.choice([1, 3, 20, 70, 200])
        out.append((u, k, k, rnd.choice([None, [], ["A"], ["B", "A", "B"], ["rare"], ["Z"], [None], ["A", None]]),
                    rnd.choice([None, -1.0, 0.0, 5.0, 19.99, 20.0, 150.0, float("inf"), float("nan")]), rnd.choice([None, None, "P", "Z"])))
    return out


@pytest.mark.parametrize("n", [1, 63, 1_000])
def test_first_passing_ids_match_brute_force(spark, n):
    items, reqs = catalogue(n, n), requests(n, 120)
    idf, rdf = spark.createDataFrame(items, ITEM), spark.createDataFrame(reqs, REQ)
    got = {}
    cands = FI.passing_candidates(rdf.drop("top_n"), idf).collect()
    for r in cands:
        got.setdefault(r.user_id, []).append(r.item_id)
    for u, k, _, cats, budget, prov in reqs:
        want = sorted(i[0] for i in items if ok(i, cats, budget, prov))[:k]
        assert sorted(got.get(u, []))[:k] == want, (u, cats, budget, prov)
        # classes x limit x (log2 n + 1)
        classes = max(1, len({c for c in cats or [] if c is not None}))
        assert len(got.get(u, [])) == len(set(got.get(u, []))) <= classes * k * (math.log2(n) + 1)
    top = FI.first_by_id(FI.passing_candidates(rdf.drop("top_n"), idf), rdf)
    assert {(r.user_id, r.item_id) for r in top.collect()} == {
        (u, x) for u, k, _, *f in reqs for x in sorted(i[0] for i in items if ok(i, *f))[:k]}


def test_a_rare_category_needs_no_deep_scan(spark):
    """Three passing items at the end of 20,000 ids: the candidates are those."""
    items = [(i, "common", "P", float(i % 50)) for i in range(20_000)] + [(20_000 + i, "rare", "P", 1.0) for i in range(3)]
    rdf = spark.createDataFrame([(u, 30, 10, ["rare"], 10.0, None) for u in range(50)], REQ)
    got = FI.passing_candidates(rdf.drop("top_n"), spark.createDataFrame(items, ITEM))
    assert got.count() == 150 and {r.item_id for r in got.select("item_id").distinct().collect()} == {20_000, 20_001, 20_002}


def test_no_requests_and_no_items(spark):
    rdf, idf = spark.createDataFrame(requests(1, 5), REQ), spark.createDataFrame(catalogue(1, 5), ITEM)
    for r, i in ((rdf.limit(0), idf), (rdf, idf.limit(0)), (rdf.withColumn("limit", F.lit(0).cast("long")), idf)):
        assert FI.passing_candidates(r.drop("top_n"), i).count() == 0
        assert FI.first_ids(r, i).count() == 0


def test_first_ids_in_packed_rows(spark):
    idf = spark.createDataFrame([(i * 3,) for i in range(150)], "item_id long")
    rdf = spark.createDataFrame([(1, 1), (2, 64), (3, 65), (4, 500), (5, 0)], "user_id long, limit long")
    got = {}
    for r in FI.first_ids(rdf, idf).collect():
        got.setdefault(r.user_id, []).append(r.item_id)
    assert {u: sorted(v) for u, v in got.items()} == {u: [i * 3 for i in range(min(k, 150))] for u, k in ((1, 1), (2, 64), (3, 65), (4, 500))}


def test_hot_rows_are_salted(spark, monkeypatch):
    monkeypatch.setattr(salted, "PER_TASK", 10)
    wanted = spark.range(100).select(F.col("id").alias("user_id"), (F.col("id") % 7 == 0).cast("int").alias("seg"))
    packed = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "seg int, what string")
    table = {r.seg: r._salts for r in salted.demand_of(wanted, ["seg"])[0].collect()}
    assert table == {0: 9, 1: 2}
    got = salted.salted_join(wanted, packed, ["seg"], "user_id")
    assert sorted((r.user_id, r.what) for r in got.collect()) == [(u, "b" if u % 7 == 0 else "a") for u in range(100)]


def test_recommendation_joins_no_raw_position(spark):
    """Packed, salted rows only: no join whose key is a position of the id order."""
    items = spark.createDataFrame([(i, "n", "AB"[i % 2], "P", 1.0 * i) for i in range(1, 40)],
                                  "item_id long, name string, category string, province string, price double")
    tr = spark.createDataFrame([(1, 3, 0.5), (2, 4, 0.5)], "user_id long, item_id long, score double")
    req = spark.createDataFrame([(1, 3, ["A"]), (2, 3, None)], "user_id long, top_n int, categories array<string>")
    df = R.recommend_batch(req, tr, items)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join" in x]
    assert joins and not any("pos#" in x for x in joins)
    assert any("_salt#" in x and "seg#" in x for x in joins)
    assert "Cartesian" not in plan and df.count() == 6


def test_running_total_over_a_hot_key(spark):
    rnd = random.Random(5)
    rows = [("hot" if i % 3 else None, rnd.randrange(50), i, i % 4) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, a int, b int, w int")
    got = {r.b: r.t for r in running_total(df, ["k"], ["a", "b"], F.col("w"), "t").collect()}
    for k, a, b, w in rows:
        assert got[b] == sum(x[3] for x in rows if x[0] == k and (x[1], x[2]) <= (a, b))


@pytest.mark.parametrize("n", [63, 1_000])
def test_requests_that_admit_the_same_items_share_a_list(spark, monkeypatch, n):
    items, reqs = catalogue(n, n), requests(n + 1, 120)
    reqs += [(1000 + i, 3 + i % 5, 3, ["A", "B"], 1e9 + i, None) for i in range(200)]  # other budgets, the same items
    wanted, blocks = [], FI.prefix_blocks
    monkeypatch.setattr(FI, "prefix_blocks", lambda r: wanted.append(r.count()) or blocks(r))
    got = {}
    for r in FI.passing_lists(spark.createDataFrame(reqs, REQ).drop("top_n"), spark.createDataFrame(items, ITEM)).collect():
        assert r.ids and r.ids == sorted(r.ids)
        got.setdefault(r.user_id, []).extend(r.ids)
    for u, k, _, cats, budget, prov in reqs:
        assert sorted(got.get(u, []))[:k] == sorted(i[0] for i in items if ok(i, cats, budget, prov))[:k], (u, cats, budget, prov)
        assert len(got.get(u, [])) <= k * max(1, len(set(cats or [])))
    assert sum(wanted) <= 200  # a prefix for every request and class would be over 400


def test_a_long_limit_takes_the_other_path(spark, monkeypatch):
    """The same answers whether a request reads a list or meets its candidates row by row."""
    rnd = random.Random(2)
    items = spark.createDataFrame([(i, "n", rnd.choice("AB"), "P", 1.0 * rnd.randrange(9)) for i in range(1, 200)],
                                  "item_id long, name string, category string, province string, price double")
    tr = spark.createDataFrame([(u, rnd.randrange(1, 60), 0.5) for u in range(12) for _ in range(1 + 9 * (u % 3))],
                               "user_id long, item_id long, score double")
    req = spark.createDataFrame([(u, 6, ["A"], 1.0 * (u % 8)) for u in range(12)],
                                "user_id long, top_n int, categories array<string>, max_budget double")
    asked, lists = [], R.passing_lists
    monkeypatch.setattr(R, "passing_lists", lambda r, i: asked.append(r.count()) or lists(r, i))
    rows = lambda: sorted((r.user_id, r["rank"], r.item_id) for r in R.recommend_batch(req, tr, items).collect())
    whole = rows()
    monkeypatch.setattr(R, "LIST", 15)
    assert rows() == whole and asked[0] == 12 and 0 < asked[1] < 12
