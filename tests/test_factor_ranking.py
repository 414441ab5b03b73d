"""recommend_batch_factorized against the ranking rules computed pair by pair."""

import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from wanderrank.operators import collaborative as CFM
from wanderrank.operators import ranking as R
from wanderrank.operators import similarity as SIM


def _weights(n):
    return (0.2, 0.8) if n < 5 else (0.5, 0.5) if n < 20 else (0.7, 0.3)


def _norm(d):
    if not d:
        return {}
    lo, hi = min(d.values()), max(d.values())
    return {k: 0.5 for k in d} if hi == lo else {k: (v - lo) / (hi - lo) for k, v in d.items()}


def test_factorized_recommend_matches_bruteforce(spark):
    rnd = random.Random(11)
    catalog = {i: (rnd.choice("AB"), rnd.choice("PQ"), float(rnd.choice(range(10, 100, 9))))
               for i in range(1, 61)}
    train = [(u, rnd.choice(list(catalog)), round(rnd.random() * 5, 2))
             for u in range(1, 16) for _ in range(rnd.choice([1, 6, 25]))]
    tr = spark.createDataFrame(train, "user_id long, item_id long, score double")
    parts, _ = CFM.cf_factorization(tr, rank=3, max_iter=4)
    uvec, ivec = CFM._augmented(parts)
    gval = parts["global"]
    U = {r.user_id: np.array(r.vec) for r in uvec.collect() if r.vec is not None}
    V = {r.item_id: np.array(r.vec) for r in ivec.collect() if r.vec is not None}

    items = spark.createDataFrame([(i, f"n{i}", c, p, pr) for i, (c, p, pr) in catalog.items()],
                                  "item_id long, name string, category string, province string, price double")
    vecs = spark.createDataFrame([(i, [rnd.random(), rnd.random()]) for i in catalog],
                                 "item_id long, features array<double>")
    nb = SIM.cosine_topk(vecs, k=20)
    nb_rows = defaultdict(list)
    for r in nb.orderBy("src", "rank").collect():
        nb_rows[r.src].append((r.dst, r.score))
    requests = [(u, rnd.choice([3, 5, 10]), rnd.sample(list(catalog), rnd.choice([0, 1, 2])),
                 rnd.choice([None, ["A"]]), rnd.choice([None, 40.0, 5.0]), None) for u in range(1, 19)]
    req = spark.createDataFrame(requests, "user_id long, top_n int, favorites array<long>, "
                                          "categories array<string>, max_budget double, province string")
    got = R.recommend_batch_factorized(req, tr, items, parts, nb, block_rows=7).collect()

    n = Counter(u for u, _, _ in train)
    seen = defaultdict(set)
    for u, i, _ in train:
        seen[u].add(i)
    rank = parts["rank"]
    for u, top_n, favs, cats, budget, prov in requests:
        uv = U.get(u, np.concatenate([[gval, 1.0], np.zeros(rank)]))
        s = {i: float(np.round(np.clip(uv @ V.get(i, np.concatenate([[1.0, 0.0], np.zeros(rank)])), 0, 5), 4))
             for i in catalog if i not in seen[u]}
        cf = _norm(s)
        cb = {}
        for f in favs:
            for dst, sc in nb_rows.get(f, [])[:20]:
                cb[dst] = max(cb.get(dst, 0), round(sc, 4))
        cbn = _norm(cb)
        w_cf, w_cb = _weights(n.get(u, 0))
        final = {k: w_cf * cf.get(k, 0) + w_cb * cbn.get(k, 0) for k in set(cf) | set(cbn)}
        if cats or budget is not None:
            kept = {k: v for k, v in final.items()
                    if (not cats or catalog[k][0] in cats) and (budget is None or catalog[k][2] <= budget)}
            if kept:
                final = kept
        want = [k for k, _ in sorted(final.items(), key=lambda kv: (-kv[1], kv[0]))[:top_n]]
        have = [r.item_id for r in sorted((r for r in got if r.user_id == u), key=lambda r: r["rank"])]
        assert have == want, (u, have, want)


def test_factorized_cf_topn_matches_pairwise(spark):
    rnd = random.Random(4)
    train = [(u, rnd.randint(1, 40), round(rnd.random() * 5, 2)) for u in range(1, 12) for _ in range(8)]
    tr = spark.createDataFrame(train, "user_id long, item_id long, score double")
    items = spark.createDataFrame([(i,) for i in range(1, 41)], "item_id long")
    parts, rmse = CFM.cf_factorization(tr, rank=3, max_iter=4)
    assert rmse is not None and rmse >= 0
    uvec, ivec = CFM._augmented(parts)
    U = {r.user_id: np.array(r.vec) for r in uvec.collect() if r.vec is not None}
    V = {r.item_id: np.array(r.vec) for r in ivec.collect() if r.vec is not None}
    gval = parts["global"]
    req = spark.createDataFrame([(u, 5) for u in range(1, 14)], "user_id long, top_n int")
    got = CFM.cf_recommend_factorized(parts, req, items, tr, block_rows=4).collect()
    seen = defaultdict(set)
    for u, i, _ in train:
        seen[u].add(i)
    rank = parts["rank"]
    for u in range(1, 14):
        uv = U.get(u, np.concatenate([[gval, 1.0], np.zeros(rank)]))
        pred = {i: float(np.clip(uv @ V.get(i, np.concatenate([[1.0, 0.0], np.zeros(rank)])), 0, 5))
                for i in range(1, 41) if i not in seen[u]}
        want = sorted(pred, key=lambda i: (-pred[i], i))[:5]
        have = [r.item_id for r in sorted((r for r in got if r.user_id == u), key=lambda r: r["rank"])]
        assert have == want, (u, have, want)


def test_two_factorized_requests_of_one_user(spark, tmp_path):
    train = [(u, (u * 7 + k) % 30 + 1, float(k % 5)) for u in range(1, 8) for k in range(6)]
    tr = spark.createDataFrame(train, "user_id long, item_id long, score double")
    items = spark.createDataFrame([(i, "n", "AB"[i % 2], "P", 1.0) for i in range(1, 31)],
                                  "item_id long, name string, category string, province string, price double")
    parts, _ = CFM.cf_factorization(tr, rank=2, max_iter=2)
    CFM.save_model(parts, str(tmp_path / "m"))
    kept = CFM.load_model(spark, str(tmp_path / "m"))
    req = spark.createDataFrame([(10, 1, 3, ["A"]), (11, 1, 4, ["B"]), (12, 2, 2, None)],
                                "request_id long, user_id long, top_n int, categories array<string>")
    rows = R.recommend_batch_factorized(req, tr, items, parts).collect()
    assert sorted((r.request_id, r.user_id, r["rank"]) for r in rows) == \
        [(10, 1, k) for k in (1, 2, 3)] + [(11, 1, k) for k in (1, 2, 3, 4)] + [(12, 2, 1), (12, 2, 2)]
    assert {r.category for r in rows if r.request_id == 10} == {"A"} and {r.category for r in rows if r.request_id == 11} == {"B"}
    again = R.recommend_batch_factorized(req, tr, items, kept).collect()
    key = lambda r: (r.request_id, r["rank"], r.item_id, r.hybrid_score)
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_factor_model_on_structure_and_noise(spark):
    rnd = random.Random(3)
    taste = {u: rnd.choice([0, 1]) for u in range(60)}
    structured = [(u, i, 4.0 if (i % 2) == taste[u] else 1.0) for u in taste for i in rnd.sample(range(40), 20)]
    noise = [(u, i, rnd.random()) for u in taste for i in rnd.sample(range(40), 20)]
    for rows, bound in ((structured, 0.7), (noise, 1.03)):
        tr = spark.createDataFrame(rows, "user_id long, item_id long, score double")
        _, rmse = CFM.cf_factorization(tr, rank=8, max_iter=8)
        te = CFM.split_ratings(tr)[1]
        mean = sum(r[2] for r in rows) / len(rows)
        base = CFM.eval_rmse(te.withColumn("p", F.lit(mean)), "rating", "p")
        assert rmse < bound * base, (rmse, base)


def test_only_items_with_vectors_are_scored_in_blocks(spark, monkeypatch):
    ids = range(1, 201)
    items = spark.createDataFrame([(i, f"n{i}", "AB"[i % 2], "P", float(i)) for i in ids],
                                  "item_id long, name string, category string, province string, price double")
    vec = {i: [1.0, 0.01 * i, (-1.0) ** i * i / 10] for i in range(20, 32)}
    parts = {"global": 2.0, "rank": 1, "vectors": (
        spark.createDataFrame([(1, [2.5, 1.0, 0.3]), (2, [1.0, 1.0, -0.5])], "user_id long, vec array<double>"),
        spark.createDataFrame(list(vec.items()), "item_id long, vec array<double>"))}
    tr = spark.createDataFrame([(1, 20, 1.0), (1, 5, 1.0), (3, 21, 1.0), (3, 1, 1.0)], "user_id long, item_id long, score double")
    req = spark.createDataFrame([(1, 6, None), (2, 6, ["A"]), (3, 6, None), (4, 15, ["B"])],
                                "user_id long, top_n int, categories array<string>")
    scored, visits = [], []
    meet = R.IP.meet_blocks

    def spy(routes, blocks, *rest):
        scored.append(blocks.count())
        visits.append(routes.count())
        return meet(routes, blocks, *rest)
    monkeypatch.setattr(R.IP, "meet_blocks", spy)
    got = R.recommend_batch_factorized(req, tr, items, parts, block_rows=3).collect()
    assert scored == [len(vec), len(vec)] and visits[0] == 4 and sum(visits) <= 4 * 4  # 4 blocks of 3, not 67
    seen = {1: {20, 5}, 3: {21, 1}}
    users = {1: [2.5, 1.0, 0.3], 2: [1.0, 1.0, -0.5]}
    for u, n, want in ((1, 6, None), (2, 6, "A"), (3, 6, None), (4, 15, "B")):
        s = {i: round(float(np.clip(np.dot(users.get(u, [2.0, 1.0, 0.0]), vec.get(i, [1.0, 0.0, 0.0])), 0, 5)), 4)
             for i in ids if i not in seen.get(u, ())}
        best = sorted((k for k in s if want is None or "AB"[k % 2] == want), key=lambda i: (-s[i], i))[:n]
        rows = sorted((r for r in got if r.user_id == u), key=lambda r: r["rank"])
        lo, hi = min(s.values()), max(s.values())
        assert [r.item_id for r in rows] == best, u
        assert np.allclose([r.cf_score for r in rows], [round((s[i] - lo) / (hi - lo), 4) for i in best], atol=1e-4)


def test_the_last_plan_is_short(spark):
    """Fill, cb items and ranking are written one after the other: what is left to run joins the catalogue and the users."""
    items = spark.createDataFrame([(i, f"n{i}", "AB"[i % 2], "P", float(i)) for i in range(1, 41)],
                                  "item_id long, name string, category string, province string, price double")
    parts = {"global": 2.0, "rank": 1, "vectors": (
        spark.createDataFrame([(1, [2.5, 1.0, 0.3])], "user_id long, vec array<double>"),
        spark.createDataFrame([(i, [1.0, 0.01 * i, 0.1]) for i in range(5, 9)], "item_id long, vec array<double>"))}
    tr = spark.createDataFrame([(1, 5, 1.0), (2, 6, 1.0)], "user_id long, item_id long, score double")
    req = spark.createDataFrame([(1, 3, ["A"]), (2, 3, None)], "user_id long, top_n int, categories array<string>")
    out = R.recommend_batch_factorized(req, tr, items, parts)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2 and "Window" not in plan  # before: all joins and windows in one plan
    assert out.count() == 6
