"""Blocks of near vectors: bounds hold, near blocks only are visited, copies and odd rows."""

import numpy as np
from pyspark.sql import functions as F

from wanderrank.operators import cells
from wanderrank.operators import similarity as SIM


def _unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_few_blocks_are_visited_and_none_is_missed(spark):
    rng = np.random.default_rng(5)
    x = _unit(np.repeat(rng.random((40, 5)), 25, axis=0) + rng.normal(0, 1e-3, (1000, 5)))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "cls long, u array<double>")
    df = df.withColumn("floor", F.lit(0.9999))
    out, assign, reach = cells.blocks(df, "u", "cls", 25)
    block = {r.cls: r.block for r in out.collect()}
    assert {r.cls: r.block for r in assign(df).collect()} == block
    seen = {(r.cls, r.block) for r in reach(out, 1e-9).collect()}
    assert len(seen) < len(x) * len(set(block.values())) / 5  # before: every block for every row
    near = x @ x.T >= 0.9999
    assert all((i, block[j]) in seen for i, j in zip(*np.nonzero(near)) if block[i] != block[j])


def test_copies_odd_vectors_and_repeated_ids(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.integers(0, 3, 3).astype(float).tolist()) for i in range(60)]        # many equal vectors, zero ones
    rows += [(7, [9.0, 1.0, 0.0]), (7, [0.0, 1.0, 9.0]), (8, rows[8][1]), (90, [0.0, 0.0, 0.0])]  # an id with three vectors, a row twice
    k = 4
    ids, u = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    norm = np.linalg.norm(u, axis=1, keepdims=True)
    u = np.divide(u, norm, out=np.zeros_like(u), where=norm > 0)
    want = {}
    for src in set(ids.tolist()):
        cand = [(-round(float(u[a] @ u[b]), 12), int(ids[b])) for a in np.flatnonzero(ids == src) for b in np.flatnonzero(ids != src)]
        want[src] = [(d, round(-s, 6)) for s, d in sorted(cand)[:k]]
    odd = [(91, None), (92, [float("nan"), 1.0, 1.0])]
    df = spark.createDataFrame(rows + odd, "item_id long, features array<double>")
    for block_rows in (5, 1000):
        got = {}
        for r in sorted(SIM.cosine_topk(df, k=k, block_rows=block_rows).collect(), key=lambda r: (r.src, r["rank"])):
            got.setdefault(r.src, []).append((r.dst, round(r.score, 6)))
        assert got == want


def test_a_task_scores_few_queries_at_once(monkeypatch):
    import pandas as pd
    sizes = []
    monkeypatch.setattr(SIM, "topk_rows", lambda s, *a: sizes.append(s.shape) or (np.empty(0, int), np.empty(0, int)))
    u = list(np.ones((600, 2)))
    q = pd.DataFrame({"qid": range(600), "u": u, "self": None, "floor": np.nan})
    SIM._topk_block(3)((0, 0), q, pd.DataFrame({"cls": range(600), "c_u": u, "first": range(600), "name": ""}))
    assert sum(r for r, _ in sizes) == 600 and max(r for r, _ in sizes) <= 256


def _items(n):
    """Vectors like those of items: two spread entries, a flag of four, two codes."""
    rng = np.random.default_rng(8)
    x = np.zeros((n, 8))
    x[:, 0], x[:, 1] = rng.random(n), rng.integers(0, 50, n) / 49
    x[np.arange(n), 2 + rng.integers(0, 4, n)] = 1
    x[:, 6], x[:, 7] = rng.integers(0, 6, n) / 5, rng.integers(0, 25, n) / 24
    return _unit(x)


def test_distances_bound_unit_vectors(spark):
    x = _items(2000)
    s = x @ x.T
    floor = np.sort(s, axis=1)[:, -6]
    df = spark.createDataFrame([(i, r.tolist(), float(f)) for i, (r, f) in enumerate(zip(x, floor))],
                               "cls long, u array<double>, floor double")
    out, _, reach = cells.blocks(df, "u", "cls", 63)
    block = np.array([r.block for r in out.orderBy("cls").collect()])
    seen = {(r.cls, r.block) for r in reach(out, 1e-9).collect()}
    assert len(seen) < 3 * len(x)  # before: 7 blocks for a row
    assert all((i, block[j]) in seen for i, j in zip(*np.nonzero(s >= floor[:, None])) if block[i] != block[j])


def test_a_query_is_scored_against_few_rows_of_its_block(monkeypatch):
    import pandas as pd
    x, k, cost = _items(2000), 6, []
    topk = SIM.topk_rows
    monkeypatch.setattr(SIM, "topk_rows", lambda s, *a: cost.append(s.size) or topk(s, *a))
    n = len(x)
    got = SIM._topk_block(k)((0, 0), pd.DataFrame({"qid": range(n), "u": list(x), "self": None, "floor": np.nan}),
                             pd.DataFrame({"cls": range(n), "c_u": list(x), "first": range(n), "name": ""}))
    s = np.round(x @ x.T, 12)
    want = {(i, j) for i in range(n) for j in np.lexsort((np.arange(n), -s[i]))[:k]}
    assert set(zip(got.qid, got.cls)) == want and len(got) == n * k
    assert sum(cost) < n * n / 3  # before: every row of the block


def test_a_visit_gives_one_row_a_query(spark):
    x = _items(300)
    df = spark.createDataFrame([(i, [(i, 1)], str(i), r.tolist(), 0) for i, r in enumerate(x)],
                               "cls long, ids array<struct<dst: long, m: int>>, name string, u array<double>, block long")
    routes = df.select(F.col("cls").alias("qid"), "u", F.lit(None).cast("string").alias("self"),
                       F.lit(None).cast("double").alias("floor"), "block")
    rows = SIM._visit(routes, df, 4, 100).collect()
    s = np.round(x @ x.T, 12)
    assert len(rows) == 300 and all([e.dst for e in r.near] == np.lexsort((np.arange(300), -s[r.qid]))[:4].tolist() for r in rows)
    assert all(abs(r.floor - r.near[-1].score) < 1e-15 for r in rows)


def test_text_ids_and_no_rows(spark):
    rows = [(f"D{i:02d}", r.tolist()) for i, r in enumerate(_items(30))] + [("D03", [1.0] * 8), (None, [0.5] * 8)]
    df = spark.createDataFrame(rows, "item_id string, features array<double>")
    u = _unit(np.array([r[1] for r in rows]))
    for src in ("D00", "D03", "D29"):
        cand = sorted((-round(float(u[a] @ u[b]), 12), rows[b][0] or "") for a in range(32) for b in range(32) if rows[a][0] == src != rows[b][0])
        got = SIM.cosine_topk(df, k=3, block_rows=8, queries=df.where(F.col("item_id") == src)).orderBy("rank").collect()
        assert [(r.dst or "", round(r.score, 9)) for r in got] == [(d, round(-s, 9)) for s, d in cand[:3]]
    assert SIM.cosine_topk(df.limit(0), k=3).count() == 0
