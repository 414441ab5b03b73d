"""Vectors and exact blocked cosine top-k."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from wanderrank import schemas
from wanderrank.operators import similarity as SIM
from wanderrank.plans.roles import travel_roles

# the 29-row destination catalogue (CSV with header); golden tests skip without it
CATALOGUE = os.environ.get("WR_CATALOGUE_CSV", "")


def _brute(vecs, k):
    ids = np.array(sorted(vecs))
    m = np.array([vecs[i] for i in ids], dtype=float)
    n = np.linalg.norm(m, axis=1)
    u = np.divide(m, n[:, None], out=np.zeros_like(m), where=n[:, None] > 0)
    s = u @ u.T
    out = {}
    for a, i in enumerate(ids):
        cand = [(round(s[a, b], 12), j, s[a, b]) for b, j in enumerate(ids) if j != i]
        cand.sort(key=lambda t: (-t[0], t[1]))
        out[i] = [(j, v) for _, j, v in cand[:k]]
    return out


@pytest.mark.parametrize("block_rows", [4, 16, 1000])
def test_blocked_cosine_equals_bruteforce(spark, block_rows):
    rng = np.random.default_rng(7)
    vecs = {i: rng.integers(0, 3, 4).astype(float).tolist() for i in range(30)}
    vecs[5] = [0.0, 0.0, 0.0, 0.0]           # zero vector: cosine 0 with all
    vecs[6] = list(vecs[7])                   # duplicate vectors: tie broken by id
    df = spark.createDataFrame(list(vecs.items()), "item_id long, features array<double>")
    got = SIM.cosine_topk(df, k=5, block_rows=block_rows).collect()
    want = _brute(vecs, 5)
    by_src = {}
    for r in sorted(got, key=lambda r: (r.src, r["rank"])):
        by_src.setdefault(r.src, []).append((r.dst, r.score))
    for i, rows in want.items():
        assert [d for d, _ in by_src[i]] == [d for d, _ in rows]
        assert all(abs(a - b) < 1e-12 for (_, a), (_, b) in zip(by_src[i], rows))
    assert all(r.src != r.dst for r in got)


def test_similarity_is_symmetric(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, rng.random(3).tolist()) for i in range(12)],
                               "item_id long, features array<double>")
    nb = {(r.src, r.dst): r.score for r in SIM.cosine_topk(df, k=11, block_rows=5).collect()}
    assert all(abs(v - nb[(b, a)]) < 1e-12 for (a, b), v in nb.items())


def test_minmax_constant_column_is_zero(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 3.0)], "item_id long, price double, rating double")
    v = {r.item_id: r.features for r in SIM.build_item_vectors(df).collect()}
    assert v[1] == [0.0, 0.0] and v[2] == [1.0, 0.0]


def check_catalogue_goldens(spark):
    """Golden values listed in FIXTURES.md for the 29-row catalogue."""
    from wanderrank.operators import clean as C
    from wanderrank.operators import features as FE

    raw = spark.read.option("header", True).schema(schemas.DESTINATION_CATALOG).csv(CATALOGUE)
    empty = spark.createDataFrame([], schemas.USER_PROFILES)
    roles = travel_roles(empty, raw, spark.createDataFrame([], schemas.USER_INTERACTIONS),
                         spark.createDataFrame([], schemas.TRANSACTION_HISTORY))
    items = C.clean_items(roles.items)
    flags = FE.facility_flags(items, schemas.TRAVEL_FACILITIES)
    sums = flags.agg(*[F.sum(f"has_{w}").alias(w) for w in schemas.TRAVEL_FACILITIES]).first()
    assert [sums[w] for w in schemas.TRAVEL_FACILITIES] == [8, 11, 24, 8, 17, 10, 1]
    free = sorted(r.item_id for r in items.filter("price = 0").collect())
    assert free == ["DST0002", "DST0005", "DST0008", "DST0021"]
    stats = {r.category: (r.lo, r.hi, r.n) for r in items.groupBy("category").agg(
        F.min("price").alias("lo"), F.max("price").alias("hi"), F.count("*").alias("n")).collect()}
    assert stats == {"Alam": (20000, 150000, 5), "Bahari": (20000, 500000, 7), "Budaya": (15000, 60000, 3),
                     "Gunung": (150000, 320000, 2), "Kuliner": (0, 0, 1), "Pantai": (0, 150000, 6),
                     "Petualangan": (70000, 100000, 2), "Sejarah": (5000, 350000, 3)}
    norm = {r.item_id: r.price_normalized
            for r in FE.group_minmax(items, "category", "price", "price_normalized").collect()}
    for k, v in {"DST0001": 0.999977778, "DST0003": 0.461534911, "DST0011": 0.999997917,
                 "DST0008": 0.0}.items():
        assert abs(norm[k] - v) < 1e-8
    idx = {r.category: r.category_idx
           for r in FE.index_category(items, "category", "category_idx").select("category", "category_idx")
           .distinct().collect()}
    assert idx == {"Bahari": 0, "Pantai": 1, "Alam": 2, "Budaya": 3, "Sejarah": 4, "Gunung": 5,
                   "Petualangan": 6, "Kuliner": 7}
    # content vectors from the raw catalogue: 4 numerics + alphabetical indexes
    vec = SIM.build_item_vectors(roles.items.select("item_id", "rating", "price", "visit_hours",
                                                    "annual_visitors", "category", "province"))
    nb = SIM.cosine_topk(vec, k=5)
    top = lambda s: [(r.dst, round(r.score, 4)) for r in nb.filter(F.col("src") == s).orderBy("rank").collect()]
    assert top("DST0001") == [("DST0024", .9319), ("DST0017", .9187), ("DST0016", .8575),
                              ("DST0015", .8243), ("DST0014", .7798)]
    assert top("DST0012") == [("DST0029", .9743), ("DST0011", .9617), ("DST0028", .9484),
                              ("DST0014", .9434), ("DST0018", .9315)]


if os.path.exists(CATALOGUE):  # run only where the 29-row catalogue file is named
    test_catalogue_goldens = check_catalogue_goldens


def test_approx_neighbours_finds_close_pairs(spark):
    rows = [(i, [1.0, 0.01 * i, 0.0]) for i in range(10)] + [(100 + i, [0.0, 0.0, 1.0 + 0.01 * i]) for i in range(5)]
    df = spark.createDataFrame(rows, "item_id long, features array<double>")
    pairs = SIM.approx_neighbours(df, threshold=0.3).collect()
    assert pairs and all(r.src != r.dst for r in pairs)
    assert all(r.score > 0.9 for r in pairs)
    assert not any((r.src < 100) != (r.dst < 100) for r in pairs)   # the two groups never meet


def test_window_and_group_minmax_agree(spark):
    from wanderrank.operators import features as FE
    df = spark.createDataFrame([(i, "ab"[i % 2], float(i * 7 % 13)) for i in range(20)],
                               "item_id long, category string, price double")
    a = {r.item_id: r.n for r in FE.group_minmax(df, "category", "price", "n").collect()}
    b = {r.item_id: r.n for r in FE.window_minmax(df, "category", "price", "n").collect()}
    assert a == b
