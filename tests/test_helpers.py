"""Core helpers of the exact paths: per-row top-k with ties, consecutive positions."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from wanderrank.operators.indexing import index_by
from wanderrank.operators.topk import topk_rows


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6), st.integers(1, 12), st.integers(0, 14), st.integers(0, 10**6))
def test_topk_rows_equals_full_sort(rows, cols, k, seed):
    rng = np.random.default_rng(seed)
    scores = rng.integers(0, 4, (rows, cols)).astype(float)       # many ties
    scores[rng.random((rows, cols)) < 0.1] = -np.inf                # some never rank
    ids = rng.permutation(cols) + 100
    r, c = topk_rows(scores, ids, k)
    for i in range(rows):
        want = sorted((j for j in range(cols) if np.isfinite(scores[i, j])),
                      key=lambda j: (-scores[i, j], ids[j]))[:k]
        assert list(c[r == i]) == want


def test_index_by_is_consecutive_across_partitions(spark):
    df = spark.range(0, 1000, 1, 7).selectExpr("(id * 7919) % 1000 AS k")
    rows = index_by(df, "k", out="pos").orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(1, 1001))
    assert [r.k for r in rows] == sorted(r.k for r in rows)
