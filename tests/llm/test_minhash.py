from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from test_ngram_join import LOW, WORD, corpus
from wanderrank.llm import minhash as M


def shingles(text):
    w = WORD.findall((text or "").translate(LOW))
    if len(w) >= 3:
        return {tuple(w[i:i + 3]) for i in range(len(w) - 2)}
    return {tuple(w)} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, s in enumerate(sets):
        for o in range(k):
            n = len(s & sets[o])
            if n and 100 * n >= 85 * (len(s) + len(sets[o]) - n):
                up[find(k)] = find(o)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(i, low.get(find(k), i))
    out = []
    for k, (i, _) in enumerate(rows):
        c = i if not sets[k] else low.get(find(k))
        out.append((i, len(sets[k]), c, i == c))
    return Counter(out)


def test_matches_brute_force(docs, odd_texts):
    texts = corpus(1, 120, 3) + corpus(2, 100, 8) + odd_texts
    texts += texts[:20] + [texts[0].upper()] * 60
    rows = [((i * 37) % 1009, t) for i, t in enumerate(texts)] + [(None, texts[3]), (None, None), (None, "lonely words"),
                                                               (5000, texts[7]), (5000, texts[7]), (5001, "one two"), (5002, "one  TWO")]
    df = docs([(i, t, "s") for i, t in rows], {"n": 1, "rid": 2, "key": 3, "kept": 4, "th": 5})
    assert Counter(map(tuple, M.near_components(df).collect())) == brute(rows)
    assert M.near_components(df.limit(0)).count() == 0


def test_long_lists_squares_and_chunks(docs, monkeypatch):
    """Every list is long, hubs have several chunks, squares are small: chains of
    near copies whose ends are not linked, all through the second round."""
    monkeypatch.setattr(M, "LIST", 2)
    monkeypatch.setattr(M, "FIRST", 1)
    for k, v in (("SQUARE", 3), ("CHUNK", 3), ("HUBS", 1), ("ROUNDS", 1), ("FEW", 0)):
        monkeypatch.setattr(M.L, k, v)
    texts = corpus(3, 60, 6)
    w = [f"v{i}" for i in range(140)]
    for k in range(40):  # a window sliding by two words: near neighbours only
        texts.append(" ".join(w[2 * k % 40:2 * k % 40 + 100]))
    rows = list(enumerate(texts))
    assert Counter(map(tuple, M.near_components(docs([(i, t, "s") for i, t in rows])).collect())) == brute(rows)


def test_every_coordinate_fills_and_equals_with_probability_j():
    rng = np.random.default_rng(0)
    got = []
    for _ in range(60):
        x = rng.integers(-2**62, 2**62, 120)
        a, b = x[:100], x[20:]  # J = 80 / 120
        s = M.sketches([a, b, x[:1], x[:3], np.empty(0, np.int64)])
        full = np.iinfo(np.uint64).max
        assert (s[:4] != full).all() and (s[4] == full).all()
        got.append(float((s[0] == s[1]).mean()))
    assert abs(np.mean(got) - 2 / 3) < 0.02
    # no worse than independent coordinates (0.0295), with some room
    assert np.std(got) < 0.045


def test_rounds_end_even_if_hashes_avoid_a_bin(monkeypatch):
    """One element meets each bin in the last T rounds at the latest."""
    monkeypatch.setattr(M, "_mix", lambda h: h & ~np.uint64(M.T - 1))  # hashed rounds know bin 0 only
    s = M.sketches([np.array([7], dtype=np.int64)])
    assert (s != np.iinfo(np.uint64).max).all()


@given(st.lists(st.lists(st.integers(-5, 300), min_size=0, max_size=40, unique=True), max_size=6), st.integers(1, 60))
@settings(max_examples=60, deadline=None)
def test_blocks_do_not_change_sketches(sets, block):
    sets = [np.array(sorted(s), dtype=np.int64) for s in sets]
    want = [M.sketches([s])[0].tolist() for s in sets]
    old, M.BLOCK = M.BLOCK, block
    try:
        assert M.sketches(sets).tolist() == want
    finally:
        M.BLOCK = old


@given(st.lists(st.lists(st.integers(1, 90), min_size=1, max_size=40, unique=True), min_size=1, max_size=6), st.integers(1, 30))
@settings(max_examples=60, deadline=None)
def test_list_stream_over_any_batching(lists, step):
    rows = [(k, r, 50) for k, rids in enumerate(lists) for r in sorted(rids)]
    cols = [np.array([r[i] for r in rows], dtype=np.int64) for i in range(3)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c[k:k + step]) for c in cols], names=["key", "rid", "n"])
               for k in range(0, len(rows), step)]
    out = [r for b in M._list_stream(iter(batches)) for r in b.to_pylist()]
    hubs = lambda ls: sorted(ls)[:M.FIRST]
    assert Counter((r["a"], r["b"]) for r in out if not r["long"]) == Counter(
        (x, y) for ls in lists if len(ls) <= M.LIST for x in ls for y in ls if x < y) + Counter(
        (h, x) for ls in lists if len(ls) > M.LIST for h in hubs(ls) for x in ls if x != h)
    assert Counter((r["b"], r["a"]) for r in out if r["long"]) == Counter((k, x) for k, ls in enumerate(lists) if len(ls) > M.LIST for x in ls)


@pytest.mark.parametrize("j", [0.85])
def test_bands_catch_what_is_linked(j):
    rng = np.random.default_rng(1)
    for _ in range(200):
        x = rng.integers(-2**62, 2**62, 1000)
        k = int(1000 * (1 - j) / 2)
        b = M.bands(M.sketches([x[:1000 - k], x[k:]]))
        assert (b[0] == b[1]).any()


def test_a_large_family_settles_in_rounds(docs):
    """Near copies of one text, of which only some link with each other: few
    verified pairs, all of one component that belong to it."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(160):
        t = list(base)
        for k in rng.choice(150, int(rng.integers(1, 9)), replace=False):
            t[k] = f"x{int(rng.integers(0, 10**6))}"
        texts.append(" ".join(t))
    rows = list(enumerate(texts))
    assert Counter(map(tuple, M.near_components(docs([(i, t, "s") for i, t in rows])).collect())) == brute(rows)


def test_a_member_meets_a_hub_once_whatever_lists_they_share(spark):
    """Members of many common lists: their hubs are joined before pairs are dealt."""
    n = 40
    classes = spark.createDataFrame([(k, k, k, b"%d" % k, 3, k, k) for k in range(n)],
                                    "rid long, low long, id long, d binary, n int, th long, root long")
    documents = spark.createDataFrame([(k, f"a{k} b{k} c{k}") for k in range(n)], "doc_id long, text string")
    lists = spark.createDataFrame([(key, k, 3) for key in range(9) for k in range(n)], "key long, rid long, n int")
    found = spark.createDataFrame([], "node long, root long")
    asked = []

    def verify(documents, classes, pairs, *rest):
        asked.append((pairs.count(), pairs.distinct().count()))
        return M.L.no_pairs(spark)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(M.L, "verify", verify)
        m.setattr(M.L, "family_links", lambda *a: M.L.no_pairs(spark))
        M.L.settle(documents, classes, lists, found, ["n"], lambda *h: F.lit(True), M.WIDTH, M.SIMILAR)
    assert len(asked) == M.L.ROUNDS
    assert all(k == d == M.L.HUBS * (n - 1) for k, d in asked)
