from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from wanderrank.llm.mixing import _with_cut, mix_documents, mix_sizes, split_quotas, taken_copies, water_fill


@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=12))
@settings(max_examples=60, deadline=None)
def test_water_fill_shares_all_within_caps(sizes):
    weights = [(1, 2, 3)[i % 3] for i in range(len(sizes))]
    got = water_fill(sizes, weights)
    assert sum(got) == sum(sizes) or all(t == 3 * s for t, s in zip(got, sizes))
    assert all(t <= 3 * s for t, s in zip(got, sizes))
    free = [t / w for t, s, w in zip(got, sizes, weights) if t < 3 * s]
    assert len(set(free)) <= 1  # what is not capped is shared by weight
    assert all(t / w <= free[0] for t, s, w in zip(got, sizes, weights) if free and t == 3 * s)


def test_water_fill_example():
    assert water_fill([10, 1000, 1000], [1, 2, 3]) == [30, Fraction(1980 * 2, 5), Fraction(1980 * 3, 5)]


@given(st.lists(st.integers(0, 500), min_size=1, max_size=6), st.integers(1, 17))
@settings(max_examples=60, deadline=None)
def test_split_is_exact_and_balanced(quotas, shards):
    got = split_quotas(np.array(quotas), shards)
    assert (got.sum(axis=0) == quotas).all() and (got >= 0).all()
    totals = got.sum(axis=1)
    assert totals.max() - totals.min() <= np.ceil(np.log2(max(2, shards))) + 1
    assert (got == split_quotas(np.array(quotas), shards)).all()


def test_split_is_hypergeometric_in_the_mean():
    got = np.mean([split_quotas(np.array([300, 100]), 4, seed)[:, 0] for seed in range(300)], axis=0)
    assert np.allclose(got, 75, atol=1.5)


def rows(n=400):
    rng = np.random.default_rng(3)
    out = [(i, " ".join(["w"] * int(rng.integers(0, 60))), ["a", "b", "c", None][min(3, int(rng.integers(0, 9)) // 2)])
           for i in range(n)]
    return out + [(n, None, "a"), (n + 1, "", "zz"), (None, "w w", "b"), (None, "w w", "b"), (5, "w " * 5_000, "c")]


def test_contract(docs):
    df = docs(rows())
    got = mix_sizes(df).toPandas()
    assert len(got) == df.count()
    size = {r[0]: 0 for r in [(x[2],) for x in rows()]}
    for _, text, source in rows():
        size[source] += len((text or "").split())
    order = sorted([s for s in size if s is not None]) + [None]
    want = dict(zip(order, water_fill([size[s] for s in order], [(1, 2, 3)[i % 3] for i in range(len(order))])))
    by_source = {}
    src = {(r[0], len((r[1] or "").split())): r[2] for r in rows()}
    for r in got.itertuples():
        s = src[(None if r.doc_id != r.doc_id else int(r.doc_id), r.size)]
        assert r.source_size == size[s] and abs(r.target - float(want[s])) < 1e-6
        assert r.taken <= 3 * r.size
        by_source.setdefault(s, [0, r.target, 0])
        by_source[s][0] += r.taken
        by_source[s][2] = max(by_source[s][2], r.size)
    for taken, target, largest in by_source.values():
        assert abs(taken - target) <= largest / 2 + 1


def test_reruns_and_partitionings_agree(docs):
    a = sorted(map(str, mix_sizes(docs(rows())).collect()))
    assert a == sorted(map(str, mix_sizes(docs(rows()).repartition(7)).collect()))


def test_mixed_rows_are_the_taken_copies(docs):
    df = docs(rows(), {"h": 1, "size": "s", "copies": 2, "block": 3, "copy": 4, "shard": 5})
    out = mix_documents(df)
    assert out.columns == df.columns
    taken = {}
    for r in mix_sizes(df).collect():
        taken[(r.doc_id, r.size)] = taken.get((r.doc_id, r.size), 0) + r.taken
    seen = {}
    for r in out.collect():
        n = len((r.text or "").split())
        seen[(r.doc_id, n)] = seen.get((r.doc_id, n), 0) + n
        assert (r.h, r["size"], r.copies, r.shard) == (1, "s", 2, 5)
    assert {k: v for k, v in taken.items() if v} == {k: v for k, v in seen.items() if v}


def test_empty_table(docs):
    assert mix_sizes(docs([]).limit(0)).count() == 0
    assert mix_documents(docs([]).limit(0)).count() == 0


def test_cut_in_the_first_fine_part_takes_none_below(spark):
    # h, size, cut, taken: a first row too long for the cut, a cut at a later part, a cut after the first row
    cases = [([(5, 100), (1 << 60, 7)], 10, []), ([(5, 4), (3 << 54, 100)], 6, [5]), ([(0, 100)], 10, []),
             ([(5, 10), (6, 100)], 12, [5])]
    for hashes, cut, want in cases:
        rows = spark.createDataFrame([("a", n, h, 0, h >> 54) for h, n in hashes],
                                     "source string, size long, h long, block int, fine int")
        draws = spark.createDataFrame([("a", 0, 0, 0, cut)], "source string, block int, copy int, shard int, cut long")
        out = _with_cut(rows, draws)
        kept = taken_copies(rows.select("source", rows["h"].alias("_mix_h")), out, 1).where("size(_mix_copies) > 0")
        assert sorted(r._mix_h for r in kept.collect()) == want
