import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wanderrank.llm import manifest as M
from wanderrank.llm import sha_tree as S


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes, at, fanout):
    """(root, siblings of ``at`` level by level, fold of a replacement)."""
    steps = []
    while len(nodes) > 1:
        run = at - at % fanout
        steps.append((nodes[run:at], nodes[at + 1:run + fanout]))
        nodes = [H(*nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)]
        at //= fanout

    def fold(x):
        for left, right in steps:
            x = H(*left, x, *right)
        return x

    return nodes[0], [s for left, right in steps for s in left + right], fold


def brute(rows, fanout=2):
    """rows: (doc_id, text, lang, source, n_chars) -> sorted result rows."""
    trees = {}
    for doc_id, text, lang, source, n in rows:
        leaf = H(*map(field, (doc_id, source, lang, n, text)))
        bad = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n is not None
        other = H(*map(field, (doc_id, source, lang, n + bad, text))) if bad else leaf
        trees.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf, doc_id, other))
    keys = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    for k in keys:
        trees[k].sort(key=lambda r: r[:3])
    subs = [climb([r[2] for r in trees[k]], 0, fanout)[0] for k in keys]
    out = []
    for t, k in enumerate(keys):
        root, over, fold2 = climb(subs, t, fanout)
        for at, (_, _, leaf, doc_id, other) in enumerate(trees[k]):
            sub, sib, fold1 = climb([r[2] for r in trees[k]], at, fanout)
            got = fold2(fold1(other))
            out.append((doc_id, leaf, sub, root, H(*sib, *over), got, got == root))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def corpus(n, langs, odd=()):
    rng = np.random.default_rng(n)
    rows = [(int(i), f"text {i % 17} é🎉", langs[int(rng.integers(0, len(langs)))], "s", int(i) % 50)
            for i in rng.permutation(n)]
    return rows + list(odd)


ODD = [(None, None, None, None, None), (None, "a", None, "s", 3), (5, "", "zz", None, None), (5, "", "zz", None, None),
       (-9, "x" * 50_000, "é", "", 0), (2**62, "a\x00b", "", "-", -1)]


def test_matches_brute_force_with_odd_rows(spark):
    rows = corpus(300, ["en", "fr", "de", None], ODD)
    df = frame(spark, rows)
    for c in ("leaf", "tree", "pos", "root", "key", "changed", "block"):  # clashing names
        df = df.withColumn(c, df.doc_id)
    assert sorted(map(tuple, M.manifest_documents(df).collect()), key=str) == brute(rows)


def test_small_trees(spark, monkeypatch):
    """Trees of 1 to 9 leaves, in blocks of four."""
    monkeypatch.setattr(M, "MAX_BLOCK", 4)
    rows = [(100 * n + i, "t", f"k{n}", "s", i) for n in range(1, 10) for i in range(n)]
    assert sorted(map(tuple, M.manifest_documents(frame(spark, rows)).collect()), key=str) == brute(rows)


def test_lone_leaf(spark):
    rows = corpus(1, ["en"])
    assert list(map(tuple, M.manifest_documents(frame(spark, rows)).collect())) == brute(rows)


@pytest.mark.parametrize("fanout,block", [(2, 2), (3, 9)])
def test_blocks_and_fanouts(spark, monkeypatch, fanout, block):
    """Several rounds of blocks, trees of many sizes, more keys than a block."""
    monkeypatch.setattr(M, "MAX_BLOCK", block)
    rows = corpus(90, ["a", "b"]) + [(1000 + i, "t", f"k{i:02d}", "s", 1) for i in range(12)]
    whole = frame(spark, rows)
    leaves = whole.select("doc_id", whole.lang.alias("key"),
                          M.F.unhex(M.leaf([whole[c] for c in M.FIELDS])).alias("leaf")).withColumn("changed", M.F.col("leaf"))
    got = sorted(map(tuple, M.manifest(leaves, "key", ["doc_id", "leaf"], fanout).collect()), key=str)
    want = [(*r[:5], r[3], True) for r in brute(rows, fanout)]
    assert got == want
    assert all(r[-1] for r in got)


def test_empty_table(spark):
    assert M.manifest_documents(frame(spark, [])).count() == 0


@given(st.lists(st.binary(min_size=32, max_size=32), min_size=1, max_size=5), st.integers(1, 4))
@settings(max_examples=60, deadline=None)
def test_states_resume(digests, copies):
    want = hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()
    state = S.starts(copies)
    for d in digests:
        state = S.absorb(state, S.from_bytes(d * copies))
        state = S.from_bytes(b"".join(S.to_bytes(state)))  # through a table
    assert S.to_bytes(S.finish(state, np.full(copies, len(digests)))) == [want] * copies


def test_folding_needs_only_the_state_and_the_right(spark):
    """Left siblings may be lost once the state before the slot is kept."""
    d = [hashlib.sha256(bytes([i])).digest() for i in range(7)]
    level = S.Level(np.zeros(7, np.int64), np.arange(7), S.from_bytes(b"".join(d)), np.ones(7, bool), 3)
    new = hashlib.sha256(b"new").digest()
    level.digest[3] = 0  # the left sibling of node 4
    got = S.to_bytes(level.fold(np.array([4]), S.from_bytes(new)))[0]
    assert got == hashlib.sha256((d[3].hex() + new.hex() + d[5].hex()).encode()).digest()
