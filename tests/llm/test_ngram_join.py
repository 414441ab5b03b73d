import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from wanderrank.llm import components as C
from wanderrank.llm import links as L
from wanderrank.llm import ngram_join as J
from wanderrank.llm.shingles import shingle_sets, signature

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOW))
    if len(w) >= 5:
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    return {tuple(w)} if w else set()


def brute(rows):
    """{(doc_id, n_shingles, component_id): rows} over every pair."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    post = defaultdict(list)
    for k, s in enumerate(sets):
        shared = Counter(o for x in s for o in post[x])
        for o, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[o]) - n):
                up[find(k)] = find(o)
        for x in s:
            post[x].append(k)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(i, low.get(find(k), i))
    return Counter((i, len(sets[k]), i if not sets[k] else low.get(find(k))) for k, (i, _) in enumerate(rows))


def corpus(seed, n, edits):
    """Families of near copies, a passage that many share, and odd rows."""
    rng = np.random.default_rng(seed)
    vocab = [f"w{i}" for i in range(4_000)]
    text = lambda k: [vocab[int(i)] for i in rng.integers(0, len(vocab), k)]
    passage, out = text(60), []
    while len(out) < n:
        base = text(int(rng.integers(1, 150)))
        for _ in range(int(rng.choice([1, 1, 1, 2, 5]))):
            t = list(base)
            for _ in range(int(rng.integers(0, edits))):
                t[int(rng.integers(0, len(t)))] = vocab[int(rng.integers(0, len(vocab)))]
            if rng.random() < 0.3:
                t = t + passage
            out.append((" " if rng.random() < 0.9 else "\n\t").join(t))
    centre = text(120)
    for k in range(150):  # one large family: more members than a list may pair
        t = list(centre)
        for _ in range(int(rng.integers(0, 6))):
            t[int(rng.integers(0, len(t)))] = vocab[int(rng.integers(0, len(vocab)))]
        out.append(" ".join(t))
    return out


def test_components_match_brute_force(docs, odd_texts):
    texts = corpus(1, 150, 3) + corpus(2, 150, 8) + odd_texts
    texts += texts[:20] + [texts[0].upper()] * 90
    rows = [((i * 37) % 1009, t) for i, t in enumerate(texts)] + [(None, texts[3]), (None, None), (None, "lonely words"), (5000, texts[7]), (5000, texts[7])]
    df = docs([(i, t, "s") for i, t in rows])
    got = Counter(map(tuple, J.near_documents(df).collect()))
    assert got == brute(rows)


def test_no_hint_and_short_lists_give_the_same(docs, monkeypatch):
    texts = corpus(3, 120, 6)
    rows = list(enumerate(texts))
    monkeypatch.setattr(J, "common_shingles", lambda d: np.empty(0, dtype=np.int64))
    got = Counter(map(tuple, J.near_documents(docs([(i, t, "s") for i, t in rows])).collect()))
    assert got == brute(rows)


def test_a_long_list_takes_the_whole_group_of_its_leader(docs, monkeypatch):
    """Equal prefix and size, but only the second of the group links with a third."""
    def sets(*words):
        return [s for s in shingle_sets(pa.array([" ".join(w) for w in words]))]

    rng = np.random.default_rng(4)
    lead = [f"w{i}" for i in range(104)]
    mate, turns = list(lead), 0
    prefix = J.prefix_length(100)
    while turns < 3:  # words changed whose shingles, old and new, stand after the prefix
        new = list(mate)
        new[int(rng.integers(5, 98))] = f"x{int(rng.integers(0, 1 << 40))}"
        a, b, c = sets(lead, mate, new)
        if len(c) == 100 and np.array_equal(a[:prefix], c[:prefix]) and len(np.intersect1d(b, c)) == 95 and len(np.intersect1d(a, c)) == 85 + 5 * (2 - turns):
            mate, turns = new, turns + 1
    third = list(mate)
    while True:
        third = list(mate)
        third[int(rng.integers(5, 98))] = "y"
        a, b, c = sets(lead, mate, third)
        if not np.array_equal(a[:prefix], c[:prefix]) and len(np.intersect1d(a, c)) <= 85 and len(np.intersect1d(b, c)) >= 90:
            break
    hint = np.unique(np.concatenate([a, b, c]))
    monkeypatch.setattr(J, "common_shingles", lambda d: hint)  # every list counts as long
    rows = [(i, " ".join(w)) for i, w in enumerate((lead, mate, third))]
    got = Counter(map(tuple, J.near_documents(docs([(i, t, "s") for i, t in rows]).coalesce(1)).collect()))
    assert got == brute(rows) == Counter([(0, 100, 0), (1, 100, 1), (2, 100, 1)])


def test_first_of_component(docs, odd_texts):
    base = " ".join(f"w{i}" for i in range(80))
    rows = [(9, base, "a"), (4, base, "b"), (7, base.replace("w79", "x"), "c"), (1, "other text " * 9, "d"), (1, "other text " * 9, "d"),
            (2, None, "e"), (3, "", "f"), (None, "no id", "g"), (None, "no id", "g")]
    df = docs(rows, {"component_id": 1, "n": 2, "rid": 3, "d": 4})
    out = J.first_of_component(df)
    assert out.columns == df.columns
    assert Counter((r.doc_id, r.source) for r in out.collect()) == Counter([(4, "b"), (1, "d"), (2, "e"), (3, "f"), (None, "g")])
    assert J.first_of_component(df.limit(0)).count() == 0


def test_rows_without_an_id_are_judged_by_their_set(docs):
    base = " ".join(f"w{i}" for i in range(80))
    rows = [(1, base, "a"), (None, base, "b"), (None, base.replace("w79", "x"), "c"), (5, base.replace("w0", "y"), "d"), (5, "quite another text", "e"),
            (None, None, "f"), (None, "alone here", "g"), (None, "ALONE  here", "h")]
    long = " ".join(f"v{i}" for i in range(12_000))  # over 2048 shared shingles in the prefixes
    rows += [(20, long, "i"), (21, long + " end", "j")]
    out = J.first_of_component(docs(rows)).collect()
    kept = Counter((r.doc_id, r.source) for r in out if r.source not in "gh")
    assert kept == Counter([(1, "a"), (5, "e"), (None, "f"), (20, "i")])
    assert sum(r.source in "gh" for r in out) == 1
    import pytest
    with pytest.raises(ValueError, match="_ngram_id"):
        J.first_of_component(docs(rows, {"_ngram_id": 1}))


def test_scratch_is_given_back(docs):
    """Of all intermediates only those that the result reads stay."""
    import os
    from wanderrank.session import ensure_checkpoint_dir
    df = docs([(i, t, "s") for i, t in enumerate(corpus(9, 40, 3))])
    root = ensure_checkpoint_dir(df.sparkSession)
    before = set(os.listdir(root))
    J.near_documents(df).collect()
    left = {x.split("-", 2)[-1].rsplit("-", 1)[0] for x in set(os.listdir(root)) - before}
    assert left <= {"sets", "class-components", "roots"}, left


@given(st.lists(st.none() | st.text(alphabet="aAbB É é\n\t🎉\x0b\x85", max_size=40), max_size=12))
@settings(max_examples=200, deadline=None)
def test_shingle_hashes_stand_for_shingles(texts):
    whole = pa.array(["pad"] + texts, pa.string())
    for column in (whole.slice(1), pa.array(texts, pa.large_string())):
        got = list(shingle_sets(column))
        assert [len(g) for g in got] == [len(shingles(t)) for t in texts]
        for x, s in zip(texts, got):
            for y, t in zip(texts, got):
                assert len(np.intersect1d(s, t)) == len(shingles(x) & shingles(y))


def test_blocks_do_not_change_sets(monkeypatch):
    from wanderrank.llm import shingles as S
    texts = corpus(5, 40, 3)
    a = [s.tolist() for s in shingle_sets(pa.array(texts))]
    monkeypatch.setattr(S, "BLOCK_BYTES", 100)
    assert [s.tolist() for s in shingle_sets(pa.array(texts))] == a


@given(st.lists(st.lists(st.integers(1, 200), min_size=1, max_size=90, unique=True), min_size=1, max_size=6), st.integers(1, 7), st.sets(st.integers(0, 5)))
@settings(max_examples=60, deadline=None)
def test_list_stream_over_any_batching(lists, step, common):
    n = 1_000
    rows = sorted((s, ((s in common) << 62) | (p * 1024 // n << 52) | (n << 26) | p, r) for s, rids in enumerate(lists) for p, r in enumerate(rids))
    cols = [np.array([r[i] for r in rows], dtype=np.int64) for i in range(3)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c[k:k + step * 13]) for c in cols], names=["s", "w", "rid"])
               for k in range(0, len(rows), step * 13)]
    out = [r for b in J._list_stream(iter(batches)) for r in b.to_pylist()]
    pairs = Counter((r["a"], r["b"]) for r in out if not r["long"])
    short = [ls for s, ls in enumerate(lists) if len(ls) <= J.LIST and s not in common]
    assert pairs == Counter((min(x, y), max(x, y)) for ls in short for i, x in enumerate(ls) for y in ls[i + 1:])
    assert all(r["c"] == 1 + (1 << 32) and r["nn"] == (n << 32 | n) for r in out if not r["long"])
    assert Counter((r["a"], r["b"], r["hub"], r["nn"]) for r in out if r["long"]) == Counter(
        (x, s, ls[0], n << 26 | p) for s, ls in enumerate(lists) if len(ls) > J.LIST or (s in common and len(ls) > 1) for p, x in enumerate(ls))


def test_positions_rule_a_pair_out():
    """The last shared shingle comes too late in both sets, or too far apart."""
    def pairs(*entries):
        rows = sorted((7, (p * 1024 // n << 52) | (n << 26) | p, r) for r, (n, p) in enumerate(entries))
        b = pa.RecordBatch.from_arrays([pa.array(np.array([r[i] for r in rows], dtype=np.int64)) for i in range(3)], names=["s", "w", "rid"])
        return [(r["a"], r["b"], r["c"] >> 32) for x in J._list_stream(iter([b])) for r in x.to_pylist()]

    assert pairs((100, 0), (100, 20)) == []             # at most 80 of 120 shared
    assert pairs((100, 20), (100, 20)) == [(0, 1, 0)]   # only if something is shared before
    assert pairs((100, 5), (100, 5)) == [(0, 1, 1)]
    assert pairs((100, 0), (70, 0)) == []               # sizes alone


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 105), (105, 103), (200, 300)] + [(1000, 1000 + k) for k in range(1, 60)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(map(tuple, C.components(df).collect()))
    want = {i: 0 for i in range(41)} | {100: 100, 103: 100, 105: 100, 200: 200, 300: 200} | {1000 + k: 1000 for k in range(60)}
    assert got == want
    assert C.components(df.limit(0)).count() == 0


def _sets(rng, cases):
    """Pairs of hash sets: (shared, only left, only right)."""
    for shared, left, right in cases:
        x = rng.integers(-(1 << 63), (1 << 63) - 1, shared + left + right, dtype=np.int64)
        yield np.sort(x[:shared + left]), np.sort(np.r_[x[:shared], x[shared + left:]])


def test_signatures_drop_no_link():
    rng = np.random.default_rng(6)
    cases = [(int(k), int(rng.integers(0, k // 4 + 2)), int(rng.integers(0, k // 4 + 2))) for k in rng.integers(1, 3_000, 300)]
    both = list(_sets(rng, cases))
    parts = []
    for side in (0, 1):
        s = [signature(p[side]) for p in both]
        wide = np.array([len(x) for x in s])
        parts.append((np.concatenate(s), np.cumsum(wide) - wide, wide))
    total = np.array([len(a) + len(b) for a, b in both])
    ok = L.may_link(*parts, total, J.SIMILAR)
    linked = np.array([100 * k >= J.SIMILAR * (k + a + b) for k, a, b in cases])
    assert ok[linked].all() and 0 < linked.sum() < len(cases)
    assert ok[~linked].sum() < (~linked).sum()
    assert any(w != v for w, v in zip(parts[0][2], parts[1][2]))  # sizes that fold


def test_pairs_of_a_long_list_do_not_reach_verification(docs, monkeypatch):
    """Texts that share a passage, but link with few others: their number of compared
    whole sets does not grow with the list's square."""
    rng = np.random.default_rng(8)
    passage = " ".join(f"p{i}" for i in range(60))
    own = [[f"o{int(x)}" for x in rng.integers(0, 1 << 40, 24)] for _ in range(100)]
    texts = [passage + " " + " ".join(w) for w in own] + [passage + " " + " ".join(own[0][:-1] + ["end"])]
    seen, real = [], L.sets_of
    monkeypatch.setattr(L, "sets_of", lambda d, c, rids, w: (seen.append(rids.count()), real(d, c, rids, w))[1])
    met, verify = [], L.verify

    def count(documents, classes, pairs, *a, **k):
        met.append((pairs.distinct().count(), len(a) > 2))
        return verify(documents, classes, pairs, *a, **k)

    monkeypatch.setattr(L, "verify", count)
    hint = np.unique(np.concatenate(list(shingle_sets(pa.array([passage])))))
    monkeypatch.setattr(J, "common_shingles", lambda d: hint)
    monkeypatch.setattr(J, "prefix_length", lambda n: n)  # every shingle is dealt: one list for each of the passage
    rows = list(enumerate(texts))
    got = Counter(map(tuple, J.near_documents(docs([(i, t, "s") for i, t in rows])).collect()))
    assert got == brute(rows)
    assert all(k < 500 for k, sifts in met if not sifts), met
    assert sum(seen) < 50, seen


def test_a_pair_goes_out_of_one_of_its_lists_only(docs, monkeypatch):
    """Texts that nearly link share dozens of long lists; each of their pairs leaves the
    squares once, not once for every list."""
    rng = np.random.default_rng(12)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(k, passage + " " + " ".join(f"o{int(x)}" for x in rng.integers(0, 1 << 40, 12))) for k in range(30)]
    rows.append((30, rows[0][1] + " end"))
    out, squares = [], L.squares

    def count(lists, *a, **k):
        with monkeypatch.context() as m:
            m.setattr(type(lists), "distinct", lambda self: self)
            found = squares(lists, *a, **k)
        out.append((found.count(), found.distinct().count()))
        return found

    monkeypatch.setattr(L, "squares", count)
    monkeypatch.setattr(L, "ROUNDS", 0)
    monkeypatch.setattr(L, "SIDE", 8)
    hint = np.unique(np.concatenate(list(shingle_sets(pa.array([passage])))))
    monkeypatch.setattr(J, "common_shingles", lambda d: hint)
    monkeypatch.setattr(J, "prefix_length", lambda n: n)
    got = Counter(map(tuple, J.near_documents(docs([(i, t, "s") for i, t in rows])).collect()))
    assert got == brute(rows)
    (n, pairs), = out
    assert n == pairs > 20


def test_lists_below_one_that_a_pair_shares():
    rng = np.random.default_rng(13)
    lists = [np.sort(rng.choice(40, int(k), replace=False)) for k in rng.integers(0, L.FIRST + 1, 60)]
    wide = np.array([len(x) for x in lists])
    values, at = np.concatenate(lists), np.cumsum(wide) - wide
    i, j = rng.integers(0, 60, 20_000), rng.integers(0, 60, 20_000)
    for key in (-3, 0, 7, 25, 100):
        got = L.elsewhere((values, at[i], wide[i]), (values, at[j], wide[j]), key)
        want = [any(v < key for v in set(lists[a]) & set(lists[b])) for a, b in zip(i, j)]
        assert got.tolist() == want
