import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from wanderrank.llm import spelling as P

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def vocabulary(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def brute(words):
    """word -> (form, root, n, n_near, form_n) over all pairs."""
    form, out = {}, {}
    for w, n in words.items():
        mates = sorted((-m, x) for x, m in words.items() if near(w, x))
        top = mates[0] if mates and -mates[0][0] >= 10 * n else None
        form[w] = (top and top[1], n, len(mates), top and -top[0])
    for w, (f, n, k, m) in form.items():
        root = w
        while form[root][0] is not None:
            root = form[root][0]
        out[w] = (f, root, n, k, m)
    return out


def rows_of(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def texts(seed, n_words=160, n_docs=60):
    """Words with planted edits (also of accents and case), counts over decades."""
    rng = np.random.default_rng(seed)
    letters = list("abcdefghijklmnopqrstuvwxyzäéñßÀÉ")
    word = lambda: "".join(rng.choice(letters, int(rng.integers(6, 12))))
    pool = []
    for _ in range(n_words):
        w = word()
        pool.append(w)
        for _ in range(int(rng.integers(0, 4))):
            k = int(rng.integers(0, len(w)))
            pool.append([w[:k] + w[k + 1:], w[:k] + str(rng.choice(letters)) + w[k:], w[:k] + str(rng.choice(letters)) + w[k + 1:]][int(rng.integers(0, 3))])
            w = pool[int(rng.integers(0, len(pool)))]
    weight = 10.0 ** rng.integers(0, 4, len(pool))
    weight /= weight.sum()
    out = []
    for _ in range(n_docs):
        ws = [pool[i] for i in rng.choice(len(pool), 120, p=weight)]
        out.append(" ".join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in ws))
    return out


def test_matches_brute_force(docs, odd_texts):
    rows = list(enumerate(texts(1) + odd_texts)) + [(None, "Variant variant variantt 1variants×2 ÷÷÷÷÷÷÷ ÷÷÷÷÷÷÷")] * 2 \
        + [(7, "Variant, variant")] * 12 + [(3, None)] + [(9, "x" * 50_000 + " " + "y" * 9)] * 2
    df = docs([(i, t, "s") for i, t in rows], {"word": "w", "n": 1, "shard": 2, "form": "f"})
    got = rows_of(P.spelling_variants(df))
    want = brute(vocabulary(rows))
    assert got == want
    assert any(v[0] for v in want.values())
    assert P.spelling_variants(df.limit(0)).count() == 0


def test_split_shards_chunks_and_small_leaves(docs, monkeypatch):
    """Shards in several parts, a dictionary handed on, and a deep search."""
    for k, v in (("SHARD", 3), ("PAIRS", 7), ("LEAF", 1), ("HELD", 40)):
        monkeypatch.setattr(P, k, v)
    rows = list(enumerate(texts(2, 90, 40)))
    words = vocabulary(rows)
    counted = {r.word: r.n for r in P.word_counts(docs([(i, t, "s") for i, t in rows])).collect()}
    assert counted == words
    # SHARD takes part in the plan; the search runs where the words are
    words |= {f"ba{a}de{b}ol": 2 + 31 * i for i, (a, b) in enumerate((a, b) for a in "nrsdt" for b in "nrsdt")}
    words |= {f"ba{a}{a}den{b}ol": 5 for a in "nrs" for b in "aei"}
    spark = docs([(0, "", "s")]).sparkSession
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows_of(P.group_variants(df)) == brute(words)
    assert P.dealt(df).where("part > 0").count() > 0


def test_chains_lead_to_the_last_form(spark):
    words = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2_000, "aaabbbb": 20_000, "zzzzzzz": 5, "zzzzzzy": 49,
             "tiesone": 3, "tiesona": 30, "tiesonb": 30, "tieson": 30, "alonely": 4}
    got = rows_of(P.group_variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == brute(words)
    assert got["aaaaaaa"][1] == "aaabbbb" and got["zzzzzzz"][0] is None and got["tiesone"][0] == "tieson"


@given(st.lists(st.text(alphabet="abcäé", min_size=1, max_size=8), min_size=1, max_size=25, unique=True), st.integers(0, 5000))
@settings(max_examples=150, deadline=None)
def test_trie_finds_every_near_pair(words, leaf):
    P.LEAF, old = leaf, P.LEAF
    try:
        w = P.Words(words, np.arange(len(words)))
        trie = P.Trie(w)
        got = Counter((words[i], trie.words.text[j]) for a, b in trie.search(w, np.ones(len(words))) for i, j in zip(a, b))
    finally:
        P.LEAF = old
    assert got == Counter((x, y) for x in words for y in words if near(x, y))
