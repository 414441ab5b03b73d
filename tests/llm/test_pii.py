import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wanderrank.llm import pii as P

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute(text):
    out = []
    for k, x in enumerate(PATTERNS):
        for m in re.finditer(x, text):
            d = re.sub("[^0-9]", "", m[0])
            if k == 0 or k == 1 and all(int(p) <= 255 for p in m[0].split(".")) or \
                    k == 2 and 16 <= len(d) <= 19 and P.luhn(d) or k == 3 and 8 <= len(d) <= 15:
                out.append((k, m.start(), m.end()))
    return out


@given(st.text(alphabet="0125 9-.@+()aZ_%é\n", max_size=60))
@settings(max_examples=1500, deadline=None)
def test_patterns_match_brute_force(text):
    assert P.pattern_spans(text)[0] == brute(text)


def test_pattern_examples():
    t = "🎉 a.b+c@x-y.example.org, 10.0.0.255 256.1.1.1 1.2.3.4.5 4111 1111-1111 1111 +44 (20) 7946-0958 @a.b x@@c.d"
    assert P.pattern_spans(t)[0] == brute(t)
    assert P.luhn("4111111111111111") and not P.luhn("4111111111111112")


def test_long_runs_are_linear():
    for t in ("a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "+" * 100_000, "+1" + " " * 100_000, "@" * 100_000):
        P.pattern_spans(t)


def digits(rng, n):
    return "".join(map(str, rng.integers(0, 10, n)))


def with_luhn(d):
    return next(d + c for c in "0123456789" if P.luhn(d + c))


def labelled(seed, n):
    rng = np.random.default_rng(seed)
    words = "the and of that there here northern tion ering ment".split()
    out = []
    for _ in range(n):
        w = lambda: " ".join(words[int(i)] for i in rng.integers(0, len(words), 4))
        kind = int(rng.integers(0, 5))
        v = ["", f"user{digits(rng, 2)}@mail{digits(rng, 1)}.example.com", ".".join(str(int(x)) for x in rng.integers(1, 255, 4)),
             with_luhn(digits(rng, 15)), f"+1 ({digits(rng, 3)}) 555-{digits(rng, 4)}"][kind]
        t = f"{w()} {v} {w()}" if kind else f"{w()} version {digits(rng, 1)}.0 {w()}"
        out.append((t, brute(t)))
    return out


@pytest.fixture(scope="module")
def model():
    return P.train(labelled(1, 400))


def test_held_out_accuracy(model):
    held = labelled(2, 150)
    codes = [P._codes(t) for t, _ in held]
    right = sum(sorted((k, s, e) for k, s, e, _ in found) == sorted(spans)
                for found, (_, spans) in zip(P.tag_regions(model, codes), held))
    assert right >= 0.93 * len(held)


def test_gradient_is_the_slope():
    rng = np.random.default_rng(0)
    m = P.Tagger({k: v.astype(np.float64) for k, v in P.Tagger.fresh(3).w.items()})
    codes, tags, lengths = rng.integers(32, 100, (2, 7)), rng.integers(0, P.TAGS, (2, 7)), np.array([7, 5])
    codes[1, 5:] = P.PAD

    def loss():
        s = m.scores(codes).astype(np.float64)
        total = 0.0
        for i, n in enumerate(lengths):
            a = s[i, 0].copy()
            path = s[i, 0, tags[i, 0]]
            for p in range(1, n):
                a = np.log(np.exp(a[:, None] + m.w["trans"]).sum(0)) + s[i, p]
                path += m.w["trans"][tags[i, p - 1], tags[i, p]] + s[i, p, tags[i, p]]
            total += np.log(np.exp(a).sum()) - path
        return total / len(lengths)

    grad = m.gradient(codes, tags, lengths)
    for k in ("out", "trans", "hf", "xb", "bb", "emb"):
        at = (int(codes[0, 0]), 2) if k == "emb" else tuple(int(rng.integers(0, d)) for d in m.w[k].shape)
        old = m.w[k][at]
        m.w[k][at] = old + 1e-3
        up = loss()
        m.w[k][at] = old - 1e-3
        down = loss()
        m.w[k][at] = old
        assert abs((up - down) / 2e-3 - grad[k][at]) < 2e-3, k


def test_marginals_and_viterbi_match_enumeration():
    rng = np.random.default_rng(5)
    w = P.Tagger.fresh(1).w
    w["trans"] = rng.standard_normal((P.TAGS, P.TAGS)).astype(np.float32)
    m, s = P.Tagger(w), rng.standard_normal((1, 3, P.TAGS)).astype(np.float32)
    paths = [(a, b, c) for a in range(P.TAGS) for b in range(P.TAGS) for c in range(P.TAGS)]
    score = np.array([s[0, 0, a] + s[0, 1, b] + s[0, 2, c] + w["trans"][a, b] + w["trans"][b, c] for a, b, c in paths])
    tags, marginal = m.crf(s, np.array([3]))
    assert tuple(tags[0]) == paths[int(score.argmax())]
    p = np.exp(score - score.max())
    p /= p.sum()
    assert abs(marginal[0, 1, 4] - sum(x for x, (_, b, _) in zip(p, paths) if b == 4)) < 1e-4


def test_failed_card_is_added_and_clean_text_left_alone(model):
    rng = np.random.default_rng(9)
    card = with_luhn(digits(rng, 15))
    wrong = card[:-1] + str((int(card[-1]) + 1) % 10)
    clean = "the northern hills and that there, version 2.0 of the licence " * 20
    long = "there the and " * 3_000 + wrong + " and of that " + card
    got = P.find_batch([f"the and {wrong} of that", clean, long, "", "x" * 50_000, "7" * 500], model)
    assert got[0] == ([], [(2, 8, 24)])
    assert got[1] == ([], [])
    assert [t[0] for t in got[2]] == [(2, len(long) - 16, len(long))] or got[2][0] == [(2, len(long) - 16, len(long))]
    assert got[3] == ([], []) and got[4] == ([], []) and got[5][1] == []


def test_windows_reconcile_to_one_span(model):
    pad = "the and of 3 that "
    for shift in range(0, 60, 7):
        t = pad * 3 + ("and the ering tion of " * 3)[:shift] + " +1 (415) 555-0199 " + pad * 3
        found = P.tag_regions(model, [P._codes(t)])[0]
        s = t.index("+1")
        assert (3, s, s + 17) in [(k, a, b) for k, a, b, _ in found]


def test_contract_and_redaction(docs, odd_texts):
    texts = odd_texts + [t for t, _ in labelled(4, 60)]
    df = docs(texts, {"spans": "mine", "n_card": 1})
    got = {r.doc_id: r for r in P.scan_documents(df).collect()}
    for i, t in enumerate(texts):
        base = brute(t or "")
        assert got[i].base_sha256 == hashlib.sha256(P.span_text(base).encode()).hexdigest()
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(k == x for k, _, _ in base) for x in range(4)]
        assert set(P.span_text(base).split(",")) <= set(got[i].spans.split(",")) | {""}
    out = {r.doc_id: r for r in P.redact_documents(df).collect()}
    for i, t in enumerate(texts):
        assert (out[i].text is None) == (t is None) and out[i].spans == "mine"
        if t is not None:
            assert brute(out[i].text) == [] and out[i].n_chars == len(out[i].text)
            if not got[i].spans:
                assert out[i].text == t


def test_redact_merges_overlaps():
    assert P.redact("ab 12345 cd", [(2, 3, 8), (3, 5, 9)]) == "ab [CARD]cd"


def test_empty_table_and_too_few_labels(docs):
    assert P.scan_documents(docs([]).limit(0)).count() == 0
    assert P.train([("a 1.2.3.4", [(1, 2, 9)])]) is None
    assert P.scan_documents(docs(["x 1.2.3.4", None])).toPandas().spans.tolist() == ["ip:2:9", ""]
