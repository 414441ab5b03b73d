import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from wanderrank.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines, earlier, dup = t.split("\n"), set(), 0
    for x in lines:
        if WORD.search(x):
            dup += x in earlier
            earlier.add(x)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)


@given(st.text(alphabet="ab #|<\n\t\x0b\x0c\r\x1c\x85\xa0é🎉", max_size=80))
@settings(max_examples=300, deadline=None)
def test_counts_match_brute_force(text):
    assert Q.text_counts(text) == brute(text)


def test_counts_of_odd_texts(odd_texts):
    for t in odd_texts:
        assert Q.text_counts(t) == brute(t)


def test_contract(docs, odd_texts):
    good = " ".join(f"word{i}" for i in range(60))
    texts = odd_texts + [good, good + " again", "a b c " * 30]
    got = {r.doc_id: r for r in Q.quality_documents(docs(texts)).collect()}
    for i, t in enumerate(texts):
        n, _, _, _, rep = brute(t)
        assert got[i].base_failed == (n < 50 or 100 * rep > 50 * n)
        assert not (got[i].base_failed and got[i].kept)
    assert got[len(odd_texts)].kept


def host(name, good, bad):
    fine = " ".join(f"w{i}rd" for i in range(60))
    spam = " ".join(f"w{i}rd#" for i in range(60))  # fails a soft rule only
    return [fine] * good, [spam] * bad, name


def test_host_verdicts(docs):
    rows, i = [], 0
    for good, bad, name in [host("clean", 95, 5), host("strict", 30, 70), host("worst", 2, 198), host(None, 50, 0), host("tiny", 0, 1)]:
        for t in good + bad:
            rows.append((i, t, name))
            i += 1
    got = {r.doc_id: r for r in Q.quality_documents(docs(rows)).collect()}
    source = {r[0]: r[2] for r in rows}
    spam = {r[0]: "#" in r[1] for r in rows}
    for k, r in got.items():
        want = {"clean": True, "strict": not spam[k], "worst": not spam[k], None: True}
        if source[k] in want:
            assert r.kept == want[source[k]], (source[k], r)
    assert {r.host_verdict for k, r in got.items() if source[k] == "strict"} == {"strict"}
    # one document cannot condemn a host: its rate is shrunk to the others'
    assert got[rows[-1][0]].host_verdict in ("ok", "strict")


def test_beta_prior():
    a, b = Q.beta_prior(100, 10_000, 2_000, 10_000 * (0.2 ** 2 + 0.01))  # spread beyond binomial noise
    assert abs(a / (a + b) - 0.2) < 1e-9 and 5 < a + b < 40
    a, b = Q.beta_prior(100, 10_000, 2_000, 10_000 * 0.2 ** 2)  # none: as strong as all documents
    assert a + b == 10_000
    assert Q.beta_prior(0, 0, 0, 0.0) == (1.0, 1.0)
    assert all(x > 0 for x in Q.beta_prior(3, 30, 30, 30.0) + Q.beta_prior(3, 30, 0, 0.0))


def test_keep_good_keeps_columns(docs, odd_texts):
    df = docs(odd_texts + [" ".join(f"word{i}" for i in range(60))], {"kept": "mine", "host": 1, "rate": 2, "verdict": "v", "n": 9})
    out = Q.keep_good(df)
    assert out.columns == df.columns
    assert [(r.doc_id, r.kept, r.n) for r in out.collect()] == [(len(odd_texts), "mine", 9)]
    assert Q.keep_good(df.limit(0)).count() == 0


def test_keep_good_judges_rule_by_rule(docs):
    rows, i = [], 0
    for good, bad, name in [host("clean", 95, 5), host("code", 2, 198), host("mixed", 30, 70), host(None, 50, 0), host("tiny", 0, 1)]:
        for t in good + bad:
            rows.append((i, t, name))
            i += 1
    # in a host whose form is symbols, another failed rule still rejects
    repeated = "\n".join([" ".join(f"w{k}rd#" for k in range(30))] + [f"w{k}rd# a line of its own" for k in range(20)])
    rows.append((i, repeated + "\n" + "\n".join(["same#"] * 9), "code"))
    kept = {r.doc_id for r in Q.keep_good(docs(rows)).collect()}
    assert {k for k, t, _ in rows if "#" not in t} <= kept
    assert {name for k, t, name in rows if "#" in t and k in kept} == {"code"}
    assert sum(name == "code" for k, _, name in rows if k in kept) == 200 and i not in kept


def test_keep_good_without_spread(docs):
    fine, spam, name = host("only", 19, 1)
    assert Q.keep_good(docs([(i, t, name) for i, t in enumerate(fine + spam)])).count() == 19
    _, spam, name = host("only", 0, 40)  # all documents of all hosts: the form of the table
    assert Q.keep_good(docs([(i, t, name) for i, t in enumerate(spam)])).count() == 40
