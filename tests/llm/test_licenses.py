from hypothesis import given, settings
from hypothesis import strategies as st

from wanderrank.llm import licenses as L


@given(st.lists(st.integers(0, 50), max_size=25, unique=True))
@settings(max_examples=200, deadline=None)
def test_increasing_is_longest(values):
    best = [1] * len(values)
    for i in range(len(values)):
        for j in range(i):
            if values[j] < values[i]:
                best[i] = max(best[i], best[j] + 1)
    got = L.increasing(values)
    picked = [values[i] for i in got]
    assert picked == sorted(picked) and got == sorted(got) and len(got) == max(best, default=0)


@given(st.lists(st.sampled_from("abcdef"), max_size=15), st.lists(st.sampled_from("abcdef"), max_size=15))
@settings(max_examples=300, deadline=None)
def test_alignment_is_a_common_subsequence(a, b):
    got = L.align(a, b)
    assert all(a[i] == b[j] for i, j in got)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))


def test_alignment_of_equal_and_edited():
    t = L.words(L.TEMPLATES["MIT-text"][0])
    assert len(L.align(t, t)) == len(t)
    edited = t[:10] + ["extra", "words"] + t[10:30] + t[32:]
    assert len(L.align(edited, t)) == len(t) - 2


def names(text):
    return sorted({h[0] for h in L.Scanner(L.TEMPLATES).scan(text)})


def test_notices():
    noise = "some ordinary prose about licenses, software and the public of no kind. " * 40
    assert names(noise) == []
    assert names(noise + "Released under the MIT License. " + noise) == ["MIT"]
    assert names("Licensed under the Apache License, Version 2.0.") == ["Apache-2.0"]
    assert names("Licensed under CC BY-NC 4.0.") == ["CC-BY-NC-4.0"]
    assert names("This work is licensed under the GNU General Public License, version 3.") == ["GPL-3.0"]
    full = L.TEMPLATES["MIT-text"][0].upper().replace(" ", "\n * ")
    assert names(noise + full + " " + noise) == ["MIT-text"]
    assert names(None) == names("") == names("the mit people") == []


def test_repeated_notices_are_all_found():
    text = ("word " * 50 + "Released under the MIT License. ") * 7
    hits = L.Scanner(L.TEMPLATES).scan(text)
    assert len(hits) == 7 and all(h[1] == 1.0 for h in hits)


def test_contract(docs, odd_texts):
    df = docs(odd_texts + ["Licensed under CC BY 4.0."], {"licenses": 3})
    got = {r.doc_id: r for r in L.scan_documents(df).collect()}
    assert len(got) == len(odd_texts) + 1
    assert got[len(odd_texts)].licenses == "CC-BY-4.0" and got[len(odd_texts)].coverage == 1.0
    assert all(got[i].n_licenses == 0 and got[i].coverage == 0.0 for i in range(len(odd_texts)))
    assert L.scan_documents(df.limit(0)).count() == 0


def test_versions_and_variants_are_told_apart():
    assert names("Licensed under the GNU General Public License, version 2.") == ["GPL-2.0"]
    assert names("Licensed under the GNU General Public License, version 3.0.") == ["GPL-3.0"]
    assert names("Licensed under the GNU Lesser General Public License, version 2.1.") == ["LGPL-2.1"]
    assert names("Licensed under the GNU Affero General Public License, version 3.") == ["AGPL-3.0"]
    notice = L.TEMPLATES["GPL-3.0-notice"][0]
    assert names(notice) == ["GPL-3.0-notice"]
    assert names(notice.replace("version 3", "version 2")) == ["GPL-2.0-notice"]
    assert names(notice.replace("GNU", "GNU Lesser")) == ["LGPL-3.0-notice"]
    assert names(notice.replace("GNU", "GNU Affero")) == ["AGPL-3.0-notice"]
    assert names(notice.replace("GNU", "GNU Lesser").replace("version 3", "version 2.1")) == ["LGPL-2.1-notice"]
    for name in ("ISC-text", "EPL-1.0", "EPL-2.0", "Apache-2.0-notice"):
        assert names(L.TEMPLATES[name][0]) == [name]
    assert names("Licensed under the Apache License, Version 2.0. Released under the MIT License") == ["Apache-2.0", "MIT"]


def test_notices_back_to_back_are_all_found():
    for name in ("MIT", "GPL-3.0", "Apache-2.0", "CC-BY-4.0"):
        line = L.TEMPLATES[name][0] + ". "
        for before in range(9):
            hits = L.Scanner(L.TEMPLATES).scan("word " * before + line * 6)
            assert [(h[0], h[1]) for h in hits] == [(name, 1.0)] * 6, (name, before)
