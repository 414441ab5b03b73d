import hashlib

from pyspark.sql import functions as F

from wanderrank.llm import fingerprints as M


def test_edited_text_and_next(docs, odd_texts):
    rows = [(10 * i, t, "s") for i, t in enumerate(odd_texts)]
    got = {r.doc_id: r for r in M.fingerprint_documents(docs(rows).repartition(5)).collect()}
    texts = [t or "" for t in odd_texts]
    for i, t in enumerate(texts):
        k = len(t) // 2
        nxt = texts[(i + 1) % len(texts)]
        edited = t[:len(t) - k] + nxt[:k]
        r = got[10 * i]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == r.edited_fingerprint) == (edited == t)
        if edited == t:
            assert r.near_edited == 1.0
    by_text = {}
    for i, t in enumerate(texts):
        by_text.setdefault(t, set()).add(got[10 * i].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert len({v.pop() for v in by_text.values()}) == len(by_text)


def test_many_rows_over_ranges(spark, docs):
    n = 500
    rows = [(i * i, f"text {i}. " * 9, "s") for i in range(n)]
    got = M.with_next(docs(rows).repartition(9), "doc_id", "text", "next").collect()
    assert len(got) == n
    for r in got:
        i = round(r.doc_id ** 0.5)
        assert r.next == f"text {(i + 1) % n}. " * 9


def test_ties_nulls_one_row_and_none(docs):
    rows = [(None, "n1", "s"), (None, "n2", "s"), (1, "b", "s"), (1, "a", "s"), (2, "c", "s")]
    got = {(r.doc_id, r.text): r.next for r in M.with_next(docs(rows), "doc_id", "text", "next").collect()}
    assert got == {(None, "n1"): "n2", (None, "n2"): "a", (1, "a"): "b", (1, "b"): "c", (2, "c"): "n1"}
    one = M.with_next(docs([(7, "only", "s")]), "doc_id", "text", "next").collect()
    assert [(r.doc_id, r.next) for r in one] == [(7, "only")]
    assert M.fingerprint_documents(docs([]).limit(0)).count() == 0


def test_differing_branches_locate_the_edit(spark):
    a = "first line. second part.\nmiddle line here.\nlast line.\n"
    b = a.replace("middle", "centre")
    df = spark.createDataFrame([(a, b)], "a string, b string")
    nodes = [M.section_nodes(M.paragraph_nodes(F.col(c))) for c in "ab"]
    assert df.select(M.differing_sections(*nodes)).first()[0] == [1]
    leaves = [M.leaves(M.paragraph_nodes(F.col(c))) for c in "ab"]
    assert df.select(M.likeness(*leaves)).first()[0] == 2 * 3 / 8


def test_leaves_cover_the_whole_text(spark, odd_texts):
    df = spark.createDataFrame([(t or "",) for t in odd_texts], "t string")
    cut = F.flatten(F.transform(F.filter(F.split("t", r"(?<=\n)", -1), lambda s: s != ""),
                                lambda s: F.regexp_extract_all(s, F.lit(M._LEAF), F.lit(0))))
    assert all(r[0] == r[1] for r in df.select(F.array_join(cut, ""), "t").collect())
