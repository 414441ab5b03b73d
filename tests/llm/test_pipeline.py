import os

import pytest

import corpus_pipeline as P
from wanderrank.llm import quality as Q
from wanderrank.llm import sentencepiece_codec as S

SF = "/root/testdata/sf0.001"


def test_stages_in_order_and_columns(spark, docs, odd_texts):
    fine = [" ".join(f"w{i}rd{k}" for i in range(70)) for k in range(12)]
    texts = odd_texts + fine + [fine[0], fine[1].replace("w69rd1", "changed")] + [fine[2] + " mail me.too@example.com now"]
    rows = [(i, t, f"s{i % 2}") for i, t in enumerate(texts)]
    df = docs(rows, {"kept": 1, "h": 2, "size": 3})
    kept = P.quality_rules(spark, df, "")
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, t, _ in rows if Q.text_counts(t)[0] >= 50 and
                                                  2 * Q.text_counts(t)[4] <= Q.text_counts(t)[0]}
    clean = P.personal_data(spark, kept, "")
    assert clean.columns == df.columns
    assert not any("example.com" in r.text for r in clean.collect())
    mixed = P.mix_sources(spark, clean, "")
    assert mixed.columns == df.columns and mixed.count() > 0
    if os.path.exists(S.MODEL_PATH):
        out = P.tokenise(spark, mixed, "").collect()
        assert len(out) == mixed.count() and all(r.parity and r.round_trip for r in out)


@pytest.mark.skipif(not os.path.exists(S.MODEL_PATH), reason="no SentencePiece model file")
def test_ids_keep_the_columns_of_their_document(spark, docs):
    df = docs([(7, "one two", "s1"), (7, "one two", "s1"), (8, None, None)], {"lang": "x", "ids": 3})
    out = P.tokenise(spark, df, "")
    assert {"source", "lang"} <= set(out.columns) and "text" not in out.columns  # before: neither
    rows = sorted((r.doc_id, r.source or "", r.lang, r.n_tokens) for r in out.collect())
    n = rows[0][3]
    assert rows == [(7, "s1", "x", n), (7, "s1", "x", n), (8, "", "x", 0)] and n >= 2
    assert dict(out.dtypes)["ids"] == "array<int>"


@pytest.mark.skipif(not os.path.exists(SF) or not os.path.exists(S.MODEL_PATH), reason="no test data")
def test_run(spark):
    out = P.run(spark, SF).toPandas()
    assert len(out) and out.parity.all() and out.round_trip.all()
