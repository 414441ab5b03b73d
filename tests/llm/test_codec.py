import os
import subprocess
import sys

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wanderrank.llm import sentencepiece_codec as S

pytestmark = pytest.mark.skipif(not os.path.exists(S.MODEL_PATH), reason="no SentencePiece model file")


def ints(ids):
    return [list(memoryview(x).cast("i")) for x in ids]


@pytest.fixture(scope="module")
def pair():
    import sentencepiece
    raw = open(S.MODEL_PATH, "rb").read()
    m = S.read_model(raw)
    return S.Codec(m, S.build(m).to_str()), sentencepiece.SentencePieceProcessor(model_proto=raw), m


def test_model_file(pair):
    _, own, m = pair
    assert len(m.pieces) == own.vocab_size()
    assert m.pieces == [own.id_to_piece(i) for i in range(len(m.pieces))]
    assert [round(x, 3) for x in m.scores[:500]] == [round(own.get_score(i), 3) for i in range(500)]


@given(st.text(max_size=60) | st.text(alphabet=" ▁abé<s>\n\x00日🎉", max_size=30))
@settings(max_examples=400, deadline=None)
def test_parity_and_round_trip(pair, text):
    codec, own, _ = pair
    ids = codec.encode([text])
    assert ints(ids) == own.encode([text])
    assert codec.decode(ids) == own.decode(ints(ids))
    if "▁" not in text:
        assert codec.decode(ids) == [text]


def test_whole_text_and_unit_encoders_agree(pair, odd_texts):
    codec, own, m = pair
    texts = [t or "" for t in odd_texts]
    assert codec.by_unit
    assert ints(codec.encode(texts)) == S.encode_all(codec.tok, texts) == own.encode(texts)
    assert codec.decode(codec.encode(texts)) == codec.tok.decode_batch(ints(codec.encode(texts)), skip_special_tokens=False)


def test_generations_keep_results(pair, monkeypatch, odd_texts):
    _, own, m = pair
    codec = S.Codec(m, S.build(m).to_str())
    monkeypatch.setattr(S.Codec, "KEEP", 3)
    for t in [t for t in odd_texts if t] * 2:
        assert ints(codec.encode([t])) == own.encode([t])
    assert len(codec.old) > 0


def test_unigram_model_rebuild():
    """A hand-made unigram model: scores decide the segmentation, bytes the rest."""
    import struct

    def field(n, kind, body):
        return bytes([n << 3 | kind]) + (bytes([len(body)]) + body if kind == 2 else body)

    def piece(text, score, kind=S.NORMAL):
        body = field(1, 2, text.encode()) + field(2, 5, struct.pack("<f", score)) + field(3, 0, bytes([kind]))
        return field(1, 2, body)

    raw = piece("<unk>", 0, S.UNKNOWN) + b"".join(piece(f"<0x{i:02X}>", -9, S.BYTE) for i in range(256))
    raw += piece("▁", -3) + piece("a", -3) + piece("b", -3) + piece("ab", -2) + piece("▁ab", -1)
    trainer = field(3, 0, b"\x01") + bytes([35 << 3 & 0x7F | 0x80, 35 >> 4, 1])
    raw += field(2, 2, trainer) + field(3, 2, field(3, 0, b"\x01") + field(4, 0, b"\x00") + field(5, 0, b"\x01"))
    m = S.read_model(raw)
    assert m.kind == S.UNIGRAM and m.byte_fallback and m.dummy_prefix and not m.trim
    codec = S.Codec(m, S.build(m).to_str())
    ids = codec.encode(["ab aab", "é", ""])
    assert [[m.pieces[i] for i in x] for x in ints(ids)] == [["▁ab", "▁", "a", "ab"], ["▁", "<0xC3>", "<0xA9>"], []]
    assert codec.decode(ids) == ["ab aab", "é", ""]


def test_contract(docs, odd_texts):
    df = docs(odd_texts, {"ids": 1, "parity": "x"})
    got = {r.doc_id: r for r in S.encode_documents(df).collect()}
    for i, t in enumerate(odd_texts):
        r = got[i]
        if t is None:
            assert (r.n_tokens, r.ids, r.round_trip, r.parity) == (0, None, None, None)
        else:
            assert r.n_tokens == len(r.ids) and r.parity and r.round_trip
    assert S.encode_documents(df.limit(0)).count() == 0


def test_ids_are_the_rebuilt_tokenizers(pair, odd_texts):
    codec, own, _ = pair
    texts = [t or "" for t in odd_texts]
    rebuilt = codec.encode(texts)
    library = [b"\0\0\0\0" + rebuilt[0]] + [np.array(x, dtype="<i4").tobytes() for x in own.encode(texts)][1:]
    ids, parity = S.agreed(rebuilt, library)
    assert parity == [False] + [True] * (len(texts) - 1) and ids[0] is library[0]
    assert all(x is y for x, y in zip(ids[1:], rebuilt[1:]))  # before: always the library's


def test_a_worker_stays_small(tmp_path):
    """Texts of ever new words: a worker's own memory (a new process) grows little."""
    code = tmp_path / "worker.py"
    code.write_text(f'''
import random, re, sys
sys.path.insert(0, {os.getcwd()!r})
import pyarrow as pa
from wanderrank.llm import sentencepiece_codec as S

def own():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

raw = open(S.MODEL_PATH, "rb").read()
as_json = S.build(S.read_model(raw)).to_str() if len(sys.argv) < 2 else open(sys.argv[1]).read()
if len(sys.argv) < 2:
    open({str(tmp_path / "json")!r}, "w").write(as_json)
    sys.exit()
rng, before, most = random.Random(1), own(), 0
codec = S.Codec(S.read_model(raw), as_json)
for _ in range(3):
    texts = [" ".join("%x" % rng.getrandbits(28) for _ in range(400)) for _ in range(400)]
    for part in S._slices(pa.RecordBatch.from_pydict({{"text": texts}}), "text"):
        codec.decode(codec.encode(part.column(0).to_pylist()))
        most = max(most, own() - before)
print(most)
''')
    for more in ([], [str(tmp_path / "json")]):
        out = subprocess.run([sys.executable, str(code), *more], capture_output=True, text=True, check=True, timeout=300).stdout
    assert float(out) < 150, out
