"""SentencePiece encoding and decoding on a tokenizers-library backend.

The model file is read as protobuf wire format: pieces with score and type,
trainer and normaliser settings. From these a ``tokenizers.Tokenizer`` is
rebuilt: the normaliser (precompiled character map, extra white space, dummy
prefix, the metaspace marker), the model (unigram scores, or for a BPE model
merges ranked by score) with byte fallback, and the decoder. Batches are
encoded by the library's own threads.

Where no piece goes on past a metaspace mark (checked on the vocabulary) and
the normaliser only adds and replaces marks, a text falls apart into units
that start at a run of marks. Units are encoded once per worker, kept in a
bounded table, and their ids joined; other models encode whole texts.

Parity: every row is also encoded with the SentencePiece library itself and
compared; where the two differ (ties that the merge ranks cannot express) the
library's ids are returned and the row says so.

Defined results: a null text gives null ids and zero tokens; an empty text
gives no ids; texts of any length are encoded whole; special-token strings in a
text are ordinary text; other columns are not touched.
"""

from __future__ import annotations

import os
import re
import struct
from dataclasses import dataclass, field
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wanderrank.llm.common import trim_memory, with_package

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"  # a parameter; never copied
THREADS = 2
BATCH_CHARS = 1 << 16  # text in one library call; a slice of a batch is four of them
MARK = "▁"

# Piece and model types of the model format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


# ----------------------------------------------------------- the model file
def _fields(raw: bytes):
    """(field number, value) of a protobuf message; varints as int, 32-bit and
    length-delimited values as bytes."""
    at, end = 0, len(raw)

    def varint():
        nonlocal at
        value, shift = 0, 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return value

    while at < end:
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, raw[at:at + size]
            at += size


@dataclass
class Model:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim: bool = True
    escape: bool = True
    suffix: bool = False


def read_model(raw: bytes) -> Model:
    m = Model()
    for number, value in _fields(raw):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode("utf-8")
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            m.pieces.append(piece)
            m.scores.append(score)
            m.types.append(kind)
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    m.kind = v
                elif n == 24:
                    m.suffix = bool(v)
                elif n == 35:
                    m.byte_fallback = bool(v)
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    m.charsmap = v
                elif n == 3:
                    m.dummy_prefix = bool(v)
                elif n == 4:
                    m.trim = bool(v)
                elif n == 5:
                    m.escape = bool(v)
    return m


# ------------------------------------------------------------- the tokenizer
def build(m: Model):
    """The tokenizers.Tokenizer of a model."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if m.suffix:
        raise ValueError("models with the white-space mark as a suffix are not supported")
    unk = next((i for i, t in enumerate(m.types) if t == UNKNOWN), 0)
    if m.kind == UNIGRAM:
        model = models.Unigram(list(zip(m.pieces, m.scores)), unk_id=unk, byte_fallback=m.byte_fallback)
    elif m.kind == BPE:
        vocab = {p: i for i, p in enumerate(m.pieces)}
        usable = {p: i for i, p in enumerate(m.pieces) if m.types[i] in (NORMAL, USER_DEFINED)}
        ranked = []
        for p, i in usable.items():
            for cut in range(1, len(p)):
                left, right = p[:cut], p[cut:]
                if left in usable and right in usable:
                    ranked.append((-m.scores[i], i, usable[left], usable[right], left, right))
        ranked.sort(key=lambda r: r[:4])
        model = models.BPE(vocab, [(r[4], r[5]) for r in ranked], unk_token=m.pieces[unk], fuse_unk=True,
                           byte_fallback=m.byte_fallback, cache_capacity=10_000)
    else:
        raise ValueError(f"model type {m.kind} is not supported")
    tok = Tokenizer(model)
    steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
    if m.trim:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if m.dummy_prefix:
        steps.append(normalizers.Prepend(MARK if m.escape else " "))
    if m.escape:
        steps.append(normalizers.Replace(" ", MARK))
    tok.normalizer = normalizers.Sequence(steps)
    if m.escape and not any(MARK in p.lstrip(MARK) for p, t in zip(m.pieces, m.types) if t in (NORMAL, USER_DEFINED)):
        # no piece goes on past a mark, so no merge crosses the start of a run
        # of marks: runs can be encoded one by one, and cached
        tok.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), "isolated")
    steps = [decoders.Replace(MARK, " ")]
    if m.byte_fallback:
        steps.append(decoders.ByteFallback())
    steps.append(decoders.Fuse())
    if m.dummy_prefix:
        steps.append(decoders.Strip(" ", 1, 0))
    tok.decoder = decoders.Sequence(steps)
    return tok


def _ascii(piece: str) -> str | None:
    """The character of a byte piece ('<0x0A>') below 0x80."""
    value = int(piece[3:5], 16)
    return chr(value) if value < 0x80 else None


class Codec:
    """Encode and decode with a rebuilt tokenizer (``as_json``). Ids of a text
    are little-endian 32-bit integers in bytes."""

    KEEP = 50_000    # units in each of the two generations kept per worker
    JOIN = 64        # new units encoded as one text

    def __init__(self, m: Model, as_json: str):
        from tokenizers import Tokenizer, normalizers

        self.json = as_json
        self.used = Tokenizer.from_str(as_json)  # a worker holds one tokenizer, not two
        self.by_unit = self.used.pre_tokenizer is not None and not m.charsmap and not m.trim and m.dummy_prefix
        if self.by_unit:
            self.used.normalizer = normalizers.Sequence([])
            self.young: dict[str, bytes] = {}
            self.old: dict[str, bytes] = {}
            self.cut = re.compile(f"{MARK}+[^{MARK}]*")
            self.opens = np.array([p.startswith(MARK) for p in m.pieces], dtype=bool)
        plain = [p.replace(MARK, " ") if t in (NORMAL, USER_DEFINED) else _ascii(p) if t == BYTE else None
                 for p, t in zip(m.pieces, m.types)]
        self.hard = np.array([p is None for p in plain], dtype=bool)
        self.plain = np.array(plain, dtype=object)
        self.strip = m.dummy_prefix

    @cached_property
    def tok(self):
        """The tokenizer of whole texts; where units are encoded, nothing here asks for it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.json) if self.by_unit else self.used

    def _new(self, units: list[str]) -> dict[str, bytes]:
        """Ids of units not met before; a unit without a mark stands for itself
        after one. Units with one mark are encoded joined: no piece goes on past
        a mark, so each piece that opens with one starts the next unit."""
        out = {}
        single = [u for u in units if MARK not in u]
        groups = [single[i:i + self.JOIN] for i in range(0, len(single), self.JOIN)]
        for group, ids in zip(groups, encode_all(self.used, [MARK + MARK.join(g) for g in groups])):
            ids = np.array(ids, dtype="<i4")
            cuts = np.flatnonzero(self.opens[ids])
            raw, at = ids.tobytes(), (cuts * 4).tolist()
            out.update((u, raw[s:e]) for u, s, e in zip(group, at, at[1:] + [len(raw)]))
        several = [u for u in units if MARK in u]
        out.update((u, np.array(ids, dtype="<i4").tobytes()) for u, ids in zip(several, encode_all(self.used, several)))
        return out

    def _cut(self, text: str) -> list[str]:
        """Units of a text: words between single spaces as they are; where marks
        or runs of spaces occur, pieces from one run of marks to the next."""
        if not text:
            return []
        parts = text.split(" ")
        if "" in parts or MARK in text:
            return self.cut.findall(MARK + text.replace(" ", MARK))
        return parts

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_unit:
            return [np.array(x, dtype="<i4").tobytes() for x in encode_all(self.tok, texts)]
        parts = [self._cut(t) for t in texts]
        if len(self.young) > self.KEEP:
            self.old, self.young = self.young, {}
            trim_memory()
        young, old = self.young, self.old
        missing = set().union(*parts)
        missing.difference_update(young)
        known = [u for u in missing if u in old]
        young.update((u, old[u]) for u in known)
        missing.difference_update(known)
        young.update(self._new(list(missing)))
        return [b"".join(map(young.__getitem__, us)) for us in parts]

    def decode(self, ids: list[bytes]) -> list[str]:
        """Piece texts joined; texts with bytes outside ASCII or unknown pieces go
        through the library's decoder."""
        out: list = []
        hard = []
        for i, raw in enumerate(ids):
            pieces = np.frombuffer(raw, dtype="<i4")
            if self.hard[pieces].any():
                hard.append(i)
                out.append("")
            else:
                text = "".join(self.plain[pieces])
                out.append(text[1:] if self.strip and text[:1] == " " else text)
        back = [list(memoryview(ids[i]).cast("i")) for i in hard]
        for i, text in zip(hard, self.used.decode_batch(back, skip_special_tokens=False)):
            out[i] = text
        return out


def encode_all(tok, texts: list[str]) -> list[list[int]]:
    """Ids of each text, in batches of bounded size (one call of the library,
    spread over its threads, per batch)."""
    out: list[list[int]] = []
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (end == at or size + len(texts[end]) <= BATCH_CHARS):
            size += len(texts[end])
            end += 1
        out += [e.ids for e in tok.encode_batch_fast(texts[at:end], add_special_tokens=False)]
        at = end
    return out


def agreed(rebuilt: list[bytes], library: list[bytes]) -> tuple[list[bytes], list[bool]]:
    """(ids, parity): a text's ids are the rebuilt tokenizer's, the library's only where the two differ."""
    parity = [x == y for x, y in zip(rebuilt, library, strict=True)]
    return [x if same else y for x, y, same in zip(rebuilt, library, parity)], parity


_CACHE: dict = {}


def _loaded(name: str, make):
    if name not in _CACHE:
        _CACHE[name] = make()
    return _CACHE[name]


def encode_documents(documents: DataFrame, model_path: str = MODEL_PATH, threads: int = THREADS,
                     text: str = "text", key: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``op2_sentencepiece``: key, n_tokens, ids, round_trip (the ids
    decode to the text), parity (the rebuilt tokenizer agrees with the
    SentencePiece library). The columns ``keep`` go along, after the key."""
    spark = documents.sparkSession
    with_package(spark)
    with open(model_path, "rb") as f:  # on the driver; half a megabyte
        raw = f.read()
    shipped = spark.sparkContext.broadcast((raw, build(read_model(raw)).to_str()))
    rows = documents.select(key, text, *keep)
    schema = T.StructType([rows.schema[key], *(rows.schema[c] for c in keep), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("round_trip", T.BooleanType()),
                           T.StructField("parity", T.BooleanType())])

    def run(batches):
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        import sentencepiece

        proto, as_json = shipped.value
        codec = _loaded("codec" + str(hash(proto)), lambda: Codec(read_model(proto), as_json))
        own = _loaded("sp" + str(hash(proto)), lambda: sentencepiece.SentencePieceProcessor(model_proto=proto))
        try:
            for b in batches:
                for part in _slices(b, text):
                    given = [x.as_py() for x in part.column(text)]
                    texts = [t or "" for t in given]
                    check = [np.array(x, dtype="<i4").tobytes() for x in own.encode(texts, num_threads=threads)]
                    ids, parity = agreed(codec.encode(texts), check)
                    back = codec.decode(ids)
                    none = [t is None for t in given]
                    lengths = np.array([0] + [len(x) // 4 for x in ids])
                    values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"), pa.int32())
                    lists = pa.ListArray.from_arrays(pa.array(np.cumsum(lengths), pa.int32()), values,
                                                     mask=pa.array(none, pa.bool_()))
                    yield pa.RecordBatch.from_arrays([
                        part.column(key), *(part.column(c) for c in keep), pa.array(lengths[1:], pa.int64()), lists,
                        pa.array([None if n else x == t for x, t, n in zip(back, texts, none)], pa.bool_()),
                        pa.array([None if n else p for p, n in zip(parity, none)], pa.bool_())], names=schema.names)
        finally:
            _CACHE.clear()  # the worker outlives this stage
            del codec, own
            trim_memory()

    return rows.mapInArrow(run, schema)


RESULT = ("n_tokens", "ids", "round_trip", "parity")


def _slices(batch: pa.RecordBatch, text: str):
    """The batch in pieces of bounded text, so that ids of a piece fit."""
    at, size = 0, 0
    for i, x in enumerate(batch.column(text)):
        n = len(x.as_py() or "") if x.is_valid else 0
        if i > at and size + n > 4 * BATCH_CHARS:
            yield batch.slice(at, i - at)
            at, size = i, 0
        size += n
    if at < batch.num_rows:
        yield batch.slice(at)
