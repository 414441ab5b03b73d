"""Personal data: fixed patterns plus a character BiLSTM-CRF trained in numpy.

The tagger labels characters B/I per kind or O. It is trained on the driver
from labelled spans: at most ``SNIPPETS`` short snippets, chosen by hash
(documented bound). The query labels them with the fixed patterns; snippets
with a pattern match that fails its check (a wrong check digit, a part over
255) are left out, being neither.

Every text is tagged where it can hold personal data: each of the four kinds
has a digit or an ``@``, so only regions within ``CONTEXT`` characters of one
are run through the network (a sound gate: no span outside it exists). A region
is covered by overlapping windows; each window gives tag scores, a position's
scores are the centre-weighted mean over its windows, and one CRF pass over
the whole region decodes them (Viterbi) and gives each span its confidence
(forward-backward marginals). Spans that overlap a pattern span, lie inside a
longer token, have the wrong shape or a confidence below ``MIN_CONFIDENCE``
are dropped; the rest is added.

Defined results: a null text is empty; an empty text has no spans; with fewer
than ``LEAST_SNIPPETS`` labelled snippets no network is trained and only the
patterns count; repeated rows give repeated results; a text of any length is
read whole, its windows in bounded batches.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanderrank.llm.common import with_package

KINDS = ("email", "ip", "card", "phone")
SNIPPETS = 2_000
LEAST_SNIPPETS = 20
CONTEXT = 24
WINDOW, STRIDE = 64, 32
MIN_CONFIDENCE = 0.9
EMBED, HIDDEN = 16, 24
EPOCHS, BATCH, RATE = 12, 32, 0.01
SEED = 7
TAGS = 1 + 2 * len(KINDS)  # O, then B and I of each kind
BATCH_CELLS = 1 << 17      # positions in one network or CRF batch

# ------------------------------------------------------------ fixed patterns
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")  # always matches at a digit: linear
_GROUP = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_SIGN = re.compile(r"[0-9@]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """One step per ``@``: the run of local characters before it and the
    domain after it (the leftmost match always starts at the run's start)."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def _ips(text: str) -> tuple[list[tuple[int, int]], int]:
    """Four groups at a time along each chain of dotted digit groups."""
    out, failed = [], 0
    for chain in _CHAIN.finditer(text):
        groups = [(g.start(), g.end()) for g in _GROUP.finditer(text, chain.start(), chain.end())]
        for i in range(0, len(groups) - 3, 4):
            four = groups[i:i + 4]
            parts = [text[s:e].lstrip("0") or "0" for s, e in four]
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                out.append((four[0][0], four[3][1]))
            else:
                failed += 1
    return out, failed


def pattern_spans(text: str) -> tuple[list[tuple[int, int, int]], int]:
    """[(kind, start, end)] by kind, then start; and how many matches failed
    their check."""
    out: list[tuple[int, int, int]] = []
    failed = 0
    if "@" in text:
        out += [(0, s, e) for s, e in _emails(text)]
    if _DIGIT.search(text) is None:
        return out, 0
    ips, failed = _ips(text)
    out += [(1, s, e) for s, e in ips]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
        elif len(digits) >= 13:
            failed += 1
    for m in _PHONE.finditer(text):
        if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            out.append((3, m.start(), m.end()))
        else:
            failed += 1
    return out, failed


# ------------------------------------------------------------------ the model
def _codes(text: str) -> np.ndarray:
    """ASCII as it is, other letters 128, other characters 129, padding 130."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    return np.where(raw < 128, raw, np.where(raw < 0x2000, 128, 129))


PAD, SYMBOLS = 130, 131


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _logsumexp(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


class Tagger:
    """BiLSTM scores, CRF transitions. ``w`` is a dict of float32 arrays."""

    def __init__(self, w: dict[str, np.ndarray]):
        self.w = w

    @classmethod
    def fresh(cls, seed: int = SEED) -> "Tagger":
        rng = np.random.default_rng(seed)
        f = lambda *s: (rng.standard_normal(s) * (1.0 / np.sqrt(s[0]))).astype(np.float32)
        w = {"emb": f(SYMBOLS, EMBED) * 3, "out": f(2 * HIDDEN, TAGS), "out_b": np.zeros(TAGS, np.float32),
             "trans": np.zeros((TAGS, TAGS), np.float32)}
        for d in "fb":
            w[f"x{d}"], w[f"h{d}"] = f(EMBED, 4 * HIDDEN), f(HIDDEN, 4 * HIDDEN)
            w[f"b{d}"] = np.zeros(4 * HIDDEN, np.float32)
            w[f"b{d}"][HIDDEN:2 * HIDDEN] = 1.0  # forget gates start open
        return cls(w)

    def _lstm(self, x, mask, d, keep):
        n, t, _ = x.shape
        h = np.zeros((n, HIDDEN), np.float32)
        c = np.zeros_like(h)
        hs = np.zeros((n, t, HIDDEN), np.float32)
        pre = x @ self.w[f"x{d}"] + self.w[f"b{d}"]
        kept = []
        for k in (range(t) if d == "f" else range(t - 1, -1, -1)):
            z = pre[:, k] + h @ self.w[f"h{d}"]
            i, f = _sigmoid(z[:, :HIDDEN]), _sigmoid(z[:, HIDDEN:2 * HIDDEN])
            o, g = _sigmoid(z[:, 2 * HIDDEN:3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN:])
            m = mask[:, k, None]
            c2 = f * c + i * g
            th = np.tanh(c2)
            if keep:
                kept.append((k, i, f, o, g, c, th, h, m))
            c, h = m * c2 + (1 - m) * c, m * (o * th) + (1 - m) * h
            hs[:, k] = h
        return hs, kept

    def _lstm_back(self, x, dhs, kept, d, grad):
        n = x.shape[0]
        dh = np.zeros((n, HIDDEN), np.float32)
        dc = np.zeros_like(dh)
        dx = np.zeros_like(x)
        for k, i, f, o, g, c0, th, h0, m in reversed(kept):
            dh = dh + dhs[:, k]
            dhm = dh * m
            dct = dc * m + dhm * o * (1 - th * th)
            dz = np.concatenate([dct * g * i * (1 - i), dct * c0 * f * (1 - f),
                                 dhm * th * o * (1 - o), dct * i * (1 - g * g)], axis=1)
            grad[f"x{d}"] += x[:, k].T @ dz
            grad[f"h{d}"] += h0.T @ dz
            grad[f"b{d}"] += dz.sum(0)
            dx[:, k] = dz @ self.w[f"x{d}"].T
            dh = dh * (1 - m) + dz @ self.w[f"h{d}"].T
            dc = dc * (1 - m) + dct * f
        return dx

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """[n x t x TAGS] tag scores of windows of character codes."""
        mask = (codes != PAD).astype(np.float32)
        x = self.w["emb"][codes]
        h = np.concatenate([self._lstm(x, mask, d, False)[0] for d in "fb"], axis=2)
        return h @ self.w["out"] + self.w["out_b"]

    def crf(self, scores: np.ndarray, lengths: np.ndarray):
        """Viterbi tags and marginals, [n x t] and [n x t x TAGS]."""
        n, t, k = scores.shape
        trans = self.w["trans"]
        live = np.arange(t)[None, :] < lengths[:, None]
        alpha = np.zeros((n, t, k), np.float32)
        best = np.zeros((n, t, k), np.float32)
        back = np.zeros((n, t, k), np.int8)
        alpha[:, 0] = best[:, 0] = scores[:, 0]
        for p in range(1, t):
            on = live[:, p, None]
            a = _logsumexp(alpha[:, p - 1, :, None] + trans, 1) + scores[:, p]
            v = best[:, p - 1, :, None] + trans
            back[:, p] = np.where(on, v.argmax(1), np.arange(k))
            best[:, p] = np.where(on, v.max(1) + scores[:, p], best[:, p - 1])
            alpha[:, p] = np.where(on, a, alpha[:, p - 1])
        beta = np.zeros((n, t, k), np.float32)
        for p in range(t - 2, -1, -1):
            b = _logsumexp(trans[None] + (scores[:, p + 1] + beta[:, p + 1])[:, None, :], 2)
            beta[:, p] = np.where(live[:, p + 1, None], b, beta[:, p + 1])
        log_z = _logsumexp(alpha[:, -1], 1)
        marginal = np.exp(np.minimum(alpha + beta - log_z[:, None, None], 0))
        tags = np.zeros((n, t), np.int64)
        tags[:, -1] = best[:, -1].argmax(1)
        for p in range(t - 1, 0, -1):
            tags[:, p - 1] = np.take_along_axis(back[:, p], tags[:, p, None], 1)[:, 0]
        return np.where(live, tags, 0), marginal

    def gradient(self, codes: np.ndarray, tags: np.ndarray, lengths: np.ndarray):
        """Mean negative log-likelihood's gradient over a batch."""
        n, t = codes.shape
        mask = (codes != PAD).astype(np.float32)
        x = self.w["emb"][codes]
        (hf, kf), (hb, kb) = (self._lstm(x, mask, d, True) for d in "fb")
        h = np.concatenate([hf, hb], axis=2)
        scores = h @ self.w["out"] + self.w["out_b"]
        trans = self.w["trans"]
        alpha = np.zeros_like(scores)
        alpha[:, 0] = scores[:, 0]
        for p in range(1, t):
            a = _logsumexp(alpha[:, p - 1, :, None] + trans, 1) + scores[:, p]
            alpha[:, p] = np.where(mask[:, p, None] > 0, a, alpha[:, p - 1])
        beta = np.zeros_like(scores)
        for p in range(t - 2, -1, -1):
            b = _logsumexp(trans[None] + (scores[:, p + 1] + beta[:, p + 1])[:, None, :], 2)
            beta[:, p] = np.where(mask[:, p + 1, None] > 0, b, beta[:, p + 1])
        log_z = _logsumexp(alpha[:, -1], 1)
        ds = np.exp(np.minimum(alpha + beta - log_z[:, None, None], 0)) * mask[..., None]
        rows = np.arange(n)[:, None]
        ds[rows, np.arange(t)[None, :], tags] -= mask
        grad = {key: np.zeros_like(v) for key, v in self.w.items()}
        for p in range(1, t):
            on = mask[:, p]
            pair = np.exp(np.minimum(alpha[:, p - 1, :, None] + trans + (scores[:, p] + beta[:, p])[:, None, :]
                                     - log_z[:, None, None], 0)) * on[:, None, None]
            grad["trans"] += pair.sum(0)
            np.add.at(grad["trans"], (tags[:, p - 1], tags[:, p]), -on)
        ds /= n
        grad["trans"] /= n
        grad["out"] = h.reshape(-1, 2 * HIDDEN).T @ ds.reshape(-1, TAGS)
        grad["out_b"] = ds.sum((0, 1))
        dh = ds @ self.w["out"].T
        dx = self._lstm_back(x, dh[..., :HIDDEN], kf, "f", grad) + \
            self._lstm_back(x, dh[..., HIDDEN:], kb, "b", grad)
        np.add.at(grad["emb"], codes, dx)
        return grad


def train(labelled: list[tuple[str, list[tuple[int, int, int]]]], epochs: int = EPOCHS,
          seed: int = SEED) -> Tagger | None:
    """Fit on (text, [(kind, start, end)]) pairs of at most a few hundred
    characters each (Adam, seeded; None with too few)."""
    labelled = [x for x in labelled if x[0]]
    if len(labelled) < LEAST_SNIPPETS or not any(s for _, s in labelled):
        return None
    longest = max(len(t) for t, _ in labelled)
    codes = np.full((len(labelled), longest), PAD, np.int64)
    tags = np.zeros((len(labelled), longest), np.int64)
    for i, (text, spans) in enumerate(labelled):
        codes[i, :len(text)] = _codes(text)
        for kind, s, e in spans:
            tags[i, s] = 1 + 2 * kind
            tags[i, s + 1:e] = 2 + 2 * kind
    model, rng = Tagger.fresh(seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in model.w.items()}
    v2 = {k: np.zeros_like(v) for k, v in model.w.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(labelled))
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            lengths = (codes[pick] != PAD).sum(1)
            width = int(lengths.max())
            grad = model.gradient(codes[pick, :width], tags[pick, :width], lengths)
            size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            step += 1
            rate = RATE * (1 - 0.8 * epoch / epochs)
            for k, g in grad.items():
                g = g * min(1.0, 5.0 / (size + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                v2[k] = 0.999 * v2[k] + 0.001 * g * g
                model.w[k] = (model.w[k] - rate * (m[k] / (1 - 0.9 ** step))
                              / (np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return model


# ---------------------------------------------------------------- the tagging
def regions(text: str) -> list[tuple[int, int]]:
    """Stretches within CONTEXT characters of a digit or an @."""
    out: list[list[int]] = []
    for m in _SIGN.finditer(text):
        s, e = max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)
        if out and s <= out[-1][1]:
            out[-1][1] = e
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _windows(length: int) -> list[int]:
    if length <= WINDOW:
        return [0]
    starts = list(range(0, length - WINDOW, STRIDE))
    return starts + [length - WINDOW]


_CENTRE = 1.0 - np.abs(np.arange(WINDOW) - (WINDOW - 1) / 2) / (WINDOW / 2 + 1)


def tag_regions(model: Tagger, codes: list[np.ndarray]) -> list[list[tuple[int, int, int, float]]]:
    """Per region [(kind, start, end, confidence)]."""
    out: list = [[] for _ in codes]
    order = sorted(range(len(codes)), key=lambda i: len(codes[i]))
    at = 0
    while at < len(order):
        # regions of like length together, a bounded number of positions a batch
        take = 1
        while at + take < len(order) and (take + 1) * len(codes[order[at + take]]) <= BATCH_CELLS:
            take += 1
        batch = order[at:at + take]
        at += take
        lengths = np.array([len(codes[i]) for i in batch])
        width = int(lengths.max())
        total = np.zeros((len(batch), width, TAGS), np.float32)
        weight = np.full((len(batch), width, 1), 1e-9, np.float32)
        place = [(r, s) for r, i in enumerate(batch) for s in _windows(len(codes[i]))]
        step = max(1, BATCH_CELLS // WINDOW)
        for k in range(0, len(place), step):
            some = place[k:k + step]
            cut = np.full((len(some), WINDOW), PAD, np.int64)
            for j, (r, s) in enumerate(some):
                piece = codes[batch[r]][s:s + WINDOW]
                cut[j, :len(piece)] = piece
            got = model.scores(cut)
            for j, (r, s) in enumerate(some):
                n = min(WINDOW, int(lengths[r]) - s)
                c = _CENTRE[:n, None].astype(np.float32)
                total[r, s:s + n] += got[j, :n] * c
                weight[r, s:s + n] += c
        tags, marginal = model.crf(total / weight, lengths)
        for r, p0 in zip(*np.nonzero((tags % 2 == 1))):
            kind = (int(tags[r, p0]) - 1) // 2
            e = int(p0) + 1
            while e < lengths[r] and tags[r, e] == 2 + 2 * kind:
                e += 1
            path = marginal[r, np.arange(p0, e), tags[r, p0:e]]
            out[batch[r]].append((kind, int(p0), e, float(path.mean())))
    return out


def _shaped(kind: int, value: str) -> bool:
    digits = sum("0" <= c <= "9" for c in value)
    if kind == 0:
        left, at, right = value.partition("@")
        return bool(left and at and right) and not re.search(r"\s", value)
    if kind == 1:
        parts = re.split(r"[^0-9]+", value)
        return len(parts) == 4 and all(p and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 13 <= digits <= 19 and re.fullmatch(r"[0-9 -]+", value) is not None
    return 8 <= digits <= 15 and re.fullmatch(r"[+0-9 ().-]+", value) is not None


def _whole_token(text: str, s: int, e: int) -> bool:
    return (s == 0 or not text[s - 1].isalnum()) and (e == len(text) or not text[e].isalnum())


def find_batch(texts: list[str], model: Tagger | None) -> list[tuple[list, list]]:
    """Per text (pattern spans, added spans), each [(kind, start, end)]."""
    found = [pattern_spans(t)[0] for t in texts]
    added: list[list] = [[] for _ in texts]
    if model is not None:
        where = [(i, s, e) for i, t in enumerate(texts) for s, e in regions(t)]
        for (i, s0, _), spans in zip(where, tag_regions(model, [_codes(texts[i][s:e]) for i, s, e in where])):
            for kind, s, e, sure in spans:
                s, e = s0 + s, s0 + e
                if sure >= MIN_CONFIDENCE and _whole_token(texts[i], s, e) and _shaped(kind, texts[i][s:e]) \
                        and not any(b < e and s < c for _, b, c in found[i]):
                    added[i].append((kind, s, e))
    return list(zip(found, added))


def span_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each span (overlapping ones as one) becomes its kind in brackets."""
    merged: list[list[int]] = []
    for s, e, k in sorted((s, e, k) for k, s, e in spans):
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e, k])
    out, at = [], 0
    for s, e, k in merged:
        out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = e
    return "".join(out) + text[at:]


# ------------------------------------------------------------------ on Spark
def snippets(documents: DataFrame, limit: int = SNIPPETS) -> list[str]:
    """At most ``limit`` distinct snippets around digits and @, by hash. The
    last, possibly cut token of a snippet goes."""
    around = F.regexp_extract_all(F.col("text"), F.lit(r"[^\n]{0,40}[0-9@][^\n]{0,40}"), F.lit(0))
    got = (documents.select(F.explode(around).alias("s")).distinct()
           .withColumn("o", F.xxhash64("s")).orderBy("o", "s").limit(limit).select("s").collect())
    cut = [r["s"].rsplit(" ", 1)[0] for r in got]
    return [s for s in cut if s]


def fit(documents: DataFrame, limit: int = SNIPPETS) -> Tagger | None:
    labelled = []
    for s in snippets(documents.where(F.regexp_like("text", F.lit("[0-9@]"))), limit):
        spans, failed = pattern_spans(s)
        taken: list = []
        for k, a, b in spans:  # a character has one label
            if not any(a < y and x < b for _, x, y in taken):
                taken.append((k, a, b))
        if not failed:
            labelled.append((s, taken))
    return train(labelled)


def _with_found(documents: DataFrame, schema: T.StructType, make) -> DataFrame:
    with_package(documents.sparkSession)
    model = fit(documents.select("text"))
    weights = model.w if model is not None else None

    def run(batches):
        tagger = Tagger(weights) if weights is not None else None
        for b in batches:
            texts = [x.as_py() for x in b.column("text")]
            found = find_batch([t or "" for t in texts], tagger)
            yield pa.RecordBatch.from_arrays(make(b, texts, found), names=schema.names)

    return documents.mapInArrow(run, schema)


def scan_documents(documents: DataFrame) -> DataFrame:
    """Digest rows of ``op5_pii``."""
    docs = documents.select("doc_id", "text")
    fields = [docs.schema["doc_id"]] + [T.StructField(f"n_{k}", T.LongType()) for k in KINDS] + \
        [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]

    def make(b, texts, found):
        counts = [[sum(k == i for k, _, _ in base) for i in range(len(KINDS))] for base, _ in found]
        return [b.column("doc_id"), *(pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS))),
                pa.array([hashlib.sha256(span_text(base).encode()).hexdigest() for base, _ in found], pa.string()),
                pa.array([span_text(base + more) for base, more in found], pa.string())]

    return _with_found(docs, T.StructType(fields), make)


def redact_documents(documents: DataFrame) -> DataFrame:
    """``documents`` with personal data replaced; ``n_chars``, where there is
    one, follows the new text. Null texts stay null."""
    names = documents.columns

    def make(b, texts, found):
        new = [None if t is None else redact(t, base + more) for t, (base, more) in zip(texts, found)]
        out = {"text": pa.array(new, pa.string())}
        if "n_chars" in names:
            kind = b.column("n_chars").type
            out["n_chars"] = pa.array(
                [n.as_py() if t is None or n.as_py() is None or (t2 == t) else len(t2)
                 for n, t, t2 in zip(b.column("n_chars"), texts, new)], kind)
        return [out.get(c, b.column(c)) for c in names]

    return _with_found(documents, documents.schema, make)
