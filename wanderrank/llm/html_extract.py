"""Main text of web pages by a tree-structured graphical model.

The page becomes a tree: block elements are inner nodes, runs of text are
leaves. Every node has a hidden label (content or not), a unary potential (a
logistic model over tag, class words, text length, link share, punctuation) and
a potential with its parent's label. Sum-product messages go up to the root
and down again; a leaf whose content marginal is above one half is kept.

Both potentials are trained from labelled pages, ``fit_pages`` of (html, set of
content leaf numbers) at most ``PAGES`` of them (documented bound). The query
labels a sample of its own pages by their semantic markup (leaves inside
``article`` or ``main`` but not inside navigation, header, footer, aside, form
or comment parts) and adds to each a variant without semantic tags: renamed to
``div`` with a class word, with sidebars, notices, forms and reader comments
put in, so that the model also learns class words, lengths and link shares.

Text: character references are decoded, white space inside a block (``br``
included) becomes one space, blocks are joined by one newline in page order.

Defined results: a null, empty or text-free page gives an empty text; unclosed
tags and comments end with the page; markup of any length is read whole; with
no labelled page the semantic labels themselves are the extraction.
"""

from __future__ import annotations

import html as html_lib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanderrank.llm.common import with_package

PAGES = 120
SEED = 5

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")

# HTML element groups (fixed by the language).
_RAW = ("script", "style", "textarea", "noscript", "template", "iframe", "svg", "title", "select")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter "
                    "output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
_CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
                      "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
             "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = frozenset("ul ol table dl html".split())

# What semantic markup says; used to label training pages.
_INSIDE, _OUTSIDE = ("article", "main"), ("nav", "header", "footer", "aside", "form", "menu", "dialog")
_BOILER = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager tabs".split(),
    "edge": "header footer masthead topbar copyright legal colophon".split(),
    "side": "sidebar aside widget related recommended trending tags".split(),
    "ads": "ad ads advert advertisement banner promo sponsor sponsored".split(),
    "notice": "cookie consent notice alert popup modal overlay newsletter subscribe gdpr".split(),
    "social": "comment comments reply replies share social discussion disqus".split(),
    "form": "form search login signup register".split(),
}
_CONTENT = "article content post entry story main body text page".split()
_TAGS = ("article main section div p h1 h2 h3 h4 h5 h6 nav ul ol li header footer aside form table td figure "
         "blockquote pre body html menu dialog").split()
_LEXICON = {w: i for i, ws in enumerate(_BOILER.values()) for w in ws}
_TAG_AT = {t: i for i, t in enumerate(_TAGS)}
_N_LEX = len(_BOILER) + 1
_REAL = 7
_ABOVE = ("article", "main", "nav", "header", "footer", "aside", "form")
_ABOVE_AT = {t: _N_LEX + i for i, t in enumerate(_ABOVE)}
_N_ABOVE = _N_LEX + len(_ABOVE)
DIM = 1 + len(_TAGS) + 1 + _N_LEX + 1 + len(_TAGS) + _REAL + _N_ABOVE


class Page:
    """Nodes in page order (a parent before its children): ``parent``, ``tag``
    ('' for a text leaf), ``lex`` (class word groups), ``text`` of leaves and
    ``link`` characters."""

    def __init__(self):
        self.parent, self.tag, self.lex, self.text, self.link = [], [], [], [], []

    def add(self, parent: int, tag: str, lex: tuple, text: str = "", link: int = 0) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.lex.append(lex)
        self.text.append(text)
        self.link.append(link)
        return len(self.tag) - 1

    def leaves(self) -> list[int]:
        return [i for i, t in enumerate(self.tag) if not t]


def _groups(attrs: str) -> tuple:
    if not attrs or "=" not in attrs:
        return ()
    out = set()
    for m in _NAMES.finditer(attrs):
        for w in _WORD.findall((m[1] or m[2] or m[3] or "").lower()):
            if w in _LEXICON:
                out.add(_LEXICON[w])
            elif w in _CONTENT:
                out.add(_N_LEX - 1)
    return tuple(sorted(out))


def parse(source: str) -> Page:
    page = Page()
    stack = [page.add(-1, "html", ())]
    buffer: list[str] = []
    state = {"link": 0, "in_a": False}

    def flush():
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                page.add(stack[-1], "", (), text, min(state["link"], len(text)))
            buffer.clear()
        state["link"] = 0

    def close_to(depth: int):
        flush()
        del stack[depth:]
        state["in_a"] = False

    def words(s: str):
        if s:
            s = html_lib.unescape(s) if "&" in s else s
            buffer.append(s)
            if state["in_a"]:
                state["link"] += len(s.strip())

    at, n = 0, len(source)
    in_head = False
    while at < n:
        lt = source.find("<", at)
        if lt < 0:
            if not in_head:
                words(source[at:])
            break
        m = _TAG.match(source, lt)
        if not in_head:
            words(source[at:lt] if m else source[at:lt + 1])
        if not m:
            at = lt + 1
            continue
        at = m.end()
        end, start = m[1], m[2] or m[4]
        if start:
            tag = start.lower()
            attrs = m[3] if m[2] else m[5]
            if tag in _RAW:
                closing = re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.I).search(source, at)
                at = closing.end() if closing else n
                continue
            if tag == "head":
                in_head = True
            elif tag in ("html", "meta", "link", "base"):
                pass
            elif tag == "body":
                in_head = False
                flush()
                if len(stack) == 1:
                    stack.append(page.add(stack[-1], "body", _groups(attrs)))
            elif tag == "br":
                buffer.append(" ")
            elif tag in _INLINE:
                if tag == "a":
                    state["in_a"] = True
            else:
                if in_head:
                    in_head = False
                flush()
                if tag in _CLOSES_P:
                    for d in range(len(stack) - 1, 0, -1):
                        if page.tag[stack[d]] == "p":
                            close_to(d)
                            break
                        if page.tag[stack[d]] in _CLOSES_P:
                            break
                for sibling in _SIBLINGS.get(tag, ()):
                    for d in range(len(stack) - 1, 0, -1):
                        if page.tag[stack[d]] == sibling:
                            close_to(d)
                            break
                        if page.tag[stack[d]] in _SCOPE:
                            break
                if tag not in _VOID and not (attrs or "").rstrip().endswith("/"):
                    state["in_a"] = False
                    stack.append(page.add(stack[-1], tag, _groups(attrs)))
        elif end:
            tag = end.lower()
            if tag == "head":
                in_head = False
            elif tag == "a":
                state["in_a"] = False
            elif tag in _INLINE or tag == "html":
                pass
            else:
                for d in range(len(stack) - 1, 0, -1):
                    if page.tag[stack[d]] == tag:
                        close_to(d)
                        break
    flush()
    return page


# ------------------------------------------------------------------ potentials
def features(page: Page) -> np.ndarray:
    """[nodes x DIM]: indicator and length features, own tag, class words of
    the node and of the elements above it, and for leaves the parent's tag."""
    n = len(page.tag)
    chars, links, blocks, stops = [0] * n, [0] * n, [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        if not page.tag[i]:
            t = page.text[i]
            chars[i], links[i], blocks[i] = len(t), page.link[i], 1
            stops[i] = t.count(". ") + t.count(", ") + t.endswith((".", "!", "?"))
        p = page.parent[i]
        if p >= 0:
            chars[p] += chars[i]
            links[p] += links[i]
            blocks[p] += blocks[i]
            stops[p] += stops[i]
    out = np.zeros((n, DIM), np.float32)
    out[:, 0] = 1
    t0 = 1
    l0 = t0 + len(_TAGS) + 1
    p0 = l0 + _N_LEX + 1
    r0 = p0 + len(_TAGS)
    a0 = r0 + _REAL
    other = len(_TAGS)
    above: list[frozenset] = []
    for i in range(n):
        q = page.parent[i]
        seen = above[q] if q >= 0 else frozenset()
        own = [a0 + g for g in page.lex[i]]
        if page.tag[i] in _ABOVE_AT:
            own.append(a0 + _ABOVE_AT[page.tag[i]])
        above.append(seen.union(own) if own else seen)
        if seen:
            out[i, list(seen)] = 1
        leaf = not page.tag[i]
        row = out[i]
        if leaf:
            q = page.tag[page.parent[i]]
            if q in _TAG_AT:
                row[p0 + _TAG_AT[q]] = 1
            row[l0 + _N_LEX] = 1
        else:
            row[t0 + _TAG_AT.get(page.tag[i], other)] = 1
        for g in page.lex[i]:
            row[l0 + g] = 1
    c = np.array(chars, np.float32)
    total = max(1.0, float(c[0]))
    b = np.maximum(1, np.array(blocks, np.float32))
    out[:, r0] = np.log1p(c) / 8
    out[:, r0 + 1] = np.array(links, np.float32) / np.maximum(1, c)
    out[:, r0 + 2] = np.minimum(1, np.array(stops, np.float32) * 25 / np.maximum(25, c))
    out[:, r0 + 3] = np.log1p(c / b) / 8
    out[:, r0 + 4] = c / total
    out[:, r0 + 5] = np.log1p(b) / 5
    out[:, r0 + 6] = c == 0
    return out


def node_labels(page: Page, content: set[int]) -> np.ndarray:
    """A leaf's label is given; an element is content if most of its text is."""
    n = len(page.tag)
    good, every = [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        if not page.tag[i]:
            every[i] = len(page.text[i])
            good[i] = every[i] if i in content else 0
        if page.parent[i] >= 0:
            every[page.parent[i]] += every[i]
            good[page.parent[i]] += good[i]
    return np.array([2 * g > e for g, e in zip(good, every)], dtype=bool)


class TreeModel:
    """``w``: unary log-odds weights. ``pair``: 2 x 2 log potentials
    [parent label, child label] by ``edge_kinds``."""

    def __init__(self, w: np.ndarray, pair: np.ndarray):
        self.w, self.pair = w, pair

    def marginals(self, page: Page, feats: np.ndarray | None = None) -> np.ndarray:
        """P(content) of every node, by one upward and one downward pass."""
        unary = (features(page) if feats is None else feats) @ self.w
        return sum_product(page.parent, edge_kinds(page), unary, self.pair)


def edge_kinds(page: Page) -> list[int]:
    """Which pairwise potential joins a node to its parent: 0 below the page's
    root, 1 between other elements, 2 for a leaf."""
    top = ("html", "body")
    return [2 if not t else 0 if p < 0 or page.tag[p] in top else 1 for t, p in zip(page.tag, page.parent)]


def sum_product(parent: list[int], kind: list[int], unary: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Exact marginals of a binary tree field. ``unary`` is the log-odds of
    label 1; messages are log-odds too. ``parent[i] < i``; ``pair[kind[i]]``
    joins i to its parent."""
    n = len(parent)
    u = unary.tolist()
    tables = [tuple(t.ravel().tolist()) for t in pair]
    up_in = list(u)       # unary plus messages from children
    up_out = [0.0] * n    # message to the parent

    def log_add(x: float, y: float) -> float:
        return max(x, y) + math.log1p(math.exp(-abs(x - y)))

    for i in range(n - 1, 0, -1):
        x = up_in[i]
        t00, t01, t10, t11 = tables[kind[i]]
        m = log_add(t10, t11 + x) - log_add(t00, t01 + x)
        up_out[i] = m
        up_in[parent[i]] += m
    full = list(up_in)    # all evidence, as log-odds
    for i in range(1, n):
        y = full[parent[i]] - up_out[i]  # the parent without this branch
        t00, t01, t10, t11 = tables[kind[i]]
        full[i] += log_add(t01, t11 + y) - log_add(t00, t10 + y)
    return 1.0 / (1.0 + np.exp(-np.clip(full, -60, 60)))


def fit_pages(labelled: list[tuple[str, set[int]]], steps: int = 300) -> TreeModel | None:
    """Unary weights by logistic regression (full-batch Adam, L2), pairwise
    potentials as smoothed log ratios of P(child | parent) to P(child)."""
    xs, ys = [], []
    pair = np.ones((3, 2, 2))
    for source, content in labelled:
        page = parse(source)
        label = node_labels(page, content)
        xs.append(features(page))
        ys.append(label)
        kinds = edge_kinds(page)
        for i in range(1, len(label)):
            pair[kinds[i], int(label[page.parent[i]]), int(label[i])] += 1
    if not xs:
        return None
    x, y = np.concatenate(xs), np.concatenate(ys).astype(np.float32)
    if y.min() == y.max():
        return None
    w = np.zeros(DIM, np.float64)
    m, v = np.zeros(DIM), np.zeros(DIM)
    for k in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) / len(y) + 1e-4 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-8)
    given = pair / pair.sum(axis=2, keepdims=True)
    prior = pair.sum(axis=1, keepdims=True) / pair.sum(axis=(1, 2), keepdims=True)
    return TreeModel(w, np.log(given) - np.log(prior))


# -------------------------------------------------------------- labelled pages
def semantic_leaves(page: Page) -> set[int]:
    """Leaves that the page's own markup calls content."""
    side = set(_LEXICON.values())
    state: list[int] = []
    out = set()
    for i, tag in enumerate(page.tag):
        s = state[page.parent[i]] if i else 0
        if tag in _OUTSIDE or any(g in side for g in page.lex[i]):
            s = 2
        elif tag in _INSIDE and s == 0:
            s = 1
        state.append(s)
        if not tag and s == 1:
            out.add(i)
    return out


def plain_variant(source: str, seed: int) -> tuple[str, set[int]] | None:
    """The page without semantic tags, other parts put in, and its labels."""
    page = parse(source)
    content = semantic_leaves(page)
    if not content:
        return None
    rng = np.random.default_rng([SEED, seed])
    pick = lambda group: _BOILER[group][int(rng.integers(len(_BOILER[group])))]
    esc = html_lib.escape
    leaves = page.leaves()
    spare = [page.text[i] for i in leaves if i not in content] or ["."]
    body = [page.text[i] for i in leaves if i in content]
    line = lambda: spare[int(rng.integers(len(spare)))]
    talk = lambda: body[int(rng.integers(len(body)))][:300]
    links = lambda k: "".join(f'<li><a href="#">{esc(line()[:30])}</a></li>' for _ in range(k))
    parts: list[tuple[str, list[bool]]] = []
    parts.append((f'<div class="{pick("edge")}"><a href="#">{esc(line()[:40])}</a></div>', [False]))
    k = int(rng.integers(3, 9))
    parts.append((f'<div id="{pick("menu")}"><ul>{links(k)}</ul></div>', [False] * k))
    if rng.random() < 0.6:
        parts.append((f'<div class="{pick("notice")}"><p>{esc(talk())}</p></div>', [False]))
    if rng.random() < 0.6:
        parts.append((f'<div class="{pick("ads")}">{esc(line())}</div>', [False]))
    word = _CONTENT[int(rng.integers(len(_CONTENT)))]
    outer = ("section", "div", "main", "article")[int(rng.integers(4))]
    parts.append((f'<{outer} class="{word}">' + f"<h1>{esc(body[0])}</h1>"
                  + "".join(f"<p>{esc(t)}</p>" for t in body[1:]) + f"</{outer}>", [True] * len(body)))
    if rng.random() < 0.7:
        parts.append((f'<div class="{pick("side")}"><h3>{esc(line()[:30])}</h3><ul>{links(3)}</ul></div>', [False] * 4))
    if rng.random() < 0.7:
        k = int(rng.integers(1, 5))
        parts.append((f'<div class="{pick("social")}">' + "".join(f"<p>{esc(talk())}</p>" for _ in range(k)) + "</div>",
                      [False] * k))
    if rng.random() < 0.4:
        parts.append((f'<form class="{pick("form")}"><label>{esc(line()[:20])}</label><input></form>', [False]))
    tag = ("footer", "div")[int(rng.integers(2))]
    parts.append((f'<{tag} class="{pick("edge")}"><p>{esc(line())}</p></{tag}>', [False]))
    out = "<html><body>" + "".join(p for p, _ in parts) + "</body></html>"
    flags = [f for _, fs in parts for f in fs]
    made = parse(out)
    numbers = made.leaves()
    if len(numbers) != len(flags):  # a text that vanished when decoded
        return None
    return out, {i for i, f in zip(numbers, flags) if f}


def labelled_pages(sources: list[str]) -> list[tuple[str, set[int]]]:
    out = []
    for k, source in enumerate(sources):
        content = semantic_leaves(parse(source))
        if content:
            out.append((source, content))
            out += [v for v in [plain_variant(source, k)] if v]
    return out


# ------------------------------------------------------------------ extraction
def extract(source: str | None, model: TreeModel | None) -> str:
    if not source:
        return ""
    page = parse(source)
    leaves = page.leaves()
    if not leaves:
        return ""
    if model is None:
        keep = semantic_leaves(page)
    else:
        p = model.marginals(page)
        keep = {i for i in leaves if p[i] > 0.5}
    return "\n".join(page.text[i] for i in leaves if i in keep)


def extract_pages(pages: DataFrame, limit: int = PAGES) -> DataFrame:
    """Digest rows of ``op8_html``."""
    with_package(pages.sparkSession)
    sample = (pages.where(F.char_length("html").between(1, 100_000)).select("html")
              .withColumn("o", F.xxhash64("html")).orderBy("o").limit(limit).select("html").collect())
    model = fit_pages(labelled_pages([r["html"] for r in sample]))
    rows = pages.select("page_id", "url", "html")
    schema = T.StructType([rows.schema["page_id"], rows.schema["url"],
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for b in batches:
            texts = [extract(x.as_py(), model) for x in b.column("html")]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return rows.mapInArrow(run, schema)
