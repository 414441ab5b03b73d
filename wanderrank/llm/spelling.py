"""Spelling variant grouping: words one edit apart, found by a trie over letter
counts, and each word led to its most frequent form.

1. Texts are read once. A run's deletion depends only on document and run, so
   runs are counted per document first; a task keeps a bounded dictionary.
2. A word's frequency vector holds its counts of letters by group. An edit of
   one code point changes it by a surplus of at most one and a deficit of at
   most one. Words are arranged by successive counts: first of ``TOP`` broad
   groups, then of single letters (``SINGLE``), as a trie.
3. The broad counts name a shard. A word stays in its own, and visits the shards
   that a surplus of one, or a surplus and a deficit, leads to, always towards
   the larger counts, so two shards meet once. Shards of over ``SHARD`` words
   are split by a hash of the word; visitors come to every part.
4. In a task the shard's words are a trie of sorted vectors. A depth-first search
   carries a batch of words down at once, spending what is left of each word's
   budget. Where few pairs are left under a node, or the counts are used up, the
   words under it are verified: equal but for one code point.
5. Per task only a word's number of near words and its best form leave; they are
   added up, and forms are followed by doubling.

Memory of a task: one part of a shard, one Arrow batch of visitors, and pairs in
chunks of ``PAIRS``.

Defined results: a null text has no words; a null id counts as an empty id;
empty and very long texts, repeated rows and ties (smallest form in code-point
order) follow the rules as they stand; a word with nothing near has n_near 0 and
is its own root; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanderrank.llm.common import broadcast_if_small, materialise, shuffle_partitions, trim_memory, with_package

MIN_LENGTH = 7
MIN_COUNT = 2
FORM_TIMES = 10
DELETE_ONE_IN = 31
HELD = 100_000        # words in a task's dictionary before it is handed on
SHARD = 20_000        # words of a shard part
PAIRS = 200_000       # pairs compared at once
LEAF = 32_768         # pairs under a node that are compared instead of searched

# broad groups of about equal weight in European text; anything else counts to
# the last one. The trie goes on with single letters, the rest by code point.
TOP = ["eaäàâèéêëáåæ", "nrsdtßñx", "ioulyóòôöõøúùûüíìîï", "cmhpgbfvkwqjzç"]
SINGLE = "entaiohrsulcdfgbmpvwykqxzj"
REST = 6
LETTERS = len(SINGLE) + REST
_GROUP = np.array([SINGLE.find(chr(c)) if chr(c) in SINGLE else len(SINGLE) + c % REST for c in range(256)])

_RUN = re.compile("[A-Za-zÀ-ÿ]+")


# -------------------------------------------------------------------- the words
def document_runs(doc_id, text: str) -> Counter:
    """Runs of one text after lower-casing A-Z and the deletions."""
    start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    out: Counter = Counter()
    for run, k in Counter(_RUN.findall(text.encode().lower().decode())).items():  # bytes: A-Z only
        h = zlib.crc32(run.encode(), start)
        if h % DELETE_ONE_IN == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= MIN_LENGTH:
            out[run] += k
    return out


def word_counts(documents: DataFrame) -> DataFrame:
    """word, n of the words that count (long enough, often enough)."""

    def run(batches):
        def out(counts):
            return pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.string()),
                                               pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        counts: Counter = Counter()
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()  # one text at a time
                if text:
                    counts.update(document_runs(doc_id, text))
                    if len(counts) >= HELD:
                        yield out(counts)
                        counts = Counter()
        yield out(counts)
        del counts
        trim_memory()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.length("text") >= MIN_LENGTH)
    return (rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= MIN_COUNT))


# ------------------------------------------------------------------------ shards
def broad_counts(word: Column) -> list[Column]:
    """Code points of the word in each group of ``TOP``; the last one takes the rest."""
    low = F.lower(word)
    counts = [F.length(low) - F.length(F.translate(low, g, "")) for g in TOP[:-1]]
    rest = F.length(low)
    for c in counts:
        rest = rest - c
    return [*counts, rest]


def _key(counts: list) -> Column:
    """Counts as one long; words of over 2^15 letters in a group share keys, which
    costs time only."""
    key = F.lit(0).cast("long")
    for c in counts:
        key = key * 32768 + F.least(c, F.lit(32767)).cast("long")
    return key


def shards(words: DataFrame) -> tuple[DataFrame, int]:
    """(shard, parts) of the shards that hold words, and their number."""
    sizes = words.groupBy("shard").agg(F.count(F.lit(1)).alias("k"))
    sizes = materialise(sizes.select("shard", F.ceil(F.col("k") / SHARD).cast("int").alias("parts")), "shards")
    return sizes, sizes.count()


def dealt(words: DataFrame) -> DataFrame:
    """Every word in its shard's part (home) and in all parts it visits. ``deficit``:
    whether the words there may have less of some letter, not only more."""
    keyed = words.select("word", "n", *[c.alias(f"c{i}") for i, c in enumerate(broad_counts(F.col("word")))])
    cs = [F.col(f"c{i}") for i in range(len(TOP))]
    keyed = materialise(keyed.select("word", "n", *cs, _key(cs).alias("shard"), F.xxhash64("word").alias("h")), "words")
    sizes, n_shards = shards(keyed)

    def moved(up: int, down: int | None):
        return _key([c + (1 if i == up else 0) - (1 if i == down else 0) for i, c in enumerate(cs)])

    def step(to, deficit, same=False):
        return F.struct(to.alias("to"), F.lit(deficit).alias("deficit"), F.lit(same).alias("same"))

    steps = [step(F.col("shard"), 1, True)]
    for g in range(len(TOP)):
        steps.append(step(moved(g, None), 0))
        steps += [F.when(F.col(f"c{h}") > 0, step(moved(g, h), 1)) for h in range(g + 1, len(TOP))]
    ways = keyed.select("word", "n", "h", F.explode(F.array_compact(F.array(*steps))).alias("e")).select("word", "n", "h", "e.*")
    at = broadcast_if_small(sizes.withColumnRenamed("shard", "to"), n_shards)
    met = ways.join(at, "to")
    own = F.pmod(F.col("h"), F.col("parts")).cast("int")
    # in its own shard a word visits the later parts; elsewhere all of them
    visits = F.sequence(F.when(F.col("same"), own).otherwise(F.lit(0)), F.col("parts") - 1)
    out = met.select("to", "word", "n", F.explode(visits).alias("part"), "deficit", "same", own.alias("own"))
    parts = shuffle_partitions(words.sparkSession)
    home = F.col("same") & (F.col("part") == F.col("own"))
    return (out.select("to", "part", F.when(home, 1).otherwise(0).alias("home"), "deficit", "word", "n")
            .repartition(parts, "to", "part").sortWithinPartitions("to", "part", F.desc("home")))


# -------------------------------------------------------------------- comparison
class Words:
    """Words as code points in rows of equal width, and their counts by group."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.text, self.n = words, n
        self.length = np.array([len(w) for w in words], dtype=np.int32)
        width = int(self.length.max(initial=1)) + 1
        flat = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
        self.code = np.zeros((len(words), width), dtype=np.uint8)
        self.code[np.arange(width)[None, :] < self.length[:, None]] = flat
        row = np.repeat(np.arange(len(words)) * LETTERS, self.length)
        counts = np.bincount(row + _GROUP[flat], minlength=len(words) * LETTERS)
        self.vector = counts.astype(np.int16).reshape(len(words), LETTERS)
        self.weight = self.vector.astype(np.float32)
        self.norm = (self.weight ** 2).sum(axis=1)
        self._rank = None

    def take(self, order: np.ndarray) -> Words:
        out = object.__new__(Words)
        out.text, out._rank = [self.text[i] for i in order], None
        for k in ("n", "length", "code", "vector", "weight", "norm"):
            setattr(out, k, getattr(self, k)[order])
        return out

    def __len__(self):
        return len(self.text)

    @property
    def rank(self) -> np.ndarray:
        """Place of each word in code-point order."""
        if self._rank is None:
            order = np.argsort(np.ascontiguousarray(self.code).view(f"S{self.code.shape[1]}")[:, 0], kind="stable")
            self._rank = np.empty(len(order), dtype=np.int64)
            self._rank[order] = np.arange(len(order))
        return self._rank


def one_edit(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Which pairs (a[i], b[j]) differ by exactly one code point inserted,
    deleted or replaced."""
    la, lb = a.length[i], b.length[j]
    out = np.zeros(len(i), dtype=bool)
    width = min(a.code.shape[1], b.code.shape[1])
    same = np.flatnonzero(la == lb)
    if len(same):
        x, y = a.code[i[same], :width], b.code[j[same], :width]
        out[same] = (x != y).sum(axis=1) == 1
    for left, li, right, ri, more in ((a, i, b, j, 1), (b, j, a, i, -1)):  # left is the shorter one
        rows = np.flatnonzero(lb - la == more)
        if len(rows) == 0:
            continue
        width = min(left.code.shape[1], right.code.shape[1] - 1)
        x = left.code[li[rows], :width]
        y = right.code[ri[rows], :width + 1]
        wide = np.arange(width)[None, :]
        used = wide < left.length[li[rows], None]
        differs = np.where(used, x != y[:, :-1], True)
        first = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
        late = np.where(used & (wide >= first[:, None]), x != y[:, 1:], False)
        out[rows] = ~late.any(axis=1)
    return out


def near_vectors(a: Words, rows: np.ndarray, b: Words, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a[i], b[j]), i of ``rows`` and j of lo..hi, whose counts differ by at
    most two in squares: by one more, one less, or both."""
    x, y = a.weight[rows], b.weight[lo:hi]
    d = a.norm[rows, None] + b.norm[None, lo:hi] - 2 * (x @ y.T)  # whole numbers below 2^24: exact
    i, j = np.nonzero(d < 2.5)
    return rows[i], j + lo


# ------------------------------------------------------------- depth-first search
class Trie:
    """Words in order of their vectors: a node is a range with equal first counts."""

    def __init__(self, words: Words):
        self.words = words.take(np.lexsort(words.vector.T[::-1]))

    def search(self, batch: Words, deficit: np.ndarray):
        """Yield (i, j): batch word i and trie word j one edit apart. A trie word
        may have one letter more, and one less where ``deficit`` is 1."""
        trie, vectors = self.words, self.words.vector
        held_i: list[np.ndarray] = []
        held_j: list[np.ndarray] = []
        size = 0

        def verified():
            i, j = np.concatenate(held_i), np.concatenate(held_j)
            ok = one_edit(batch, i, trie, j)
            return i[ok], j[ok]

        todo = [(0, 0, len(trie), np.arange(len(batch)), np.ones(len(batch), dtype=np.int16), deficit.astype(np.int16))]
        while todo:
            level, lo, hi, rows, up, down = todo.pop()
            if level == LETTERS or len(rows) * (hi - lo) <= LEAF:
                step = max(1, PAIRS // (hi - lo))
                for at in range(0, len(rows), step):
                    i, j = near_vectors(batch, rows[at:at + step], trie, lo, hi)
                    held_i.append(i)
                    held_j.append(j)
                    size += len(i)
                    if size >= PAIRS:
                        yield verified()
                        held_i, held_j, size = [], [], 0
                continue
            column = vectors[lo:hi, level]
            cuts = np.concatenate(([0], np.flatnonzero(column[1:] != column[:-1]) + 1, [hi - lo]))
            have = batch.vector[rows, level]
            for a, b in zip(cuts[:-1], cuts[1:]):
                more = column[a] - have  # the trie word has so many more
                go = np.flatnonzero((more <= up) & (-more <= down))
                if len(go):
                    spent = more[go]
                    todo.append((level + 1, lo + a, lo + b, rows[go], up[go] - np.maximum(spent, 0), down[go] - np.maximum(-spent, 0)))
        if size:
            yield verified()


class Best:
    """Per word of a list: near words so far and the best form among them."""

    def __init__(self, words: Words):
        self.words, k = words, len(words)
        self.near, self.n, self.form = np.zeros(k, np.int64), np.zeros(k, np.int64), [None] * k

    def add(self, i: np.ndarray, j: np.ndarray, other: Words) -> None:
        """Pairs of own words i and near words j of ``other``."""
        if len(i) == 0:
            return
        self.near += np.bincount(i, minlength=len(self.near))
        order = np.lexsort((other.rank[j], -other.n[j], i))
        i, j = i[order], j[order]
        one = np.r_[True, i[1:] != i[:-1]]
        i, j = i[one], j[one]
        for x, y in zip(i[other.n[j] >= self.n[i]], j[other.n[j] >= self.n[i]]):
            if other.n[y] > self.n[x] or other.text[y] < self.form[x]:
                self.n[x], self.form[x] = other.n[y], other.text[y]

    def rows(self) -> pa.RecordBatch:
        there = np.flatnonzero(self.near)
        return pa.RecordBatch.from_arrays(
            [pa.array([self.words.text[k] for k in there], pa.string()), pa.array(self.near[there]),
             pa.array(self.n[there]), pa.array([self.form[k] for k in there], pa.string())],
            names=["word", "n_near", "form_n", "form"])


def _search_stream(batches):
    """Rows (to, part, home, deficit, word, n), home rows of a part first."""
    trie = best = None
    at = None
    own: list[pa.RecordBatch] = []

    def words(rows) -> Words:
        return Words(rows.column("word").to_pylist(), rows.column("n").to_numpy().astype(np.int64))

    def build():
        nonlocal trie, best
        table = pa.Table.from_batches(own)
        trie = Trie(words(table))
        best = Best(trie.words)
        # the shard with itself: each pair is met from both sides
        for step in range(0, len(trie.words), 2_048):
            some = np.arange(step, min(step + 2_048, len(trie.words)))
            batch = trie.words.take(some)
            for i, j in trie.search(batch, np.ones(len(some), dtype=np.int16)):
                best.add(some[i], j, trie.words)

    for b in batches:
        b = b if b.num_rows else None
        if b is None:
            continue
        to, part, home = (b.column(c).to_numpy(zero_copy_only=False) for c in ("to", "part", "home"))
        cut = np.r_[0, np.flatnonzero((to[1:] != to[:-1]) | (part[1:] != part[:-1]) | (home[1:] != home[:-1])) + 1, len(to)]
        for x, y in zip(cut[:-1], cut[1:]):
            key = (to[x], part[x])
            if key != at:
                if own and trie is None:
                    build()
                if best is not None:
                    yield best.rows()
                at, own, trie, best = key, [], None, None
            rows = b.slice(x, y - x)
            if home[x]:
                own.append(rows)
                continue
            if not own:  # the words of this part are all elsewhere
                continue
            if trie is None:
                build()
            visitors = words(rows)
            guest = Best(visitors)
            for i, j in trie.search(visitors, rows.column("deficit").to_numpy()):
                guest.add(i, j, trie.words)
                best.add(j, i, visitors)
            yield guest.rows()
    if own and trie is None:
        build()
    if best is not None:
        yield best.rows()
    trim_memory()


# ---------------------------------------------------------------------- operator
def near_words(words: DataFrame) -> DataFrame:
    """words (word, n) -> word, n_near, form_n, form: the most frequent near word
    (ties: smallest), for words that have near ones."""
    found = materialise(dealt(words).mapInArrow(_search_stream, "word string, n_near long, form_n long, form string"), "near")
    best = F.min(F.struct((-F.col("form_n")).alias("m"), F.col("form")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")) \
        .select("word", "n_near", (-F.col("b.m")).alias("form_n"), F.col("b.form").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """forms (word, form) -> word, root by doubling; a form has at least ten times
    its word's n, so chains are short and end."""
    forms = materialise(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        n = forms.count()
        on = broadcast_if_small(forms.select(F.col("word").alias("_w"), F.col("root").alias("_r")), n)
        forms = materialise(forms.join(on, F.col("root") == F.col("_w"), "left")
                            .select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")), "forms")
        if forms.where("moved").isEmpty():
            return forms.select("word", "root")


def group_variants(words: DataFrame, times: int = FORM_TIMES) -> DataFrame:
    """words (word, n; each once) -> word, form, root, n, n_near, form_n."""
    with_package(words.sparkSession)
    words = materialise(words.select("word", "n"), "vocabulary")
    near = words.join(near_words(words), "word", "left")
    near = materialise(near.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        *[F.when(F.col("form_n") >= times * F.col("n"), F.col(c)).alias(c) for c in ("form", "form_n")]), "variants")
    root = roots(near.where("form is not null")).select(F.col("word").alias("_w"), F.col("root").alias("_root"))
    return near.join(root, F.col("word") == F.col("_w"), "left").select(
        "word", "form", F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(documents: DataFrame) -> DataFrame:
    """Digest rows of ``op13_spelling_variants``."""
    with_package(documents.sparkSession)
    return group_variants(word_counts(documents))
