"""MinHash near-duplicates: fast similarity sketches, banding, exact verification.

1. Sets of ``WIDTH``-word shingles; equal sets are one class and take part once.
2. Sketch of ``T`` coordinates per set. In round i every element falls into the
   bin that its i-th hash names, with the value (i, rest of the hash); a
   coordinate is the least value of its bin, so only empty bins are open to later
   rounds. After ``T`` rounds, round T + k puts every element into bin k: each
   coordinate fills. Two sets agree in a coordinate with probability J, and the
   share of equal coordinates is concentrated like that of independent ones,
   though most sets need only a few passes.
3. Bands of ``ROWS`` coordinates. Sets of J = 0.85 share none of the 42 bands
   with probability 2e-9 (J = 0.9: 1e-14).
4. Bands are dealt by value and read in order, so a band's list is met as a
   stream. Lists of up to ``LIST`` classes give their pairs (sizes within reach).
   Members of longer lists are first compared with the list's first members. Long
   lists that still hold many pairs of different components go through further
   rounds of stars. What is left is compared in families of lists that share a
   component: squares of members, whose sets meet in one task and of which only
   links leave it (``links.settle``).
5. Every candidate is verified on whole sets.

Defined results: a null or word-free text has an empty set, links with nothing
and is its own component; fewer than three words are one shingle; null ids do
not count for the smallest id (all null: null, and such rows are kept); repeated
rows are one class, each row keeps its id's verdict; very long texts are hashed
whole, a block at a time; an empty table gives no rows; other columns are not
read, so their names may clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanderrank.llm import links as L
from wanderrank.llm.common import broadcast_if_small, materialise, release, shuffle_partitions, trim_memory, with_package
from wanderrank.llm.components import components
from wanderrank.llm.shingles import int_lists, shingle_sets

WIDTH = 3
SIMILAR = 85
T = 256              # coordinates, a power of two
ROWS = 6             # coordinates of a band
BANDS = T // ROWS
LIST = 4             # longest band list that is paired at once
FIRST = 2            # members of a longer list that all others meet in the first round
BLOCK = 200_000      # elements sketched at once

_U = np.uint64
_BITS = T.bit_length() - 1
_seeds = np.random.Generator(np.random.PCG64(77_003)).integers(0, 1 << 63, 2 * T, dtype=np.uint64) * _U(2) + _U(1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0x7FB5D329728EA185)
    h = (h ^ (h >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return h ^ (h >> _U(33))


# ---------------------------------------------------------------------- sketches
def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """(len(sets), T) uint64; a row of an empty set is all ones."""
    full = np.iinfo(np.uint64).max
    out = np.full((len(sets), T), full, dtype=np.uint64)
    at = 0
    while at < len(sets):  # sets up to the block size, one large set at least
        end, total = at + 1, len(sets[at])
        while end < len(sets) and total + len(sets[end]) <= BLOCK:
            total += len(sets[end])
            end += 1
        out[at:end] = _block(sets[at:end], full)
        at = end
    return out


def _block(sets: list[np.ndarray], full: int) -> np.ndarray:
    out = np.full(len(sets) * T, full, dtype=np.uint64)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    row = np.repeat(np.arange(len(sets), dtype=np.int64), size)
    x = np.concatenate(sets).view(np.uint64) if len(sets) else np.empty(0, np.uint64)
    for i in range(2 * T):
        if len(x) == 0:
            break
        h = _mix(x ^ _seeds[i])
        bins = (h & _U(T - 1)).astype(np.int64) if i < T else np.full(len(x), i - T)
        value = (_U(i) << _U(64 - _BITS - 1)) | (h >> _U(_BITS + 1))  # the round first
        np.minimum.at(out, row * T + bins, value)
        open_ = (out.reshape(-1, T) == full).any(axis=1)[row]
        if not open_.all():
            row, x = row[open_], x[open_]
    return out.reshape(-1, T)


def bands(sketch: np.ndarray) -> np.ndarray:
    """(n, BANDS) int64: one value per band, bands kept apart."""
    parts = _mix(sketch[:, :BANDS * ROWS].reshape(len(sketch), BANDS, ROWS))
    h = np.broadcast_to(_mix(np.arange(1, BANDS + 1, dtype=np.uint64)), parts.shape[:2]).copy()
    for k in range(ROWS):
        h = _mix(h * _U(0x9E3779B97F4A7C15) + parts[:, :, k])
    return h.view(np.int64)


def document_sets(documents: DataFrame) -> DataFrame:
    """One row per document: rid, doc_id, text key, set size, set digest, bands."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), L.text_key(F.col("text")).alias("th"), "text")

    def run(batches):
        for b in batches:
            n, d, keys = [], [], []
            held: list[np.ndarray] = []

            def flush():
                keys.extend(bands(sketches(held)) if held else [])
                held.clear()

            for s in shingle_sets(b.column("text"), WIDTH):
                n.append(len(s))
                d.append(L.digest(s) if len(s) else None)
                held.append(s)
                if sum(map(len, held[-1:])) > BLOCK or len(held) >= 256:
                    flush()
            flush()
            none = np.empty(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), pa.array(n, pa.int32()), pa.array(d, pa.binary()),
                 int_lists([k if m else none for k, m in zip(keys, n)])], names=["doc_id", "th", "n", "d", "keys"])
            del keys
        trim_memory()

    return (rows.mapInArrow(run, "doc_id long, th long, n int, d binary, keys array<long>")
            .withColumn("rid", F.monotonically_increasing_id()))


# -------------------------------------------------------------------- candidates
def _reach(a, b):
    return 100 * np.minimum(a, b).astype(np.int64) >= SIMILAR * np.maximum(a, b).astype(np.int64)


def _list_stream(batches):
    """Rows (key, rid, n) in order of (key, rid) -> candidate pairs (long false: a, b)
    of lists up to LIST and of longer lists' members with their first FIRST rows, and
    rows (long true: a = rid, b = key, n) of longer ones. Holds at most LIST rows
    and FIRST hubs between batches."""
    held = None
    running = None  # (key, hubs, their n) of a list known to be long

    def record(is_long, a, b, n):
        k = len(a)
        return pa.RecordBatch.from_arrays([pa.array(np.full(k, is_long)), pa.array(a), pa.array(b), pa.array(np.broadcast_to(n, k).astype(np.int32))],
                                          names=["long", "a", "b", "n"])

    def star(key, rid, n, hubs, hub_n):
        yield record(True, rid, key, n)
        for h, m in zip(hubs, hub_n):
            ok = (rid != h) & _reach(n, m)
            if ok.any():
                yield record(False, np.full(int(ok.sum()), h), rid[ok], 0)

    def whole(key, rid, n):
        if len(key) == 0:
            return
        cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
        size = np.diff(cut)
        for k in np.flatnonzero(size > LIST):
            x, y = cut[k], cut[k + 1]
            yield from star(key[x:y], rid[x:y], n[x:y], rid[x:x + FIRST], n[x:x + FIRST])
        wide = np.repeat(size, size)
        some = (wide > 1) & (wide <= LIST)
        key, rid, n = key[some], rid[some], n[some]
        for k in range(1, LIST):
            i = np.flatnonzero(key[k:] == key[:-k])
            if len(i) == 0:
                return
            i = i[_reach(n[i], n[i + k])]
            if len(i):
                yield record(False, np.minimum(rid[i], rid[i + k]), np.maximum(rid[i], rid[i + k]), 0)

    for b in batches:
        rows = [b.column(c).to_numpy() for c in ("key", "rid", "n")]
        if held is not None:
            rows, held = [np.concatenate([h, x]) for h, x in zip(held, rows)], None
        if running is not None and len(rows[0]):
            more = int(np.searchsorted(rows[0], running[0], side="right"))
            if more:
                yield from star(*(x[:more] for x in rows), *running[1:])
                rows = [x[more:] for x in rows]
        if len(rows[0]) == 0:
            continue
        running = None
        tail = int(np.searchsorted(rows[0], rows[0][-1], side="left"))
        yield from whole(*(x[:tail] for x in rows))
        last = [x[tail:] for x in rows]
        if len(last[0]) > LIST:
            running = (last[0][0], last[1][:FIRST].copy(), last[2][:FIRST].copy())
            yield from star(*last, *running[1:])
        else:
            held = last
    if held is not None:
        yield from whole(*held)
    trim_memory()


def candidates(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Band lists of the classes' first rows -> rows of ``_list_stream``."""
    parts = shuffle_partitions(sets.sparkSession)
    taken = classes.select(F.col("rid").alias("_first"), "d")
    # first rows are most rows: leave out the others, which are fewer
    copies = materialise(sets.where("n > 0").select("rid", "d").join(taken, "d").where("rid <> _first").select("rid"), "copies")
    k = copies.count()
    keys = (sets.where("n > 0").select("rid", "n", "keys").join(broadcast_if_small(copies, k), "rid", "left_anti")
            .select(F.explode("keys").alias("key"), "rid", "n"))
    out = (keys.repartition(parts, "key").sortWithinPartitions("key", "rid")
           .mapInArrow(_list_stream, "long boolean, a long, b long, n int"))
    return materialise(out, "band-lists")


# ---------------------------------------------------------------------- operator
def near_components(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``documents``."""
    with_package(documents.sparkSession)
    documents = documents.select("doc_id", "text")
    sets = materialise(document_sets(documents), "sketches")
    classes = materialise(L.equal_sets(sets), "classes")
    found = candidates(sets, classes)
    pairs = L.verify(documents, classes, found.where("not long").select("a", "b"), WIDTH, SIMILAR)
    stars = components(pairs)
    first = materialise(stars, "rooted")
    lists = found.where("long").select(F.col("b").alias("key"), F.col("a").alias("rid"), "n")
    near = lambda h: 100 * F.least(F.col("n"), h["n"]).cast("long") >= SIMILAR * F.greatest(F.col("n"), h["n"]).cast("long")
    first, more = L.settle(documents, classes, lists, first, ["n"], near, WIDTH, SIMILAR)
    roots = L.joined_roots(classes, first, more)
    release(found, stars, pairs, more, first, classes)
    done = L.with_components(sets.select("doc_id", "n", "d"), roots)
    return done.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id",
                       F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
