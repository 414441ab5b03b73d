"""Grouped prefix join: documents linked by the Jaccard similarity of their
five-word shingle sets (at least ``SIMILAR`` percent), exact.

1. Equal sets are one class; the class takes part once, through its first row.
2. Shingles have one global order: rare before common, then by hash. Common
   shingles are a hint from a hash sample of the texts; a wrong hint costs time,
   never a link. Two linked sets share a shingle within their prefixes, the
   first n - ceil(0.75 n) + 1 shingles.
3. Classes with the same prefix and size are one group; its first class leads.
4. Prefix shingles of leaders are dealt by shingle and read in order, so a
   shingle's list is met as a stream. Lists of up to ``LIST`` leaders give
   candidate pairs where sizes and positions leave the overlap in reach, counted
   per pair. A pair is dropped when even its remaining shingles cannot make the
   overlap. Longer lists and lists of hinted shingles give one pair per member:
   with the list's first, which is the one whose shingle comes earliest.
5. Candidates that the signatures of both sets (parities of hash buckets, at most a
   32nd of a set) leave possible are verified on whole sets (``links``), in two rounds: the star of
   each long list, each leader with its most promising partner, each member with
   its leader; long lists (where a leader stands for the components of its whole
   group) that still hold many pairs of different components go
   through more stars and then, like groups, through squares of members whose sets
   meet in one task (``links.settle``); last the pairs of short lists that still
   join different components, groups root by root before they are expanded.

Defined results: a null or word-free text has an empty set, links with nothing
and is its own component; fewer than five words are one shingle; null ids do
not count for the smallest id (all null: null); repeated rows are one class;
very long texts are hashed whole, a block at a time; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanderrank.llm import links as L
from wanderrank.llm.common import (broadcast_if_small, materialise, release, shuffle_partitions, trim_memory,
                                   with_package)
from wanderrank.llm.components import components
from wanderrank.llm.shingles import WIDTH, int_lists, shingle_sets, signature

SIMILAR = 75
LIST = 64            # longest shingle list that is paired directly
SAMPLE = 16          # one text in so many gives the hint
COMMON = 4           # sampled texts with a shingle that make it common
HINTS = 500_000      # shingles in the hint (4 MB)


def prefix_length(n):
    """n - ceil(0.75 n) + 1."""
    return n // 4 + 1


def _reach(a: Column, b: Column) -> Column:
    """Sizes that can be similar."""
    a, b = (F.col(x).cast("long") if isinstance(x, str) else x.cast("long") for x in (a, b))
    return 100 * F.least(a, b) >= SIMILAR * F.greatest(a, b)


def _enough(overlap: Column, a: Column, b: Column) -> Column:
    overlap, a, b = (x.cast("long") for x in (overlap, a, b))
    return 100 * overlap >= SIMILAR * (a + b - overlap)


# -------------------------------------------------------------- sets and order
def common_shingles(documents: DataFrame) -> np.ndarray:
    """The hint: at most HINTS shingles, most common in the sample first."""
    sample = documents.select("text").where(
        F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).distinct()

    def run(batches):
        for b in batches:
            for s in shingle_sets(b.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(s, pa.int64())], names=["s"])

    counts = materialise(sample.mapInArrow(run, "s long").groupBy("s").count().where(F.col("count") >= COMMON), "hint")
    # the least count that leaves at most HINTS, so that no task sends more; ties
    # at that count are dropped, a hint need not be complete
    per = counts.groupBy("count").agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("count")).collect()  # one row per count
    total, least = 0, None
    for r in per:
        total += r["k"]
        if total > HINTS:
            break
        least = r["count"]
    found = [] if least is None else [r["s"] for r in counts.where(F.col("count") >= least).select("s").collect()]
    release(counts)
    return np.sort(np.array(found, dtype=np.int64))


def _is_common(s: np.ndarray, hint: np.ndarray) -> np.ndarray:
    if len(hint) == 0 or len(s) == 0:
        return np.zeros(len(s), dtype=bool)
    at = np.searchsorted(hint, s)
    at[at == len(hint)] = 0
    return hint[at] == s


_SETS = "doc_id long, th long, n int, d binary, pd binary, light array<long>, common array<long>, sig array<long>"


def document_sets(documents: DataFrame, hint: np.ndarray) -> DataFrame:
    """One row per document: text key, set size, digests of set and prefix, the
    prefix as its rare and its common shingles, and the set's signature."""
    shipped = documents.sparkSession.sparkContext.broadcast(hint)  # HINTS * 8 bytes at most
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), L.text_key(F.col("text")).alias("th"), "text")

    def run(batches):
        common = shipped.value
        for b in batches:
            n, d, pd_, light, heavy, signs = [], [], [], [], [], []
            for s in shingle_sets(b.column("text")):
                k = prefix_length(len(s)) if len(s) else 0
                known = _is_common(s, common)
                rare = s[~known][:k]
                rest = s[known][:k - len(rare)]
                n.append(len(s))
                d.append(L.digest(s) if len(s) else None)
                pd_.append(L.digest(np.concatenate([rare, rest])) if len(s) else None)
                light.append(rare)
                heavy.append(rest)
                signs.append(signature(s))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), pa.array(n, pa.int32()), pa.array(d, pa.binary()),
                 pa.array(pd_, pa.binary()), int_lists(light), int_lists(heavy), int_lists(signs)],
                names=["doc_id", "th", "n", "d", "pd", "light", "common", "sig"])
            del light, heavy, signs
        trim_memory()

    return rows.mapInArrow(run, _SETS).withColumn("rid", F.monotonically_increasing_id())


# ------------------------------------------------------------------ candidates
_STREAM = "long boolean, a long, b long, nn long, hub long, hub_nn long, c long"
_LOW = 26            # bits of a set size or position
_MASK = (1 << _LOW) - 1


def _entry(n: Column, pos: Column, common: bool) -> Column:
    """An entry of a shingle's list as one long whose order is the list's: where
    the shingle stands in its set (in 1024ths), size, position."""
    n, pos = n.cast("long"), pos.cast("long")
    q = F.floor(pos * 1024 / n).cast("long")
    return (F.lit((1 << 62) if common else 0) + q * (1 << 2 * _LOW) + n * (1 << _LOW) + pos)


def _near(most, n, m):
    return 100 * most >= SIMILAR * (n + m - most)


def _list_stream(batches):
    """Rows (s, w, rid) in order of (s, w) -> candidate pairs (long false: a, b, nn =
    both sizes, c = 1 plus 2^32 if this may be their first shared shingle) of lists
    up to LIST long, rows (long true: a = rid, b = s, nn = size and position, hub,
    hub_nn: those of the list's first row) of longer and of common ones. Keeps one
    list of at most LIST rows between batches."""
    held = running = None

    def record(is_long, a, b, nn, hub, hub_nn, c):
        k = len(a)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(k, is_long)), *[pa.array(np.broadcast_to(x, k).astype(np.int64)) for x in (a, b, nn, hub, hub_nn, c)]],
            names=["long", "a", "b", "nn", "hub", "hub_nn", "c"])

    def low(w):
        return w & ((1 << 2 * _LOW) - 1)

    def emit_pairs(s, w, r):
        n, p = (w >> _LOW) & _MASK, w & _MASK
        for k in range(1, LIST):
            i = np.flatnonzero(s[k:] == s[:-k])
            if len(i) == 0:
                return
            j = i + k
            first = np.minimum(n[i] - p[i], n[j] - p[j])        # if nothing is shared before
            most = np.minimum(p[i], p[j]) + first               # if all that can be is shared before
            ok = (100 * np.minimum(n[i], n[j]) >= SIMILAR * np.maximum(n[i], n[j])) & _near(most, n[i], n[j])
            i, j, first = i[ok], j[ok], first[ok]
            if len(i) == 0:
                continue
            swap = r[i] > r[j]
            a, b = np.where(swap, j, i), np.where(swap, i, j)
            yield record(False, r[a], r[b], (n[a] << 32) | n[b], 0, 0, 1 + (_near(first, n[a], n[b]).astype(np.int64) << 32))

    def whole_lists(s, w, r):
        if len(s) == 0:
            return
        cut = np.flatnonzero(np.r_[True, s[1:] != s[:-1], True])
        size = np.diff(cut)
        wide, first = np.repeat(size, size), np.repeat(cut[:-1], size)
        several = wide > 1
        many = several & ((wide > LIST) | (w >> 62 > 0))
        if many.any():
            yield record(True, r[many], s[many], low(w[many]), r[first[many]], low(w[first[many]]), 1)
        some = several & ~many
        if some.any():
            yield from emit_pairs(s[some], w[some], r[some])

    for b in batches:
        rows = [b.column(c).to_numpy() for c in ("s", "w", "rid")]
        if held is not None:
            rows, held = [np.concatenate([h, x]) for h, x in zip(held, rows)], None
        if running is not None and len(rows[0]):
            more = int(np.searchsorted(rows[0], running[0], side="right"))
            if more:
                s, w, r = (x[:more] for x in rows)
                yield record(True, r, s, low(w), *running[1:], 1)
                rows = [x[more:] for x in rows]
        if len(rows[0]) == 0:
            continue
        running = None
        tail = int(np.searchsorted(rows[0], rows[0][-1], side="left"))
        yield from whole_lists(*(x[:tail] for x in rows))
        last = [x[tail:] for x in rows]
        if len(last[0]) > LIST:
            running = (last[0][0], last[2][0], low(last[1][0]))
            yield record(True, last[2], last[0], low(last[1]), *running[1:], 1)
        else:
            held = last
    if held is not None:
        yield from whole_lists(*held)
    trim_memory()


def candidates(sets: DataFrame, leaders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs: a, b, na, nb, c; lists: s, rid, n, pos, hub, hub_n, hub_pos). ``pairs``
    are leaders whose shared prefix shingles in short lists leave a link possible;
    ``lists`` are the members of long and of common lists."""
    parts = shuffle_partitions(sets.sparkSession)
    filled = sets.where("n > 0")
    # most rows lead: leave out the others, which are fewer
    others = materialise(filled.select("rid").join(leaders, "rid", "left_anti"), "others")
    lead = filled.select("rid", "n", "light", "common").join(broadcast_if_small(others, others.count()), "rid", "left_anti")
    light = lead.select("rid", "n", F.posexplode("light").alias("pos", "s")) \
        .select("s", _entry(F.col("n"), F.col("pos"), False).alias("w"), "rid")
    common = lead.where(F.size("common") > 0).select("rid", "n", F.size("light").alias("at"), F.posexplode("common").alias("pos", "s")) \
        .select("s", _entry(F.col("n"), F.col("at") + F.col("pos"), True).alias("w"), "rid")
    dealt = light.unionAll(common).repartition(parts, "s").sortWithinPartitions("s", "w")
    found = (dealt.mapInArrow(_list_stream, _STREAM).groupBy("long", "a", "b", "nn", "hub", "hub_nn").agg(F.sum("c").alias("c"))
             .where("long or c >= 4294967296"))
    found = materialise(found, "candidates")
    release(others)
    part = lambda c: [F.shiftright(c, _LOW).cast("int"), F.col(c).bitwiseAND(_MASK).cast("int")]
    n, pos = part("nn")
    hub_n, hub_pos = part("hub_nn")
    lists = found.where("long").select(  # reads the same files as ``pairs`` did: released with them
        F.col("b").alias("s"), F.col("a").alias("rid"), n.alias("n"), pos.alias("pos"),
                                       "hub", hub_n.alias("hub_n"), hub_pos.alias("hub_pos"))
    heavy = materialise(lists.groupBy("rid").agg(F.count(F.lit(1)).alias("k")), "heavy")
    n_heavy = heavy.count()
    pairs = found.where("not long").select("a", "b", F.shiftright("nn", 32).cast("int").alias("na"),
                                           F.col("nn").bitwiseAND((1 << 32) - 1).cast("int").alias("nb"),
                                           F.col("c").bitwiseAND((1 << 32) - 1).cast("int").alias("c"))
    for side in ("a", "b"):
        h = broadcast_if_small(heavy.select(F.col("rid").alias(side), F.col("k").alias(f"k{side}")), n_heavy)
        pairs = pairs.join(h, side, "left")
    rest = lambda n: n - (F.floor(n / 4) + 1)
    most = (F.col("c") + F.least(F.coalesce("ka", F.lit(0)), F.coalesce("kb", F.lit(0)))
            + F.greatest(rest(F.col("na")), rest(F.col("nb"))))
    most = F.least(most, F.col("na"), F.col("nb"))
    pairs = materialise(pairs.where(_enough(most, F.col("na"), F.col("nb"))).select("a", "b", "na", "nb", "c"), "pairs")
    release(heavy)
    lists._scratch = found._scratch
    return pairs, lists


def _may_link(x, y):
    """Sizes and positions of two members of a list leave the overlap in reach."""
    n, m, p, q = (v.astype(np.int64) for v in (x["n"][:, None], y["n"][None, :], x["pos"][:, None], y["pos"][None, :]))
    most = np.minimum(p, q) + np.minimum(n - p, m - q)
    return (100 * np.minimum(n, m) >= SIMILAR * np.maximum(n, m)) & _near(most, n, m)


# -------------------------------------------------------------------- the join
def _roots(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sets, one row per document; (d, low, root) of every class)."""
    with_package(documents.sparkSession)
    documents = documents.select("doc_id", "text")
    sets = materialise(document_sets(documents, common_shingles(documents)), "sets")
    classes = materialise(L.equal_sets(sets, "pd"), "classes")
    groups = materialise(classes.groupBy("pd", "n").agg(F.min("rid").alias("lead"), F.count(F.lit(1)).alias("members")), "groups")
    pairs, lists = candidates(sets, groups.select(F.col("lead").alias("rid")))
    shared = groups.where("members > 1").select("pd", "n", "lead")
    mates = materialise(classes.select("pd", "n", "rid").join(shared, ["pd", "n"]).select("lead", "rid"), "mates")  # groups of several

    # first round: members with their leader, long lists with their first member,
    # every leader with its most promising partner
    hub = [F.col(c) for c in ("hub_n", "hub_pos")]
    star = (lists.where(F.col("rid") != F.col("hub")).where(_reach(F.col("n"), hub[0]))
            .where(_enough(F.least("pos", hub[1]) + F.least(F.col("n") - F.col("pos"), hub[0] - hub[1]), F.col("n"), hub[0]))
            .select(F.col("hub").alias("a"), F.col("rid").alias("b")))
    share = (F.col("c").cast("long") * (1 << 20) / F.least("na", "nb")).cast("long")
    ways = pairs.select("a", "b", share.alias("q")).unionAll(
        pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), share.alias("q")))
    best = ways.groupBy("a").agg(F.max_by("b", "q").alias("b"))
    inner = mates.where("lead <> rid").select(F.col("lead").alias("a"), F.col("rid").alias("b"))
    signatures = sets.select("rid", F.col("n").alias("size"), "sig")
    first = L.verify(documents, classes, star.unionAll(best.select("a", "b")).unionAll(inner), WIDTH, SIMILAR, signatures)
    stars = components(first)
    found = materialise(stars, "round-1")
    release(stars)

    # further rounds of stars over long lists, then what still joins different components
    def reach(h):
        most = F.least(F.col("pos"), h["pos"]) + F.least(F.col("n") - F.col("pos"), h["n"] - h["pos"])
        return _reach(F.col("n"), h["n"]) & _enough(most, F.col("n"), h["n"])

    # a group is a list, too: its sizes and prefixes are equal, so nothing rules a pair out
    none = F.lit(0).alias
    every = lists.select(F.col("s").alias("key"), "rid", "n", "pos").unionAll(
        mates.select(F.col("lead").alias("key"), "rid", none("n"), none("pos")))
    found, across = L.settle(documents, classes, every, found, ["n", "pos"], reach, WIDTH, SIMILAR, _may_link, mates, signatures)
    leads = pairs.select("a", "b")
    # groups of several: their other classes stand in for the leader, root by root
    mated = materialise(L.rooted(mates, found, "rid", "root"), "rooted-mates")
    roots_of = mated.select("lead", "root").distinct()
    for side in ("a", "b"):
        m = roots_of.select(F.col("lead").alias(side), F.col("root").alias("_o"))
        leads = L.rooted(leads.join(m, side, "left"), found, side, f"r{side}") \
            .withColumn(f"r{side}", F.coalesce("_o", f"r{side}")).drop("_o")
    leads = leads.where("ra <> rb")
    for side in ("a", "b"):
        m = mated.select(F.col("lead").alias(side), F.col("root").alias(f"r{side}"), F.col("rid").alias("_o"))
        leads = leads.join(m, [side, f"r{side}"], "left").withColumn(side, F.coalesce("_o", side)).drop("_o")
    more = L.verify(documents, classes, leads.select("a", "b"), WIDTH, SIMILAR, signatures)
    roots = L.joined_roots(classes, found, more.unionAll(across))
    release(groups, pairs, lists, mates, first, found, across, mated, more, classes)
    return sets, roots


def near_components(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``documents``."""
    sets, roots = _roots(documents)
    return L.with_components(sets.select("doc_id", "n", "d"), roots).select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def near_documents(documents: DataFrame) -> DataFrame:
    """Digest rows of ``op9_ngram_jaccard``."""
    return near_components(documents.select("doc_id", "text"))


def first_of_component(documents: DataFrame) -> DataFrame:
    """``documents`` with one row per component: the one of the smallest id (no
    ids: of the smallest text key), judged by the row's set, so rows without an
    id and ids that occur twice are no exception; of rows equal in id and text
    one stays. Rows without words link with nothing:
    one per id and text stays."""
    clash = {"_ngram_id", "_ngram_th"} & set(documents.columns)
    if clash:
        raise ValueError(f"reserved column names: {sorted(clash)}")
    sets, roots = _roots(documents)
    keyed = sets.select("doc_id", "th", "n", "d").join(roots.select("d", "root"), "d", "left")
    alone = keyed.where("root is null").select("doc_id", "th").distinct()
    # the representative of a root: least (id, text key), ids before none
    least = keyed.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("doc_id"))
    first = keyed.where("root is not null").join(least.withColumnRenamed("doc_id", "_low"), "root") \
        .where(F.col("doc_id").eqNullSafe(F.col("_low"))).groupBy("root", "doc_id").agg(F.min("th").alias("th"))
    kept = first.select("doc_id", "th").unionByName(alone).select(F.col("doc_id").alias("_ngram_id"), F.col("th").alias("_ngram_th"))

    def on(id_col):
        return id_col.eqNullSafe(F.col("_ngram_id")) & (F.col("th") == F.col("_ngram_th"))

    # most rows stay: leave out the others, which are fewer
    gone = keyed.select("doc_id", "th").distinct().join(kept, on(F.col("doc_id")), "left_anti") \
        .select(F.col("doc_id").alias("_ngram_id"), F.col("th").alias("_ngram_th"))
    gone = materialise(gone, "gone")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_ngram_id")) & (L.text_key(F.col("text")) == F.col("_ngram_th"))
    there = documents.join(broadcast_if_small(gone, gone.count()), same, "left_anti")
    release(sets, roots)
    # equal id and text: one row. Only keys that occur twice are grouped
    twice = materialise(there.groupBy("doc_id", L.text_key(F.col("text")).alias("th")).count().where("count > 1")
                        .select(F.col("doc_id").alias("_ngram_id"), F.col("th").alias("_ngram_th")), "twice")
    m = twice.count()
    if m == 0:
        return there
    again = broadcast_if_small(twice, m)
    return there.join(again, same, "left_anti").unionAll(there.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))
