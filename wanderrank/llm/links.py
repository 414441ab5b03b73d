"""Classes of equal shingle sets, exact verification of candidate pairs, and the
component of every row: what the joins on shingle sets share.

Verification makes the sets of the classes in question again from their texts and
sends each set once per candidate pair, to the pair's hub (its smaller class). A
hub's pairs are dealt in chunks of ``CHUNK``, and its own set goes to every chunk,
so no task meets more than that of one hub; rows are streamed, one hub's set and
one Arrow batch at a time. Where signatures of the sets are at hand, pairs that
these rule out are dropped before (``may_link``): a 64th to a 32nd of a set's size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wanderrank.llm.common import BROADCAST_ROWS, broadcast_if_small, materialise, release, shuffle_partitions, trim_memory
from wanderrank.llm.components import components
from wanderrank.llm.shingles import int_lists, shingle_sets

CHUNK = 256
WORDS = 1 << 18      # words of signatures compared at once


def digest(a: np.ndarray) -> bytes:
    return hashlib.blake2b(a.tobytes(), digest_size=16).digest()


def no_pairs(spark) -> DataFrame:
    return spark.createDataFrame([], "a long, b long")


def text_key(text):
    return F.xxhash64(F.coalesce(text, F.lit("")))


def equal_sets(sets: DataFrame, *more: str) -> DataFrame:
    """sets (rid, doc_id, th, n, d) -> one row per non-empty set: its first row's
    rid, doc_id (``id``) and text key (``th``), the lowest id of all (``low``)."""
    return sets.where("n > 0").groupBy("d").agg(
        F.min("rid").alias("rid"), F.min("doc_id").alias("low"), F.first("n").alias("n"),
        F.min_by("doc_id", "rid").alias("id"), F.min_by("th", "rid").alias("th"),
        *[F.first(c).alias(c) for c in more])


def linked(own: np.ndarray, values: np.ndarray, offsets: np.ndarray, percent: int) -> np.ndarray:
    """Which of the sorted sets values[offsets[i]:offsets[i + 1]] link with ``own``."""
    at = np.minimum(np.searchsorted(own, values), len(own) - 1)
    total = np.concatenate(([0], np.cumsum(own[at] == values)))
    shared, n = total[offsets[1:]] - total[offsets[:-1]], np.diff(offsets)
    return 100 * shared >= percent * (len(own) + n - shared)


def may_link(a: tuple, b: tuple, total: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sets their signatures leave possible. a, b: (words of all
    signatures, where the pair's one starts, its length); total: both sizes added.
    Linked sets differ in at most (100 - percent) / (100 + percent) of ``total``."""
    (values_a, at_a, wide_a), (values_b, at_b, wide_b) = a, b
    keep = np.zeros(len(total), dtype=bool)
    for u, v in {(int(x), int(y)) for x, y in np.unique(np.stack([wide_a, wide_b]), axis=1).T}:
        of, w = np.flatnonzero((wide_a == u) & (wide_b == v)), min(u, v)
        step = max(1, WORDS // (u + v))
        for k in (of[p:p + step] for p in range(0, len(of), step)):
            # a longer signature is folded to the shorter one's buckets
            x, y = (np.bitwise_xor.reduce(values[at[k][:, None] + np.arange(wide)].reshape(len(k), -1, w), axis=1)
                    for values, at, wide in ((values_a, at_a, u), (values_b, at_b, v)))
            differ = np.bitwise_count((x ^ y).view(np.uint64)).sum(axis=1, dtype=np.int64)
            keep[k] = (100 + percent) * differ <= (100 - percent) * total[k]
    return keep


def _words(column) -> tuple:
    """list<int64> column -> (values, starts, lengths)."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.values.to_numpy(), offsets[:-1], np.diff(offsets)


def sifted(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) that the signatures (rid, size, sig) leave possible."""
    rids = materialise(pairs.select(F.explode(F.array("a", "b")).alias("rid")).distinct(), "sift")
    own = materialise(signatures.join(broadcast_if_small(rids, rids.count()), "rid", "left_semi"), "signatures")
    both = pairs
    for side in ("a", "b"):
        both = both.join(own.select(F.col("rid").alias(side), F.col("size").alias(f"n{side}"), F.col("sig").alias(f"s{side}")), side)

    def run(batches):
        for b in batches:
            total = b.column("na").to_numpy().astype(np.int64) + b.column("nb").to_numpy()
            ok = may_link(_words(b.column("sa")), _words(b.column("sb")), total, percent)
            yield pa.RecordBatch.from_arrays([pa.array(b.column(c).to_numpy()[ok]) for c in ("a", "b")], names=["a", "b"])
        trim_memory()

    out = materialise(both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long"), "sifted")
    release(rids, own)
    return out


def sets_of(documents: DataFrame, classes: DataFrame, rids: DataFrame, width: int) -> DataFrame:
    """(rid, s): the sorted shingle hashes of the classes ``rids``, made again from their texts."""
    wanted = materialise(classes.join(rids, "rid").select("rid", "d", F.col("id").alias("_id"), F.col("th").alias("_th")), "wanted")
    n = wanted.count()
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("th", text_key(F.col("text")))
    texts = rows.join(broadcast_if_small(wanted, n), (F.col("th") == F.col("_th")) & F.col("doc_id").eqNullSafe(F.col("_id"))) \
        .select("rid", "d", "text")

    def again(batches):
        for b in batches:
            rid, sets = [], []
            for r, d, s in zip(b.column("rid").to_pylist(), b.column("d").to_pylist(), shingle_sets(b.column("text"), width)):
                if digest(s) == d:
                    rid.append(r)
                    sets.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), int_lists(sets)], names=["rid", "s"])
            del sets
        trim_memory()

    sets = materialise(texts.mapInArrow(again, "rid long, s array<long>"), "class-sets")
    if sets.count() > n:  # rows of equal id and text
        many, sets = sets, materialise(sets.dropDuplicates(["rid"]), "class-sets")
        release(many)
    release(wanted)
    return sets


def verify(documents: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, percent: int,
           signatures: DataFrame | None = None) -> DataFrame:
    """The links among ``pairs`` (a, b: class rids): 100 * shared >= percent * union
    on whole sets. ``documents``: doc_id, text. Pairs that ``signatures`` (rid, size,
    sig) rule out are dropped first."""
    parts = shuffle_partitions(documents.sparkSession)
    pairs = materialise(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "verify")
    if signatures is not None and not pairs.isEmpty():
        every, pairs = pairs, sifted(pairs, signatures, percent)
        release(every)
    if pairs.isEmpty():
        release(pairs)
        return no_pairs(pairs.sparkSession)
    hubs = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("k"))
    hubs = materialise(hubs, "hubs")
    n_hubs = hubs.count()
    spokes = pairs.join(broadcast_if_small(hubs, n_hubs), "a").select(
        F.col("b").alias("rid"), F.col("a").alias("hub"), F.pmod(F.xxhash64("b"), F.col("k")).cast("int").alias("chunk"))
    routes = materialise(spokes.unionAll(hubs.select(
        F.col("a").alias("rid"), F.col("a").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("chunk"))), "routes")
    n_routes = routes.count()
    sets = sets_of(documents, classes, routes.select("rid").distinct(), width)

    def meet(batches):
        hub = chunk = own = None
        for b in batches:
            if b.num_rows == 0:
                continue
            a, c, rid = (b.column(x).to_numpy() for x in ("hub", "chunk", "rid"))
            lists = b.column("s")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            values = lists.values.to_numpy()
            cut = np.r_[0, np.flatnonzero((a[1:] != a[:-1]) | (c[1:] != c[:-1])) + 1, len(a)]
            out_a, out_b = [], []
            for x, y in zip(cut[:-1], cut[1:]):
                if (a[x], c[x]) != (hub, chunk):  # the hub's own row is the first: its rid is the lowest
                    hub, chunk, own = a[x], c[x], values[offsets[x]:offsets[x + 1]].copy() if rid[x] == a[x] else None
                    x += 1
                if own is None or x == y:
                    continue
                ok = linked(own, values[offsets[x]:offsets[y]], offsets[x:y + 1] - offsets[x], percent)
                out_a.append(np.full(int(ok.sum()), hub, dtype=np.int64))
                out_b.append(rid[x:y][ok])
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])
        trim_memory()

    met = (sets.join(broadcast_if_small(routes, n_routes), "rid").select("hub", "chunk", "rid", "s")
           .repartition(parts, "hub", "chunk").sortWithinPartitions("hub", "chunk", "rid"))
    links = materialise(met.mapInArrow(meet, "a long, b long"), "links")
    release(pairs, hubs, routes, sets)
    return links


def rooted(df: DataFrame, found: DataFrame, col: str, out: str) -> DataFrame:
    """``df`` with the root of ``col`` (itself where ``found`` has no row for it)."""
    r = found.select(F.col("node").alias(col), F.col("root").alias("_r"))
    return df.join(r, col, "left").withColumn(out, F.coalesce("_r", col)).drop("_r")


HUBS = 3             # members of a long list that all others are compared with in a round
ROUNDS = 2           # such rounds at most; then every pair that is left
FEW = 16             # a list with fewer pairs of different roots a member takes no more rounds
SQUARE = 128         # members on a side of a task's square
SIDE = 256           # the same where rows and signatures meet, not whole sets
FIRST = 8            # a member's lowest lists, which tell where a pair has gone out already


def mixed_lists(lists: DataFrame) -> DataFrame:
    """lists (key, root, ..) -> (key, many) of the lists that hold several roots;
    ``many``: more than ``FEW`` pairs of different roots for each member."""
    sizes = lists.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("key").agg(
        F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("q"))
    return sizes.where("m * m > q").select("key", (F.col("m") * F.col("m") - F.col("q") > 2 * FEW * F.col("m")).alias("many"))


def families(lists: DataFrame, side: int) -> DataFrame:
    """lists (key, rid, root) that hold several roots -> (fam, x, y, side, rid, root): the
    members of lists that share a root are one family; each takes part in the squares
    of its block of ``side`` members. Members of the family's largest root have blocks of
    their own, which never meet each other."""
    of = lists.select("key", "root").distinct()
    low = of.groupBy("key").agg(F.min("root").alias("low"))
    stars = components(of.join(low, "key").select(F.col("root").alias("a"), F.col("low").alias("b")))
    members = rooted(lists.select("rid", "root").distinct(), stars, "root", "fam").select("fam", "rid", "root")
    members = materialise(members, "family")
    sizes = members.groupBy("fam", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("fam").agg(
        F.max_by("root", "c").alias("big"), F.max("c").alias("cb"), F.sum("c").alias("m"))
    sizes = materialise(sizes.select("fam", "big", F.ceil(F.col("cb") / side).cast("int").alias("wb"),
                                     F.ceil((F.col("m") - F.col("cb")) / side).cast("int").alias("wo")), "sizes")
    h = F.xxhash64("rid")
    of_big = F.col("root") == F.col("big")
    met = members.join(broadcast_if_small(sizes, sizes.count()), "fam").withColumn(
        "at", F.when(of_big, F.pmod(h, F.col("wb"))).otherwise(F.col("wb") + F.pmod(h, F.col("wo"))).cast("int"))
    others = F.sequence(F.when(of_big, F.col("wb")).otherwise(F.lit(0)), F.col("wb") + F.col("wo") - 1)
    out = met.select("fam", "rid", "root", F.explode(F.transform(others, lambda o: F.struct(
        F.least("at", o).alias("x"), F.greatest("at", o).alias("y"), (F.col("at") > o).cast("int").alias("side")))).alias("q")) \
        .select("fam", "q.*", "rid", "root")
    out = materialise(out, "squares")
    release(stars, members, sizes)
    return out


def family_links(documents: DataFrame, classes: DataFrame, lists: DataFrame, width: int, percent: int) -> DataFrame:
    """The links between different roots in the families of ``lists``, found in place:
    a task holds the sets of one square, and only links leave it."""
    parts = shuffle_partitions(documents.sparkSession)
    squares = families(lists, SQUARE)
    sets = sets_of(documents, classes, squares.select("rid").distinct(), width)
    at = ["fam", "x", "y"]

    def work(t):
        rid, root, side = (t.column(c).to_numpy() for c in ("rid", "root", "side"))
        if (root == root[0]).all():
            return
        lists_ = t.column("s").combine_chunks()
        offsets = lists_.offsets.to_numpy().astype(np.int64)
        values = lists_.values.to_numpy()
        same = t.column("x")[0].as_py() == t.column("y")[0].as_py()
        j = np.flatnonzero(side == (0 if same else 1))
        if len(j) == 0:
            return
        lengths = np.diff(offsets)
        flat = np.concatenate([values[offsets[k]:offsets[k + 1]] for k in j])
        bounds = np.concatenate(([0], np.cumsum(lengths[j])))
        for i in np.flatnonzero(side == 0):
            small, large = np.minimum(lengths[i], lengths[j]), np.maximum(lengths[i], lengths[j])
            may = (root[j] != root[i]) & (100 * small >= percent * large)
            if not may.any():
                continue
            ok = may & linked(values[offsets[i]:offsets[i + 1]], flat, bounds, percent)
            if ok.any():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(int(ok.sum()), rid[i])), pa.array(rid[j[ok]])], names=["a", "b"])

    def run(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            if t.num_rows == 0:
                continue
            differs = np.zeros(t.num_rows - 1, dtype=bool)
            for c in at:
                x = t.column(c).to_numpy()
                differs |= x[1:] != x[:-1]
            cut = np.concatenate(([0], np.flatnonzero(differs) + 1))
            for p, q in zip(cut[:-1], cut[1:]):
                yield from work(t.slice(p, q - p))
            held = t.slice(cut[-1])
        if held is not None and held.num_rows:
            yield from work(held)
        trim_memory()

    met = sets.join(broadcast_if_small(squares, squares.count()), "rid").select(*at, "side", "rid", "root", "s")
    links = materialise(met.repartition(parts, *at).sortWithinPartitions(*at).mapInArrow(run, "a long, b long"), "links")
    release(squares, sets)
    return links


def elsewhere(a: tuple, b: tuple, key: int) -> np.ndarray:
    """Which pairs share one of their lowest lists below ``key``. a, b: (lists of all members,
    where the pair's one starts, its length)."""
    (values_a, at_a, wide_a), (values_b, at_b, wide_b) = a, b
    found = np.zeros(len(at_a), dtype=bool)
    values_a, values_b = (np.r_[v, key] for v in (values_a, values_b))
    n = np.arange(FIRST)
    step = WORDS // FIRST ** 2
    for k in (slice(p, p + step) for p in range(0, len(at_a), step)):
        x, y = (values[np.where(n < wide[k, None], at[k, None] + n, -1)] for values, at, wide in
                ((values_a, at_a, wide_a), (values_b, at_b, wide_b)))
        found[k] = ((x[:, :, None] == y[:, None, :]) & (x < key)[:, :, None]).any(axis=(1, 2))
    return found


def squares(lists: DataFrame, side: int, carry: list[str], near, percent: int) -> DataFrame:
    """Pairs (a, b) of different roots inside each list of ``lists`` (key, rid, root,
    size, sig, first, ``carry``). A list is dealt in squares of ``side`` x ``side`` members,
    so no task holds more than one of them. ``near(x, y)``: the matrix of pairs that
    may link, from the columns of both sides; a pair that it rules out in one list
    links in none. Only those that the signatures leave possible, too, go out, and
    not again from a list above one that both name in ``first``, their lowest lists."""
    parts = shuffle_partitions(lists.sparkSession)
    if lists.isEmpty():
        return no_pairs(lists.sparkSession)
    # members of the list's largest root have blocks of their own, which never meet each other
    sizes = lists.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("key").agg(
        F.max_by("root", "c").alias("_big"), F.max("c").alias("cb"), F.sum("c").alias("m")).where("m > cb")
    sizes = materialise(sizes.select("key", "_big", F.ceil(F.col("cb") / side).cast("int").alias("_wb"),
                                     F.ceil((F.col("m") - F.col("cb")) / side).cast("int").alias("_wo")), "sizes")
    h, of_big = F.xxhash64("rid"), F.col("root") == F.col("_big")
    met = lists.join(broadcast_if_small(sizes, sizes.count()), "key").withColumn(
        "_at", F.when(of_big, F.pmod(h, F.col("_wb"))).otherwise(F.col("_wb") + F.pmod(h, F.col("_wo"))).cast("int"))
    # a member's block is one side of every square that it takes part in
    others = F.sequence(F.when(of_big, F.col("_wb")).otherwise(F.lit(0)), F.col("_wb") + F.col("_wo") - 1)
    own = ["rid", "root", "size", "sig", "first", *carry]
    dealt = met.select("key", *own, F.explode(F.transform(others, lambda o: F.struct(
        F.least("_at", o).alias("_x"), F.greatest("_at", o).alias("_y"), (F.col("_at") > o).cast("int").alias("_side")))).alias("_q")) \
        .select("key", "_q.*", *own)
    at = ["key", "_x", "_y"]

    def run(batches):
        def work(t):
            rows = {c: t.column(c).to_numpy() for c in ("rid", "root", "size", *carry)}
            if (rows["root"] == rows["root"][0]).all():
                return
            words, rows["_at"], rows["_wide"] = _words(t.column("sig"))
            firsts, rows["_from"], rows["_many"] = _words(t.column("first"))
            which = t.column("_side").to_numpy()
            same = t.column("_x")[0].as_py() == t.column("_y")[0].as_py()
            x, y = ({c: v[which == k] for c, v in rows.items()} for k in (0, 0 if same else 1))
            ok = x["root"][:, None] != y["root"][None, :]
            if same:
                ok &= x["rid"][:, None] < y["rid"][None, :]
            i, j = np.nonzero(ok & near(x, y))
            ok = may_link((words, x["_at"][i], x["_wide"][i]), (words, y["_at"][j], y["_wide"][j]),
                          x["size"][i].astype(np.int64) + y["size"][j], percent)
            i, j = i[ok], j[ok]
            again = elsewhere((firsts, x["_from"][i], x["_many"][i]), (firsts, y["_from"][j], y["_many"][j]), t.column("key")[0].as_py())
            i, j = i[~again], j[~again]
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(x["rid"][i]), pa.array(y["rid"][j])], names=["a", "b"])

        held = None
        for b in batches:
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            t = t.combine_chunks()
            if t.num_rows == 0:
                continue
            differs = np.zeros(t.num_rows - 1, dtype=bool)
            for c in at:
                x = t.column(c).to_numpy()
                differs |= x[1:] != x[:-1]
            cut = np.r_[0, np.flatnonzero(differs) + 1]
            for p, q in zip(cut[:-1], cut[1:]):
                yield from work(t.slice(p, q - p))
            held = t.slice(cut[-1])
        if held is not None and held.num_rows:
            yield from work(held)
        trim_memory()

    found = dealt.repartition(parts, *at).sortWithinPartitions(*at).mapInArrow(run, "a long, b long").distinct()
    found = materialise(found, "squares")
    release(sizes)
    return found


def settle(documents: DataFrame, classes: DataFrame, lists: DataFrame, found: DataFrame, carry: list[str],
           reach, width: int, percent: int, near=None, mates: DataFrame | None = None,
           signatures: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Rounds of stars over the long lists (key, rid, ``carry``) that still hold many
    pairs of different roots: each time ``HUBS`` members, another choice but the same
    in all lists that share them, are compared with the members of other roots. A
    family of near copies falls into few components this way, without its pairs.
    ``reach(h)``: whether a row and a hub (struct ``h``) may link. ``mates`` (lead,
    rid; the lead, too): classes that a list's lead stands for. They count by their
    roots, and lists of several roots take them all.

    -> (node, root) after the rounds, and the links between those roots that the
    lists still mixed give: with ``near`` and ``signatures`` (rid, size, sig) the pairs of
    one list that both let through are verified (``squares``), else whole families
    are compared in place."""
    for r in range(ROUNDS + 1):
        at = rooted(lists, found, "rid", "root")
        if mates is not None:
            mated = materialise(rooted(mates, found, "rid", "root"), "mates")
            at = at.join(mated.select(F.col("lead").alias("rid"), F.col("root").alias("_o")).distinct(), "rid", "left") \
                .withColumn("root", F.coalesce("_o", "root")).drop("_o")
        at = materialise(at, "rooted-lists")
        mixed = materialise(mixed_lists(at), "mixed")
        n_mixed = mixed.count()
        if n_mixed == 0:
            release(at, mixed, *([] if mates is None else [mated]))
            return found, no_pairs(documents.sparkSession)
        left = at.join(broadcast_if_small(mixed, n_mixed), "key")
        if mates is not None:
            whole = at
            left = left.join(mated.select(F.col("lead").alias("rid"), "root", F.col("rid").alias("_o")), ["rid", "root"], "left") \
                .withColumn("rid", F.coalesce("_o", "rid")).drop("_o")
            at = materialise(left, "mixed-lists")
            left = at
            release(whole, mated)
        if r == ROUNDS or mixed.where("many").isEmpty():
            if near is None:
                held = materialise(left.select("key", "rid", "root"), "mixed-lists")  # read three times
                links = family_links(documents, classes, held, width, percent)
                release(held)
            else:
                lowest = F.slice(F.sort_array(F.collect_list("key")), 1, FIRST).alias("first")
                rids = materialise(left.groupBy("rid").agg(lowest), "mixed-rids")
                own = materialise(signatures.join(broadcast_if_small(rids, rids.count(), BROADCAST_ROWS // FIRST), "rid"), "signatures")
                signed = materialise(left.select("key", "rid", "root", *carry).join(own, "rid"), "signed")  # read three times
                pairs = squares(signed, SIDE, carry, near, percent)
                links = verify(documents, classes, pairs, width, percent)
                release(rids, own, signed, pairs)
            release(at, mixed)
            return found, links
        # a list's hubs travel as one array, and a member's over all its lists are joined before they are dealt
        many = at.join(broadcast_if_small(mixed.where("many"), n_mixed), "key", "left_semi")
        w = Window.partitionBy("key").orderBy(F.xxhash64("rid", F.lit(r)), "rid")
        hubs = materialise(many.withColumn("_i", F.row_number().over(w)).where(F.col("_i") <= HUBS)
                           .groupBy("key").agg(F.collect_list(F.struct("rid", "root", *carry)).alias("hubs")), "list-hubs")
        met = F.filter("hubs", lambda h: (h["root"] != F.col("root")) & reach(h))
        star = (many.join(broadcast_if_small(hubs, hubs.count()), "key")
                .select("rid", F.transform(met, lambda h: h["rid"]).alias("h")).where(F.size("h") > 0)
                .groupBy("rid").agg(F.array_distinct(F.flatten(F.collect_set("h"))).alias("h"))
                .select(F.col("rid").alias("a"), F.explode("h").alias("b")))
        links = verify(documents, classes, star, width, percent, *([] if signatures is None else [signatures]))
        joined = components(rooted(rooted(links, found, "a", "ra"), found, "b", "rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")))
        # roots move; a class that was alone has no row in ``found`` yet
        moved = rooted(found.withColumnRenamed("root", "_old"), joined.select("node", "root"), "_old", "root").select("node", "root")
        new = joined.join(found.select("node"), "node", "left_anti").select("node", "root")
        last, found = found, materialise(moved.unionAll(new), "rooted")
        release(at, mixed, hubs, links, joined, last)


def joined_roots(classes: DataFrame, first: DataFrame, more: DataFrame) -> DataFrame:
    """classes -> (d, root): the components of the first round, joined by the links
    ``more`` between them."""
    between = rooted(rooted(more, first, "a", "ra"), first, "b", "rb").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    second = components(between)
    if not hasattr(second, "_scratch"):  # nothing was joined
        return materialise(rooted(classes.select("d", "low", "rid"), first, "rid", "root").select("d", "low", "root"), "roots")
    final = rooted(classes.select("d", "low", "rid"), first, "rid", "r1")
    out = final.join(second.select(F.col("node").alias("r1"), F.col("root").alias("_r2")), "r1", "left") \
        .withColumn("root", F.coalesce("_r2", "r1")).select("d", "low", "root")
    out = materialise(out, "roots")
    release(second)
    return out


def with_components(sets: DataFrame, roots: DataFrame) -> DataFrame:
    """sets (.., n, d) plus root (null for an empty set) and component_id: the
    lowest id of the component, or the row's own id."""
    lowest = roots.groupBy("root").agg(F.min("low").alias("component_id"))
    by_class = materialise(roots.join(lowest, "root").select("d", "root", "component_id"), "class-components")
    return sets.join(by_class, "d", "left").withColumn(
        "component_id", F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")))
