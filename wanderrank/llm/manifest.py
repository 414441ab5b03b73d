"""Merkle dataset manifest: one tree per key over rows in order, a root over the
trees, and folding that resumes copied SHA-256 states.

A parent hashes the hex texts of its children. It keeps a copy of the hash state
before each child's slot. To replace a child, the state of its slot is resumed
with the replacement and the siblings on its right; what lies on its left is
not read again. States are 32-byte values (``sha_tree``), so they travel in
tables.

1. Leaves are native ``sha2`` digests of the typed columns. A distributed sort
   by (key, order, leaf), with one count per partition and key, gives each leaf
   its position in its tree; no window holds a tree.
2. Blocks of ``BLOCK`` consecutive positions are dealt out. A task streams whole
   blocks, builds their levels, and for each leaf folds its replacement up to
   the block's root and starts its proof hash.
3. Block roots are the leaves of the next round, until one node per tree is
   left; these subroots, in order of the key, are one more tree. Rounds grow
   with log(rows) / log(BLOCK). These rounds return paths: per level, the state
   before the slot and the siblings' digests.
4. Every leaf row meets the path of its block and resumes both hashes to the root.

No task holds more than one block and one Arrow batch, whatever a tree's size;
tables of blocks are broadcast only when counted as small.

Defined results: a null column hashes as ``-``; null order values come first,
ties by leaf digest (equal rows are equal leaves, so their order does not
matter); a null key is a tree of its own, the first; repeated rows are leaves of
their own; a tree of one leaf has no sibling there; without any sibling the
proof is the hash of nothing; very long texts are hashed whole; an empty table
gives no rows; other columns are not read, so their names may clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wanderrank.llm import sha_tree as S
from wanderrank.llm.common import broadcast_if_small, materialise, shuffle_partitions, trim_memory, with_package
from wanderrank.operators.indexing import index_by

BLOCK_LEVELS = 10          # a block has fanout ** levels leaves, at most MAX_BLOCK
MAX_BLOCK = 1_024
PATH_ROWS = 4_000          # paths (about 2 KB each) that may be broadcast
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def field(c: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    v = c.cast("string")
    return F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v))


def leaf(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


# -------------------------------------------------------------------- positions
def positions(leaves: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``leaves`` plus tree (rank of the key, nulls first, from 0), pos (from 0
    in the tree) and n (rows of the tree)."""
    parts = shuffle_partitions(leaves.sparkSession)
    rows = materialise(leaves.repartitionByRange(parts, key, *order).sortWithinPartitions(key, *order)
                       .withColumn("_part", F.spark_partition_id())
                       .withColumn("_seq", F.monotonically_increasing_id()), "leaves")
    runs = materialise(rows.groupBy("_part", key).agg(F.count(F.lit(1)).alias("_c"), F.min("_seq").alias("_s0")), "runs")
    of_key = Window.partitionBy(key)  # one row per partition that holds the key
    runs = runs.select("_part", F.col(key).alias("_key"), "_s0", F.sum("_c").over(of_key).alias("n"),
                       F.coalesce(F.sum("_c").over(of_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
                                  F.lit(0)).alias("_off"))
    ranks = index_by(runs.select("_key").distinct(), "_key", out="tree").select(F.col("_key").alias("_k"), "tree")
    n_runs = runs.count()
    ranked = runs.join(broadcast_if_small(ranks, n_runs), F.col("_key").eqNullSafe(F.col("_k"))) \
        .select(F.col("_part").alias("_p"), "_key", "_s0", "n", "_off", (F.col("tree") - 1).alias("tree"))
    return (rows.join(broadcast_if_small(ranked, n_runs),
                      (F.col("_part") == F.col("_p")) & F.col(key).eqNullSafe(F.col("_key")))
            .withColumn("pos", F.col("_off") + F.col("_seq") - F.col("_s0"))
            .select(*leaves.columns, "tree", "pos", "n"))


# ------------------------------------------------------------------------ blocks
def _raw(column) -> np.ndarray:
    return S.from_bytes(b"".join(column.to_pylist()))


def _levels(tree, block, pos, n, digest, fanout, depth):
    """Levels of whole blocks, and per block its root. Blocks of a tree that has
    several grow ``depth`` times, a lone block until one node is left."""
    size = fanout ** depth
    ident = np.cumsum(np.r_[True, (tree[1:] != tree[:-1]) | (block[1:] != block[:-1])]) - 1
    left = np.where(n > size, size, n)[np.flatnonzero(np.r_[True, ident[1:] != ident[:-1]])]  # nodes wide
    at, out = pos % size, []
    for _ in range(depth):
        grows = left[ident] > 1
        if not grows.any():
            break
        level = S.Level(ident, at, digest, grows, fanout)
        out.append(level)
        ident, at, digest = level.tree, level.at, level.above
        left = -(-left // fanout)
    return out, digest


def _stream(batches, work):
    """Feed whole blocks (rows sorted by tree and pos) to ``work``; the last
    block of a batch waits for the next one."""
    held = None
    for b in batches:
        rows = pa.Table.from_batches([b])
        if held is not None and held.num_rows:
            rows = pa.concat_tables([held, rows]).combine_chunks()
        if not rows.num_rows:
            continue
        tree, block = (rows.column(c).to_numpy() for c in ("tree", "block"))
        cut = np.flatnonzero((tree[1:] != tree[:-1]) | (block[1:] != block[:-1]))
        end = int(cut[-1]) + 1 if len(cut) else 0
        if end:
            yield from work(rows.slice(0, end)).to_batches()
        held = rows.slice(end)
    if held is not None and held.num_rows:
        yield from work(held.combine_chunks()).to_batches()
    trim_memory()


def _dealt(nodes: DataFrame, size: int) -> DataFrame:
    parts = shuffle_partitions(nodes.sparkSession)
    return (nodes.withColumn("block", F.expr(f"pos div {size}L")).repartition(parts, "tree", "block")
            .sortWithinPartitions("tree", "pos"))


def _fold_blocks(leaves: DataFrame, fanout: int, depth: int) -> DataFrame:
    """leaves (doc_id, tree, pos, n, leaf, changed) -> the same key with the
    replaced leaf folded to its block's root, and the proof's state so far."""
    size = fanout ** depth

    def work(t: pa.Table) -> pa.Table:
        tree, block, pos, n = (t.column(c).to_numpy() for c in ("tree", "block", "pos", "n"))
        digest = _raw(t.column("leaf"))
        levels, top = _levels(tree, block, pos, n, digest, fanout, depth)
        node = np.arange(len(tree))
        folded = _raw(t.column("changed"))
        proof, absorbed = S.starts(len(tree)), np.zeros(len(tree), dtype=np.int64)
        for level in levels:
            for rows, other in level.siblings(node):
                proof[rows] = S.absorb(proof[rows], other)
                absorbed[rows] += 1
            folded = level.fold(node, folded)
            node = level.parent[node]
        if not levels:  # lone leaves only
            ident = np.cumsum(np.r_[True, tree[1:] != tree[:-1]]) - 1
            node = ident
        keep = t.select(["doc_id", "tree", "block", "pos", "n", "leaf"])
        for name, values in (("folded", folded), ("proof", proof), ("root", top[node])):
            keep = keep.append_column(name, pa.array(S.to_bytes(values), pa.binary()))
        return keep.append_column("absorbed", pa.array(absorbed))

    schema = ("doc_id long, tree long, block long, pos long, n long, leaf binary, folded binary, proof binary, "
              "root binary, absorbed long")
    return _dealt(leaves, size).mapInArrow(lambda batches: _stream(batches, work), schema)


_STEP = "array<struct<slot:int, count:int, state:binary, others:binary>>"


def _paths(nodes: DataFrame, fanout: int, depth: int) -> DataFrame:
    """nodes (tree, pos, n, digest) -> tree, pos, n, block, root and the path to
    the block's root: per level the slot, the children of the parent, the state
    before the slot, and the digests of the other children."""
    size = fanout ** depth

    def work(t: pa.Table) -> pa.Table:
        tree, block, pos, n = (t.column(c).to_numpy() for c in ("tree", "block", "pos", "n"))
        levels, top = _levels(tree, block, pos, n, _raw(t.column("digest")), fanout, depth)
        node = np.arange(len(tree))
        path: list[list] = [[] for _ in range(len(tree))]
        for level in levels:
            others = [b""] * len(tree)
            for rows, digest in level.siblings(node):
                for r, raw in zip(rows, S.to_bytes(digest)):
                    others[r] += raw
            states, up = S.to_bytes(level.state[node]), level.parent[node]
            for r in np.flatnonzero(level.grows[node]):
                path[r].append({"slot": int(level.slot[node[r]]), "count": int(level.count[up[r]]),
                                "state": states[r], "others": others[r]})
            node = up
        if not levels:
            node = np.cumsum(np.r_[True, tree[1:] != tree[:-1]]) - 1
        kind = pa.list_(pa.struct([("slot", pa.int32()), ("count", pa.int32()), ("state", pa.binary()), ("others", pa.binary())]))
        out = t.select(["tree", "pos", "n", "block"])
        out = out.append_column("root", pa.array(S.to_bytes(top[node]), pa.binary()))
        return out.append_column("path", pa.array(path, kind))

    return _dealt(nodes, size).mapInArrow(lambda batches: _stream(batches, work),
                                          f"tree long, pos long, n long, block long, root binary, path {_STEP}")


def _upper(nodes: DataFrame, fanout: int, depth: int, name: str) -> tuple[DataFrame, DataFrame]:
    """All rounds above ``nodes`` (tree, pos, n, digest): (tree, pos, root, path)
    with the whole path to the tree's root, and the roots (tree, root)."""
    size, rounds = fanout ** depth, []
    while True:
        level = materialise(_paths(nodes, fanout, depth), name)
        rounds.append(level)
        nodes = level.where(F.col("pos") % size == 0).select(
            "tree", F.col("block").alias("pos"), F.ceil(F.col("n") / size).cast("long").alias("n"),
            F.col("root").alias("digest"))
        if (level.agg(F.max("n")).first()[0] or 0) <= size:
            break
    top = rounds.pop().select("tree", "pos", "root", "path")
    roots = top.where("pos = 0").select("tree", "root")
    while rounds:  # downwards: the path of a node, then that of its block
        below = rounds.pop()
        up = top.select(F.col("tree").alias("_t"), F.col("pos").alias("_b"), F.col("root").alias("_r"), F.col("path").alias("_up"))
        top = materialise(below.join(up, (F.col("tree") == F.col("_t")) & (F.col("block") == F.col("_b")))
                          .select("tree", "pos", F.col("_r").alias("root"), F.concat("path", "_up").alias("path")), name)
    return top, roots


_DONE = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _finish(rows: DataFrame) -> DataFrame:
    """Resume every leaf's fold and proof along the path of its block."""

    def work(b: pa.RecordBatch) -> pa.RecordBatch:
        tree, block = (b.column(c).to_numpy() for c in ("tree", "block"))
        cut = np.flatnonzero(np.r_[True, (tree[1:] != tree[:-1]) | (block[1:] != block[:-1])])
        long = np.diff(np.r_[cut, len(tree)])
        paths = b.column("path").take(pa.array(cut)).to_pylist()  # a block's rows share it
        folded, proof = _raw(b.column("folded")), _raw(b.column("proof"))
        absorbed = b.column("absorbed").to_numpy().copy()
        for k in range(max(map(len, paths), default=0)):
            steps = [p[k] if k < len(p) else None for p in paths]
            live = np.repeat([s is not None for s in steps], long)
            rows_ = np.flatnonzero(live)
            run = np.repeat(np.arange(len(paths)), long)[rows_]
            slot, count = (np.array([0 if s is None else s[c] for s in steps], dtype=np.int64) for c in ("slot", "count"))
            before = S.from_bytes(b"".join(bytes(32) if s is None else s["state"] for s in steps))
            width = max(len(s["others"]) for s in steps if s is not None)
            others = S.from_bytes(b"".join((b"" if s is None else s["others"]).ljust(width, b"\0") for s in steps)) \
                .reshape(len(steps), width // 32, 8)
            state = S.absorb(before[run], folded[rows_])
            for j in range(width // 32):
                there = np.flatnonzero(j + 1 < count[run])
                sibling = others[run[there], j]
                proof[rows_[there]] = S.absorb(proof[rows_[there]], sibling)
                absorbed[rows_[there]] += 1
                right = j >= slot[run[there]]
                state[there[right]] = S.absorb(state[there[right]], sibling[right])
            folded[rows_] = S.finish(state, count[run])
        top = b.column("top").to_pylist()
        got = S.to_bytes(folded)
        text = lambda values: pa.array([v.hex() for v in values], pa.string())
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id"), text(b.column("leaf").to_pylist()), text(b.column("subroot").to_pylist()), text(top),
             text(S.to_bytes(S.finish(proof, absorbed))), text(got), pa.array([x == y for x, y in zip(got, top)])],
            names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield work(b)
        trim_memory()

    return rows.mapInArrow(run, _DONE)


# ---------------------------------------------------------------------- operator
def block_depth(fanout: int) -> int:
    depth = 1
    while fanout ** (depth + 1) <= MAX_BLOCK and depth < BLOCK_LEVELS:
        depth += 1
    return depth


def manifest(leaves: DataFrame, key: str, order: list[str], fanout: int = 2) -> DataFrame:
    """``leaves``: doc_id (long), ``key``, ``order``, leaf and changed (32-byte
    digests; ``changed`` replaces ``leaf`` when folding). One row each with the
    hex leaf, subroot, root, proof hash, and the root folded from ``changed``."""
    if fanout < 2:
        raise ValueError("fanout must be at least 2")
    spark, depth = leaves.sparkSession, block_depth(fanout)
    with_package(spark)
    size = fanout ** depth
    placed = positions(leaves, key, order).select("doc_id", "tree", "pos", "n", "leaf", "changed")
    folded = materialise(_fold_blocks(placed, fanout, depth), "folded")
    blocks = folded.where(F.col("pos") % size == 0).select(
        "tree", F.col("block").alias("pos"), F.ceil(F.col("n") / size).cast("long").alias("n"), F.col("root").alias("digest"))
    inner, subroots = _upper(blocks, fanout, depth, "block-paths")
    subroots = materialise(subroots, "subroots")
    n_trees = subroots.count()
    over, root = _upper(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"),
                                        F.lit(n_trees).cast("long").alias("n"), F.col("root").alias("digest")),
                        fanout, depth, "tree-paths")
    over = over.select(F.col("pos").alias("_tree"), F.col("root").alias("top"), F.col("path").alias("_over"))
    paths = materialise(
        inner.join(over, F.col("tree") == F.col("_tree"))
        .select(F.col("tree").alias("_t"), F.col("pos").alias("_b"), F.col("root").alias("subroot"), "top",
                F.concat("path", "_over").alias("path")), "paths")
    small = paths.count()
    rows = folded.select("doc_id", "tree", "block", "leaf", "folded", "proof", "absorbed").join(
        broadcast_if_small(paths, small, PATH_ROWS), (F.col("tree") == F.col("_t")) & (F.col("block") == F.col("_b")))
    return _finish(rows.select("doc_id", "tree", "block", "leaf", "folded", "proof", "absorbed", "subroot", "top", "path"))


def manifest_documents(documents: DataFrame) -> DataFrame:
    """Digest rows of ``op12_merkle_manifest``."""
    doc_id = F.col("doc_id").cast("long")
    tampered = F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 7 == 0, F.lit(False))
    columns = [doc_id if c == "doc_id" else F.col(c) for c in FIELDS]
    other = [F.col("n_chars") + 1 if c == "n_chars" else x for c, x in zip(FIELDS, columns)]
    whole = leaf(columns)
    leaves = documents.select(doc_id.alias("doc_id"), F.col("lang").alias("key"), F.unhex(whole).alias("leaf"),
                              F.unhex(F.when(tampered, leaf(other)).otherwise(whole)).alias("changed"))
    return manifest(materialise(leaves, "digests"), "key", ["doc_id", "leaf"])
