"""Mix sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is cut into ``BLOCKS`` blocks by a seeded hash of its rows, so a
block is a random part of its source. A source's target in words is met by
whole passes over all its blocks plus one partial pass over a prefix of a
permutation of them; the last block of that prefix is itself cut along the
row hash, so a source misses its target by half a row at most. The block draws
of all sources are then split among the output shards: from the root (all
draws, all shards) each node hands its left half a multivariate-hypergeometric
sample of its per-source quotas, down to one shard per leaf. Shard after shard
takes the next run of each source's draw sequence, so shards hold disjoint
draws, and rows are shuffled inside their shard by another hash.

What is gathered: one row per source on the driver, ``BLOCKS`` rows per source
in one grouped task, ``FINE`` rows per source for the cut. Rows only meet in
sums that combine before the shuffle and in a join on (source, block).

Defined results: a null text has size 0; a null source is a source of its own,
ordered last; sources without words get target 0; rows equal in doc_id and
text share a hash and are taken together; an empty table gives no rows.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wanderrank.llm.common import (WORD_JAVA, broadcast_if_small, materialise, shuffle_partitions,
                                   with_package)

BLOCKS = 256          # blocks per source
FINE = 1024           # finer hash parts of the one block that a source cuts
SHARDS = 64           # output shards of the mix
MAX_COPIES = 3        # a target stops at this many times its source's size
WEIGHTS = (1, 2, 3)   # by source in code-point order, repeating
SEED = 20_011


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_JAVA)), F.lit(0)).cast("long")


def row_hash(id_col: str, text_col: str, seed: int = SEED) -> Column:
    return F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))


def water_fill(sizes: list[int], weights: list[int], max_copies: int = MAX_COPIES) -> list[Fraction]:
    """Share ``sum(sizes)`` by weight; a share stops at ``max_copies`` times its
    size and the excess is shared again by weight until none is above."""
    left, total = set(range(len(sizes))), Fraction(sum(sizes))
    target = [Fraction(0)] * len(sizes)
    while left:
        weight = sum(weights[i] for i in left)
        full = {i for i in left if total * weights[i] / weight > max_copies * sizes[i]}
        if not full:
            for i in left:
                target[i] = total * weights[i] / weight
            break
        for i in full:
            target[i] = Fraction(max_copies * sizes[i])
            total -= target[i]
        left -= full
    return target


def split_quotas(quotas: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """[shards x sources]: how many of each source's draws every shard gets.
    Each node has a generator of its own, seeded by its shard range, so a
    subtree can be worked out apart from the others."""
    out = np.zeros((shards, len(quotas)), dtype=np.int64)

    def split(lo: int, hi: int, have: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = have
            return
        mid = (lo + hi) // 2
        total = int(have.sum())
        share = total * (mid - lo) // (hi - lo)
        rng = np.random.Generator(np.random.PCG64([seed, lo, hi]))
        left = rng.multivariate_hypergeometric(have, share, method="marginals") if total else have
        split(lo, mid, left)
        split(mid, hi, have - left)

    split(0, shards, np.asarray(quotas, dtype=np.int64))
    return out


def _draws(source_key: int, blocks: np.ndarray, sizes: np.ndarray, passes: int, extra: float, seed: int):
    """The source's draw sequence as (block positions, pass numbers, words that
    the last draw takes of its block; -1: all of it)."""
    seq, number = [], []
    for p in range(passes):
        order = np.random.Generator(np.random.PCG64([seed, source_key, p])).permutation(len(blocks))
        seq.append(order)
        number.append(np.full(len(order), p))
    cut = -1
    if extra > 0:
        order = np.random.Generator(np.random.PCG64([seed, source_key, passes])).permutation(len(blocks))
        upto = np.cumsum(sizes[order])
        k = int(np.searchsorted(upto, extra))
        k = min(k, len(order) - 1)
        seq.append(order[:k + 1])
        number.append(np.full(k + 1, passes))
        cut = int(round(extra - (upto[k - 1] if k else 0)))
        if cut >= sizes[order[k]]:
            cut = -1
    empty = np.empty(0, dtype=np.int64)
    return (np.concatenate(seq) if seq else empty), (np.concatenate(number) if number else empty), cut


def _n_draws(sizes: np.ndarray, blocks: np.ndarray, key: int, passes: int, extra: float, seed: int) -> int:
    return len(_draws(key, blocks, sizes, passes, extra, seed)[0])


_PLAN_SCHEMA = "source string, block int, copy int, shard int, cut long"


def plan_mix(rows: DataFrame, shards: int = SHARDS, seed: int = SEED,
             weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES):
    """``rows`` has source, size, h. Returns (targets, draws): ``targets`` has
    one row per source (source, source_size, target); ``draws`` one row per
    block draw (source, block, copy, shard, cut_at: rows whose position is above
    it are left out, or at it if ``cut_open``; null: whole block)."""
    spark = rows.sparkSession
    with_package(spark)
    rows = rows.withColumn("block", _block()).withColumn("fine", _fine())
    blocks = materialise(rows.groupBy("source", "block").agg(F.sum("size").alias("words")), "mix-blocks")
    # one row per source
    totals = [(r["source"], int(r["words"])) for r in
              blocks.groupBy("source").agg(F.sum("words").alias("words")).collect()]
    totals.sort(key=lambda r: (r[0] is None, r[0] or ""))
    share = water_fill([n for _, n in totals], [weights[i % len(weights)] for i in range(len(totals))], max_copies)
    plan = []
    for i, ((source, size), target) in enumerate(zip(totals, share)):
        passes = int(target // size) if size else 0
        plan.append((source, size, float(target), i, passes, float(target - passes * size) if size else 0.0))
    schema = "source string, source_size long, target double, key int, passes int, extra double"
    targets = spark.createDataFrame(plan, schema)
    per_block = blocks.join(broadcast_if_small(targets, len(plan)), blocks["source"].eqNullSafe(targets["source"])) \
        .select(targets["source"], "block", "words", "key", "passes", "extra")

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        r = pdf.iloc[0]
        n = _n_draws(pdf["words"].to_numpy(), pdf["block"].to_numpy(), int(r["key"]), int(r["passes"]),
                     float(r["extra"]), seed)
        return pd.DataFrame({"key": [int(r["key"])], "n": [n]})

    counted = {r["key"]: r["n"] for r in
               per_block.groupBy("key").applyInPandas(count, "key int, n long").collect()}
    quotas = np.array([counted.get(i, 0) for i in range(len(plan))], dtype=np.int64)
    bounds = np.cumsum(split_quotas(quotas, shards, seed), axis=0)  # [shards x sources]
    bound_rows = [(i, [int(x) for x in bounds[:, i]]) for i in range(len(plan))]
    bound = spark.createDataFrame(bound_rows, "key int, ends array<long>")
    per_block = per_block.join(broadcast_if_small(bound, len(plan)), "key")

    def deal(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        r = pdf.iloc[0]
        at = pdf["block"].to_numpy()
        seq, number, cut = _draws(int(r["key"]), at, pdf["words"].to_numpy(), int(r["passes"]),
                                  float(r["extra"]), seed)
        cuts = np.full(len(seq), -1, dtype=np.int64)
        if len(seq):
            cuts[-1] = cut
        return pd.DataFrame({
            "source": pd.Series([r["source"]] * len(seq), dtype="object"), "block": at[seq].astype(np.int32),
            "copy": number.astype(np.int32), "cut": cuts,
            "shard": np.searchsorted(np.asarray(r["ends"]), np.arange(len(seq)), side="right").astype(np.int32)})[
                ["source", "block", "copy", "shard", "cut"]]

    draws = materialise(per_block.groupBy("key").applyInPandas(deal, _PLAN_SCHEMA), "mix-draws")
    return targets, _with_cut(rows, draws)


def _block(h: str = "h") -> Column:
    return F.pmod(F.shiftrightunsigned(h, 8), F.lit(BLOCKS)).cast("int")


def _fine() -> Column:
    return F.shiftrightunsigned("h", 54).cast("int")  # the top 10 bits: 0 .. FINE-1


def _position(h: Column) -> Column:
    """Hashes in unsigned order, as a signed long."""
    return h.bitwiseXOR(F.lit(-(1 << 63)))


def _with_cut(rows: DataFrame, draws: DataFrame) -> DataFrame:
    """Turn the word count that a partial draw takes into a hash bound. First
    the fine part that holds the bound (a sum per fine part), then, inside that
    part only, the row: a row is in if its middle word is before the cut. If no
    row of the part is, the bound is the part's first hash, left out itself:
    ``cut_open`` (the first part begins at the least long, nothing is below)."""
    n_cut = draws.where("cut >= 0").count()  # one per source at most
    some = broadcast_if_small(draws.where("cut >= 0").select(
        F.col("source").alias("s"), F.col("block").alias("b"), "cut"), n_cut)
    inside = rows.join(some, rows["source"].eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))) \
        .select("s", "b", "cut", "fine", "h", "size")
    by_fine = Window.partitionBy("s", "b").orderBy("fine").rowsBetween(Window.unboundedPreceding, -1)
    fine = (inside.groupBy("s", "b", "cut", "fine").agg(F.sum("size").alias("w"))
            .withColumn("before", F.coalesce(F.sum("w").over(by_fine), F.lit(0))))
    hit = fine.where("before <= cut and cut < before + w") \
        .select(F.col("s").alias("s2"), F.col("b").alias("b2"), F.col("fine").alias("f2"), "before")
    tail = inside.join(broadcast_if_small(hit, n_cut), inside["s"].eqNullSafe(F.col("s2"))
                       & (F.col("b") == F.col("b2")) & (F.col("fine") == F.col("f2")))
    by_row = Window.partitionBy("s2", "b2").orderBy(_position(F.col("h")), "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    tail = tail.withColumn("at", F.col("before") + F.coalesce(F.sum("size").over(by_row), F.lit(0)))
    last = (tail.where(2 * F.col("at") + F.col("size") <= 2 * F.col("cut"))
            .groupBy("s2", "b2").agg(F.max(_position(F.col("h"))).alias("p")))
    floor = hit.select(F.col("s2").alias("s3"), F.col("b2").alias("b3"), "f2")
    bound = floor.join(last, floor["s3"].eqNullSafe(last["s2"]) & (F.col("b3") == F.col("b2")), "left") \
        .select("s3", "b3", F.coalesce(
            "p", _position(F.shiftleft(F.col("f2").cast("long"), 54))).alias("cut_at"),
            F.col("p").isNull().alias("cut_open"))
    out = draws.join(broadcast_if_small(bound, n_cut), draws["source"].eqNullSafe(F.col("s3"))
                     & (F.col("block") == F.col("b3")) & (F.col("cut") >= 0), "left")
    return out.select("source", "block", "copy", "shard", "cut_at", "cut_open")


def taken_copies(rows: DataFrame, draws: DataFrame, n_draws: int) -> DataFrame:
    """``rows`` (with source, ``_mix_h``) plus ``_mix_copies``: an array of
    (copy, shard, cut_at, cut_open), one for each time the mix takes the row. Names
    starting with ``_mix_`` are reserved."""
    per_block = draws.groupBy(F.col("source").alias("_mix_s"), F.col("block").alias("_mix_b")).agg(
        F.collect_list(F.struct("copy", "shard", "cut_at", "cut_open")).alias("_mix_d"))  # MAX_COPIES + 1 at most
    rows = rows.withColumn("_mix_block", _block("_mix_h"))
    out = rows.join(broadcast_if_small(per_block, n_draws), F.col("source").eqNullSafe(F.col("_mix_s"))
                    & (F.col("_mix_block") == F.col("_mix_b")), "left")
    at = _position(F.col("_mix_h"))
    copies = F.filter(F.coalesce("_mix_d", F.array().cast("array<struct<copy:int,shard:int,cut_at:bigint,cut_open:boolean>>")),
                      lambda d: d["cut_at"].isNull() | (at < d["cut_at"])
                      | (~d["cut_open"] & (at == d["cut_at"])))
    return out.withColumn("_mix_copies", copies).drop("_mix_s", "_mix_b", "_mix_d", "_mix_block")


def mix_sizes(documents: DataFrame) -> DataFrame:
    """Digest rows of ``op7_mix``."""
    rows = materialise(documents.select(
        "doc_id", "source", words(F.col("text")).alias("size"), row_hash("doc_id", "text").alias("h")), "mix-rows")
    targets, draws = plan_mix(rows)
    n = draws.count()
    out = taken_copies(rows.withColumnRenamed("h", "_mix_h"), draws, n)
    t = targets.select(F.col("source").alias("_t"), "source_size", "target")
    out = out.join(broadcast_if_small(t, n), F.col("source").eqNullSafe(F.col("_t")))
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("size") * F.size("_mix_copies")).cast("long").alias("taken"))


def mix_documents(documents: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mixed corpus: every column of ``documents``, a row once per copy
    taken, dealt to shards and shuffled inside each."""
    narrow = materialise(documents.select(
        "source", words(F.col("text")).alias("size"), row_hash("doc_id", "text", seed).alias("h")), "mix-rows")
    _, draws = plan_mix(narrow, shards, seed)
    n = draws.count()
    keyed = documents.withColumn("_mix_h", row_hash("doc_id", "text", seed))
    copied = taken_copies(keyed, draws, n).withColumn("_mix_c", F.explode("_mix_copies"))
    copied = copied.withColumn("_mix_shard", F.col("_mix_c.shard")) \
        .withColumn("_mix_key", F.xxhash64(F.lit(seed), "_mix_shard", "_mix_c.copy", "_mix_h"))
    parts = shuffle_partitions(documents.sparkSession)
    return (copied.repartitionByRange(parts, "_mix_shard", "_mix_key").sortWithinPartitions("_mix_shard", "_mix_key")
            .select(*documents.columns))
