"""Content similarity: item vectors, exact cosine top-k, neighbour lookup.

Exact all-pairs top-k without all pairs:

1. vectors are L2-normalised in the JVM (zero vector stays zero, so its
   cosine with anything is 0); equal vectors are one class, of which a query can
   need the ``k + 1`` smallest ids only;
2. classes are cut into blocks of about ``block_rows`` near ones (``operators.cells``);
   a block's box and ball bound what a query can score there;
3. a query meets its own block first; its ``k + 1``-th score there is a floor, and only
   blocks whose bound reaches the floor are visited. A task holds one block and at
   most ``block_rows`` queries, scored ``CHUNK`` queries at a time, near ones together,
   against those cells of the block that they can need (``cells.Near``). A visit gives a
   query one row, the list of its ``k + 1`` best that reach the floor;
4. zero vectors score 0 with everything: they take the smallest ids;
5. a query's lists are merged to ``k + 1`` entries; a source with one vector takes its
   ``k`` from the list, without another shuffle.

Vectors without a bound in reach (many dimensions, no structure) visit every
block: the work is then n^2, the memory of a task stays the same.

Ranking uses the score rounded to 12 places, then the neighbour id, so equal
scores that differ only in floating-point noise rank the same on any engine.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from wanderrank.operators import cells
from wanderrank.operators.cells import matrix
from wanderrank.operators.features import label_encode
from wanderrank.operators.topk import block_tasks, topk_rows
from wanderrank.session import broadcast_if_small, materialise, release, saved, ship_package

NUMERIC_FEATURES = ["rating", "price", "visit_hours", "annual_visitors"]
RANK_DIGITS = 12
CHUNK = 256          # query rows scored at once
SLACK = 1e-9         # rounding of scores and bounds


def feature_columns(items: DataFrame) -> list[str]:
    cols = [c for c in NUMERIC_FEATURES if c in items.columns]
    cols += [c for c in items.columns if c.startswith("has_")]
    cols += [c for c in ("category_idx", "province_idx") if c in items.columns]
    return cols


def build_item_vectors(items: DataFrame, id_col: str = "item_id",
                       default_category: str = "Alam", default_province: str = "Bali") -> DataFrame:
    """Item feature vectors: the numeric columns present, every ``has_*`` flag
    and the two category indexes (label-encoded when the frame has none);
    null -> 0; min-max scaled per column over all items, a constant column
    -> 0. Returns ``(item_id, features array<double>)``.

    The per-column min and max are one global aggregate (one row, a fixed
    size) evaluated as one scalar subquery.
    """
    df = items
    if "category_idx" not in df.columns and "category" in df.columns:
        df = label_encode(df, "category", "category_idx", default_category)
    if "province_idx" not in df.columns and "province" in df.columns:
        df = label_encode(df, "province", "province_idx", default_province)
    cols = feature_columns(df)
    # The n x d matrix is written once: the min/max aggregate and the scaled
    # projection both read it instead of re-running the feature lineage.
    filled = df.select(id_col, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                                 for c in cols]).transform(saved)
    stats = filled.select(F.struct(*[F.min(c).alias(f"lo_{c}") for c in cols],
                                   *[F.max(c).alias(f"hi_{c}") for c in cols])).scalar()
    scaled = []
    for c in cols:
        lo, hi = stats.getField(f"lo_{c}"), stats.getField(f"hi_{c}")
        rng = hi - lo
        scaled.append(F.when(rng == 0, F.lit(0.0)).otherwise((F.col(c) - lo) / rng))
    return filled.select(F.col(id_col).alias("item_id"), F.array(*scaled).alias("features"))


def _unit(features: str = "features"):
    norm = F.sqrt(F.aggregate(F.col(features), F.lit(0.0), lambda acc, x: acc + x * x))
    # the norm is bound by an array of one: inside the inner lambda it would be worked out per entry
    return F.transform(F.array(norm), lambda n: F.when(n == 0, F.transform(F.col(features), lambda x: x * 0.0)).otherwise(
        F.transform(F.col(features), lambda x: x / n)))[0]


def _topk_block(k: int):
    """Query classes (qid, u, self, floor) x classes of one block -> per query the
    ``k`` best classes; classes whose first id is ``self`` come in addition."""
    def score(key, q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"qid": np.empty(0, np.int64), "cls": np.empty(0, np.int64), "score": np.empty(0)})]
        if q.empty or c.empty:
            return out[0]
        near, um = cells.Near(np.stack(c["c_u"].to_numpy())), np.stack(q["u"].to_numpy())
        cls, name = c["cls"].to_numpy(), c["name"].to_numpy()
        first = c["first"].fillna("" if c["first"].dtype == object else -np.inf).to_numpy()
        qids, floors, selves = q["qid"].to_numpy(), q["floor"].fillna(-np.inf).to_numpy(dtype=float), q["self"].to_numpy()
        several = q["self"].notna().to_numpy()
        for at in near.chunks(um, CHUNK):
            qid, own, u = qids[at], selves[at], um[at]
            rows, floor = near.reached(u, floors[at], ~several[at], k, SLACK)
            sims = u @ near.x[rows].T
            ranked = np.round(sims, RANK_DIGITS)
            ranked[sims < floor[:, None] - SLACK] = -np.inf
            for i in np.flatnonzero(several[at]):
                for j in np.flatnonzero((name[rows] == own[i]) & np.isfinite(ranked[i])):
                    out.append(pd.DataFrame({"qid": [qid[i]], "cls": [cls[rows[j]]], "score": [sims[i, j]]}))
                    ranked[i, j] = -np.inf
            r, col = topk_rows(sims, first[rows], k, ranked)
            out.append(pd.DataFrame({"qid": qid[r], "cls": cls[rows[col]], "score": sims[r, col]}))
        return pd.concat(out, ignore_index=True)
    return score


def _ranks(ids: pa.Array) -> np.ndarray:
    """The place of each id in Spark's order, nulls first; equal ids share one."""
    return pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy(zero_copy_only=False).astype(np.int64)


def _lists(k: int, near: pa.DataType):
    """``_topk_block`` over Arrow tables: queries (qid, u, self, floor, block) and classes (u, dst,
    m, name: ids, how often each occurs, and the first as text) -> the queries with ``near``, the
    ``k`` best ids (p: minus the rounded score, dst, m, score), and a new ``floor`` where there are ``k``."""
    best = _topk_block(k)

    def score(key, q: pa.Table, c: pa.Table) -> pa.Table:
        q = q.combine_chunks()
        n, floor, ends = len(q), q["floor"].to_numpy(zero_copy_only=False), np.zeros(len(q) + 1, np.int64)
        values = pa.StructArray.from_arrays([pa.array([], f.type) for f in near.value_type], fields=list(near.value_type))
        if n and len(c):
            dst, m = c["dst"].combine_chunks(), c["m"].combine_chunks()
            sizes = pc.list_value_length(dst).to_numpy(zero_copy_only=False).astype(np.int64)
            start, ids = np.cumsum(sizes) - sizes, dst.flatten()
            place = _ranks(ids)
            own = q["self"].to_pandas()
            found = best(key, pd.DataFrame({"qid": np.arange(n), "u": list(matrix(q["u"])), "self": own, "floor": floor}),
                         pd.DataFrame({"cls": np.arange(len(c)), "c_u": list(matrix(c["c_u"])), "first": place[start],
                                       "name": c["name"].to_pandas()}))
            cls = found["cls"].to_numpy()
            times = sizes[cls]
            row, got = np.repeat(found["qid"].to_numpy(), times), np.repeat(found["score"].to_numpy(), times)
            at = np.repeat(start[cls] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
            if own.notna().any():
                text = ids.cast(pa.string()).to_pandas().to_numpy()
                mine = own.to_numpy()[row]
                ok = ~((mine == text[at]) & own.notna().to_numpy()[row])
                row, got, at = row[ok], got[ok], at[ok]
            p = 0.0 - np.round(got, RANK_DIGITS)
            order = np.lexsort((place[at], p, row))
            row, got, at, p = row[order], got[order], at[order], p[order]
            keep = np.arange(len(row)) - np.searchsorted(row, row) < k
            row, got, at, p = row[keep], got[keep], at[keep], p[keep]
            count = np.bincount(row, minlength=n)
            ends = np.append(0, np.cumsum(count))
            least = np.minimum.reduceat(np.append(got, np.inf), np.minimum(ends[:-1], len(got)))
            floor = np.where(count >= k, least, floor)
            values = pa.StructArray.from_arrays([pa.array(p), ids.take(pa.array(at)), m.flatten().take(pa.array(at)), pa.array(got)],
                                                fields=list(near.value_type))
        near_ = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values).cast(near)
        return pa.table([*(q[x] for x in ("qid", "u", "self", "block")), pa.array(floor, pa.float64(), from_pandas=True), near_],
                        names=["qid", "u", "self", "block", "floor", "near"])
    return score


def _n_blocks(df: DataFrame, block_rows: int) -> int:
    return max(1, math.ceil(df.count() / block_rows))


def block_copies(src: DataFrame, v: DataFrame, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """All pairs of blocks, without bounds: query rows (item_id, u, qb, cb), one per
    candidate block, and candidate rows (c_id, c_u, c_qb, c_cb), one per query block."""
    nq, nc = _n_blocks(src, block_rows), _n_blocks(v, block_rows)

    def block(n: int):
        return F.pmod(F.xxhash64("item_id"), F.lit(n)).cast("int")

    q = src.select("item_id", "u", block(nq).alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(nc - 1))).alias("cb"))
    c = v.select(F.col("item_id").alias("c_id"), F.col("u").alias("c_u"),
                 F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("c_qb"), block(nc).alias("c_cb"))
    return q, c


def _visit(routes: DataFrame, classes: DataFrame, k: int, block_rows: int) -> DataFrame:
    """Queries (qid, u, self, floor, block) with ``near``, the list of their block (``_lists``)."""
    sizes = materialise(routes.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("_k")), "visits")
    row = sizes.agg(F.count(F.lit(1)).alias("n"), F.sum("_k").alias("t")).first()
    tasks = max(block_tasks(routes.sparkSession, row["t"] or 1), (row["t"] or 1) // 8)
    small = broadcast_if_small(sizes, row["n"])
    q = (routes.join(small, "block").withColumn("part", F.pmod(F.xxhash64("qid"), F.col("_k")).cast("int"))
         .select("qid", "u", "self", "floor", "block", "part").repartition(tasks, "block", "part"))
    c = (classes.join(small, "block").withColumn("c_part", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
         .select(F.col("u").alias("c_u"), F.col("ids.dst").alias("dst"), F.col("ids.m").alias("m"), "name",
                 F.col("block").alias("c_block"), "c_part").repartition(tasks, "c_block", "c_part"))
    of = classes.select("ids.dst").schema[0].dataType.elementType
    near = T.ArrayType(T.StructType([T.StructField("p", T.DoubleType()), T.StructField("dst", of),
                                     T.StructField("m", T.IntegerType()), T.StructField("score", T.DoubleType())]))
    schema = T.StructType([*routes.select("qid", "u", "self", "block").schema.fields, T.StructField("floor", T.DoubleType()),
                           T.StructField("near", near)])
    found = (q.groupBy("block", "part").cogroup(c.groupBy("c_block", "c_part"))
             .applyInArrow(_lists(k, to_arrow_type(near)), schema))
    found = materialise(found, "scores")
    release(sizes)
    return found


def _vector_classes(v: DataFrame, k: int) -> DataFrame:
    """Rows (item_id, u) -> u, ids: the ``k`` smallest ids with that vector and how
    often each occurs (``k`` at most), and ``name`` (the least id as text)."""
    one = v.groupBy("u", "item_id").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("m"))
    w = Window.partitionBy("u").orderBy("item_id")
    return (one.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
            .groupBy("u").agg(F.array_sort(F.collect_list(F.struct("_r", F.col("item_id").alias("dst"), "m"))).alias("ids"))
            .withColumn("name", F.col("ids")[0]["dst"].cast("string")))


def cosine_topk(vectors: DataFrame, k: int = 5, block_rows: int = 4096,
                id_col: str = "item_id", features: str = "features",
                queries: DataFrame | None = None) -> DataFrame:
    """Exact cosine top-k neighbours per item, self excluded.

    Returns ``(src, dst, score, rank)`` with the raw cosine in ``score``
    (round for display with ``round4``). ``queries`` (a frame with ``id_col``)
    restricts the source side to those ids; candidates are always the whole
    table, so the result for those sources is the same. Vectors that are null or
    hold a NaN have no neighbours and are none. Repeated rows count as often as
    they occur.
    """
    ship_package(vectors.sparkSession)
    # Written once to the shared checkpoint folder: queries and candidates
    # read it instead of recomputing the feature lineage.
    v = vectors.select(F.col(id_col).alias("item_id"), _unit(features).alias("u")) \
        .where(F.col("u").isNotNull() & ~F.exists("u", F.isnan)).transform(saved)
    src = v
    if queries is not None:
        src = v.join(queries.select(F.col(id_col).alias("item_id")).distinct(), "item_id", "left_semi")
    whole = materialise(_vector_classes(v, k + 1).withColumn("cls", F.monotonically_increasing_id()), "classes")
    classes, assign, reach = cells.blocks(whole, "u", "cls", block_rows)
    release(whole)

    # one query per vector; ids that have several vectors are queries of their own
    several = v.groupBy("item_id").agg(F.count_distinct("u").alias("c")).where("c > 1").select("item_id", F.lit(True).alias("_several"))
    src = src.join(several, "item_id", "left").withColumn(
        "self", F.when(F.col("_several"), F.col("item_id").cast("string"))).groupBy("item_id", "u", "self").agg(
        F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("times"))
    src = materialise(src, "sources")
    asked = materialise(src.select("u", "self").distinct().withColumn("qid", F.monotonically_increasing_id()), "queries")
    same = (F.col("u") == F.col("q_u")) & F.col("self").eqNullSafe(F.col("q_self"))
    owners = materialise(src.join(asked.select("qid", F.col("u").alias("q_u"), F.col("self").alias("q_self")), same)
                         .select("qid", F.col("item_id").alias("src"), "times", "self"), "owners")
    low = materialise(v.groupBy("item_id").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("m"))
                      .orderBy("item_id").limit(k + 1), "least")
    release(v, src)

    some = F.exists("u", lambda x: x != 0)
    first = _visit(assign(asked.where(some)).withColumn("floor", F.lit(None).cast("double")), classes, k + 1, block_rows)
    routes = materialise(reach(first.select("qid", "u", "self", "floor", "block"), SLACK), "routes")
    more = _visit(routes, classes, k + 1, block_rows)
    release(routes, classes)
    merged = (first.select("qid", "near").unionAll(more.select("qid", "near")).where(F.size("near") > 0).groupBy("qid")
              .agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k + 1).alias("near")))
    # zero vectors: every cosine is 0
    zero = low.agg(F.array_sort(F.collect_list(F.struct(F.lit(0.0).alias("p"), F.col("item_id").alias("dst"), "m",
                                                        F.lit(0.0).alias("score")))).alias("near"))
    none = asked.where(~some).select("qid").join(F.broadcast(zero), how="cross")
    best = materialise(merged.unionAll(none), "neighbours")
    release(first, more, asked, low)

    def of(owners: DataFrame) -> DataFrame:
        pairs = owners.join(best, "qid").withColumn("near", F.filter("near", lambda x: ~F.coalesce(x["dst"] == F.col("src"), F.lit(False))))
        times = F.transform("near", lambda x: F.array_repeat(x, F.least(x["m"] * F.col("times"), F.lit(k))))
        return pairs.select("src", F.slice(F.flatten(times), 1, k).alias("near"))

    one = F.col("self").isNull() & F.col("src").isNotNull()  # its list is the only one of the source, and in order
    alone = of(owners.where(one)).select("src", F.posexplode("near").alias("_i", "_x")).select(
        "src", "_x.dst", "_x.score", (F.col("_i") + 1).alias("rank"))
    n_shared = owners.where(~one).count()
    if n_shared == 0:
        return alone
    w = Window.partitionBy("src").orderBy(F.round("score", RANK_DIGITS).desc(), F.col("dst").asc())
    shared = of(broadcast_if_small(owners.where(~one), n_shared)).select("src", F.inline("near")).select(
        "src", "dst", "score").withColumn("rank", F.row_number().over(w))
    return alone.unionAll(shared.where(F.col("rank") <= k))


def similar_items(neighbours: DataFrame, ids: DataFrame, k: int = 5,
                  id_col: str = "item_id", catalogue: DataFrame | None = None) -> DataFrame:
    """Neighbours of the requested ids (unknown id -> no rows), first ``k``;
    with a ``catalogue`` also the neighbour's name, category and rating."""
    req = ids.select(F.col(id_col).alias("src")).distinct()
    out = neighbours.join(req, "src", "left_semi").filter(F.col("rank") <= k)
    if catalogue is None:
        return out
    attrs = [F.col(c) if c in catalogue.columns else F.lit(None).cast(t).alias(c)
             for c, t in (("name", "string"), ("category", "string"), ("rating", "double"))]
    return out.join(catalogue.select(F.col("item_id").alias("dst"), *attrs), "dst", "left").select(
        *neighbours.columns, "name", "category", "rating")


def approx_neighbours(vectors: DataFrame, threshold: float = 0.5, bucket_length: float = 0.5,
                      num_tables: int = 3, id_col: str = "item_id",
                      features: str = "features", k: int | None = None) -> DataFrame:
    """Approximate option: random-projection LSH on unit vectors; pairs with
    euclidean distance below ``threshold`` (cosine = 1 - d^2 / 2). With ``k`` the
    best ``k`` per source, cut map-side before they are shuffled, with ``rank``."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    v = vectors.select(F.col(id_col).alias("item_id"),
                       array_to_vector(_unit(features)).alias("vec"))
    lsh = BucketedRandomProjectionLSH(inputCol="vec", outputCol="h",
                                      bucketLength=bucket_length, numHashTables=num_tables,
                                      seed=42).fit(v)
    j = lsh.approxSimilarityJoin(v, v, threshold, distCol="d")
    pairs = (j.select(F.col("datasetA.item_id").alias("src"), F.col("datasetB.item_id").alias("dst"),
                      (1 - F.col("d") * F.col("d") / 2).alias("score"))
             .filter(F.col("src") != F.col("dst")))
    if k is None:
        return pairs
    w = Window.partitionBy("src").orderBy(F.col("score").desc(), F.col("dst").asc())
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
