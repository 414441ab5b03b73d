"""Blocks of near vectors, and which of them a query vector can need.

A tree of axis cuts at medians of a sample (``PER_CELL`` vectors for each cell, at most
``MAX_CELLS`` cells) deals vectors to cells; a cell with more than two blocks' rows is
dealt by hash, a zero vector is a cell of its own. The sample decides how near the vectors
of a block are, never a result: bounds come from all vectors of a block. They are its box
(no product exceeds q+ . high + q- . low), its ball (q . centre + |q| radius), and the
distances to both: q . x = (|q|^2 + |x|^2 - |q - x|^2) / 2. The driver holds the
sample and one bound per block. ``Near`` does the same inside a block.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanderrank.session import materialise, release

PER_CELL = 32
MAX_CELLS = 4096
SUB = 64             # rows of a cell inside a block
FEW = 64             # query rows looked up at once, where they are near
BOX_DIMS = 32        # with more entries the ball alone bounds a cell inside a block
PAIRS = 1 << 18      # entries (query, block, dimension) compared at once


def cut_tree(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(dimension, threshold) of the inner nodes of a full tree, numbered from 1 (children
    of i: 2i and 2i + 1). A node that cannot be cut sends everything left."""
    dim, at = np.zeros(1 << depth, dtype=np.int64), np.full(1 << depth, np.inf)
    rows = {1: sample}
    for node in range(1, 1 << depth):
        x = rows.pop(node, sample[:0])
        if len(x) > 1 and (spread := x.var(axis=0)).max() > 0:
            d = int(spread.argmax())
            low = np.median(x[:, d])
            if low >= x[:, d].max():
                low = x[:, d][x[:, d] < x[:, d].max()].max()
            dim[node], at[node] = d, low
            right = x[:, d] > low
            rows[2 * node], rows[2 * node + 1] = x[~right], x[right]
        else:
            rows[2 * node] = x
    return dim, at


def _cells(x: np.ndarray, dim: np.ndarray, at: np.ndarray) -> np.ndarray:
    node = np.ones(len(x), dtype=np.int64)
    for _ in range(int(len(dim)).bit_length() - 1):
        node = 2 * node + (x[np.arange(len(x)), dim[node]] > at[node])
    return node - len(dim)


def _bounds(key, t: pd.DataFrame) -> pd.DataFrame:
    x = np.stack(t["u"].to_numpy())
    centre = x.mean(axis=0)
    return pd.DataFrame({"block": [key[0]], "low": [x.min(axis=0)], "high": [x.max(axis=0)], "centre": [centre],
                         "radius": [float(np.sqrt(((x - centre) ** 2).sum(axis=1).max()))],
                         "most": [float((x ** 2).sum(axis=1).max())]})


def matrix(column) -> np.ndarray:
    """An Arrow column of arrays of one length, a row each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _by_ball(q: np.ndarray, centre: np.ndarray, radius: np.ndarray, most: np.ndarray) -> np.ndarray:
    """[rows x balls]: the most that a vector of the ball, of a squared norm up to ``most``, can score."""
    inner, square = q @ centre.T, (q ** 2).sum(axis=1)[:, None]
    away = np.sqrt(np.maximum(square + (centre ** 2).sum(axis=1)[None, :] - 2 * inner, 0)) - radius[None, :]
    return np.minimum(inner + np.sqrt(square) * radius[None, :], (square + most[None, :] - np.maximum(away, 0) ** 2) / 2)


def _by_box(q: np.ndarray, low: np.ndarray, high: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The same for boxes; shapes [.., dimensions] that go together."""
    away = np.maximum(np.maximum(low - q, q - high), 0)
    return ((q ** 2).sum(axis=-1) + most - (away ** 2).sum(axis=-1)) / 2


class Near:
    """The rows ``x`` of one block in cells of about ``SUB`` near ones, to score few of them per query."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.tree = cut_tree(x, max(0, math.ceil(math.log2(max(1, len(x)) / SUB))))
        cell = _cells(x, *self.tree)
        self.order = np.argsort(cell, kind="stable")
        self.starts = np.flatnonzero(np.diff(cell[self.order], prepend=-1))
        self.sizes = np.diff(np.append(self.starts, len(x)))
        rows = x[self.order]
        self.low, self.high = np.minimum.reduceat(rows, self.starts, axis=0), np.maximum.reduceat(rows, self.starts, axis=0)
        self.most = np.maximum.reduceat((rows ** 2).sum(axis=1), self.starts)
        self.centre = np.add.reduceat(rows, self.starts, axis=0) / self.sizes[:, None]
        far = ((rows - np.repeat(self.centre, self.sizes, axis=0)) ** 2).sum(axis=1)
        self.radius = np.sqrt(np.maximum.reduceat(far, self.starts))

    def chunks(self, q: np.ndarray, most: int):
        """Positions of ``q`` in pieces of ``most`` at most, near rows together."""
        cell = _cells(q, *self.tree)
        order, at = np.argsort(cell, kind="stable"), 0
        for end in np.append(np.flatnonzero(np.diff(cell[order])) + 1, len(q)):
            while end - at > most:
                yield order[at:at + most]
                at += most
            if end - at >= FEW or end == len(q) > at:
                yield order[at:end]
                at = end

    def _rows(self, cells: np.ndarray) -> np.ndarray:
        return np.concatenate([self.order[s:s + n] for s, n in zip(self.starts[cells], self.sizes[cells])])

    def reached(self, q: np.ndarray, floor: np.ndarray, lift: np.ndarray, k: int, slack: float):
        """(rows of ``x`` that may reach the floor of one of ``q``, the floors): a floor of a
        row where ``lift`` is true rises to its ``k``-th score in the nearest cells."""
        bound = _by_ball(q, self.centre, self.radius, self.most)
        if q.shape[1] <= BOX_DIMS:
            bound = np.minimum(bound, _by_box(q[:, None, :], self.low[None], self.high[None], self.most[None]))
        if len(self.sizes) > 1 and (lift & ~np.isfinite(floor)).any():
            best = np.argsort(-bound.sum(axis=0), kind="stable")
            few = best[:1 + int(np.searchsorted(np.cumsum(self.sizes[best]), max(2 * k, SUB)))]
            if (rows := self._rows(few)).size >= k:
                score = np.partition(q @ self.x[rows].T, rows.size - k, axis=1)[:, rows.size - k]
                floor = np.where(lift, np.maximum(floor, score), floor)
        keep = np.flatnonzero((bound >= floor[:, None] - slack).any(axis=0))
        return (self._rows(keep) if keep.size else self.order[:0]), floor


def blocks(vectors: DataFrame, u: str, key: str, block_rows: int):
    """``vectors`` (written; ``u`` array<double>, ``key`` long) -> the same with ``block``,
    written; ``assign(df)``: df with the block of its vector ``u``; ``reach(df, slack)``: df (block =
    the one visited, floor) with one row per other block whose bound reaches the floor."""
    spark = vectors.sparkSession
    n = vectors.count()
    want = max(1, math.ceil(n / block_rows))
    depth = min(MAX_CELLS.bit_length() - 1, max(0, math.ceil(math.log2(want))))
    tree = None
    if depth:
        step = max(1, n // (PER_CELL << depth))
        got = vectors.where(F.pmod(F.xxhash64(u), F.lit(step)) == 0).select(u).limit(2 * (PER_CELL << depth)).collect()
        sample = np.array([r[0] for r in got], dtype=float)
        if len(sample):
            tree = spark.sparkContext.broadcast(cut_tree(sample, depth))

    def with_cell(df: DataFrame) -> DataFrame:
        zero = ~F.exists(u, lambda x: x != 0)
        if tree is None:
            return df.withColumn("_cell", F.when(zero, -1).otherwise(0).cast("long"))

        @F.pandas_udf("long")
        def cell(x: pd.Series) -> pd.Series:
            return pd.Series(_cells(np.stack(x.to_numpy()), *tree.value) if len(x) else np.empty(0, np.int64))
        return df.withColumn("_cell", F.when(zero, F.lit(-1).cast("long")).otherwise(cell(u)))

    celled = materialise(with_cell(vectors), "cells")
    sizes = materialise(celled.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(2 * block_rows)).cast("int").alias("_w")), "cells")

    def numbered(df: DataFrame, by: str) -> DataFrame:  # one row of ``sizes`` per cell
        part = F.pmod(F.xxhash64(by), F.coalesce("_w", F.lit(1)))
        return df.join(F.broadcast(sizes), "_cell", "left").withColumn("block", F.col("_cell") * (1 << 32) + part).drop("_cell", "_w")

    out = materialise(numbered(celled, key), "blocks")
    release(celled)
    table = out.select("block", F.col(u).alias("u")).groupBy("block").applyInPandas(
        _bounds, "block long, low array<double>, high array<double>, centre array<double>, radius double, most double").collect()
    block = np.array([r["block"] for r in table], dtype=np.int64)
    shipped = spark.sparkContext.broadcast((block, *(np.array([r[c] for r in table], dtype=float)
                                                     for c in ("low", "high", "centre", "radius", "most"))))

    def assign(df: DataFrame) -> DataFrame:
        return numbered(with_cell(df), u)

    def reach(df: DataFrame, slack: float) -> DataFrame:
        names = [c for c in df.columns if c != "block"]
        schema = T.StructType([*df.select(*names).schema.fields, T.StructField("block", T.LongType())])

        def run(batches):
            block, low, high, centre, radius, most = shipped.value
            for b in batches:
                for at in range(0, b.num_rows, 1024):
                    part = b.slice(at, 1024)
                    q = matrix(part.column(u))
                    step = max(1, PAIRS // q.shape[1])
                    floor = part.column("floor").cast(pa.float64()).to_numpy(zero_copy_only=False)
                    floor = np.where(np.isnan(floor), -np.inf, floor) - slack
                    bound = np.minimum(np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T, _by_ball(q, centre, radius, most))
                    home = part.column("block").to_numpy(zero_copy_only=False)
                    rows, to = np.nonzero((bound >= floor[:, None]) & (block[None, :] != home[:, None]))
                    for x in range(0, len(rows), step):
                        i, j = rows[x:x + step], to[x:x + step]
                        ok = _by_box(q[i], low[j], high[j], most[j]) >= floor[i]
                        i, j = i[ok], j[ok]
                        for y in range(0, len(i), 4096):
                            out = part.select(names).take(pa.array(i[y:y + 4096]))
                            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(block[j[y:y + 4096]], pa.int64())], names=[*names, "block"])

        return df.select(*names, "block").mapInArrow(run, schema)

    return out, assign, reach
