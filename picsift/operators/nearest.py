"""Which balls a top-k search has to visit.

The corpus is dealt to the nearest of a bounded sample of pivots.  In a first pass
each query visits its nearest balls until they hold k rows, which gives it a k-th best similarity.  A ball of radius
r whose pivot is at angle a holds nothing more similar than cos(a - r) (triangle inequality), so the
second pass visits only the balls whose bound reaches the k-th best.  Rows of the other balls are
never sent to meet the query.

Large balls are cut into blocks, and the queries that visit a block into groups, so that no task holds more than
two blocks.  The driver sees the pivots and a row of statistics for each ball.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .balls import SLACK, SLICE, UNIT, _angles, _matrix

#: Pivots at most, and rows for each pivot at least.
PIVOTS, ROWS_PER_PIVOT = 1024, 64


class Corpus:
    """Rows (_k, _v) dealt to balls; ``usable`` unless some row has no unit length."""

    def __init__(self, rows: DataFrame, n: int, block_rows: int, pivots: int = PIVOTS):
        self.spark, self.block_rows, self.n = rows.sparkSession, block_rows, n
        sample = rows.select("_v").orderBy(F.xxhash64("_k"), "_k").limit(max(1, min(pivots, n // ROWS_PER_PIVOT))).collect()
        self.centres = np.unique(np.array([r["_v"] for r in sample], dtype=np.float64), axis=0)
        sent = self.spark.sparkContext.broadcast(self.centres)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, SLICE):
                    part = batch.slice(start, SLICE)
                    x = _matrix(part.column(1))
                    angle = _angles(x, sent.value)
                    own = angle.argmin(axis=1)
                    off = np.abs(np.linalg.norm(x, axis=1) - 1)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(own.astype(np.int32)), pa.array(angle[np.arange(len(x)), own]), pa.array(off)],
                                                     names=["_k", "_v", "_ball", "_angle", "_off"])

        self.rows = cut_lineage(rows.select("_k", "_v").mapInArrow(assign, "_k long, _v array<double>, _ball int, _angle double, _off double"))
        info = (self.rows.groupBy("_ball").agg(F.count(F.lit(1)).alias("n"), F.max("_angle").alias("radius"), F.max("_off").alias("off"))
                .collect())                                                 # a row for each pivot
        self.usable = bool(info) and np.abs(np.linalg.norm(self.centres, axis=1) - 1).max() <= UNIT and max(r.off for r in info) <= UNIT
        self.members, self.radius = np.zeros(len(self.centres), dtype=np.int64), np.zeros(len(self.centres))
        for r in info:
            self.members[r["_ball"]], self.radius[r["_ball"]] = r.n, r.radius
        self.blocks = -(-self.members // block_rows)


def first_balls(queries: DataFrame, corpus: Corpus, k: int) -> DataFrame:
    """Queries (_k, _v) with ``visited``, their nearest balls that hold ``k`` rows; stored, as the second pass leaves these out."""
    sent = corpus.spark.sparkContext.broadcast((corpus.centres, corpus.members))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, members = sent.value
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                order = np.argsort(_directions(part.column(1), centres), axis=1, kind="stable")
                enough = (np.cumsum(members[order], axis=1) < k).sum(axis=1) + 1
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([o[:e].tolist() for o, e in zip(order, enough)], pa.list_(pa.int32()))],
                                                 names=["_k", "_v", "visited"])

    return cut_lineage(queries.select("_k", "_v").mapInArrow(run, "_k long, _v array<double>, visited array<int>"))


def _directions(column: pa.Array, centres: np.ndarray) -> np.ndarray:
    """Angles of the rows, of any length, to the pivots; a zero row is at a right angle to all."""
    x = _matrix(column)
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return _angles(x / np.where(length > 0, length, 1), centres)


def further_balls(queries: DataFrame, corpus: Corpus) -> DataFrame:
    """Queries (_k, _v, visited, bound) -> (_k, _v, visited): the other balls that may hold a row as similar as
    ``bound`` (null: any row)."""
    sent = corpus.spark.sparkContext.broadcast((corpus.centres, corpus.members, corpus.radius))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, members, radius = sent.value
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                x = _matrix(part.column(1))
                length = np.linalg.norm(x, axis=1)
                best = np.cos(np.maximum(_directions(part.column(1), centres) - radius - SLACK, 0)) * length[:, None]
                bound = part.column(3).to_numpy(zero_copy_only=False).astype(np.float64)
                wanted = (best + 1e-9 * (1 + length[:, None]) >= np.where(np.isnan(bound), -np.inf, bound)[:, None]) & (members > 0)
                for i, seen in enumerate(part.column(2).to_pylist()):
                    wanted[i, seen] = False
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([np.flatnonzero(w).tolist() for w in wanted], pa.list_(pa.int32()))],
                                                 names=["_k", "_v", "visited"])

    return cut_lineage(queries.select("_k", "_v", "visited", "bound").mapInArrow(run, "_k long, _v array<double>, visited array<int>")
                       .filter(F.size("visited") > 0))


def visits(queries: DataFrame, corpus: Corpus) -> np.ndarray:
    """Queries that visit each ball."""
    out = np.zeros(len(corpus.centres), dtype=np.int64)
    for r in queries.select(F.explode("visited").alias("ball")).groupBy("ball").agg(F.count(F.lit(1)).alias("n")).collect():
        out[r.ball] = r.n
    return out


def copies(count: np.ndarray, corpus: Corpus) -> int:
    """Rows shipped when balls get ``count`` visits: each visit to each block, each block to each group of visitors."""
    groups = np.maximum(-(-count // corpus.block_rows), 0)
    return int((count * corpus.blocks + groups * corpus.members).sum())


def met(queries: DataFrame, count: np.ndarray, corpus: Corpus) -> DataFrame:
    """(_k, _v, _qb, _cb, _side): queries and corpus rows by the block and the group of visitors in which they meet."""
    groups = -(-count // corpus.block_rows)
    first = np.concatenate([[0], np.cumsum(corpus.blocks)[:-1]])
    plan = corpus.spark.createDataFrame([(i, int(g), int(b), int(f)) for i, (g, b, f) in enumerate(zip(groups, corpus.blocks, first)) if g],
                                        "ball int, groups int, blocks int, first int")        # a row for each pivot at most
    plan = F.broadcast(plan)
    q = (queries.select("_k", "_v", F.explode("visited").alias("ball")).join(plan, "ball")
         .withColumn("_qb", F.pmod(F.xxhash64("_k", F.lit(7)), F.col("groups")).cast("int"))
         .withColumn("_cb", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("blocks") - 1)))
         .select("_k", "_v", "_qb", "_cb", F.lit(0).alias("_side")))
    c = (corpus.rows.select("_k", "_v", F.col("_ball").alias("ball")).join(plan, "ball")
         .withColumn("_cb", (F.col("first") + F.pmod(F.xxhash64("_k"), F.col("blocks"))).cast("int"))
         .withColumn("_qb", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
         .select("_k", "_v", "_qb", "_cb", F.lit(1).alias("_side")))
    return q.unionByName(c)
