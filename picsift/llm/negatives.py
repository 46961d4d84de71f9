"""Hard-negative mining by Strassen products of integer tiles (operator 11).

Vectors become integers (floor of ``SCALE`` times each component).  Anchors and
candidates are cut into tiles of bounded size; the scores of a tile are one product of
int64 matrices by Strassen's recursion, whose blocks are padded with zero rows and
columns where a side is odd.  All its additions are exact: int64 sums are exact modulo
2^64, and a score fits (below).  Each tile gives, for every anchor, a heap of its best
candidates; heaps merge by keeping the best of their union, first within a tile as its
column strips are multiplied, then across tiles by a ranked limit that Spark applies
before and after the exchange.

Two passes, as a window is known only when its positive is: the first merges the
heaps of positives, the second, for each anchor and positive, the heap of
candidates of another label whose score lies in the positive's window.

Scale: the anchors are a stated query set held against all rows, in blocks.  A tile holds
``ANCHORS`` x ``CANDIDATES`` rows at most and multiplies strips of them, so memory is bounded.  Rows are
dealt to candidate blocks by a stored hash that has nothing to do with their id, label or vector, anchors
by a dense number, so a hot label or a vector that a third of the rows share changes no tile's size.
The heaps hold ``positives`` (``negatives`` for each positive) rows an anchor and tile.

Defined results: rows with a null id, label or vector, or any null or non-finite
component, take no part, nor do rows whose inner product with themselves does not fit
a long, since no score of theirs could be given.  Vectors of different lengths are padded with zeros; an empty vector is
all zeros.  A repeated row counts again as a positive and as a negative; equal
anchor rows (id, label and vector) are one anchor.  Rows with an anchor's own id are
never its positives.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.ranking import global_index
from .common import read, stored

#: The contract's values: scale of a component, positives of an anchor, negatives of a
#: positive, and the window's ends as hundredths of the positive's score.
SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 3, 50, 95
#: Rows of a tile at most; candidates of a block at least, where more blocks would only keep more tasks busy.
ANCHORS, CANDIDATES, FEWEST = 4096, 32768, 512
#: A side up to which blocks are multiplied plainly; anchors and candidates of one strip.
LEAF, STRIP = 16, (128, 4096)
_NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices, modulo 2^64."""
    rows, cols = a.shape[0], b.shape[1]
    if min(rows, a.shape[1], cols) <= leaf:
        return a @ b
    if rows % 2 or a.shape[1] % 2:
        a = np.pad(a, ((0, rows % 2), (0, a.shape[1] % 2)))
    if b.shape[0] % 2 or cols % 2:
        b = np.pad(b, ((0, b.shape[0] % 2), (0, cols % 2)))
    i, j, k = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    m1, m2 = strassen(a11 + a22, b11 + b22, leaf), strassen(a21 + a22, b11, leaf)
    m3, m4 = strassen(a11, b12 - b22, leaf), strassen(a22, b21 - b11, leaf)
    m5, m6 = strassen(a11 + a12, b22, leaf), strassen(a21 - a11, b11 + b12, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * k), dtype=np.int64)
    out[:i, :k] = m1 + m4 - m5 + m7
    out[:i, k:] = m3 + m5
    out[i:, :k] = m2 + m4
    out[i:, k:] = m1 - m2 + m3 + m6
    return out[:rows, :cols]


class Heaps:
    """For each of some anchors the best ``size`` (score, id): higher scores first, then smaller ids."""

    def __init__(self, anchors: int, size: int):
        self.scores = np.full((anchors, size), _NONE, dtype=np.int64)
        self.ids = np.zeros((anchors, size), dtype=np.int64)
        self.held = np.zeros((anchors, size), dtype=bool)

    def push(self, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Merge the allowed of the strip's candidates, whose ``ids`` ascend."""
        left = np.where(allowed, scores, _NONE)
        rows = np.arange(len(left))
        found = Heaps(len(left), self.scores.shape[1])
        for r in range(min(self.scores.shape[1], left.shape[1])):
            at = left.argmax(axis=1)                  # the first of equal scores: the smallest id
            best = left[rows, at]
            if r == 0 and not (best != _NONE).any():
                return
            found.scores[:, r], found.ids[:, r], found.held[:, r] = best, ids[at], best != _NONE
            left[rows, at] = _NONE
        self.merge(found)

    def merge(self, other: "Heaps") -> None:
        scores, ids, held = (np.concatenate([getattr(self, n), getattr(other, n)], axis=1) for n in ("scores", "ids", "held"))
        order = np.lexsort((ids, ~scores, ~held), axis=1)[:, :self.scores.shape[1]]     # ~x falls as x rises, without overflow
        self.scores, self.ids, self.held = (np.take_along_axis(x, order, axis=1) for x in (scores, ids, held))

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the anchor, score and id of all that is held."""
        anchor, slot = np.nonzero(self.held)
        return anchor, self.scores[anchor, slot], self.ids[anchor, slot]


def window_of(score: np.ndarray, low: int = LOW, high: int = HIGH) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest x with low * score <= 100 * x <= high * score, without overflow."""
    q, r = score // 100, score % 100
    return low * q - (-(low * r) // 100), high * q + high * r // 100


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    column = column.combine_chunks()
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _ints(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64)


def _tile(width: int, heap: Callable[[pa.Table], Callable]) -> Callable[[pa.Table], pa.Table]:
    """Function of one tile: anchors (side 0) and candidates (side 1).  ``heap(anchors)`` gives
    (push(at, scores, candidates), rows())."""
    def run(table: pa.Table) -> pa.Table:
        side = _ints(table["side"])
        anchors = table.filter(pa.array(side == 0))
        those = table.filter(pa.array(side == 1)).sort_by("id")
        push, rows = heap(anchors)
        a, c = _matrix(anchors["v"], width), _matrix(those["v"], width)
        ids, labels = _ints(those["id"]), _ints(those["label"])
        for i in range(0, len(a), STRIP[0]):
            for j in range(0, len(c), STRIP[1]):
                scores = strassen(a[i:i + STRIP[0]], c[j:j + STRIP[1]].T)
                push(slice(i, i + STRIP[0]), scores, ids[j:j + STRIP[1]], labels[j:j + STRIP[1]])
        return rows()

    return run


def _positive_heaps(size: int):
    def make(anchors: pa.Table):
        number, own, labels = (_ints(anchors[c]) for c in ("anchor", "id", "label"))
        strips: dict[int, tuple[slice, Heaps]] = {}

        def push(at, scores, ids, other):
            heap = strips.setdefault(at.start, (at, Heaps(len(scores), size)))[1]
            heap.push(scores, (labels[at, None] == other) & (own[at, None] != ids), ids)

        def rows():
            got = [(number[at][row], score, found) for at, heap in strips.values() for row, score, found in [heap.rows()]]
            return pa.table([np.concatenate([g[i] for g in got] or [np.zeros(0, np.int64)]) for i in range(3)],
                            names=["anchor", "score", "found"])

        return push, rows
    return make


def _negative_heaps(size: int, low: int, high: int):
    def make(anchors: pa.Table):
        number, labels = _ints(anchors["anchor"]), _ints(anchors["label"])
        held = anchors["windows"].combine_chunks()
        counts = held.value_lengths().to_numpy(zero_copy_only=False)
        scores_of = np.zeros((len(counts), int(counts.max(initial=0))), dtype=np.int64)
        there = np.arange(scores_of.shape[1]) < counts[:, None]
        scores_of[there] = held.flatten().to_numpy(zero_copy_only=False)
        least, most = window_of(scores_of, low, high)
        strips: dict[tuple[int, int], tuple[slice, Heaps]] = {}

        def push(at, scores, ids, other):
            unlike = labels[at, None] != other
            bottom = np.where(there[at], least[at], np.iinfo(np.int64).max).min(axis=1)
            unlike &= scores >= bottom[:, None]
            if not unlike.any():
                return
            for k in range(there.shape[1]):
                allowed = unlike & (scores <= most[at, k, None]) & (scores >= least[at, k, None]) & there[at, k, None]
                strips.setdefault((at.start, k), (at, Heaps(len(scores), size)))[1].push(scores, allowed, ids)

        def rows():
            got = [(number[at][row], np.full(len(row), k), score, found)
                   for (_, k), (at, heap) in strips.items() for row, score, found in [heap.rows()]]
            return pa.table([np.concatenate([g[i] for g in got] or [np.zeros(0, np.int64)]) for i in range(4)],
                            names=["anchor", "positive", "score", "found"])

        return push, rows
    return make


def _best(heaps: DataFrame, keys: list[str], size: int) -> DataFrame:
    """The heaps of all tiles merged: rank 1 is the best."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "found")
    return heaps.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


def integers(df: DataFrame, vec_id: str, vec: str, label: str, scale: int = SCALE) -> DataFrame:
    """(id, label, v): the rows that take part, their vectors as integers."""
    x = F.transform(F.col(vec), lambda c: F.floor(F.lit(scale) * c.cast("double")))
    finite = F.forall(F.col(vec), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float(1 << 32))))
    rows = (df.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vec).alias("own"),
                      F.when(finite, x).alias("v"))
            .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()))
    square = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    return rows.filter(square < F.lit(float(1 << 62))).select("id", "label", "v")


def mine(df: DataFrame, anchor: Column, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
         anchor_rows: int = ANCHORS, candidate_rows: int = CANDIDATES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of ``df``
    for which ``anchor`` (a column over id and label) holds."""
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # stored: the hash that deals the rows must be the same whoever reads them
    rows = stored(integers(df, vec_id, vec, label, scale).withColumn("dealt", F.xxhash64(F.monotonically_increasing_id())))
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
    width = seen.width or 1
    blocks = max(-(-seen.n // candidate_rows), min(-(-seen.n // FEWEST), partitions), 1)
    chosen = rows.filter(anchor).select("id", "label", "v").dropDuplicates()
    anchors = stored(global_index(chosen.withColumn("h", F.xxhash64("v")), ["id", "label", "h"], out="anchor").drop("h"))
    groups = max(1, -(-anchors.count() // anchor_rows))

    def tiles(held: DataFrame, extra: list[str]) -> DataFrame:
        none = [F.lit(None).cast(held.schema[c].dataType).alias(c) for c in extra]
        left = (held.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
                .select(((F.col("anchor") % groups) * blocks + F.col("block")).cast("int").alias("tile"), F.lit(0).alias("side"),
                        "anchor", "id", "label", "v", *extra))
        right = (rows.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
                 .select((F.col("group") * blocks + F.pmod("dealt", F.lit(blocks))).cast("int").alias("tile"), F.lit(1).alias("side"),
                         F.lit(-1).cast("long").alias("anchor"), "id", "label", "v", *none))
        return left.unionByName(right).repartitionById(min(groups * blocks, 4 * max(partitions, blocks)), "tile").groupBy("tile")

    heaps = tiles(anchors, []).applyInArrow(_tile(width, _positive_heaps(positives)), "anchor long, score long, found long")
    best = stored(_best(heaps, ["anchor"], positives))
    windows = best.groupBy("anchor").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda s: s["score"]).alias("windows"))
    asked = stored(anchors.join(windows, "anchor"))          # anchors without a positive have no window
    heaps = tiles(asked, ["windows"]).applyInArrow(_tile(width, _negative_heaps(negatives, low, high)),
                                                   "anchor long, positive long, score long, found long")
    found = _best(heaps, ["anchor", "positive"], negatives).withColumnsRenamed(
        {"found": "negative_id", "score": "negative_score", "rank": "negative_rank"})
    of = best.select("anchor", (F.col("rank") - 1).cast("long").alias("positive"), F.col("found").alias("positive_id"),
                     F.col("score").alias("positive_score"))
    return (found.join(of, ["anchor", "positive"]).join(anchors.select("anchor", F.col("id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", F.col("negative_rank").cast("int").alias("rank"), "negative_id",
                    "positive_score", "negative_score"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors: ids divisible by 50; ids divisible by 7 have the next label of ten."""
    rows = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("id") % 50 == 0)


OP11_SQL = """
WITH usable AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = e.label AS alike, e.vec_id AS other_id,
         CAST(list_inner_product(a.v, e.v) AS BIGINT) AS score
  FROM usable a, usable e WHERE a.vec_id % 50 = 0 AND a.vec_id <> e.vec_id),
positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.alike
 AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
