"""Connected components of an edge DataFrame.

Each partition first contracts its own edges: it keeps a spanning forest of them, as stars
around the smallest node of each part, whatever number of edges it reads.  If the stars of all
partitions are at most ``LOCAL`` edges, one task joins them, and that's all.  Otherwise large-star /
small-star rounds (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014) follow, and
between them edges are dealt by ranges of nodes, so that neighbouring nodes meet, and contracted again.  Every star step
is a grouped ``min``, which is combined map-side, and an equi-join on the node id; no component is
ever gathered into one task.  Where a node has more than ``HUB`` edges, which
the convergence test finds out on the way, the minima are stored before the
join: both its sides are plain shuffles then and AQE splits the hub's edges.
Each round is written to the shared checkpoint folder, which bounds the lineage
and makes a lost executor cost one round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage


#: Edges of one node from which its joins are prepared for splitting.
HUB = 100_000
#: Edges that one task may join at the end (two node ids each); edges of a partition that are contracted at a time.
LOCAL, STEP = 500_000, 1 << 18


def hook(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``parent`` (every row points to its root, the smallest of its part) with the parts of i and j joined."""
    while True:
        u, v = parent[i], parent[j]
        differ = u != v
        if not differ.any():
            return parent
        i, j, u, v = i[differ], j[differ], u[differ], v[differ]
        np.minimum.at(parent, np.maximum(u, v), np.minimum(u, v))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up


def _stars(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(root, node): stars with the components of the edges, around the smallest node of each."""
    nodes, at = np.unique(np.concatenate([lo, hi]), return_inverse=True)      # ascending: the least number is the least node
    parent = hook(np.arange(len(nodes)), at[:len(lo)], at[len(lo):])
    moved = parent != np.arange(len(nodes))
    return nodes[parent[moved]], nodes[moved]


def local_forest(edges: DataFrame) -> DataFrame:
    """Edges (lo, hi) with the components of ``edges``: those of each partition contracted to stars."""
    numbers = dict(edges.dtypes)["lo"] in ("bigint", "int", "smallint", "tinyint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], []]
        rows, kind = 0, None

        def contract():
            lo, hi = _stars(*(np.concatenate(h) for h in held))
            held[0], held[1] = [lo], [hi]
            return len(lo)

        most = STEP
        for batch in batches:
            kind = batch.schema
            for h, column in zip(held, batch.columns):
                h.append(column.to_numpy(zero_copy_only=False) if numbers else np.array(column.to_pylist(), dtype=object))
            rows += batch.num_rows
            if rows > most:
                rows = contract()
                most = max(STEP, 2 * rows)           # a forest is as large as its nodes: work stays in proportion
        if rows:
            contract()
            yield pa.RecordBatch.from_arrays([pa.array(h[0], f.type) for h, f in zip(held, kind)], schema=kind)

    return edges.select("lo", "hi").mapInArrow(run, edges.select("lo", "hi").schema)


def _large_star(e: DataFrame, hub: bool = False) -> DataFrame:
    both = (e.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
             .unionByName(e.select(F.col("hi").alias("u"), F.col("lo").alias("v"))))
    m = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    m = cut_lineage(m) if hub else m
    return (both.filter(F.col("v") > F.col("u")).join(m, "u")
                .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())


def _small_star(e: DataFrame, hub: bool = False) -> DataFrame:
    m = e.groupBy("hi").agg(F.min("lo").alias("m"))
    m = cut_lineage(m) if hub else m
    moved = (e.join(m, "hi").filter(F.col("lo") != F.col("m"))
              .select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
    own = m.select("hi", F.col("m").alias("lo"))
    return moved.unionByName(own).distinct()


def _state(e: DataFrame) -> tuple[bool, bool]:
    """Whether every node has one parent and every parent is a root, and
    whether a node has more than ``HUB`` edges (one shuffle, one job)."""
    u = (e.select(F.col("hi").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("par"))
          .unionByName(e.select(F.col("lo").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("par"))))
    nodes = u.groupBy("n").agg(F.sum("out").alias("out"), F.max("par").alias("par"), F.count(F.lit(1)).alias("edges"))
    bad = (F.col("out") > 1) | ((F.col("out") >= 1) & (F.col("par") == 1))
    r = nodes.agg(F.count_if(bad).alias("bad"), F.max("edges").alias("most")).first()
    return r.bad == 0, (r.most or 0) > HUB


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst",
                         max_rounds: int = 100, local: int = LOCAL, rounds: list | None = None) -> DataFrame:
    """``(node, root)`` for every node that touches an edge; ``root`` is the
    smallest node id of the component.  Node ids must be orderable.  ``rounds`` gets an entry for each star round."""
    e = (edges.select(F.least(src, dst).alias("lo"), F.greatest(src, dst).alias("hi"))
              .filter(F.col("lo").isNotNull() & (F.col("lo") != F.col("hi"))))
    e = cut_lineage(local_forest(e))
    done = 0
    if e.count() <= local:
        e = local_forest(e.repartition(1))
    else:
        e = cut_lineage(_by_ranges(e))
        while True:
            converged, hub = _state(e)
            if converged:
                break
            if done == max_rounds:
                raise RuntimeError("connected components did not converge")
            large = _large_star(e, hub)
            e = cut_lineage(_by_ranges(_small_star(cut_lineage(large) if hub else large, hub)))
            done += 1
            if rounds is not None:
                rounds.append(done)
    roots = e.select(F.col("lo").alias("node")).distinct().withColumn("root", F.col("node"))
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)


def _by_ranges(e: DataFrame) -> DataFrame:
    """Contracted where nodes of one range meet; a hub's edges may lie in several ranges."""
    n = int(e.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return local_forest(e.repartitionByRange(n, "lo", "hi")).distinct()
