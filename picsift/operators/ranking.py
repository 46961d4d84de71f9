"""Order-based numbering without single-task windows (W5 fast path, W6).

A window ``PARTITION BY key ORDER BY x`` puts a whole key group into one
task; when one key holds a third of the rows that task holds a third of the
data.  Here rows are range-partitioned on ``(keys, order)`` instead, so a
hot key spreads over many partitions; each partition numbers its rows
locally and a tiny table of per-(partition, key) counts supplies the
offsets.  Keys must not be NULL and the order columns must be unique
within a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut_lineage


def _ranged(df: DataFrame, cols: list[str], partitions: int | None) -> DataFrame:
    """Range-partitioned, sorted rows tagged with their partition id and a
    position id.  Both ids are evaluated once and stored: the offsets table
    and the rows it is joined back to must see the same values, and two
    evaluations of a range-partitioned plan need not place rows identically."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
                         .withColumn("_pid", F.spark_partition_id())
                         .withColumn("_mid", F.monotonically_increasing_id()))


def rank_within(df: DataFrame, keys: list[str], order: list[str], out: str = "rn",
                partitions: int | None = None) -> DataFrame:
    """1-based position of each row inside its ``keys`` group by ``order``."""
    r = _ranged(df, keys + order, partitions)
    stats = r.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first"))
    # at most one row per partition for each key: this window is small
    w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    return (r.join(stats.select("_pid", *keys, "_off", "_first"), ["_pid", *keys])
             .withColumn(out, F.col("_off") + F.col("_mid") - F.col("_first") + 1)
             .drop("_pid", "_mid", "_off", "_first"))


def global_index(df: DataFrame, order: list[str], out: str = "idx",
                 partitions: int | None = None) -> DataFrame:
    """0-based position of each row in the total order ``order`` (dense ids)."""
    r = _ranged(df, order, partitions)
    stats = r.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: bounded by the partition count, safe to broadcast
    stats = stats.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    return (r.join(F.broadcast(stats.select("_pid", "_off", "_first")), "_pid")
             .withColumn(out, F.col("_off") + F.col("_mid") - F.col("_first"))
             .drop("_pid", "_mid", "_off", "_first"))
