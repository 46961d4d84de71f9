"""Exact duplicates by content hash.

The keeper of a hash group is the row with the largest pixel area, then the
earliest capture date with missing dates *last*, then the smallest path.
It is found with a grouped ``min`` over a struct sort key, which Spark
aggregates map-side, so a hash shared by a third of all files costs one
partial aggregate per task instead of one giant window partition.  The
members are then matched to their keeper with an equi-join on the hash.  Both
sides of that join are stored first: the table is read and hashed once, and
AQE can split a hash that many files share, which it can't where one side is
the aggregate itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..params import OK
from ..session import cut_lineage


def pixel_area(w: F.Column, h: F.Column) -> F.Column:
    """width*height with NULL as 0, in BIGINT (INT would overflow)."""
    return F.coalesce(w, F.lit(0)).cast("long") * F.coalesce(h, F.lit(0)).cast("long")


def exact_duplicates(images: DataFrame) -> DataFrame:
    """Rows of every hash group with more than one surviving member:
    ``path, sha256, keeper_path, is_keeper``."""
    d = F.col("date_taken")
    key = F.struct((-pixel_area(F.col("width"), F.col("height"))).alias("neg_area"),
                   d.isNull().alias("no_date"), F.coalesce(d, F.lit("")).alias("date"),
                   F.col("path").alias("path"))
    cand = cut_lineage(images.filter((F.col("status") == OK) & F.col("sha256").isNotNull())
                             .select("path", "sha256", key.alias("key")))
    groups = cut_lineage(cand.groupBy("sha256")
                             .agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("best"))
                             .filter(F.col("n") > 1)
                             .select("sha256", F.col("best.path").alias("keeper_path")))
    return (cand.select("path", "sha256").join(groups, "sha256")
                .select("path", "sha256", "keeper_path",
                        (F.col("path") == F.col("keeper_path")).alias("is_keeper")))


def exact_dedup_stats(dups: DataFrame) -> DataFrame:
    return dups.agg(F.count_distinct("sha256").alias("groups"),
                    F.count_if(~F.col("is_keeper")).alias("files_removed"))
