"""Status of each image across phases.

Each phase returns a decision table; the current status is derived, never
updated in place: scan status first, then exact, then near duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..params import EXACT_DUP, NEAR_DUP, OK


def current_images(images: DataFrame, exact: DataFrame | None = None,
                   near: DataFrame | None = None, near_key: str = "path") -> DataFrame:
    out = images
    status = F.col("status")
    if exact is not None:
        drop = exact.filter(~F.col("is_keeper")).select("path", F.lit(True).alias("_exact"))
        out = out.join(drop, "path", "left")
        status = F.when((status == OK) & F.col("_exact").isNotNull(), F.lit(EXACT_DUP)).otherwise(status)
    if near is not None:
        drop = near.filter(~F.col("is_keeper")).select(near_key, F.lit(True).alias("_near"))
        out = out.join(drop, near_key, "left")
        status = F.when((status == OK) & F.col("_near").isNotNull(), F.lit(NEAR_DUP)).otherwise(status)
    cols = [c for c in images.columns if c != "status"]
    return out.select(*cols[:1], status.alias("status"), *cols[1:])


def effective_path(images: DataFrame, listing: DataFrame) -> DataFrame:
    """Read a file from ``new_path`` when a file exists there (the layout
    was carried out), else from ``path``.  ``listing(path)`` is a file listing."""
    present = listing.select(F.col("path").alias("new_path"), F.lit(True).alias("_moved"))
    return (images.join(present, "new_path", "left")
                  .withColumn("read_path", F.when(F.col("_moved").isNotNull(), F.col("new_path"))
                                            .otherwise(F.col("path")))
                  .drop("_moved"))
