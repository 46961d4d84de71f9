"""Keyed upsert of stage rows into the images table.

A row may set only some columns (a corrupt file only sets its status).
Each update row carries ``provided``: the names of the columns it sets.
Existing rows keep every column the update does not provide; new rows take
the table defaults for those columns.  One full outer join on the key, no
per-row statements; on a table format with MERGE the same rule is a
``mergeInto(...).whenMatched().update(...).whenNotMatched().insert(...)``.

``upsert_stored`` merges into a stored table whose rows are dealt to buckets by a hash of their
key: only the buckets that an update falls into are read and written, by a dynamic partition overwrite, which replaces
them when the whole job has succeeded; a job that fails before leaves every old row in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..params import OK
from ..session import cut_lineage

DEFAULTS = {"status": OK, "face_cluster_id": -1, "face_scanned": False}


def upsert(base: DataFrame, updates: DataFrame, key: str = "path", defaults: dict | None = None) -> DataFrame:
    defaults = DEFAULTS if defaults is None else defaults
    cols = [c for c in base.columns if c != key]
    b = base.select(key, *[F.col(c).alias("_b_" + c) for c in cols], F.lit(True).alias("_in_base"))
    ucols = [c for c in updates.columns if c not in (key, "provided")]
    u = updates.select(key, "provided", *[F.col(c).alias("_u_" + c) for c in ucols])
    j = b.join(u, key, "full_outer")
    out = []
    for c in cols:
        old = F.when(F.col("_in_base").isNotNull(), F.col("_b_" + c))
        if c in defaults:
            old = F.when(F.col("_in_base").isNotNull(), F.col("_b_" + c)).otherwise(F.lit(defaults[c]))
        if c in ucols:
            val = F.when(F.array_contains(F.col("provided"), F.lit(c)), F.col("_u_" + c)).otherwise(old)
        else:
            val = old
        out.append(val.cast(base.schema[c].dataType).alias(c))
    return j.select(key, *out)


#: Buckets of a stored table unless it is made with another number.
BUCKETS = 64


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def store_bucketed(base: DataFrame, path: str, key: str = "path", buckets: int = BUCKETS) -> None:
    """Write ``base`` as a new table for ``upsert_stored``: one folder for each bucket."""
    base.withColumn("bucket", bucket_of(F.col(key), buckets)).repartition("bucket").write.partitionBy("bucket").parquet(path)


def read_bucketed(spark, path: str, schema: str) -> DataFrame:
    """The stored table, without its bucket column; ``schema``: its columns, for a table that may be empty."""
    return spark.read.schema(f"{schema}, bucket int").parquet(path).drop("bucket")


def upsert_stored(updates: DataFrame, path: str, schema: str, key: str = "path", buckets: int = BUCKETS,
                  defaults: dict | None = None) -> list[int]:
    """Merge ``updates`` into the table that ``store_bucketed`` wrote, with the same number of
    buckets; the numbers of the buckets that were rewritten."""
    spark = updates.sparkSession
    updates = updates.withColumn("bucket", bucket_of(F.col(key), buckets))
    touched = sorted(r.bucket for r in updates.select("bucket").distinct().collect())      # at most ``buckets`` rows
    if not touched:
        return touched
    old = spark.read.schema(f"{schema}, bucket int").parquet(path).filter(F.col("bucket").isin(touched)).drop("bucket")    # pruned
    merged = upsert(old, updates.drop("bucket"), key, defaults).withColumn("bucket", bucket_of(F.col(key), buckets))
    # stored first: what is overwritten is also read
    (cut_lineage(merged).repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket").parquet(path))
    return touched


def scan_provided(status: F.Column) -> F.Column:
    """Columns a scan row sets, by scan status (phase-1 row shapes)."""
    return (F.when(status == "deleted_corrupt", F.array(F.lit("status")))
             .when(status == "deleted_tiny", F.array(*map(F.lit, ["status", "width", "height"])))
             .otherwise(F.array(*map(F.lit, ["status", "width", "height", "date_taken", "camera_make",
                                             "camera_model", "sha256"]))))
