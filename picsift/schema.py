"""Declared schema of the images table and additive migration.

Stage tables are Parquet; a table written by an older version may lack a
column added later.  ``conform`` adds every missing column with its default
(the additive migration) and orders columns as declared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

IMAGES = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("width", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("date_taken", T.StringType()),
    T.StructField("camera_make", T.StringType()),
    T.StructField("camera_model", T.StringType()),
    T.StructField("sha256", T.StringType()),
    T.StructField("phash", T.LongType()),
    T.StructField("category", T.StringType()),
    T.StructField("face_cluster_id", T.IntegerType()),
    T.StructField("new_path", T.StringType()),
    T.StructField("face_scanned", T.BooleanType()),
])

DEFAULTS = {"status": "ok", "face_cluster_id": -1, "face_scanned": False}


def conform(df: DataFrame, schema: T.StructType = IMAGES, defaults: dict | None = None) -> DataFrame:
    defaults = DEFAULTS if defaults is None else defaults
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            c = F.col(f.name).cast(f.dataType)
            if f.name in defaults:
                c = F.coalesce(c, F.lit(defaults[f.name]).cast(f.dataType))
        else:
            c = F.lit(defaults.get(f.name)).cast(f.dataType)
        cols.append(c.alias(f.name))
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    return df.select(*cols, *extra)
