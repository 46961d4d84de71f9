"""File ingest.

* ``list_files``: recursive listing of ``.jpg``/``.jpeg`` files (any case)
  through the ``binaryFile`` source; only ``path``/``length`` are selected, so
  Spark never reads file bytes for it.
* ``decode_images``: Spark's built-in ``image`` source (JVM decoder) with
  ``dropInvalid=false``: an undecodable file comes back with width -1.
* ``scan_input``: listing + decode result + SHA-256 of the bytes + EXIF tag
  map, the input of ``operators.scan.scan_status``.

Spark skips files whose names start with ``_`` or ``.``, which a plain
directory walk would include; that is a known difference.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

JPEG_SUFFIX = r"(?i)\.jpe?g$"


def local_path(c: Column) -> Column:
    """``file:/x`` and ``file:///x`` -> ``/x``; other URIs unchanged."""
    return F.regexp_replace(c, r"^file:/+", "/")


def list_files(spark: SparkSession, root: str, exclude: str | None = None) -> DataFrame:
    """``(path, length, modificationTime)`` of every JPEG under ``root``;
    ``exclude`` drops an output tree that lives inside the source."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
               .select(local_path(F.col("path")).alias("path"), "length", "modificationTime")
               .filter(F.col("path").rlike(JPEG_SUFFIX)))
    if exclude:
        df = df.filter(~F.col("path").startswith(exclude.rstrip("/") + "/"))
    return df


def decode_images(spark: SparkSession, root: str) -> DataFrame:
    """S3: ``(path, decode_ok, width, height, n_channels, data)``."""
    img = (spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", "true")
                .option("ignoreCorruptFiles", "true").load(root))
    return img.select(local_path(F.col("image.origin")).alias("path"),
                      (F.col("image.width") >= 0).alias("decode_ok"),
                      F.col("image.width").alias("width"), F.col("image.height").alias("height"),
                      F.col("image.nChannels").alias("n_channels"), F.col("image.data").alias("data"))


TagReader = Callable[[bytes], dict]

def no_tags(_: bytes) -> dict:
    return {}


def tag_map_udf(reader: TagReader):
    """Wrap a ``bytes -> {tag: text}`` reader (errors -> empty map) as an
    Arrow-batched UDF returning ``map<string,string>``."""
    @F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
    def read_tags(content: pd.Series) -> pd.Series:
        out = []
        for b in content:
            try:
                tags = reader(bytes(b)) if b is not None else {}
            except Exception:
                tags = {}
            out.append({str(k): str(v) for k, v in tags.items()})
        return pd.Series(out)
    return read_tags


def scan_input(spark: SparkSession, root: str, tag_reader: TagReader = no_tags,
               exclude: str | None = None, pixel_stats: bool = False) -> DataFrame:
    """Scan rows ``(path, decode_ok, width, height, tags, sha256)`` for every
    listed JPEG.  Hash (JVM ``sha2``) and tags come from the whole content in
    the task that reads the file; what is joined by path is the hash, the tags
    and the size, never bytes or pixels."""
    listing = list_files(spark, root, exclude)
    dec = decode_images(spark, root)
    extra = [brightness(F.col("data"), F.col("height"), F.col("width"), F.col("n_channels")).alias("lum")] \
        if pixel_stats else []
    decoded = dec.select("path", "decode_ok", "width", "height", *extra)
    content = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                    .option("ignoreCorruptFiles", "true").load(root)
                    .select(local_path(F.col("path")).alias("path"), F.lit(True).alias("was_read"),
                            tag_map_udf(tag_reader)(F.col("content")).alias("all_tags"),
                            F.sha2(F.col("content"), 256).alias("all_sha256")))
    # a listed file the readers could not open is missing on the right: it
    # is reported (read_error) instead of failing the job
    rows = listing.select("path").join(decoded, "path", "left").join(content, "path", "left")
    readable = F.coalesce(F.col("decode_ok"), F.lit(False))
    reason = (F.when(F.col("decode_ok").isNull() | F.col("was_read").isNull(), F.lit("read_error"))
               .when(~F.col("decode_ok"), F.lit("undecodable")))
    return rows.select(
        "path", readable.alias("decode_ok"), "width", "height", reason.alias("reason"),
        F.when(readable, F.col("all_tags")).alias("tags"), F.when(readable, F.col("all_sha256")).alias("sha256"),
        *(["lum"] if pixel_stats else []))


def luminance_grid(rows: int = 8, cols: int = 9):
    """F6 input: ``rows x cols`` mean-luminance grid (BT.601 weights) of the
    decoded pixels, as ``array<double>``; NULL when the image did not decode."""
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def grid(data: pd.Series, h: pd.Series, w: pd.Series, c: pd.Series) -> pd.Series:
        out = []
        for d, hh, ww, cc in zip(data, h, w, c):
            if d is None or hh is None or hh <= 0 or ww <= 0:
                out.append(None)
                continue
            px = np.frombuffer(bytes(d), dtype=np.uint8).reshape(int(hh), int(ww), int(cc)).astype(np.float64)
            lum = px[..., 0] if cc == 1 else 0.114 * px[..., 0] + 0.587 * px[..., 1] + 0.299 * px[..., 2]  # BGR
            ys = np.linspace(0, hh, rows + 1).astype(int)
            xs = np.linspace(0, ww, cols + 1).astype(int)
            g = [lum[ys[i]:max(ys[i + 1], ys[i] + 1), xs[j]:max(xs[j + 1], xs[j] + 1)].mean()
                 for i in range(rows) for j in range(cols)]
            out.append(g)
        return pd.Series(out)
    return grid


@F.pandas_udf(T.StructType([T.StructField("mean", T.DoubleType()), T.StructField("std", T.DoubleType())]))
def brightness(data: pd.Series, h: pd.Series, w: pd.Series, c: pd.Series) -> pd.DataFrame:
    """P13 (opt-in): mean and standard deviation of the luminance."""
    means, stds = [], []
    for d, hh, ww, cc in zip(data, h, w, c):
        if d is None or hh is None or hh <= 0 or ww <= 0:
            means.append(None)
            stds.append(None)
            continue
        px = np.frombuffer(bytes(d), dtype=np.uint8).reshape(int(hh), int(ww), int(cc)).astype(np.float64)
        lum = px[..., 0] if cc == 1 else 0.114 * px[..., 0] + 0.587 * px[..., 1] + 0.299 * px[..., 2]
        means.append(float(lum.mean()))
        stds.append(float(lum.std()))
    return pd.DataFrame({"mean": means, "std": stds})
