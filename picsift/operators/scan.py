"""Scan decisions (P1) and scan counters (A3).

Input: one row per listed file with ``path``, ``decode_ok``, ``width``,
``height``, ``tags`` (EXIF map) and ``sha256`` (content hash).  Output: the
``images`` base table.  Later-phase columns given in ``keep`` pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exif import camera_make, camera_model, capture_date
from ..params import CORRUPT, DEFAULT, OK, TINY, Params


def scan_status(files: DataFrame, p: Params = DEFAULT, keep: tuple = ()) -> DataFrame:
    w, h = F.col("width"), F.col("height")
    decoded = F.col("decode_ok")
    status = F.when(~decoded, F.lit(CORRUPT))
    if p.check_brightness and "lum" in files.columns:
        # P13 (opt-in): ``lum`` = struct(mean, std) of the luminance
        status = status.when((F.col("lum.mean") < p.min_brightness) | (F.col("lum.std") < p.min_std),
                             F.lit(CORRUPT))
    status = status.when((w < p.min_width) | (h < p.min_height), F.lit(TINY)).otherwise(F.lit(OK))
    ok = status == OK
    # corrupt rows carry no size; tiny rows carry size but no tags or hash
    return files.select(
        "path",
        status.alias("status"),
        F.when(decoded, w).alias("width"),
        F.when(decoded, h).alias("height"),
        F.when(ok, capture_date(F.col("tags"))).alias("date_taken"),
        F.when(ok, camera_make(F.col("tags"))).alias("camera_make"),
        F.when(ok, camera_model(F.col("tags"))).alias("camera_model"),
        F.when(ok, F.col("sha256")).alias("sha256"),
        *keep,
        *(["reason"] if "reason" in files.columns else []),
    )


def scan_totals() -> list[Column]:
    """The counters as aggregates over ``status``; they also fit ``observe`` on the rows of a scan."""
    s = F.col("status")
    return [F.count(F.lit(1)).alias("files_found"), F.count_if(s == OK).alias("ok"),
            F.count_if(s == TINY).alias("tiny"), F.count_if(s == CORRUPT).alias("corrupt")]


def scan_counters(images: DataFrame) -> DataFrame:
    return images.agg(*scan_totals())
