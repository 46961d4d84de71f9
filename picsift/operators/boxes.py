"""Detection boxes (P5, P6, F23): confidence filter, integer truncation,
clamping to the image, empty boxes dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..params import DEFAULT, Params


def clip_boxes(boxes: DataFrame, p: Params = DEFAULT, keep: tuple = ()) -> DataFrame:
    """``boxes(face_id, x1, y1, x2, y2, conf, img_w, img_h)`` -> integer boxes
    inside the image, only for confident, non-empty detections (``keep``
    columns pass through)."""
    t = lambda c: F.col(c).cast("int")   # noqa: E731  (cast truncates toward zero)
    out = boxes.filter(F.col("conf") >= p.face_conf_threshold).select(
        "face_id", *keep,
        F.greatest(F.lit(0), t("x1")).alias("x1"),
        F.greatest(F.lit(0), t("y1")).alias("y1"),
        F.least(F.col("img_w").cast("int"), t("x2")).alias("x2"),
        F.least(F.col("img_h").cast("int"), t("y2")).alias("y2"))
    return out.filter((F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1")))
