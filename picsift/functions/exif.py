"""Capture-date and camera fields from an EXIF tag map.

The tag map is ``map<string,string>``: a key is present only when the file
carries the tag.  ``coalesce`` over the lookups therefore returns the first
*present* tag, so a present-but-unusable tag stops the search as it should.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..params import DATE_TAGS, MAKE_TAG, MODEL_TAG
from .text import strip


def capture_date(tags: Column) -> Column:
    """'2018:06:15 10:23:45' -> '2018-06-15T10:23:45'; NULL unless the first
    present date tag starts with a digit after stripping."""
    raw = strip(F.coalesce(*[F.element_at(tags, F.lit(t)) for t in DATE_TAGS]))
    iso = F.concat(F.translate(F.substring(raw, 1, 10), ":", "-"), F.lit("T"),
                   F.substring(raw, 12, 1 << 30))
    return F.when(raw.rlike(r"^\p{Nd}"), iso)


def camera_make(tags: Column) -> Column:
    return strip(F.element_at(tags, F.lit(MAKE_TAG)))


def camera_model(tags: Column) -> Column:
    return strip(F.element_at(tags, F.lit(MODEL_TAG)))
