"""Text helpers shared by the metadata and layout functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def strip(c: Column) -> Column:
    """Remove leading/trailing whitespace of any kind (``trim`` only removes
    spaces): Unicode white space plus the four information separators
    U+001C..U+001F, which Python's ``str.strip`` also removes."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
