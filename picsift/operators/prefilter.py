"""Thin out a large table to rows whose key is probably wanted, before costly
work on them and without shuffling them.

The wanted keys set bits of a bitmap of bounded size, which is broadcast; a row
whose bit is not set cannot be wanted.  No wanted row is lost; the few others are removed by
the exact join that follows, on rows that are small by then.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: Bits for each wanted key, and at most (32 MB).
BITS_PER_KEY, MAX_BITS = 16, 1 << 28


def keep_probable(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` has its bit set by a key of ``wanted`` (one column)."""
    name = wanted.columns[0]
    bits = 1 << max(10, min(MAX_BITS.bit_length() - 1, (wanted.count() * BITS_PER_KEY).bit_length()))
    place = F.pmod(F.xxhash64(name), F.lit(bits))
    words = (wanted.select(F.floor(place / 64).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int")).alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("value")))
    table = np.zeros(bits >> 6, dtype=np.int64)
    for r in words.toLocalIterator():            # at most MAX_BITS / 64 rows
        table[r.word] = r.value
    sent = df.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def probable(at: pd.Series) -> pd.Series:
        at = at.to_numpy(dtype=np.int64)
        return pd.Series((sent.value[at >> 6] >> (at & 63) & 1).astype(bool))

    return df.filter(probable(F.pmod(F.xxhash64(key), F.lit(bits))))
