"""Processed-ledger for incremental runs (P4, S8e).

A job that must not redo work keeps a ledger of keys it already attempted
(successful or not).  The next run takes the anti-join; after the run the
attempted keys are appended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def unprocessed(rows: DataFrame, ledger: DataFrame, key: str = "path") -> DataFrame:
    return rows.join(ledger.select(key), key, "left_anti")


def mark_processed(ledger: DataFrame, attempted: DataFrame, key: str = "path") -> DataFrame:
    return ledger.select(key).unionByName(attempted.select(key)).distinct()
