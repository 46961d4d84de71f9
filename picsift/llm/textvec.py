"""Hashed TF-IDF over whole texts: document frequencies of all rows and the
sparse vectors of a bounded labelled sample, from one pass over the table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import portions, stored

#: Bytes of a text that are turned into features at a time; terms across a cut count on one side.
CUT = 1 << 20

Counts = tuple[np.ndarray, np.ndarray]      # feature numbers (ascending), weights before IDF

_SCHEMA = "text_key string, target string, idx binary, val binary"


@dataclass
class Sample:
    """Documents seen, document frequency by feature, and the labelled rows'
    sparse vectors in order of their text's hash."""

    rows: int
    df: np.ndarray
    keys: list[str]
    targets: list[str]
    vectors: list[Counts]

    @property
    def idf(self) -> np.ndarray:
        return (np.log((1 + self.rows) / (1 + self.df)) + 1).astype(np.float32)


def share(key: Column, part: float, seed: int) -> Column:
    """Whether a row is among a ``part`` of all rows, decided by its key."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) < int(part * (1 << 30))


def gather(df: DataFrame, text: Column, target: Column, counted: Column,
           make: Callable[[], Callable[[str], Counts]], dim: int, most: int) -> Sample:
    """Document frequencies of the rows with ``counted`` and the vectors of the rows
    whose ``target`` (a string) is not null, at most ``most`` different texts.

    One task emits its partial frequencies once and its part of the sample; both
    are stored, the frequencies are summed by feature (``dim`` rows at most) and the
    sample, one row for each different text, is cut to ``most`` by the text's hash.
    Equal texts with different targets give a row for each target.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        total, rows = np.zeros(dim, dtype=np.int64), 0
        names = ["text_key", "target", "idx", "val"]
        types = [pa.string(), pa.string(), pa.binary(), pa.binary()]
        for batch in batches:
            out: list[list] = [[], [], [], []]
            targets, counts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for first, texts in portions(batch.column(0)):
                for i, t in enumerate(texts, first):
                    idx, val = function(t or "")
                    if counts[i]:
                        total[idx] += 1
                        rows += 1
                    if targets[i] is not None:
                        key = hashlib.md5((t or "").encode("utf-8", "surrogatepass")).hexdigest()
                        for column, x in zip(out, (key, targets[i], idx.astype("<i4").tobytes(), val.astype("<f4").tobytes())):
                            column.append(x)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], names=names)
        if rows:
            at = np.flatnonzero(total)
            one = [[None], [str(rows)], [at.astype("<i4").tobytes()], [total[at].astype("<i8").tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(one, types)], names=names)

    def counts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Partial frequencies of several tasks as (feature, documents); feature -1: rows."""
        total, rows = np.zeros(dim, dtype=np.int64), 0
        for batch in batches:
            for n, idx, val in zip(*(c.to_pylist() for c in batch.columns)):
                total[np.frombuffer(idx, dtype="<i4")] += np.frombuffer(val, dtype="<i8")
                rows += int(n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1], at]), pa.int64()),
                                          pa.array(np.concatenate([[rows], total[at]]), pa.int64())], names=["feature", "documents"])

    seen = stored(df.select(text.alias("text"), target.cast("string").alias("target"), counted.alias("counted"))
                  .mapInArrow(run, _SCHEMA))
    sums = (seen.filter("text_key IS NULL").select("target", "idx", "val")
            .mapInArrow(counts_of, "feature bigint, documents bigint")
            .groupBy("feature").agg(F.sum("documents").alias("documents")).collect())     # dim + 1 rows at most
    frequency, rows = np.zeros(dim, dtype=np.int64), 0
    for r in sums:
        if r.feature < 0:
            rows = r.documents
        else:
            frequency[r.feature] = r.documents
    sample = (seen.filter("text_key IS NOT NULL").groupBy("text_key", "target")
              .agg(F.min("idx").alias("idx"), F.min("val").alias("val"))
              .orderBy("text_key", "target").limit(most).collect())
    vectors = [(np.frombuffer(r.idx, dtype="<i4"), np.frombuffer(r.val, dtype="<f4")) for r in sample]
    return Sample(int(rows), frequency, [r.text_key for r in sample], [r.target for r in sample], vectors)


def weighted(counts: Counts, idf: np.ndarray) -> Counts:
    """TF-IDF of one text, of length 1 (or 0)."""
    idx, val = counts
    v = val.astype(np.float32) * idf[idx]
    n = float(np.sqrt(np.dot(v, v)))
    return idx, v / n if n else v


_FOLD = np.array([b + 33 if 65 <= b <= 90 else b + 1 for b in range(256)], dtype=np.uint64)
_POWERS = np.cumprod(np.full(64, 0x100000001B3, dtype=np.uint64))


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit value, first byte) of each word: ASCII letters folded, words
    apart by ASCII white space."""
    solid = (data != 32) & ((data < 9) | (data > 13))
    edge = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
    start = np.flatnonzero(edge == 1)
    if not len(start):
        return np.zeros(0, dtype=np.uint64), start
    size = np.flatnonzero(edge == -1) - start
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    return np.add.reduceat(_FOLD[data[solid]] * _POWERS[place & 63], first), start


def cuts(data: bytes, size: int = CUT) -> Iterator[bytes]:
    """Portions of about ``size`` bytes, cut at ASCII white space where there is some near."""
    start = 0
    while len(data) - start > size:
        end = max(data.rfind(b" ", start, start + size), data.rfind(b"\n", start, start + size)) + 1
        if end <= start:
            end = start + size
        yield data[start:end]
        start = end
    yield data[start:] if start else data
