"""Document fingerprints by a homomorphic multiset hash (operator 1).

A text is the multiset of its paragraphs (pieces between line ends; an empty
text has none).  Every paragraph is hashed to a wide vector and a text's state is
the sum of its paragraphs' vectors: ``LANES`` lanes modulo 2^16 taken from the
hash as they are, which decide equality, and ``LANES`` signed lanes modulo 2^32,
into which each run of ``RUN`` words within a paragraph is hashed with a sign, so that their
inner products estimate how many word runs two texts share.  The order of paragraphs
doesn't matter, and paragraphs are inserted into or deleted from a state without
the rest of the text.  The fingerprint is the SHA-256 of the state.

Likeness is the cosine of the signed lanes, cut to 0..1: about the share of word
runs in common (standard error 1 / sqrt(LANES) = 0.03); 1 for equal states, 0
between a text without words and another.

``edited`` needs each row's successor by id.  Rows are dealt into ranges of ids that are
fixed by approximate quantiles (one small job), sorted within their range, and
the first row of a range is also sent to the range before it.  One shuffle of the texts;
no window over the whole table, memory for two texts at a time.

Defined results: a null text is an empty text; rows without id come first, rows
with the same id are ordered by text; a single row follows itself.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from .common import portions, read, with_text_function
from .textvec import CUT, cuts, words_of

#: Lanes of each kind.
LANES = 1024
#: Words of a run in the signed lanes; a shorter paragraph is one run.
RUN = 4
#: Rows of a range of ids that a task walks through, and ranges at most (the driver holds their bounds).
ROWS_PER_RANGE, MAX_RANGES = 50_000, 20_000
#: Paragraphs that are summed at a time.
_STEP = 256
_LEAST = -(1 << 63)


class State:
    """Sum of paragraph vectors."""

    __slots__ = ("lanes", "signed")

    def __init__(self, lanes: np.ndarray | None = None, signed: np.ndarray | None = None):
        self.lanes = np.zeros(LANES, dtype=np.uint16) if lanes is None else lanes
        self.signed = np.zeros(LANES, dtype=np.uint32) if signed is None else signed

    def _vectors(self, paragraphs: Iterable[tuple[str, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        some = list(paragraphs)
        for i in range(0, len(some), _STEP):
            part = some[i:i + _STEP]
            coded = [p.encode("utf-8", "surrogatepass") for p, _ in part]
            wide = np.frombuffer(b"".join(hashlib.shake_128(c).digest(2 * LANES) for c in coded), dtype="<u2").reshape(len(part), -1)
            times = np.array([n for _, n in part], dtype=np.int64)
            lanes = (times.astype(np.uint16) @ wide).astype(np.uint16) if (times != 1).any() else wide.sum(axis=0, dtype=np.uint16)
            yield lanes, _signed(coded, times)

    def insert(self, paragraphs: Iterable[tuple[str, int]]) -> "State":
        """The state with paragraphs (text, times) more."""
        lanes, signed = self.lanes.copy(), self.signed.copy()
        for a, b in self._vectors(paragraphs):
            lanes += a
            signed += b
        return State(lanes, signed)

    def delete(self, paragraphs: Iterable[tuple[str, int]]) -> "State":
        lanes, signed = self.lanes.copy(), self.signed.copy()
        for a, b in self._vectors(paragraphs):
            lanes -= a
            signed -= b
        return State(lanes, signed)

    def __add__(self, other: "State") -> "State":
        return State(self.lanes + other.lanes, self.signed + other.signed)

    def __eq__(self, other: object) -> bool:
        return (isinstance(other, State) and bool((self.lanes == other.lanes).all())
                and bool((self.signed == other.signed).all()))

    def to_bytes(self) -> bytes:
        return self.lanes.astype("<u2").tobytes() + self.signed.astype("<u4").tobytes()

    @staticmethod
    def from_bytes(data: bytes) -> "State":
        return State(np.frombuffer(data[:2 * LANES], dtype="<u2").copy(), np.frombuffer(data[2 * LANES:], dtype="<u4").copy())

    def fingerprint(self) -> str:
        return hashlib.sha256(self.to_bytes()).hexdigest()

    def likeness(self, other: "State") -> float:
        if self == other:
            return 1.0
        a, b = (x.signed.view(np.int32).astype(np.float64) for x in (self, other))
        size = math.sqrt(float(a @ a) * float(b @ b))
        return round(min(1.0, max(0.0, float(a @ b) / size)), 6) if size else 0.0


def _signed(coded: list[bytes], times: np.ndarray) -> np.ndarray:
    """Signed lanes of paragraphs without line ends, each counted ``times``."""
    pieces, counts = [], []
    for c, n in zip(coded, times.tolist()):
        for piece in cuts(c):                    # a very long paragraph goes in portions
            pieces.append(piece)
            counts.append(n)
    out = np.zeros(LANES, dtype=np.int64)
    start, size = 0, 0
    for end in range(1, len(pieces) + 1):
        size += len(pieces[end - 1])
        if size >= CUT or end == len(pieces):
            out += _runs(b"\n".join(pieces[start:end]), np.array(counts[start:end], dtype=np.int64))
            start, size = end, 0
    return out.astype(np.uint32)


def _runs(data: bytes, times: np.ndarray) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8)
    word, at = words_of(raw)
    if not len(word):
        return np.zeros(LANES, dtype=np.int64)
    owner = np.cumsum(raw == 10)[at]             # the paragraph of each word
    word = (word ^ (word >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    many = np.diff(np.concatenate([first, [len(word)]]))
    found, of = [], []
    for size in range(1, RUN + 1):
        if size == RUN:
            n = len(word) - RUN + 1
            begin = np.flatnonzero(owner[:n] == owner[RUN - 1:]) if n > 0 else first[:0]
        else:
            begin = first[many == size]
        value = np.full(len(begin), size, dtype=np.uint64)
        for k in range(size):
            value = (value + word[begin + k]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(32)
        found.append(value)
        of.append(times[owner[begin]])
    value, weight = np.concatenate(found) * np.uint64(0x94D049BB133111EB), np.concatenate(of)
    sign = np.where(value >> np.uint64(63) > 0, weight, -weight)
    return np.bincount((value >> np.uint64(20)).astype(np.int64) % LANES, weights=sign, minlength=LANES).astype(np.int64)


def paragraphs(text: str | None) -> Counter:
    return Counter(text.split("\n")) if text else Counter()


def state_of(text: str | None) -> State:
    return State().insert(paragraphs(text).items())


def states(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, ``state`` (binary) and ``fingerprint`` of each row's text; states
    can be summed, and paragraphs inserted and deleted, with ``State``."""
    fields = StructType([StructField("state", StringType()), StructField("fingerprint", StringType())])

    def make():
        def run(texts: list) -> list[list]:
            got = [state_of(t) for t in texts]
            return [[s.to_bytes().hex() for s in got], [s.fingerprint() for s in got]]
        return run

    hexed = with_text_function(df, text, list(keep), fields, make)
    return hexed.select(*keep, F.unhex("state").alias("state"), "fingerprint")


def _dealt(df: DataFrame, text: str, doc_id: str, ranges: int) -> DataFrame:
    """(bucket, ghost, doc_id, text): ranges of ids, each followed by its successor's first row as a ghost."""
    order = F.coalesce(F.col(doc_id).cast("long"), F.lit(_LEAST))
    shares = F.array(*(F.lit(i / ranges) for i in range(1, ranges))) if ranges > 1 else F.array(F.lit(0.5))
    info = df.agg(F.min(order).alias("least"), F.percentile_approx(order, shares, max(10000, 20 * ranges)).alias("cuts")).first()
    bounds = sorted({info.least, *(info.cuts or [])}) if info.least is not None else [_LEAST]
    table = F.lit(bounds)
    steps = F.lit([1 << b for b in range(len(bounds).bit_length() - 1, -1, -1)])

    def search(at, step):
        return F.when((at + step < len(bounds)) & (F.get(table, at + step) <= F.col("order_id")), at + step).otherwise(at)

    rows = df.select(order.alias("order_id"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("bucket", F.aggregate(steps, F.lit(0), search))
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("ghost"))
    before = F.struct(F.pmod(F.col("bucket") - 1, F.lit(len(bounds))).alias("bucket"), F.lit(True).alias("ghost"))
    first = F.get(table, F.col("bucket")) == F.col("order_id")
    rows = rows.select(F.explode(F.when(first, F.array(own, before)).otherwise(F.array(own))).alias("place"), "order_id", "doc_id", "text")
    return (rows.select("place.bucket", "place.ghost", "order_id", "doc_id", "text")
            .repartitionById(len(bounds), F.col("bucket"))
            .sortWithinPartitions("bucket", "ghost", "order_id", "text"))


def edited(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """For each text and its edited text (the last half replaced by the next
    row's first characters): doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The edited state is the text's state with the paragraphs that differ deleted and inserted."""
    ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                 min(MAX_RANGES, df.count() // ROWS_PER_RANGE))
    rows = _dealt(df, text, doc_id, ranges)
    schema = StructType([StructField("doc_id", df.schema[doc_id].dataType), StructField("n_chars", LongType()),
                         StructField("edited_sha256", StringType()), StructField("fingerprint", StringType()),
                         StructField("edited_fingerprint", StringType()), StructField("near_edited", DoubleType()),
                         StructField("near_next", DoubleType())])

    def result(text: str, state: State, after: str, after_state: State) -> tuple:
        half = len(text) // 2
        changed = text[:len(text) - half] + after[:half]
        old, new = paragraphs(text), paragraphs(changed)
        changed_state = state.delete((old - new).items()).insert((new - old).items())
        return (len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), state.fingerprint(),
                changed_state.fingerprint(), state.likeness(changed_state), state.likeness(after_state))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out_schema = to_arrow_schema(schema)
        held = None                                  # the row that waits for its successor
        for batch in batches:
            ghosts, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, texts in portions(batch.column(2)):
                out: list[tuple] = []
                for i, t in enumerate(texts, first):
                    if ghosts[i] and held is None:   # only the first successor counts
                        continue
                    t = t or ""
                    state = state_of(t)
                    if held is not None:
                        out.append((held[0], *result(held[1], held[2], t, state)))
                    held = None if ghosts[i] else (ids[i], t, state)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), out_schema)], schema=out_schema)

    return rows.select("ghost", "doc_id", "text").mapInArrow(run, schema)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited(read(spark, sf_dir, "documents"))
