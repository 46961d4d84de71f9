"""Packing of documents into sequences by cutting-stock column generation (operator 13).

Every document is encoded once and its ids are kept in the shared folder.  A document's
first whole multiples of ``size`` ids are sequences of their own; its rest, shorter than ``size``, belongs to one
of ``CLASSES`` classes of length.  The histogram of the classes goes to the driver, which solves the
cutting-stock program over it (``cutting.py``); its patterns, rounded down, are broadcast, and the rests of
each class, ranked over the cluster, fill the places that the patterns have for them.

What rounding leaves, about one rest for each class and pattern, is cut to fill the gaps: all gaps,
in order of the sequences, and all ids left, in order of the rests, are laid along one line, and where a gap and a rest
overlap is a piece.  If the gaps are longer, the least full sequences are given up, each
of which makes up ``size`` ids; if they are shorter, the line goes on with whole sequences and, for the
last ids, one sequence for each binary digit of their number: a power of two is not padded.
So no id of padding is needed.

Scale: ids pass one exchange, to the pieces of their document; everything else handles a few numbers for
each rest.  Ranks and running totals are taken over ranges of rows, not in one window, and the overlap is an
equi-join on stretches of the line of ``size`` ids.  Broadcast are the patterns (at most ``CLASSES`` of
them with at most ``CLASSES`` parts) and one number for each partition.

``Encoder`` gives the library's ids, faster: a text of characters for which the rules of this
tokenizer's file are plain (below) is cut into its pieces by a regular expression here, and the
library's model encodes each different piece once; other texts, and other tokenizer files, go through the library whole.
Strings of special tokens in a text are ordinary text.

Defined results: a null text is an empty text, whose only id is the end mark; repeated rows are
documents of their own; rows without id are kept; an empty table gives no rows.  Long texts are encoded in
portions cut at white space.
"""

from __future__ import annotations

import json
import re
import unicodedata
import uuid
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from ..operators.ranking import rank_within
from ..session import ensure_checkpoint_dir
from .common import read, stored, with_text_function
from .cutting import patterns

#: The contract's values: ids of a sequence, the id after each document.
SIZE, END = 4096, 2
#: Classes of length; pieces of text whose ids are remembered; characters encoded at a time.
CLASSES, REMEMBERED, PORTION = 256, 400_000, 1 << 14
#: Pieces that are cut at once; bytes of stored ids that a task holds before it writes them.
PIECES, ROW_GROUP = 1024, 16 << 20

#: The normalizer and the splitting of the tokenizer file that ``Encoder`` knows.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def _class_of(kind: str) -> str:
    """Characters up to U+017F of a Unicode category, as a set of a regular expression."""
    return "".join(f"\\u{c:04x}" for c in range(0x180) if unicodedata.category(chr(c))[0] == kind)


_LETTER, _NUMBER = _class_of("L"), _class_of("N")
#: The same pieces for plain characters; white space and U+0085 part pieces.
_PIECE = re.compile(f"[{_LETTER}]+|[{_NUMBER}]|'s|'t|'re|'ve|'m|'ll|'d|[^\\s{_LETTER}{_NUMBER}]+")
#: Plain: printable ASCII, usual white space, Latin letters and signs, dashes, quotes and dots; none composes with another,
#: and small letters of plain ones are plain.
_STRANGE = re.compile("[^\\x20-\\x7e\\t\\n\\r\\u00a0-\\u012f\\u0132-\\u017f\\u2010-\\u2027\\u2030-\\u203e\\u20ac]")
_SPACE = re.compile("[ \\t\\n\\r]")


def _byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is a printable Latin-1 character (no space
    and no soft hyphen), the others in order from U+0100 on."""
    shown = {*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


_BYTE = _byte_characters()


class Known(dict):
    """What ``make`` gave for each key, remembered for the ``most`` keys met of late at most."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.half, self.older = make, max(1, most // 2), {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.half:
            self.older = self.copy()
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Ids of whole texts, as the library gives them for the file ``path``."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        split = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.plain = rules.get("normalizer") == _NORMALIZER and split[0].get("pattern") == {"Regex": _SPLIT} and split[1:] == [_BYTES]
        self.model = self.whole.model
        self.known = Known(self._piece, remembered)
        self.width = np.dtype("<u2" if self.whole.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")

    def _bytes(self, ids: list[int]) -> bytes:
        return array(self.width.char, ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        """The model alone, on the piece's bytes as the characters that stand for them."""
        shown = piece if piece.isascii() else "".join(map(_BYTE.__getitem__, piece.encode("utf-8")))
        return self._bytes([t.id for t in self.model.tokenize(shown)])

    def encode(self, text: str) -> bytes:
        """The ids as little-endian numbers of ``width``."""
        out = []
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > PORTION:
                stop = _SPACE.search(text, at + PORTION)
                end = stop.start() if stop else end
            part = text[at:end]
            at = end
            if not self.plain or _STRANGE.search(part):
                out.append(self._bytes(self.whole.encode(part, add_special_tokens=False).ids))
                continue
            out.append(b"".join(map(self.known.__getitem__, _PIECE.findall(part.lower()))))
        return b"".join(out)


_made: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One for each Python worker, kept across its tasks."""
    if path not in _made:
        _made[path] = Encoder(path)
    return _made[path]


def encoded(df: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", end: int = END) -> DataFrame:
    """(row, doc_id, n, width, ids): each row's number, its count of ids with the end mark, and the ids as
    little-endian numbers of ``width`` bytes; stored in the shared folder, so that reading ``n`` reads no ids."""
    fields = StructType([StructField("n", LongType()), StructField("width", LongType()), StructField("ids", BinaryType())])

    def make() -> Callable:
        encoder = _encoder(path)

        def run(texts: list) -> list[list]:
            mark, width = np.array([end], dtype=encoder.width).tobytes(), encoder.width.itemsize
            ids = [encoder.encode(t or "") + mark for t in texts]
            return [[len(x) // width for x in ids], [width] * len(ids), ids]
        return run

    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    place = f"{ensure_checkpoint_dir(df.sparkSession)}/ids-{uuid.uuid4().hex}"
    with_text_function(rows, "text", ["row", "doc_id"], fields, make).write.option("parquet.block.size", ROW_GROUP).parquet(place)
    return df.sparkSession.read.parquet(place)


def running_total(df: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """``out``: the sum of ``value`` over the rows before, by ``order`` (unique)."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [c for c in df.columns if c != value]
    ranged = df.repartitionByRange(n, order).sortWithinPartitions(order).select(*columns, F.col(value).cast("long").alias(value), F.spark_partition_id().alias("range"))
    schema = StructType([*ranged.schema.fields, StructField(out, LongType())])

    def run(batches):
        total = 0
        for batch in batches:
            v = batch.column(len(columns)).to_numpy()
            sums = np.cumsum(v) + total
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums - v, pa.int64())], names=[f.name for f in schema])
            total = int(sums[-1]) if len(sums) else total

    local = stored(ranged.mapInArrow(run, schema))           # stored: a range must mean the same to its rows and to its sum
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = (local.groupBy("range").agg(F.sum(value).alias("sum"))      # one row for each partition
            .select("range", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("ranges_before")))
    return local.join(F.broadcast(sums), "range").withColumn(out, F.col(out) + F.col("ranges_before")).drop("range", "ranges_before")


def _planned(rests: DataFrame, size: int, classes: int) -> tuple[DataFrame, int]:
    """The rests with their class, rank and place (pattern sequence or null), and the number of sequences."""
    step = -(-size // classes)
    room = size // step
    # a rest of the last, shorter step of a size that no step divides has no class
    ranked = stored(rank_within(rests.withColumn("class", F.ceil(F.col("length") / step).cast("int")), ["class"], ["row"], out="rank")
                    .withColumn("rank", F.col("rank") - 1))
    demand = {r["class"]: r["n"] for r in ranked.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect() if r["class"] <= room}   # CLASSES rows at most
    parts, sequences, used = [], 0, dict.fromkeys(demand, 0)
    for p in patterns(demand, room):
        for k, n in p.counts.items():
            parts.append((k, used[k], used[k] + n * p.times, n, sequences))
            used[k] += n * p.times
        sequences += p.times
    table = rests.sparkSession.createDataFrame(parts, "kind int, first long, last long, each long, base long")
    placed = ranked.join(F.broadcast(table), (F.col("class") == F.col("kind")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")), "left")
    return (placed.withColumn("sequence_id", F.col("base") + F.expr("(rank - first) div each"))
            .select("row", "start", "length", "class", "rank", "sequence_id")), sequences


def _overlaps(gaps: DataFrame, rests: DataFrame, size: int) -> DataFrame:
    """Pieces (row, start, length, sequence_id, offset) where a gap (at, room, sequence_id, offset)
    and a rest (from_, length, row, start) lie over each other on the line."""
    def stretches(first: Column, long: Column) -> Column:
        return F.explode(F.sequence(F.floor(first / size), F.floor((first + long - 1) / size)))

    g = gaps.withColumn("stretch", stretches(F.col("at"), F.col("room")))
    r = rests.select("row", "start", "length", "from_", stretches(F.col("from_"), F.col("length")).alias("part"))
    low = F.greatest("at", "from_")
    high = F.least(F.col("at") + F.col("room"), F.col("from_") + F.col("length"))
    return (g.join(r, (F.col("stretch") == F.col("part")) & (low < high) & (F.floor(low / size) == F.col("stretch")))
            .select("row", (F.col("start") + low - F.col("from_")).alias("start"), (high - low).alias("length"),
                    "sequence_id", (F.col("offset") + low - F.col("at")).alias("offset")))


def plan(lengths: DataFrame, size: int = SIZE, classes: int = CLASSES) -> DataFrame:
    """(row, start, length, sequence_id, offset): the pieces of documents (row, n)."""
    spark = lengths.sparkSession
    columns = ["row", "start", "length", "sequence_id", "offset"]
    full = F.expr(f"n div {size}")
    rests = lengths.select("row", (full * size).alias("start"), (F.col("n") % size).alias("length")).filter("length > 0")
    planned, sequences = _planned(rests, size, classes)
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "rank")        # at most ``size`` pieces
    placed = stored(planned.filter("sequence_id is not null")
                    .withColumn("offset", F.sum("length").over(inside) - F.col("length"))
                    .withColumn("gap", size - F.sum("length").over(Window.partitionBy("sequence_id"))))
    free = planned.filter("sequence_id is null").select("row", "start", "length")
    first = F.col("offset") == 0                                       # one row for each sequence

    def total(df: DataFrame, column: str) -> int:
        return df.agg(F.coalesce(F.sum(column), F.lit(0)).alias("x")).first().x

    gap, left = total(placed.filter(first), "gap"), total(free, "length")
    kept = sequences - max(0, -(-(gap - left) // size))                # each sequence given up makes up ``size`` ids
    stays, given_up = placed.filter(F.col("sequence_id") < kept), placed.filter(F.col("sequence_id") >= kept)
    over = left - gap + size * (sequences - kept)                      # ids left when all gaps are full
    gap = total(stays.filter(first), "gap")
    gaps = running_total(stays.filter(first & (F.col("gap") > 0))
                         .select("sequence_id", (size - F.col("gap")).alias("offset"), F.col("gap").alias("room")), "sequence_id", "room", "at")
    line = running_total(free.unionByName(given_up.select("row", "start", "length")), "row", "length", "from_")
    more = spark.range(over // size).select((F.col("id") + kept).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
                                            F.lit(size).cast("long").alias("room"), (F.col("id") * size + gap).alias("at"))
    last, at, digits = kept + over // size, gap + over // size * size, []
    for digit in range(size.bit_length() - 1, -1, -1):
        if over % size >> digit & 1:
            digits.append((last, 0, 1 << digit, at))
            last, at = last + 1, at + (1 << digit)
    more = more.unionByName(spark.createDataFrame(digits, "sequence_id long, offset long, room long, at long"))
    wholes = running_total(lengths.select("row", full.alias("full")).filter("full > 0"), "row", "full", "ahead")
    own = (wholes.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") - 1)))
           .select("row", (F.col("i") * size).alias("start"), F.lit(size).cast("long").alias("length"),
                   (F.col("ahead") + F.col("i") + last).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    return (own.unionByName(stays.select(*columns))
            .unionByName(_overlaps(gaps.select(*more.columns).unionByName(more), line, size)))


def pack(df: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", size: int = SIZE, end: int = END,
         classes: int = CLASSES) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): every piece of every document with
    its ids (little-endian unsigned 32-bit numbers)."""
    tokens = encoded(df, path, text, doc_id, end)
    pieces = plan(tokens.select("row", "n"), size, classes)
    of = pieces.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("pieces"))
    rows = tokens.join(of, "row").select("doc_id", "n", "width", "ids", "pieces")
    schema = StructType([StructField("doc_id", df.schema[doc_id].dataType), StructField("start", LongType()), StructField("length", LongType()),
                         StructField("ids", BinaryType()), StructField("doc_tokens", LongType()), StructField("sequence_id", LongType()),
                         StructField("offset", LongType())])

    def cut(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        for batch in batches:
            doc, n, width, ids = (batch.column(i) for i in range(4))
            held = batch.column(4)
            which = np.repeat(np.arange(len(held)), held.value_lengths().to_numpy(zero_copy_only=False))
            start, length, sequence, offset = held.flatten().flatten()
            begin, long = start.to_numpy(), length.to_numpy()
            row_of, wide = pa.array(which), width.to_numpy()
            # where each row's ids begin in the batch's bytes
            kind = np.dtype("<i8" if pa.types.is_large_binary(ids.type) else "<i4")
            place = np.frombuffer(ids.buffers()[1], dtype=kind, count=len(ids) + 1, offset=kind.itemsize * ids.offset)[:-1].astype(np.int64) if len(ids) else which
            data = ids.buffers()[2] if len(ids) else b""
            for first in range(0, len(which), PIECES):
                here = slice(first, first + PIECES)
                of = which[here]
                at = place[of] + begin[here] * wide[of]
                parts = [np.frombuffer(data, dtype=f"<u{w}", count=m, offset=a).astype("<u4").tobytes()
                         for w, a, m in zip(wide[of].tolist(), at.tolist(), long[here].tolist())]
                taken = row_of.slice(first, len(parts))
                columns = [doc.take(taken), start.slice(first, len(parts)), length.slice(first, len(parts)), pa.array(parts, pa.binary()),
                           n.take(taken), sequence.slice(first, len(parts)), offset.slice(first, len(parts))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    return rows.mapInArrow(cut, schema)


def sequences_of(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): what ``pack`` gave, as the sequences to be written, without padding."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))             # at most ``size`` ids
    joined = F.aggregate(parts, F.lit(b""), lambda s, p: F.concat(s, p["ids"]))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
