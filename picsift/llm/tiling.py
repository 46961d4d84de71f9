"""Benchmark decontamination by greedy string tiling (operator 4).

1. Every benchmark item gives its seeds: the rolling hashes of its ``MATCH``-token
   windows (an item with fewer tokens is one seed).
2. One pass over the documents keeps those that share a seed.  The test is a bitmap of the
   seeds, of bounded size, so it drops no true match and its broadcast doesn't
   follow the corpus; the surviving seeds then meet the items in an equi-join.
3. For each (document, item) pair that shares a seed, the longest match of
   unmarked tokens is marked in both texts, again and again, down to ``MATCH``
   tokens.  Matches come from Karp-Rabin window hashes and are verified token by
   token.  The marked share of the item is its coverage; reordered passages count in full.

A pair is compared in one task with memory in proportion to its two texts.
Pairs come from the join alone: documents that share nothing with the benchmark
are never shuffled, and a passage that many documents hold gives one pair for each of them.

Defined results: tokens are runs of ASCII letters, digits and non-ASCII characters
other than spaces, general and ideographic punctuation, lower-cased, and in scripts without
spaces (Han, kana, Thai, Lao, Khmer, Myanmar) single characters; null or token-free texts
and items match nothing; an item in the table twice is reported twice, as are
repeated documents.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from .common import fresh, portions, read, stored

#: Least tokens of a match, least share of an item's tokens that marks a document.
MATCH, COVERAGE = 5, 0.5
#: Bits of the seed bitmap for each seed, and at most (32 MB); bits that a seed sets.
BITS_PER_SEED, MAX_BITS, PROBES = 64, 1 << 28, 4

#: Scripts written without spaces (Thai, Lao, Myanmar, Khmer, Han, kana): each character is a token.
_UNSPACED = ("฀-໿က-႟ក-៿᧠-᧿⺀-⿟々-〇぀-ゟァ-ヺー-ヿ"
             "ㇰ-ㇿ㐀-䶿一-鿿豈-﫿ｦ-ﾟ\U00020000-\U0003ffff")
#: What else makes up words; ideographic and full-width punctuation is in neither.
_SPACED = ("0-9a-z\u0080-\u009f¡-෿ༀ-࿿Ⴀ-᝿᠀-᧟ᨀ-῿⁰-⹿⿠-⿿㄀-㇯"
           "㈀-㏿䷀-䷿ꀀ-ﬀ-︯﹐-＀０-９Ａ-Ｚａ-ｚﾠ-\U0001ffff"
           "\U00040000-\U0010ffff")
_TOKEN = re.compile(f"[{_SPACED}]+|[{_UNSPACED}]")
_BASE = np.uint64(0x100000001B3)


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def token_hashes(words: list[str]) -> np.ndarray:
    """A 64-bit value for each token, from its UTF-8 bytes."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    coded = [w.encode("utf-8", "surrogatepass") for w in words]
    size = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
    data = np.frombuffer(b"".join(coded), dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    first = np.cumsum(size) - size
    place = np.arange(len(data)) - np.repeat(first, size)
    mixed = np.add.reduceat(data * _powers(int(size.max()))[place], first)
    mixed ^= mixed >> np.uint64(29)
    return mixed * np.uint64(0xBF58476D1CE4E5B9)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(max(n, 1), _BASE, dtype=np.uint64))


def windows(values: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``size`` values, modulo 2^64."""
    if len(values) < size or not size:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(values) - size + 1, dtype=np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + values[k:len(values) - size + 1 + k]
    return out


def tiles(item: list[str], doc: list[str], match: int = MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in item, place in doc, tokens), longest
    first, then by place in item and doc.  No token is in two tiles of its text."""
    match = min(match, len(item))
    if not match:
        return []
    number = {w: i for i, w in enumerate(dict.fromkeys(item))}
    p = np.fromiter((number[w] for w in item), dtype=np.int64, count=len(item))
    t = np.fromiter((number.get(w, -1) for w in doc), dtype=np.int64, count=len(doc))
    of_doc = windows((t + 2).astype(np.uint64), match)
    if not len(of_doc):
        return []
    order = np.argsort(of_doc, kind="stable")
    ranked = of_doc[order]
    of_item = windows((p + 2).astype(np.uint64), match)
    low, high = np.searchsorted(ranked, of_item, "left"), np.searchsorted(ranked, of_item, "right")
    diagonal = np.zeros(len(p) + len(t), dtype=bool)        # place in doc - place in item + len(item)
    for i, (a, b) in enumerate(zip(low.tolist(), high.tolist())):
        diagonal[order[a:b] - i + len(p)] = True
    heap: list[tuple[int, int, int]] = []
    for d in (np.flatnonzero(diagonal) - len(p)).tolist():
        a, b = max(0, -d), min(len(p), len(t) - d)
        edge = np.diff(np.concatenate([[False], p[a:b] == t[a + d:b + d], [False]]).astype(np.int8))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = end - start >= match
        heap += [(-(y - x), a + x, a + x + d) for x, y in zip(start[long].tolist(), end[long].tolist())]
    heapq.heapify(heap)
    free_p, free_t = np.ones(len(p), dtype=bool), np.ones(len(t), dtype=bool)
    out = []
    while heap:
        n, i, j = heapq.heappop(heap)
        n = -n
        free = free_p[i:i + n] & free_t[j:j + n]
        if free.all():
            free_p[i:i + n] = False
            free_t[j:j + n] = False
            out.append((i, j, n))
            continue
        edge = np.diff(np.concatenate([[False], free, [False]]).astype(np.int8))
        for x, y in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            if y - x >= match:
                heapq.heappush(heap, (x - y, i + x, j + x))
    return out


def _bits(hashes: np.ndarray, probe: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, place in it) of the ``probe``-th bit of each hash."""
    mixed = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15 + 2 * probe * 0x632BE59BD9B4E019 & (1 << 64) - 1)
    bit = mixed >> np.uint64(shift)
    return (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)


def _seeds(bench: DataFrame, match: int) -> DataFrame:
    """(item_row, seed, size): the different window hashes of each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, int, int]] = []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = tokens(text)
                size = min(match, len(words))
                rows += [(row, s, size) for s in np.unique(windows(token_hashes(words), size)).view(np.int64).tolist()]
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                                              pa.array(columns[2], pa.int32())], names=["item_row", "seed", "size"])

    return bench.select("item_row", "item_text").mapInArrow(run, "item_row bigint, seed bigint, size int")


def _candidates(docs: DataFrame, doc_id: str, bitmap, sizes: list[int]) -> DataFrame:
    """(doc_id, text_key, text, seeds) of the documents with a window in the bitmap."""
    schema = StructType([docs.schema[doc_id], StructField("text_key", LongType()), *docs.select("text").schema])
    schema = schema.add("seeds", ArrayType(LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        words_of, shift = bitmap.value
        out = to_arrow_schema(schema)
        for batch in batches:
            for first, texts in portions(batch.column(2)):
                at, seeds = [], []
                for i, text in enumerate(texts, first):
                    values = token_hashes(tokens(text))
                    found = []
                    for size in sizes:
                        hashes = windows(values, size)
                        for probe in range(PROBES):
                            word, place = _bits(hashes, probe, shift)
                            hashes = hashes[(words_of[word] >> place & np.uint64(1)).astype(bool)]
                        found.append(hashes)
                    found = np.unique(np.concatenate(found))
                    if len(found):
                        at.append(i)
                        seeds.append(found.view(np.int64).tolist())
                if at:
                    kept = [batch.column(i).take(pa.array(at)) for i in range(3)]
                    yield pa.RecordBatch.from_arrays([*(a.cast(out.field(i).type) for i, a in enumerate(kept)),
                                                      pa.array(seeds, out.field(3).type)], schema=out)

    return docs.select(doc_id, "text_key", "text").mapInArrow(run, schema)


def _bitmap(seeds: DataFrame):
    """The seeds' bitmap as (64-bit words, shift), broadcast, and the window sizes."""
    info = seeds.agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("size")).alias("sizes")).first()
    bits = 1 << max(10, min(MAX_BITS.bit_length() - 1, (info.n * BITS_PER_SEED).bit_length()))
    shift = 65 - bits.bit_length()
    words = np.zeros(bits >> 6, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = np.zeros(bits >> 6, dtype=np.uint64)
        for batch in batches:
            hashes = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for probe in range(PROBES):
                word, place = _bits(hashes, probe, shift)
                np.bitwise_or.at(part, word, np.uint64(1) << place)
        at = np.flatnonzero(part)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(part[at].view(np.int64), pa.int64())],
                                         names=["word", "value"])

    # at most MAX_BITS / 64 rows come back
    for r in (seeds.select("seed").mapInArrow(run, "word bigint, value bigint")
              .groupBy("word").agg(F.bit_or("value").alias("value")).toLocalIterator()):
        words[r.word] = np.uint64(r.value & 0xFFFFFFFFFFFFFFFF)
    return seeds.sparkSession.sparkContext.broadcast((words, shift)), [s for s in info.sizes if s > 0]


_RESULT = StructType([StructField("item_tokens", IntegerType()), StructField("covered_tokens", IntegerType()),
                      StructField("tiles", IntegerType()), StructField("coverage", DoubleType())])


def contaminated(docs: DataFrame, bench: DataFrame, text: str = "text", doc_id: str = "doc_id",
                 item_id: str = "item_id", item_text: str = "text", match: int = MATCH,
                 coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, text_key, item_id, item_tokens, covered_tokens, tiles, coverage) for every
    document and item whose tiles cover at least ``coverage`` of the item; text_key is
    xxhash64 of the document's text."""
    items = stored(bench.select(F.monotonically_increasing_id().alias("item_row"), F.col(item_id).alias("item_id"),
                                F.col(item_text).alias("item_text")))
    seeds = stored(_seeds(items, match))
    bitmap, sizes = _bitmap(seeds)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    found = stored(_candidates(rows, "doc_id", bitmap, sizes or [match])
                   .withColumn("doc_row", F.monotonically_increasing_id()))
    pairs = (found.select("doc_row", F.explode("seeds").alias("seed"))
             .join(seeds.select("seed", "item_row"), "seed").select("doc_row", "item_row").distinct())
    full = (pairs.join(found.select("doc_row", "doc_id", "text_key", "text"), "doc_row").join(items, "item_row")
            .select("doc_id", "text_key", "item_id", "text", "item_text"))
    schema = StructType([full.schema["doc_id"], full.schema["text_key"], full.schema["item_id"], *_RESULT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        for batch in batches:
            kept = [batch.column(i) for i in range(3)]
            rows: list[tuple] = []
            for a, b in zip(batch.column(3), batch.column(4)):
                item = tokens(b.as_py())
                found = tiles(item, tokens(a.as_py()), match)
                n = sum(x[2] for x in found)
                rows.append((len(item), n, len(found), n / len(item) if item else 0.0))
            columns = list(zip(*rows)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([*(c.cast(out.field(i).type) for i, c in enumerate(kept)),
                                              *(pa.array(c, out.field(3 + i).type) for i, c in enumerate(columns))], schema=out)

    return full.mapInArrow(run, schema).filter(F.col("coverage") >= coverage)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each contaminated document and the item it holds."""
    found = contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "item_tokens", "covered_tokens", "tiles",
                        F.round("coverage", 6).alias("coverage"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage: documents that hold no benchmark item stay, with their columns."""
    key, found_id, found_key = (fresh(n, docs.columns) for n in ("text_key", "found_id", "found_key"))
    found = stored(contaminated(docs, read(spark, sf_dir, "benchmark"))
                   .select(F.col("doc_id").alias(found_id), F.col("text_key").alias(found_key)).distinct())
    return (docs.withColumn(key, F.xxhash64("text"))
            .join(found, F.col("doc_id").eqNullSafe(F.col(found_id)) & (F.col(key) == F.col(found_key)), "left_anti")
            .select(*docs.columns))
