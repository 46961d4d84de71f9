"""SimHash near-dedup by multi-index hashing (operator 6).

A 64-bit fingerprint is cut into two 32-bit segments.  Two fingerprints that differ in at most
``MAX_BITS`` = 4 bits differ in at most 2 bits of one segment, so both have a
point in common in that segment's small Hamming balls of radius 1.  Every
different fingerprint is therefore written into the table under the 33 points of
each ball (66 rows), and an equi-join on (segment, point) fetches the matches.
Of the points that two balls share one is taken (see ``_once``), so that a pair
is fetched once for each segment, and the whole distance is verified in the join
condition.  Equal fingerprints are one node, so copies are never paired.

Scale and skew
    Points are counted first (partial counts, so a hot point is no matter) and
    points that only one fingerprint has, nearly all, leave the table.  A point
    with more than ``hot`` different fingerprints is not joined: its members are dealt
    into blocks and each pair of blocks gives the edges of a spanning forest of
    its links, so no list of all pairs is made and no link between components is lost.
    The links form components by large-star / small-star rounds.

Defined results: a null, empty or wordless text has fingerprint 0 and is linked
like any other; component_id is the smallest non-null doc_id that can be reached, null if
there is none; repeated rows give repeated rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.components import connected_components
from .common import fresh, read, stored, with_text_function

#: The contract's values.
SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: Different fingerprints under one point that are still joined pair by pair.
HOT = 256
#: Fingerprints in a block of a hot point.
BLOCK = 2048
#: Bytes of a text whose words are held at a time.
CUT = 1 << 20

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 majority bits of the shingles' hashes, as a signed integer."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)
    ones, total = np.zeros(64, dtype=np.int64), 0
    hash_of = xxhash.xxh64_intdigest
    held: list[bytes] = []
    start = 0
    while start < len(data):
        end = len(data)
        if end - start > CUT:
            m = _SPACE.search(data, start + CUT)
            end = m.start() if m else end
        words = held + _WORD.findall(data[start:end])
        start = end
        if len(words) >= shingle:
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
            begin = np.concatenate([[0], ends[:-1]])[:len(words) - shingle + 1].tolist()
            hashes = [hash_of(line[a:b], seed) for a, b in zip(begin, (ends[shingle - 1:] - 1).tolist())]
            bits = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            total += len(hashes)
            held = words[len(words) - shingle + 1:]
        else:
            held = words
    if not total and held:
        ones = np.unpackbits(np.array([hash_of(b" ".join(held), seed)], dtype="<u8").view(np.uint8),
                             bitorder="little").astype(np.int64)
        total = 1
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 shingle: int = SHINGLE, seed: int = SEED, name: str = "fp") -> DataFrame:
    """Columns ``keep`` and the fingerprint as a bigint."""
    def make() -> Callable:
        return lambda texts: [[fingerprint(t, shingle, seed) for t in texts]]

    return with_text_function(df, text, list(keep), StructType([StructField(name, LongType())]), make)


def ball_points(fp: str = "fp") -> Column:
    """array<struct<seg, point, bit>>: the balls of radius 1 in both segments; bit 32: the centre."""
    halves = [F.col(fp).bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(F.col(fp), 32)]
    return F.array(*(F.struct(F.lit(s).cast("tinyint").alias("seg"),
                              (half if b == 32 else half.bitwiseXOR(F.lit(1 << b))).alias("point"),
                              F.lit(b).cast("tinyint").alias("bit"))
                     for s, half in enumerate(halves) for b in range(33)))


def _once(a: str, b: str) -> Column:
    """Of the points that two balls share, the one that counts: both centres when the
    segments are equal, the second's centre when they differ in one bit, the first's lower
    differing bit when in two."""
    return (F.col(b) == 32) | (F.col(a) < F.col(b))


def _block_forest(keys, rows):
    """Edges of a spanning forest of the links among the fingerprints of one pair of blocks."""
    import pandas as pd

    max_bits = int(rows["max_bits"].iloc[0])
    fps = np.unique(rows["fp"].to_numpy(dtype=np.int64))
    values = fps.view(np.uint64)
    left = np.arange(len(fps))
    out = []
    while len(left):
        front, left = [int(left[0])], left[1:]
        while front and len(left):
            i = front.pop()
            near = np.bitwise_count(values[left] ^ values[i]) <= max_bits
            found = left[near]
            left = left[~near]
            out += [(int(fps[i]), int(fps[j])) for j in found]
            front += found.tolist()
    return pd.DataFrame(out, columns=["src", "dst"], dtype="int64")


def links(fps: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """(src, dst) links among different fingerprints ``fp``: all links under
    points that are not hot, a spanning forest of those under a hot point."""
    if not 0 <= max_bits <= 5:
        raise ValueError("balls of radius 1 in two segments find up to 5 differing bits")
    table = fps.select("fp", F.explode(ball_points()).alias("p")).select(
        F.col("p.seg").alias("seg"), F.col("p.point").alias("point"), F.col("p.bit").alias("bit"), "fp")
    shared = table.groupBy("seg", "point").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    rows = stored(table.join(shared, ["seg", "point"]))
    cold = rows.filter(F.col("members") <= hot)
    a = cold.select("seg", "point", F.col("bit").alias("bit_a"), F.col("fp").alias("src"))
    b = cold.select("seg", "point", F.col("bit").alias("bit_b"), F.col("fp").alias("dst"))
    near = F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= max_bits
    pairs = (a.join(b, (a.seg == b.seg) & (a.point == b.point) & (F.col("src") < F.col("dst"))
                    & _once("bit_a", "bit_b") & near).select("src", "dst"))
    blocks = F.ceil(F.col("members") / block)
    dealt = (rows.filter(F.col("members") > hot)
             .withColumn("blocks", blocks)
             .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("seg", "point", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     "fp", F.lit(max_bits).alias("max_bits")))
    forest = dealt.groupBy("seg", "point", "i", "j").applyInPandas(_block_forest, "src bigint, dst bigint")
    return pairs.unionByName(forest)


def components(prints: DataFrame, max_bits: int = MAX_BITS, doc_id: str = "doc_id",
               hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """(fp, root, component_id) for each different fingerprint of (doc_id, fp)
    rows; root is the smallest fingerprint of the component."""
    # few bytes a row, but 66 table rows each: kept over all partitions, where AQE would take a handful
    spread = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    reps = stored(prints.groupBy("fp").agg(F.min(doc_id).alias("first_id")).repartition(spread, "fp"))
    roots = connected_components(links(reps, max_bits, hot, block)).withColumnRenamed("node", "fp")
    linked = stored(reps.join(roots, "fp"))
    least = stored(linked.groupBy("root").agg(F.min("first_id").alias("linked_id")))
    named = linked.join(least, "root").select("fp", "root", "linked_id")
    return (reps.join(named, "fp", "left")
            .select("fp", F.coalesce("root", "fp").alias("root"),
                    F.coalesce("linked_id", "first_id").alias("component_id")))


def near_duplicates(df: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``df``."""
    prints = stored(fingerprints(df, text, (doc_id,), shingle))
    named = stored(components(prints, max_bits, doc_id, hot, block))
    return (prints.join(named, "fp")
            .select(doc_id, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage: of each group the document with the smallest doc_id stays, with its
    columns.  Rows that share that id are repeated rows; one of them, the least by all its
    columns, stays.  Where no document of a group has an id, one without id stays."""
    prints = stored(fingerprints(docs))
    named = stored(components(prints))
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    kept_id = fresh("kept_id", docs.columns)
    by_id = stored(prints.join(named, "fp").groupBy(F.col("doc_id").alias(kept_id))
                   .agg(F.count(F.lit(1)).alias("id_rows"), F.max(stays).alias("stays")).filter("stays"))
    same = F.col("doc_id").eqNullSafe(F.col(kept_id))
    single = (F.col("id_rows") == 1) & F.col(kept_id).isNotNull()
    once = docs.join(by_id.filter(single).select(kept_id), same, "left_semi")
    more = docs.join(by_id.filter(~single).select(kept_id), same, "left_semi")
    fp = fresh("fp", docs.columns)
    group = named.select(F.col("fp").alias("group_fp"), "root", "component_id")
    one = (fingerprints(more.select(F.col("doc_id").alias("own_id"), F.struct(*docs.columns).alias("row"), "text"),
                        keep=("own_id", "row"), name=fp)
           .join(group, F.col(fp) == F.col("group_fp"))
           .filter(F.col("own_id").eqNullSafe(F.col("component_id")))
           .groupBy("root").agg(F.min("row").alias("row")))
    return once.unionByName(one.select("row.*"))
