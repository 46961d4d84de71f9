"""Two-pass external shuffle into shards (operator 2, DataFrame functions only).

Pass 1 scatters the records: the shard by rendezvous hashing of the id (of the
seeded hashes for each shard the largest wins, so one more shard takes rows only into
itself), and within the shard a bucket by another seeded hash; there are as many
buckets as make one fit ``BUCKET_BYTES`` on average.  Pass 2 shuffles each bucket: its rows are
ranked by id and text hash, and ``shuffle``, a seeded Fisher-Yates shuffle, of the
ranks gives each row its place.  The shuffled ranks, a few bytes a row, are
stored once, so a lost executor or a second reader sees the same order, and the seeds alone fix it: the same
rows get the same slots under any number of partitions, with adaptive execution or without.  A
shard is its buckets one after the other; ``slot`` counts through it.

The records pass one exchange, by (shard, bucket).  No task holds more than a bucket's
sort (which spills) and its ranks.  Ids that repeat are spread over a shard's buckets by their texts.

Defined results: rows without id go to the shard of the null hash; a null text
is 0 bytes; repeated rows each get a slot of their own; an empty table gives no row.  The
record is carried as one struct, so its columns clash with nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import read, stored

#: Average bytes of text in a bucket; seeds of the scatter and of the shuffle.
BUCKET_BYTES, SCATTER_SEED, SHUFFLE_SEED = 16 << 20, 20, 21
#: Tasks that shuffle buckets' ranks, at most.
MAX_TASKS = 4096
#: Shards of the registered query.
SHARDS = 8


def size_of(text: Column) -> Column:
    """UTF-8 bytes (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def shard_of(doc_id: Column, shards: int, seed: int = SCATTER_SEED) -> Column:
    """Rendezvous hashing: the shard whose hash with the id is largest."""
    drawn = F.array(*(F.struct(F.xxhash64(doc_id, F.lit(seed), F.lit(s)).alias("h"), F.lit(s).alias("s")) for s in range(shards)))
    return F.array_max(drawn)["s"]


def external_shuffle(df: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text",
                     bucket_bytes: int = BUCKET_BYTES, seed: int = SCATTER_SEED) -> DataFrame:
    """(record, shard, grown_shard, bucket, slot): every row of ``df`` as a struct, its
    shard, its shard if there were one more, and its place in the shard."""
    total = df.agg(F.sum(size_of(F.col(text))).alias("total")).first().total or 0
    buckets = max(1, -(-total // (bucket_bytes * shards)))
    key = F.xxhash64(F.col(text))
    place = [shard_of(F.col(doc_id), shards, seed).alias("shard"),
             F.pmod(F.xxhash64(F.col(doc_id), key, F.lit(seed + 1)), F.lit(buckets)).cast("int").alias("bucket")]
    counted = df.select(*place).groupBy("shard", "bucket").agg(F.count(F.lit(1)).cast("int").alias("n"))
    # one row for each bucket: its first slot and its shuffled ranks
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # the generator of ``shuffle`` starts anew in each partition: buckets are dealt by their number, so that the
    # seed alone fixes the order, whatever the plan or the session's settings
    number = (F.col("shard") * buckets + F.col("bucket")).cast("int")
    ranks = stored(counted.withColumn("first_slot", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long"))
                   .repartitionById(min(shards * buckets, MAX_TASKS), number).sortWithinPartitions("shard", "bucket")
                   .withColumn("ranks", F.shuffle(F.sequence(F.lit(0), F.col("n") - 1), SHUFFLE_SEED)))
    within = Window.partitionBy("shard", "bucket").orderBy("order_id", "order_text")
    rows = (df.select(F.struct(*(df[c] for c in df.columns)).alias("record"), *place,
                      shard_of(F.col(doc_id), shards + 1, seed).alias("grown_shard"),
                      F.col(doc_id).alias("order_id"), key.alias("order_text"))
            .withColumn("rank", F.row_number().over(within) - 1))
    return (rows.join(ranks.drop("n"), ["shard", "bucket"])
            .select("record", "shard", "grown_shard", "bucket",
                    (F.col("first_slot") + F.get("ranks", F.col("rank"))).alias("slot")))


def write_shards(shuffled: DataFrame, path: str) -> None:
    """One folder for each shard, its files and the rows in them in the order of the slots."""
    (shuffled.repartition("shard", "bucket").sortWithinPartitions("shard", "slot")
     .select("shard", "bucket", "slot", "record.*").write.partitionBy("shard", "bucket").parquet(path))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("record.text")
    return (external_shuffle(read(spark, sf_dir, "documents"))
            .select("record.doc_id", size_of(text).alias("size"), F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
                    F.lit("key").alias("law"), "shard", "slot", "grown_shard"))
