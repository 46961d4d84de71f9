import io
import zlib
from collections import Counter, defaultdict
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from picsift.llm import sharding

from helpers import empty_docs, odd_docs, odd_rows

SF = "/root/testdata/sf0.001"


def test_contract(spark):
    rows = sharding.op2_sharding(spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    slots = defaultdict(list)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


@pytest.mark.parametrize("bucket_bytes", [200, 1 << 20])
def test_many_buckets_odd_rows_and_repeatability(spark, bucket_bytes):
    docs = odd_docs(spark, clashes=True)
    first = sharding.external_shuffle(docs, 3, bucket_bytes=bucket_bytes)
    rows = first.collect()
    assert Counter((str(r.record.doc_id), r.record.text) for r in rows) == Counter((str(r[0]), r[1]) for r in odd_rows())
    assert all(r.record.shard == "own shard" for r in rows)
    slots = defaultdict(list)
    buckets = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        buckets[r.shard, r.bucket].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(max(v) - min(v) == len(v) - 1 for v in buckets.values())       # a bucket is a run of slots
    key = lambda x: sorted((r.shard, r.slot, str(r.record.doc_id), str(r.record.text)) for r in x)
    assert key(sharding.external_shuffle(docs.repartition(5), 3, bucket_bytes=bucket_bytes).collect()) == key(rows)
    assert sharding.external_shuffle(empty_docs(spark)).count() == 0


def test_a_shard_depends_on_id_and_count_alone(spark):
    ids = spark.range(3000).select(F.col("id").alias("doc_id"))
    rows = ids.select("doc_id", *(sharding.shard_of(F.col("doc_id"), n).alias(f"s{n}") for n in (7, 8, 9))).collect()
    assert all(r.s8 in (r.s7, 7) and r.s9 in (r.s8, 8) for r in rows)
    assert min(Counter(r.s8 for r in rows).values()) > 300


def test_buckets_are_shuffled(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    rows = sorted(sharding.external_shuffle(docs, 1).select("record.doc_id", "slot").collect(), key=lambda r: r.slot)
    order = [r.doc_id for r in rows]
    assert order != sorted(order) and sum(abs(a - b) for a, b in zip(order, sorted(order))) > 2000 * 2000 / 5


def test_written_shards_hold_the_rows_in_slot_order(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    shuffled = sharding.external_shuffle(docs, 4, bucket_bytes=100_000)
    sharding.write_shards(shuffled, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted((r.doc_id, r.shard, r.slot) for r in back.collect()) == sorted((r[0], r.shard, r.slot) for r in shuffled.select("record.doc_id", "shard", "slot").collect())


def test_plan_is_native(spark):
    out = io.StringIO()
    with redirect_stdout(out):
        sharding.op2_sharding(spark, SF).explain("formatted")
    assert "Python" not in out.getvalue() and "InPandas" not in out.getvalue()


def test_the_seed_alone_fixes_the_order(spark):
    """The same slots under any number of partitions, with adaptive execution or without, however the rows come."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")

    def slots(df, partitions, adaptive):
        before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
        try:
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            rows = sharding.external_shuffle(df, 3, bucket_bytes=50_000).select("record.doc_id", "shard", "slot").collect()
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)
        return {r.doc_id: (r.shard, r.slot) for r in rows}

    first = slots(docs, "4", "true")
    assert len(first) == docs.count()
    assert slots(docs, "4", "false") == first and slots(docs, "7", "false") == first
    assert slots(docs.repartition(5).orderBy("doc_id", ascending=False), "3", "true") == first
