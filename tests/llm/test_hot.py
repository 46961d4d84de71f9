"""A third of all rows in one group: no list of all pairs, whole results."""

import random

from pyspark.sql import functions as F

from picsift.llm import sharding, simhash

from helpers import prose
from test_simhash import check, grouped


def test_many_near_copies_and_many_exact_copies(spark):
    base = prose(31, 260).split()
    rng = random.Random(8)
    rows = [(i, prose(1000 + i, 60)) for i in range(120)]
    for i in range(200, 380):                       # near copies: a word or two replaced
        words = list(base)
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(9)}"
        rows.append((i, " ".join(words)))
    rows += [(i, prose(77, 50)) for i in range(500, 700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for hot in (256, 5):
        check(simhash.near_duplicates(docs, hot=hot, block=16).collect(), rows)


def test_a_dense_cluster_gives_a_forest_not_all_pairs(spark):
    """All 529 fingerprints within 2 bits of one below the upper segment: any two are linked."""
    center = random.Random(9).getrandbits(32) << 32
    flips = [0, *(1 << a for a in range(32)), *(1 << a | 1 << b for a in range(32) for b in range(a))]
    values = {center ^ f for f in flips}
    signed = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(sorted(values))]
    df = spark.createDataFrame(signed, "doc_id long, fp long")
    links = simhash.links(df, hot=20).count()
    pairs = simhash.links(df, hot=100_000).count()
    assert pairs > 50_000 and links < pairs / 2
    rows = simhash.components(df, hot=64, block=100).collect()
    assert {r.component_id for r in rows} == {0} and len(set(grouped(values).values())) == 1


def test_one_id_on_a_third_of_the_rows(spark):
    docs = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"),
                                    F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    rows = sharding.external_shuffle(docs, 2, bucket_bytes=2000).select("record.doc_id", "shard", "bucket", "slot").collect()
    hot = [r.bucket for r in rows if r.doc_id == 7]
    assert len({r.shard for r in rows if r.doc_id == 7}) == 1 and len(set(hot)) > 3      # one shard, several buckets
    for shard in (0, 1):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
