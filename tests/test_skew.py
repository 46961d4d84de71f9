"""A third of all rows on one key: the join back to the key's aggregate is
split by AQE (both its sides are stored, plain shuffles)."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from picsift.operators import components, exact, people

SMALL = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "16"}
N = 120_000


@contextmanager
def settings(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_hash(spark):
    with settings(spark):
        rows = spark.range(N).select(F.concat(F.lit("/p/"), F.col("id").cast("string")).alias("path"), F.lit("ok").alias("status"),
                                     F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.sha2(F.floor(F.col("id") / 4).cast("string"), 256)).alias("sha256"),
                                     F.lit(9).alias("width"), F.lit(9).alias("height"), F.lit(None).cast("string").alias("date_taken"))
        df = exact.exact_duplicates(rows).select("path", "is_keeper")
        plan = final_plan(df)
        assert "SortMergeJoin(skew=true)" in plan
        assert df.filter("is_keeper").count() >= 1


def test_hub_node(spark):
    with settings(spark):
        edges = spark.range(N).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.floor(F.col("id") / 5)).cast("long").alias("lo"),
                                      (F.col("id") + N).alias("hi"))
        step = components._large_star(edges.checkpoint(), hub=True)
        assert "SortMergeJoin(skew=true)" in final_plan(step)


def test_large_person_and_noise(spark):
    with settings(spark):
        rows = spark.range(N).select("id", F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(-1))
                                     .otherwise(F.floor(F.col("id") / 30) + 100).cast("int").alias("cluster")).checkpoint()
        kept = people.keep_large_clusters(rows, "cluster", 11)
        plan = final_plan(kept)
        assert "SortMergeJoin(skew=true)" in plan or "BroadcastHashJoin" in plan
        sizes = {r.cluster: r["count"] for r in kept.groupBy("cluster").count().collect()}
        assert sizes == {7: N // 3, -1: N - N // 3}
