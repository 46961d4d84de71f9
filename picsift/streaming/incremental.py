"""Incremental scan of a growing source folder with Structured Streaming.

The file stream source remembers which files it has already delivered (in
its checkpoint), so each run scans only new files -- the streaming form of
"skip what a previous run processed" (P4).  Each micro-batch writes its scan
decisions into its own ``batch_id`` partition of a decision log (dynamic
partition overwrite, so a batch replayed after a failure replaces its own
output); the current ``images`` table is the latest row per path (S7 by
last write).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.scan import scan_status
from ..params import DEFAULT, Params
from ..sources import files

BINARY_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def _scan_batch(spark: SparkSession, batch: DataFrame, p: Params, tag_reader) -> DataFrame:
    # the image reader gets the batch's own files, at most ``max_files`` paths
    paths = [r.path for r in batch.select("path").collect()]
    decoded = (spark.read.format("image").option("dropInvalid", False).option("ignoreCorruptFiles", "true").load(paths)
                    .select(files.local_path(F.col("image.origin")).alias("path"),
                            (F.col("image.width") >= 0).alias("decode_ok"),
                            F.col("image.width").alias("width"), F.col("image.height").alias("height")))
    ok = F.coalesce(F.col("decode_ok"), F.lit(False))
    read = batch.select("path", files.tag_map_udf(tag_reader)(F.col("content")).alias("all_tags"),
                        F.sha2(F.col("content"), 256).alias("all_sha256"))
    rows = read.join(decoded, "path", "left").select(
        "path", ok.alias("decode_ok"), "width", "height",
        F.when(ok, F.col("all_tags")).alias("tags"), F.when(ok, F.col("all_sha256")).alias("sha256"))
    return scan_status(rows, p)


def incremental_scan(spark: SparkSession, source: str, log_dir: str, checkpoint_dir: str,
                     p: Params = DEFAULT, tag_reader=files.no_tags, max_files: int = 10000,
                     available_now: bool = True):
    """Start the stream; with ``available_now`` it processes what is there and stops."""
    stream = (spark.readStream.format("binaryFile").schema(BINARY_SCHEMA)
                   .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files)
                   .load(source)
                   .select(files.local_path(F.col("path")).alias("path"), "modificationTime", "content")
                   .filter(F.col("path").rlike(files.JPEG_SUFFIX)))

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        out = _scan_batch(batch.sparkSession, batch, p, tag_reader).withColumn("batch_id", F.lit(epoch_id))
        # a batch replayed after a failure overwrites its own partition: exactly-once output
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id").parquet(log_dir))

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def current_from_log(spark: SparkSession, log_dir: str) -> DataFrame:
    """Latest scan row per path (grouped max, combined map-side)."""
    log = spark.read.parquet(log_dir)
    cols = [c for c in log.columns if c not in ("path", "batch_id")]
    latest = log.groupBy("path").agg(F.max(F.struct("batch_id", *cols)).alias("r"))
    return latest.select("path", *[F.col("r." + c).alias(c) for c in cols])
