"""Session helpers: building a session for tests/bench and locating the
shared checkpoint folder used to cut lineage in iterative jobs."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "picsift", extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", "16g")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints go to the cluster's shared folder.

    The folder named by ``spark.checkpoint.dir`` is used as is.  Only when the
    setting is absent *and* the session runs in local mode (tests, bench) a
    fresh temporary folder is taken; on a cluster a missing setting is an error
    because a machine-local folder would not survive executor loss.
    """
    try:
        sc = spark.sparkContext
    except Exception:       # Spark Connect: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif re.fullmatch(r"local(\[.*\])?", sc.master):      # one JVM; not local-cluster
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="picsift-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (eager, reliable)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
