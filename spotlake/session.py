"""Session settings, the shared folder for checkpoints, and broadcasts of measured size."""

from __future__ import annotations

import gc
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is hinted as broadcast only if it is measured to have at most this many rows.
BROADCAST_ROWS = 200_000


def get_spark(cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster pass your own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("spotlake")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_checkpoints(spark: SparkSession) -> None:
    """Make checkpoint() usable: keep the cluster's spark.checkpoint.dir; a folder of this machine only for a local session (tests), else an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if named is None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spotlake-checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the shared folder; survives lost executors."""
    shared_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def freed(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files and checkpoints of what is no longer referenced; else they stay until the driver happens to collect its garbage."""
    for _ in range(2):  # what ran last is held by Spark's listeners for a moment
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(1)


def measured(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """*df* with a broadcast hint if it is measured to have at most *rows* rows, else as it is. Measuring computes it: cut() what is dear first."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
