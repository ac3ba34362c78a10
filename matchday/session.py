"""Session helpers.

A library should not own the session: operators use whatever ``SparkSession``
their input DataFrames belong to.  These helpers only exist for tests, the
benchmark and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "matchday",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    * AQE on: coalesces small shuffle partitions and splits skewed join
      partitions at run time.
    * Session zone pinned to UTC so calendar fields are reproducible.
    * UI off: no web server in batch runs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only in local mode with nothing configured (tests) a fresh scratch
    folder is created and registered; a cluster session without the setting
    is an error, because a machine-local folder would not survive the loss of
    the machine that wrote it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared folder (HDFS, object store) for this cluster session"
            )
        base = os.environ.get("MATCHDAY_SCRATCH", tempfile.gettempdir())
        configured = tempfile.mkdtemp(prefix="matchday-ckpt-", dir=base)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, as Parquet in the session's checkpoint folder.

    The rows outlive any executor, and what depends on the order of a single
    run (partition numbers, places in a partition) stays as it was written.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
