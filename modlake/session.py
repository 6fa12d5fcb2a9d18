"""Session settings and small helpers around the session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Partitions that a caller wants its input dealt over.
PARTITIONS = "spark.modlake.inputPartitions"
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: str | int = 8, name: str = "modlake", **extra: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared checkpoint folder."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        return tempfile.mkdtemp(prefix=f"modlake-{name}-")  # one process: tests and the bench
    return f"{base.rstrip('/')}/modlake-{name}-{uuid.uuid4().hex}"


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt over as many partitions as the session's ``PARTITIONS`` setting says; unset: untouched.

    For callers whose tables come in fewer files than they have cores (a file is split only at
    row groups).  The caller decides; large tables need no setting and are not shuffled.
    """
    wanted = df.sparkSession.conf.get(PARTITIONS, None)
    return df if wanted is None else df.repartition(int(wanted))
