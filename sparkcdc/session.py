"""Session settings the operators are written for.

Nothing here is required for correct results except the UTC session zone; the rest are
the adaptive-execution switches the plans lean on (runtime broadcast by measured size,
skewed-partition splitting, small-partition coalescing).
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, name: str = "sparkcdc") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        # Call sites in error messages cost a stack walk per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for lineage cuts. A private one only where none is named and
    driver and tasks are one process; elsewhere tasks would not see it."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="sparkcdc-checkpoint-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt by key over as many tasks as the session shuffles to, so that costly work on them runs on
    all cores even where the input is one file or one row group. Meant for narrow rows."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def stored(df: DataFrame) -> DataFrame:
    """The frame written once to the checkpoint folder and read from there.

    For an intermediate result that several operators read: each of them may scan its input more than
    once, which is cheap for a table and expensive for a long plan.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
