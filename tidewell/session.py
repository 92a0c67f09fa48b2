"""A local Spark session for tests and the benchmark (on a cluster, use the session that is given), and checkpoints in the folder that a session names."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidewell")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TIDEWELL_DRIVER_MEMORY", memory))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` as a checkpoint in the session's ``work_folder``."""
    work_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def work_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; without one, a local folder, on a single machine only."""
    if spark.sparkContext.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not spark.sparkContext.master.startswith("local["):
            raise ValueError("on a cluster spark.checkpoint.dir must name a folder that all machines share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidewell-checkpoint-"))
    return spark.sparkContext.getCheckpointDir()
