"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but space and the ASCII controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``; without one, a local folder, on a single machine only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and not spark.sparkContext.master.startswith("local["):
        raise ValueError("on a cluster spark.checkpoint.dir must name a folder that all machines share")
    return (named or tempfile.mkdtemp(prefix="tidewell-checkpoint-")).rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` as a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def key_text(name: str) -> Column:
    """A record key as text; null keys share one text that no number has."""
    return F.coalesce(F.col(name).cast("string"), F.lit("null"))


def own_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted
