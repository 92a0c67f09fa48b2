"""Sharding by rendezvous hashing over weighted shards.

Every (key, shard) pair has a uniform number u in (0, 1) drawn from the MD5 of both; the shard with the largest
``-weight / ln(u)`` takes the row. A shard therefore gets rows in proportion to its weight, and adding or removing a
shard moves only the rows that the new shard wins or the lost one held.

Slots (positions within a shard, gapless from 0) come from counts over 64 x 64 hash cells of each shard, so that
no task sorts a whole shard: cell offsets are prefix sums over the small count table, and rows are numbered within
their cell only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import key_text, own_name, table, text_or_empty

#: Cells per shard in each of two levels of slot counting.
CELLS = 64


def uniform(key: Column, shard: int) -> Column:
    """A number in (0, 1) from the first 52 bits of MD5(key:shard)."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{shard}"))), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 52)


def rendezvous(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard that wins ``key``; of equal scores the larger shard number."""
    if not weights or any(w <= 0 for w in weights.values()):
        raise ValueError("every shard needs a positive weight")
    scores = [F.struct((F.lit(-float(w)) / F.ln(uniform(key, s))).alias("score"), F.lit(int(s)).alias("shard")) for s, w in sorted(weights.items())]
    return (scores[0] if len(scores) == 1 else F.greatest(*scores))["shard"]


def assign_shards(df: DataFrame, key: str, weights: Mapping[int, float], shard: str = "shard") -> DataFrame:
    """``df`` with column ``shard``. A narrow plan: no shuffle.

    Null keys count as one key. Repeated keys share a shard, whatever else their rows hold. An empty table stays empty. If ``df`` has a column of that
    name already, the new one is named with underscores before it.
    """
    return df.withColumn(own_name(df, shard), rendezvous(key_text(key), weights))


def number_slots(df: DataFrame, key: str, shard: str = "shard", slot: str = "slot", ties: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with a slot in each shard, gapless from 0; within a cell rows are ordered by ``key``, then ``ties``.

    Rows are dealt to cells by key and ties, so rows that share a key (a null one, say) are spread if they differ in ties; rows that are equal in all of them are
    interchangeable and share a cell. Null keys come first in their cell. If ``df`` has a column ``slot`` already, the new one is named with underscores before it.
    """
    slot = own_name(df, slot)
    hi, lo, base = (own_name(df, n) for n in ("cell_hi", "cell_lo", "cell_base"))
    marks = F.concat_ws("\n", key_text(key), *[F.coalesce(F.col(t).cast("string"), F.lit("null")) for t in ties])
    digest = F.conv(F.substring(F.md5(marks), 1, 3), 16, 10).cast("int")
    celled = df.withColumns({hi: F.floor(digest / CELLS).cast("int"), lo: (digest % CELLS).cast("int")})
    counts = celled.groupBy(shard, hi, lo).agg(F.count(F.lit(1)).alias("n"))
    before = (Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("n").over(Window.partitionBy(shard, hi).orderBy(lo).rowsBetween(*before)), F.lit(0))
    above = F.coalesce(F.sum("m").over(Window.partitionBy(shard).orderBy(hi).rowsBetween(*before)), F.lit(0))
    tops = counts.groupBy(shard, hi).agg(F.sum("n").alias("m")).withColumn("above", above).drop("m")
    offsets = counts.withColumn("within", within).join(tops, [shard, hi]).select(shard, hi, lo, (F.col("above") + F.col("within")).alias(base))
    position = F.row_number().over(Window.partitionBy(shard, hi, lo).orderBy(key, *ties))
    return celled.withColumn(slot, position).join(offsets, [shard, hi, lo]).withColumn(slot, (F.col(base) + F.col(slot) - 1).cast("long")).drop(hi, lo, base)


def write_shards(df: DataFrame, path: str, shard: str = "shard") -> None:
    """One folder per shard; a task writes each shard's rows that it holds, so a large shard has many files."""
    df.write.partitionBy(shard).mode("overwrite").parquet(path)


def op1(spark: SparkSession, sf_dir: str, shards: int = 8) -> DataFrame:
    """Null and empty texts have size 1 and CRC 0; long texts are measured whole."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text_or_empty()).alias("text_crc32"),
    )
    now = assign_shards(docs, "doc_id", {s: 1.0 for s in range(shards)})
    grown = assign_shards(now, "doc_id", {s: 1.0 for s in range(shards + 1)}, "grown_shard")
    return number_slots(grown, "doc_id", ties=("text_crc32", "size")).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
