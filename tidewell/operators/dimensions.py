"""Dimensions: slowly changing from snapshots, calendar, reference plus observed codes; point-in-time lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.cleaning import calendar
from ..functions.keys import dimension_key

#: Dates that stand for "since ever" and "still open".
EARLIEST, OPEN = "0001-01-01", "9999-12-31"


def scd2(snapshots: DataFrame, natural: str, as_of: str, attributes: Sequence[str], carried: Sequence[str] = (), version: str = "provider/v1") -> DataFrame:
    """Runs of equal attributes over successive snapshots.

    A run ends at the first snapshot that lacks the key or has other attributes; the first snapshot's runs are valid from the
    earliest date, runs that reach the last one are open. ``valid_to`` is exclusive. Attributes and ``carried`` come from a run's first row.
    """
    dates = snapshots.select(as_of).distinct()
    numbered = dates.withColumn("i", F.row_number().over(Window.orderBy(as_of)) - 1)  # one row per snapshot
    by_key = Window.partitionBy(natural).orderBy("i")
    state = F.struct(*attributes)
    rows = snapshots.join(F.broadcast(numbered), as_of)
    follows = (F.lag("i").over(by_key) == F.col("i") - 1) & F.lag(state).over(by_key).eqNullSafe(state)
    rows = rows.withColumn("starts", (~F.coalesce(follows, F.lit(False))).cast("int"))
    rows = rows.withColumn("run", F.sum("starts").over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
    first = F.min_by(F.struct(*attributes, *carried, as_of), "i").alias("first")
    runs = rows.groupBy(natural, "run").agg(first, F.min("i").alias("i0"), (F.max("i") + 1).alias("ends_at"))
    ends = numbered.select(F.col("i").alias("ends_at"), F.col(as_of).alias("ended"))
    runs = runs.join(F.broadcast(ends), "ends_at", "left")
    valid_from = F.when(F.col("i0") == 0, F.lit(EARLIEST).cast("date")).otherwise(F.col(f"first.{as_of}"))
    out = runs.select(
        natural, *[F.col(f"first.{c}").alias(c) for c in attributes], valid_from.alias("valid_from"), F.coalesce("ended", F.lit(OPEN).cast("date")).alias("valid_to"),
        F.col("ended").isNull().alias("is_current"), F.col(f"first.{as_of}").alias("snapshot_as_of_date"), *[F.col(f"first.{c}").alias(c) for c in carried],
    )
    return out.select(dimension_key(version, F.col(natural), F.col("valid_from")).alias("sk"), "*")


def snapshot_problems(snapshots: DataFrame, natural: str, as_of: str, parent: str, parents: DataFrame) -> DataFrame:
    """Snapshot rows that a dimension must not be built from: a key twice in one snapshot, or a parent that is not in ``parents``."""
    twice = snapshots.groupBy(natural, as_of).count().filter("count > 1").select(natural, as_of, F.lit("KEY_NOT_UNIQUE").alias("problem"))
    orphan = snapshots.join(parents.select(F.col(parents.columns[0]).alias(parent)), parent, "left_anti").select(natural, as_of, F.lit("PARENT_UNKNOWN").alias("problem"))
    return twice.unionByName(orphan)


def point_in_time(facts: DataFrame, dim: DataFrame, natural: str, at: str, natural_reason: str | None = None, dim_key: str | None = None) -> DataFrame:
    """``facts`` with ``sk`` of the dimension row that covers ``at``, or ``sk_reason``.

    ``dim_key`` is the key's name in the dimension, if it is another. An equi-join with a range condition; rows without key or date go past the join's hash table as non-matches.
    """
    dim_key = dim_key or natural
    d = dim.select(F.col(dim_key).alias("_k"), "valid_from", "valid_to", "sk")
    covered = (F.col(natural) == F.col("_k")) & (F.col("valid_from") <= F.col(at)) & (F.col(at) < F.col("valid_to"))
    found = facts.join(d, covered, "left").drop("_k", "valid_from", "valid_to")
    known = dim.select(F.col(dim_key).alias("_known")).distinct()
    found = found.join(known, F.col(natural) == F.col("_known"), "left")
    reason = (
        F.when(F.col("sk").isNotNull(), None)
        .when(F.col(natural).isNull(), F.col(natural_reason) if natural_reason else F.lit("NPI_MISSING"))
        .when(F.col("_known").isNull(), "NPI_NOT_IN_ROSTER")
        .when(F.col(at).isNull(), "PROVIDER_ADMIT_DATE_UNKNOWN")
        .otherwise("PROVIDER_NOT_ON_ROSTER_AT_ADMIT")
    )
    return found.withColumn("sk_reason", reason).drop("_known")


def calendar_dim(dates: DataFrame, *columns: str) -> DataFrame:
    """Every day of the calendar years that the date columns span. No dates: no rows."""
    each = [dates.select(F.col(c).cast("date").alias("d")) for c in columns]
    union = each[0]
    for e in each[1:]:
        union = union.unionByName(e)
    span = union.agg(F.trunc(F.min("d"), "year").alias("a"), (F.add_months(F.trunc(F.max("d"), "year"), 12) - F.expr("INTERVAL '1' DAY")).cast("date").alias("b"))
    days = span.filter("a IS NOT NULL").select(F.explode(F.sequence("a", "b")).alias("date_key"))
    return days.select("date_key", *calendar(F.col("date_key")))


def reference_and_observed(reference: DataFrame, observed: DataFrame, key: str) -> DataFrame:
    """The reference with ``in_reference`` true, and observed keys that it lacks, other columns null."""
    extra = observed.select(key).filter(F.col(key).isNotNull()).distinct().join(reference.select(key), key, "left_anti")
    return reference.withColumn("in_reference", F.lit(True)).unionByName(extra.withColumn("in_reference", F.lit(False)), allowMissingColumns=True)


def payer_dim(spark) -> DataFrame:
    from ..functions.cleaning import PAYER_CATEGORIES

    return spark.createDataFrame([(c,) for c in PAYER_CATEGORIES], "payer_category string")
