"""Linking deliveries of one person under a pseudonym, and the attributes that are safe to keep."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

LINKED, UNLINKED = "LINKED", "UNLINKED"


def link_identities(rows: DataFrame, source: str, local_id: str, linkage: Sequence[str], has_birth: Column, version: str = "patient/v1") -> DataFrame:
    """One row per (source, stripped local id): ``link_status``, ``link_reason`` and ``key_parts``, the texts to hash into a key.

    All of an identity's rows decide: exactly one complete linkage key (no part null) links it across sources; several conflict,
    none is incomplete or lacks a birth date. A blank local id has no key and never merges.
    """
    return resolved_identities(merged_identities(identity_states(rows, source, local_id, linkage, has_birth)), source, len(linkage), version)


def identity_states(rows: DataFrame, source: str, local_id: str, linkage: Sequence[str], has_birth: Column) -> DataFrame:
    """What rows say of each (source, local_id): the least and the greatest complete linkage key, and whether any has a birth date.

    Two different keys are as telling as thousands, so a state is one narrow row, and states of parts of the rows merge into that of all.
    """
    complete = F.when(sum(F.col(c).isNull().cast("int") for c in linkage) == 0, F.struct(*[F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(linkage)]))
    keyed = rows.select(F.col(source).alias("source"), strip(F.col(local_id)).alias("local_id"), complete.alias("low"), complete.alias("high"), has_birth.alias("born"))
    return merged_identities(keyed)


def merged_identities(states: DataFrame) -> DataFrame:
    return states.groupBy("source", "local_id").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("born").alias("born"))


def resolved_identities(merged: DataFrame, source: str, parts: int, version: str = "patient/v1") -> DataFrame:
    """Status, reason and key parts of each merged state; ``parts``: how many parts a linkage key has."""
    linked = F.col("low").isNotNull() & F.col("low").eqNullSafe(F.col("high")) & (F.col("local_id") != "")
    reason = (
        F.when(F.col("local_id") == "", "PATIENT_MRN_MISSING")
        .when(linked, None)
        .when(F.col("low").isNotNull(), "PATIENT_UNLINKED_CONFLICT")
        .when(F.coalesce("born", F.lit(False)), "PATIENT_UNLINKED_INCOMPLETE")
        .otherwise("PATIENT_UNLINKED_NO_DOB")
    )
    key = F.when(linked, F.array(F.lit(version), F.lit(LINKED), *[F.col(f"low.k{i}") for i in range(parts)])).when(
        F.col("local_id") != "", F.array(F.lit(version), F.lit(UNLINKED), F.col("source"), F.col("local_id"))
    )
    return merged.select(F.col("source").alias(source), "local_id", F.when(linked, LINKED).otherwise(UNLINKED).alias("link_status"), reason.alias("link_reason"), key.alias("key_parts"))


def changed_identities(before: DataFrame, added: DataFrame, parts: int) -> DataFrame:
    """Identities whose link ``added`` states change, new ones included: (source, local_id). Only identities that ``added`` names are looked at."""
    touched = before.join(added.select("source", "local_id").distinct(), ["source", "local_id"], "left_semi")
    then, now = (resolved_identities(merged_identities(x), "source", parts) for x in (touched, touched.unionByName(added)))
    joined = now.join(then.withColumnsRenamed({"link_status": "s", "link_reason": "r", "key_parts": "k"}).withColumn("known", F.lit(True)), ["source", "local_id"], "left")
    same = F.col("known") & F.col("link_status").eqNullSafe(F.col("s")) & F.col("link_reason").eqNullSafe(F.col("r")) & F.col("key_parts").eqNullSafe(F.col("k"))
    return joined.filter(~F.coalesce(same, F.lit(False))).select("source", "local_id")


def attach_identities(rows: DataFrame, identities: DataFrame, source: str, local_id: str) -> DataFrame:
    """``rows`` with their identity's columns. Blank ids of one source share an identity row: the join may be split by Spark."""
    return rows.withColumn("local_id", strip(F.col(local_id))).join(identities, [source, "local_id"]).drop("local_id")


def latest_attributes(rows: DataFrame, key: str, order: Sequence[str], attributes: Sequence[str], vary: Sequence[str]) -> DataFrame:
    """One row per key: attributes of its latest row (by ``order``), and whether any of ``vary`` has two values, null counted as one."""
    ranked = F.max_by(F.struct(*order, *attributes), F.struct(*order)).alias("latest")
    spread = [((F.min(c) != F.max(c)) | ((F.count(c) > 0) & (F.count(c) < F.count(F.lit(1))))) for c in vary]
    varies = F.coalesce(spread[0], F.lit(False))
    for s in spread[1:]:
        varies = varies | F.coalesce(s, F.lit(False))
    grouped = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(ranked, varies.alias("attributes_vary"))
    return grouped.select(key, *[F.col(f"latest.{c}").alias(c) for c in (*attributes, *order)], "attributes_vary")
