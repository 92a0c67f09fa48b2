"""Insert-only version history: every delivered row is classified, new versions are appended, the current state is derived.

A record is identified by its key columns, a version by the record and an instant. Rows are compared with the versions held
before their batch and with earlier rows of the same batch in lineage order. First match wins:

1. no record key, or no instant: QUARANTINED;
2. older than the record's current version before the batch: STALE (a replay if the version is known, else a new but old version);
3. the version is known: DUPLICATE, or QUARANTINED if its values conflict with the first arrival;
4. a new version: NEW_ENCOUNTER for the earliest one of a record that was not held before the batch, else NEW_VERSION.

All of it is one pass of windows that share their partitioning by record, so the plan has a single exchange. That keeps a record's rows in one
task. Records with very many rows (``hot_records``) go another way to the same result: what the windows would carry from row to row is the first arrival of each
version, the latest instant before each batch, and the earliest new instant of each batch. These come from partial aggregates by
(record, instant) and (record, batch), the instants carried over the few rows that a record has then, one per batch; joins bring them back to the rows,
and Spark splits such joins where a key is hot.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

NEW_ENCOUNTER, NEW_VERSION, DUPLICATE, STALE, QUARANTINED = "NEW_ENCOUNTER", "NEW_VERSION", "DUPLICATE", "STALE", "QUARANTINED"
EXACT, EQUIVALENT, CONFLICT = "EXACT", "EQUIVALENT", "CONFLICT"
CREATES_VERSION = (NEW_ENCOUNTER, NEW_VERSION)
P = "_h_"


def compare_values(first: str, values: Sequence[str], loose: Sequence[str] = ()) -> Column:
    """How a row's values compare with those of the struct column ``first``.

    EXACT: all equal, nulls too. EQUIVALENT: they differ only in ``loose`` columns (the instant's text) or where one side is null (its
    file has no such column). CONFLICT: anything else.
    """
    strict = [v for v in values if v not in loose]
    same = reduce(and_, [F.col(f"{first}.{v}").eqNullSafe(F.col(v)) for v in values], F.lit(True))
    differ = reduce(or_, [F.coalesce(F.col(f"{first}.{v}") != F.col(v), F.lit(False)) for v in strict], F.lit(False))
    return F.when(same, EXACT).when(differ, CONFLICT).otherwise(EQUIVALENT)


def classify_history(
    rows: DataFrame,
    record: Sequence[str],
    ts: str,
    batch: str,
    lineage: Sequence[str],
    values: Sequence[str],
    loose: Sequence[str] = (),
    ts_reason: str | None = None,
    blank: Column | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """``rows`` of all batches with ``outcome``, ``outcome_reason``, ``match_type``, ``held_current_ts`` and ``is_first_seen``.

    ``batch`` orders the batches; ``blank`` says that a record has no key (default: any of its columns is null); ``ts_reason`` is a column that
    says why an instant is null. Replaying all accepted batches at once gives what classifying them one by one gives. ``hot``: records whose rows are
    spread over tasks (see ``hot_records``); then no two rows may share batch and lineage.
    """
    blank = reduce(or_, [F.col(c).isNull() for c in record]) if blank is None else blank
    tagged = rows.withColumn(f"{P}why", F.when(blank, F.lit("SOURCE_RECORD_ID_MISSING")).when(F.col(ts).isNull(), F.col(ts_reason) if ts_reason else F.lit("TIMESTAMP_MISSING")))
    tagged = tagged.withColumn(f"{P}ok", F.col(f"{P}why").isNull())
    # rows that can't be placed keep to partitions of their own kind, spread by lineage, so that they make no hot record
    spread = F.when(~F.col(f"{P}ok"), F.pmod(F.xxhash64(*lineage), F.lit(1024)))
    tagged = tagged.withColumn(f"{P}spread", spread)
    if hot is None:
        return _decided(_placed_by_windows(tagged, record, ts, batch, lineage, values), ts, batch, values, loose)
    marked = hot.select(*record, F.lit(True).alias(f"{P}hot")).distinct()
    tagged = tagged.join(F.broadcast(marked), list(record), "left")  # at most rows / least of them
    is_hot = F.col(f"{P}ok") & F.coalesce(f"{P}hot", F.lit(False))
    cold = _placed_by_windows(tagged.filter(~is_hot), record, ts, batch, lineage, values)
    spread_out = _placed_by_aggregates(tagged.filter(is_hot), record, ts, batch, lineage, values)
    return _decided(cold.unionByName(spread_out.select(*cold.columns)), ts, batch, values, loose)


def hot_records(rows: DataFrame, record: Sequence[str], least: int = 1_000_000) -> DataFrame:
    """Records with at least ``least`` rows: so few that they may be broadcast."""
    return rows.groupBy(*record).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).select(*record).na.drop(how="any")


def _placed_by_aggregates(tagged: DataFrame, record: Sequence[str], ts: str, batch: str, lineage: Sequence[str], values: Sequence[str]) -> DataFrame:
    """What ``_placed_by_windows`` gives, for rows with a record and an instant, with no task that needs all rows of a record."""
    arrival = F.struct(batch, *lineage)
    firsts = tagged.groupBy(*record, ts).agg(F.min(arrival).alias(f"{P}arrival"), F.min_by(F.struct(F.col(batch).alias(f"{P}batch"), *values), arrival).alias(f"{P}first"))
    latest = tagged.groupBy(*record, batch).agg(F.max(ts).alias(f"{P}latest"))  # a row for each batch
    carried = latest.withColumn("held_current_ts", F.max(f"{P}latest").over(Window.partitionBy(*record).orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)))
    earliest = firsts.groupBy(*record, F.col(f"{P}first")[f"{P}batch"].alias(batch)).agg(F.min(ts).alias(f"{P}earliest"))
    by_batch = carried.join(earliest, [*record, batch], "left").drop(f"{P}latest")
    placed = tagged.join(firsts, [*record, ts], "left").join(by_batch, [*record, batch], "left")
    return placed.withColumn(f"{P}nth", F.when(arrival == F.col(f"{P}arrival"), 1).otherwise(2))


def _placed_by_windows(tagged: DataFrame, record: Sequence[str], ts: str, batch: str, lineage: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows with the latest instant held before their batch, their number among the arrivals of their version, its first arrival, and the earliest new instant of
    their batch."""
    by_record = [f"{P}ok", f"{P}spread", *record]
    before = Window.partitionBy(*by_record).orderBy(batch).rangeBetween(Window.unboundedPreceding, -1)
    arrival = Window.partitionBy(*by_record, ts).orderBy(batch, *lineage)
    in_batch = Window.partitionBy(*by_record, batch)
    held = F.max(ts).over(before)
    placed = tagged.withColumns(
        {
            "held_current_ts": F.when(F.col(f"{P}ok"), held),
            f"{P}nth": F.row_number().over(arrival),
            f"{P}first": F.first_value(F.struct(F.col(batch).alias(f"{P}batch"), *values)).over(arrival),
        }
    )
    return placed.withColumn(f"{P}earliest", F.min(F.when(F.col(f"{P}nth") == 1, F.col(ts))).over(in_batch))


def _decided(placed: DataFrame, ts: str, batch: str, values: Sequence[str], loose: Sequence[str]) -> DataFrame:
    known = F.col(f"{P}nth") > 1
    stale = F.col(ts) < F.col("held_current_ts")
    match = F.when(F.col(f"{P}ok") & known, compare_values(f"{P}first", values, loose))
    placed = placed.withColumn("match_type", match)
    conflict = F.col("match_type") == CONFLICT
    outcome = (
        F.when(~F.col(f"{P}ok"), QUARANTINED)
        .when(stale, STALE)
        .when(known & conflict, QUARANTINED)
        .when(known, DUPLICATE)
        .when(F.col("held_current_ts").isNull() & (F.col(ts) == F.col(f"{P}earliest")), NEW_ENCOUNTER)
        .otherwise(NEW_VERSION)
    )
    # a version known from before the batch is one whose first arrival is in an earlier batch
    held_version = F.col(f"{P}first")[f"{P}batch"] < F.col(batch)
    reason = (
        F.when(~F.col(f"{P}ok"), F.col(f"{P}why"))
        .when(stale & known, "STALE_REPLAY")
        .when(stale, "STALE_NEW_VERSION")
        .when(known & conflict, "VERSION_CONFLICT_SAME_TS")
        .when(known & held_version, "DUPLICATE_OF_HELD_VERSION")
        .when(known, "DUPLICATE_IN_BATCH")
    )
    out = placed.withColumns({"outcome": outcome, "outcome_reason": reason, "is_first_seen": F.col(f"{P}ok") & ~known})
    return out.drop(*[c for c in out.columns if c.startswith(P)])


def classify_batch(batch_rows: DataFrame, held: DataFrame, record: Sequence[str], ts: str, batch: str, lineage: Sequence[str], values: Sequence[str], **options: object) -> DataFrame:
    """One batch against the first-seen rows of the versions held before it (the columns that are named here are enough).

    Only history of records that the batch touches is read.
    """
    touched = batch_rows.select(*record).distinct()
    known = held.join(touched, list(record), "left_semi").select(*[c for c in batch_rows.columns if c in held.columns])
    marked = batch_rows.withColumn("_is_new", F.lit(True)).unionByName(known.withColumn("_is_new", F.lit(False)), allowMissingColumns=True)
    return classify_history(marked, record, ts, batch, lineage, values, **options).filter("_is_new").drop("_is_new")


def new_versions(classified: DataFrame, held: DataFrame | None = None, key: Sequence[str] = ()) -> DataFrame:
    """The rows that add a version to the history; with ``held``, only those whose ``key`` it lacks (a second apply adds none)."""
    first = classified.filter("is_first_seen")
    return first if held is None else first.join(held.select(*key), list(key), "left_anti")


def current_state(versions: DataFrame, record: Sequence[str], ts: str, lineage: Sequence[str], batch: str) -> DataFrame:
    """Each record's latest version, with ``version_count`` and ``first_batch``. A view: nothing is stored as an update."""
    whole = Window.partitionBy(*record)
    latest = whole.orderBy(F.col(ts).desc(), *lineage)
    ranked = versions.withColumns({"version_count": F.count(F.lit(1)).over(whole), "first_batch": F.min(batch).over(whole), f"{P}nth": F.row_number().over(latest)})
    return ranked.filter(F.col(f"{P}nth") == 1).drop(f"{P}nth")


def state_as_of(versions: DataFrame, record: Sequence[str], ts: str, lineage: Sequence[str], batch: str, as_of: object) -> DataFrame:
    """The current state as it was known at the end of batch ``as_of``."""
    return current_state(versions.filter(F.col(batch) <= F.lit(as_of)), record, ts, lineage, batch)


def version_history(versions: DataFrame, current: DataFrame, record: Sequence[str], ts: str) -> DataFrame:
    """All versions with ``is_current``."""
    flag = current.select(*record, F.col(ts).alias(f"{P}current"))
    return versions.join(flag, list(record)).withColumn("is_current", F.col(ts) == F.col(f"{P}current")).drop(f"{P}current")


def outcome_counts(classified: DataFrame, by: Sequence[str], record: Sequence[str]) -> DataFrame:
    """Rows by outcome for each batch and file, versions written, and records whose current version changed."""
    is_ = lambda o: F.col("outcome") == o
    changed = F.when(F.col("outcome").isin(*CREATES_VERSION), F.struct(*record))
    return classified.groupBy(*by).agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(is_(NEW_ENCOUNTER)).alias("new_encounter"),
        F.count_if(is_(NEW_VERSION)).alias("new_version"),
        F.count_if(is_(DUPLICATE)).alias("duplicate"),
        F.count_if(is_(STALE)).alias("stale"),
        F.count_if(F.col("outcome_reason") == "STALE_NEW_VERSION").alias("stale_new_version"),
        F.count_if(is_(QUARANTINED)).alias("quarantined"),
        F.count_if(F.col("is_first_seen")).alias("history_rows"),
        F.countDistinct(changed).alias("current_changed"),
    )


def reconcile(counts: DataFrame, expected: DataFrame, by: Sequence[str]) -> DataFrame:
    """Files whose numbers don't add up: received = expected = sum of outcomes, and history rows = rows that create a version."""
    joined = expected.select(*by, F.col("row_count").alias("expected")).join(counts, list(by), "full_outer").fillna(0)
    outcomes = sum(F.col(c) for c in ("new_encounter", "new_version", "duplicate", "stale", "quarantined"))
    created = F.col("new_encounter") + F.col("new_version") + F.col("stale_new_version")
    good = (F.col("received") == F.col("expected")) & (F.col("received") == outcomes) & (F.col("history_rows") == created)
    return joined.filter(~good)
