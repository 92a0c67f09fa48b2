"""Delivery runs: validate batches, load, classify, clean, gate, publish; then rebuild what is derived.

Tables are folders of Parquet that a log publishes (``sources.store``). All that a batch writes, its audit rows included, becomes visible with one
entry of the log, or, if the batch is rejected, its audit rows and gate issues only; a run that died leaves nothing that counts. The mart and the
quality report are published together too, and only if no invariant fails. What later batches look up by record (``held``, ``fields``) is in folders
by a bucket of the record's key, so that a batch reads the history of the buckets it touches only.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaning as clean
from ..functions.keys import keyed_hash, record_key, version_key
from ..functions.text import expand, once, strip
from ..operators import dimensions, facts, history, identity, quality
from ..operators.checks import GATE_SOURCES
from ..sources import exports, landing, reference
from ..sources.store import Store, Tables, Transaction

LINEAGE = ["file_name", "source_row_number"]
BUCKET = "key_bucket"


@dataclass
class Config:
    """What a run needs besides the landing folder. ``contracts``: source_system, file_name, version, version_position, columns, canonical."""

    canonical: Sequence[str]
    contracts: DataFrame
    conventions: DataFrame
    facilities: DataFrame
    aliases: DataFrame
    codes: DataFrame
    rosters: DataFrame
    secret: bytes = field(repr=False, default=b"")
    max_error_share: Decimal = Decimal("0.10")
    #: folders per batch of what is looked up by record; fixed for the life of a store
    key_buckets: int = 64
    #: rows from which a replay spreads a record over tasks
    hot_rows: int = 1_000_000


def committed(tables: Tables, name: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """A table's rows of batches; with ``buckets``, those of these buckets of record keys: no other folder is read."""
    rows = tables.read(name)
    return (rows if buckets is None else rows.filter(F.col(BUCKET).isin(list(buckets)))).drop(BUCKET)


AUDIT = "file_name string, source_system string, expected_count bigint, received_count bigint, status string, reason string, new_encounter bigint, new_version bigint, duplicate bigint, stale bigint, stale_new_version bigint, quarantined bigint, history_rows bigint, current_changed bigint, accepted_count bigint, reconciliation_status string, start_time timestamp_ntz, end_time timestamp_ntz, batch_id string"


def observed(raw: DataFrame, conventions: DataFrame) -> DataFrame:
    """Raw rows with their record key, instant and the reason for a missing one. The file's system counts, not the row's column."""
    c = conventions.select(F.col("source_system").alias("file_source_system"), "date_order", "amount_unit", "timestamp_timezone", "century")
    rows = raw.join(c, "file_source_system", "left")  # every contract's system has conventions: see ``require_usable``
    rows = clean.clean_timestamp(rows, "_ts", F.col("last_updated_ts"), F.col("timestamp_timezone"), F.col("date_order")).withColumns({"version_ts": F.col("_ts.value"), "version_ts_reason": F.col("_ts.reason"), "last_updated_ts_warning": F.col("_ts.warning")}).drop("_ts")
    rows = rows.withColumn("encounter_key", F.when(clean.has_record_id(F.col("source_record_id")), record_key("encounter/v1", F.col("file_source_system"), F.col("source_record_id"))))
    return rows.withColumn("version_key", F.when(F.col("version_ts").isNotNull() & F.col("encounter_key").isNotNull(), version_key("version/v1", F.col("file_source_system"), F.col("source_record_id"), F.col("version_ts"))))


def key_bucket(config: Config) -> Column:
    """The bucket of a row's record; rows without a record key share one."""
    return F.pmod(F.xxhash64("encounter_key"), F.lit(config.key_buckets)).cast("int")


def require_usable(config: Config) -> None:
    """Refuse a configuration that would give wrong tables: contracts, reference inputs, vocabulary, a system without conventions."""
    spark = config.contracts.sparkSession
    systems = config.contracts.select("source_system").distinct()
    found = {
        "contracts": landing.contract_problems(config.contracts, config.canonical),
        "conventions": systems.join(config.conventions, "source_system", "left_anti").select(F.lit("a system without conventions").alias("problem")).unionByName(config.conventions.groupBy("source_system").count().filter("count > 1").select(F.lit("two conventions of one system").alias("problem"))),
        "code list": reference.code_problems(config.codes),
        "facilities": reference.facility_problems(config.facilities),
        "facility names": reference.facility_index_problems(config.facilities, config.aliases),
        "rosters": reference.roster_problems(config.rosters).select("problem").unionByName(dimensions.snapshot_problems(config.rosters, "npi", "as_of_date", "primary_facility_id", config.facilities.select("facility_id")).select("problem")),
        "vocabulary": clean.vocabulary_problems(clean.vocabulary(spark)).select(F.lit("a spelling of two categories").alias("problem")),
    }
    # one job for all of them
    quality.require_no_problem(reduce(DataFrame.unionByName, [df.select(F.concat(F.lit(f"{what}: "), "problem").alias("problem")) for what, df in found.items()]), "configuration")


def cleaned_fields(versions: DataFrame, config: Config) -> DataFrame:
    """Cleaned columns of versions: value and reason of each field, warnings where a value can be doubtful."""
    # every field ends with a generator, so that no generated method takes in more than one of them: see ``text.Steps``
    rows = clean.resolve_npi(versions, "_number", F.col("attending_npi"))
    for out, c in (("_admit", "admit_date"), ("_discharge", "discharge_date")):
        rows = clean.clean_date(rows, out, F.col(c), F.col("date_order"), F.col("century"), F.col("delivered_date"))
    rows = clean.clean_encounter_type(rows, "_type", F.col("encounter_type"))
    rows = clean.clean_claim_status(rows, "_status", F.col("claim_status"))
    rows = clean.clean_payer_category(rows, "_payer", F.col("payer_name"))
    rows = clean.clean_amount(rows, "_amount", F.col("billed_amount"), F.col("amount_unit"))
    # few names and codes stand in most rows, so rows never move by them: facilities and the code list are sent to every task
    index = reference.facility_index(config.facilities, config.aliases)
    rows = reference.resolve_facility(rows, F.broadcast(index), "facility_name", "file_source_system")
    rows = clean.resolve_icd10(rows, "_diagnosis", F.col("primary_dx_code"), F.broadcast(config.codes))
    # Spark broadcasts a roster that it knows to be small; otherwise rows without a number, which find nothing, are spread
    listed = config.rosters.select(F.col("npi").alias("_npi")).distinct().withColumn("_in_roster", F.lit(True))
    sought = F.coalesce(F.col("_number.value"), F.concat(F.lit("row "), F.col("source_row_number")))
    rows = rows.withColumn("_sought", sought).join(listed, F.col("_sought") == F.col("_npi"), "left")
    keys = ["version_key", "batch_id", *LINEAGE, BUCKET]
    return rows.select(
        *keys, "facility_id", "facility_id_reason", "last_updated_ts_warning",
        *expand("admit_date", F.col("_admit"), warning=False), *expand("discharge_date", F.col("_discharge"), warning=False),
        clean.discharge_before_admit(F.col("_admit.value"), F.col("_discharge.value")).alias("discharge_date_warning"),
        *expand("encounter_type", F.col("_type")), *expand("claim_status", F.col("_status"), warning=False),
        *expand("payer_category", F.col("_payer")), *expand("primary_dx_code", F.col("_diagnosis")),
        F.col("_number.value").alias("attending_npi"), F.col("_number.reason").alias("attending_npi_reason"), clean.flag_not_in_roster(F.col("_number.value"), F.col("_in_roster")).alias("attending_npi_warning"),
        *expand("billed_amount_usd", F.col("_amount"), warning=False),
    )


def run_batch(store: Store, landing_folder: str, batch_id: str, config: Config) -> str:
    """Validate, load, classify, clean and gate one batch; returns ACCEPTED or REJECTED. Only the batch's own folder is read. Everything is published at once."""
    began = datetime.now(timezone.utc)
    spark, t = store.spark, store.begin()
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.persist())
        return kept[-1]

    # files, manifest entries and decisions of one batch: a row for each file, held by the driver so that later plans are short
    small = lambda df: spark.createDataFrame(df.collect(), df.schema)
    listed = landing.scan_batches(spark, landing_folder, [batch_id])
    own = small(landing.hashed(spark, listed))
    contract_files = config.contracts.select("source_system", "file_name").distinct()
    entries, manifest_failures = (small(df) for df in landing.read_manifests(own, contract_files))
    records = keep(landing.read_records(spark, listed))
    try:
        failures, matched = landing.check_files(own, entries, records, config.contracts)
        received = records.filter("kind <> 'failure'").groupBy("batch_id", "file_name").agg(F.count_if(F.col("kind") == "record").alias("received"))
        audit = small(landing.decide_batches(entries, manifest_failures, failures, received))
        matched = small(matched)
        if audit.filter("status = 'REJECTED'").head(1):
            _commit(t, audit, batch_id, began)
            return "REJECTED"
        raw = landing.to_canonical(records, matched, config.canonical)
        stamped = entries.select("batch_id", "file_name", clean.delivered_date(F.col("delivered_at")).alias("delivered_date"), F.col("sha256").alias("file_sha256"))
        loaded = t.append("raw", raw.join(F.broadcast(stamped), ["batch_id", "file_name"]), batch_id)
        _require_rows(t, "raw", batch_id, entries.agg(F.sum("row_count")).first()[0])
        ingested = matched.select("batch_id", "file_name", "source_system", "version", F.col("fields").alias("source_header")).join(stamped.withColumnRenamed("file_sha256", "sha256"), ["batch_id", "file_name"])
        t.append("ingested", ingested.join(entries.select("batch_id", "file_name", "row_count"), ["batch_id", "file_name"]).join(own.select("batch_id", "file_name", "length", "modified"), ["batch_id", "file_name"]), batch_id)
        persons = keep(person_rows(loaded, config))
        t.append("person_rows", persons.drop(*LINKAGE), batch_id)
        t.append("identity_states", identity_states(persons), batch_id)
        rows = observed(loaded, config.conventions)
        options = {"values": list(config.canonical), "loose": ["last_updated_ts"], "ts_reason": "version_ts_reason", "blank": F.col("encounter_key").isNull()}
        rows = keep(rows.withColumn(BUCKET, key_bucket(config)))
        # at most ``key_buckets`` numbers
        touched = [r[0] for r in rows.filter("version_key IS NOT NULL").select(BUCKET).distinct().collect()]
        compared = ["batch_id", *LINEAGE, "encounter_key", "version_ts", *config.canonical]
        if t.exists("versions") and not t.exists("held"):
            raise ValueError("the store has versions but no table 'held': it is of an earlier layout, run its batches into a new one")
        earlier = {n: committed(t, n, touched).filter(F.col("batch_id") < batch_id) for n in ("held", "fields") if t.exists(n)}
        held = earlier.get("held", rows.limit(0).select(*compared))
        numbered = lambda df: df.withColumn("batch_no", F.regexp_extract("batch_id", "([0-9]+)", 1).cast("int"))
        classified = keep(history.classify_batch(numbered(rows), numbered(held), ["encounter_key"], "version_ts", "batch_no", LINEAGE, **options))
        outcomes = classified.select("batch_id", *LINEAGE, F.col("file_source_system").alias("source_system"), "source_record_id", "encounter_key", "version_key", "outcome", "outcome_reason", "match_type")
        added = history.new_versions(classified)
        outcomes = t.append("outcomes", outcomes, batch_id)
        _require_rows(t, "outcomes", batch_id, t.rows("raw", batch_id))
        t.append("held", added.select(*compared, BUCKET), batch_id, [BUCKET])
        t.append("versions", added.select("batch_id", *LINEAGE, "version_key", "encounter_key", F.col("file_source_system").alias("source_system"), "source_record_id", F.col("version_ts").alias("last_updated_ts_utc"), F.col("outcome").alias("arrival_outcome")), batch_id)
        fields = t.append("fields", cleaned_fields(added, config), batch_id, [BUCKET])
        for n in ("held", "fields"):
            _require_rows(t, n, batch_id, t.rows("versions", batch_id))
        counts = history.outcome_counts(classified, ["batch_id", "file_name"], ["encounter_key"])
        expected = entries.select("batch_id", "file_name", "row_count")
        quality.require_none(history.reconcile(counts, expected, ["batch_id", "file_name"]), "the batch doesn't reconcile")
        read = ["version_key", *GATE_SOURCES]
        every = earlier["fields"].select(*read).unionByName(fields.select(*read)) if "fields" in earlier else fields
        keys = ["batch_id", *LINEAGE, "source_system", "source_record_id"]
        issues = keep(quality.gate_issues(outcomes, every, "version_key", keys, GATE_SOURCES))
        gate = quality.publish_gate(outcomes, issues, "batch_id", LINEAGE, config.max_error_share)
        if gate.filter("failed").head(1):
            t.discard("raw", "ingested", "person_rows", "identity_states", "outcomes", "held", "versions", "fields")
            t.append("gate_rejected_issues", issues, batch_id)
            _commit(t, audit.withColumns({"status": F.lit("REJECTED"), "reason": F.lit("DQ_GATE_FAILED")}), batch_id, began)
            return "REJECTED"
        flags = landing.duplicate_files(own, t.read("ingested").filter(F.col("batch_id") < batch_id))
        audit = audit.join(flags, ["batch_id", "file_name"], "left").withColumn("reason", F.coalesce("reason", "flag")).drop("flag")
        # the batch reconciled above, or it had not come this far
        done = audit.join(counts.drop("received"), ["batch_id", "file_name"], "left")
        _commit(t, done.withColumns({"accepted_count": F.col("new_encounter") + F.col("new_version"), "reconciliation_status": F.lit("RECONCILED")}), batch_id, began)
        return "ACCEPTED"
    finally:
        for df in kept:  # the caller's own cached tables stay
            df.unpersist()


def _require_rows(t: Transaction, name: str, batch_id: str, expected: int | None) -> None:
    """The rows that were counted as they were written are those that must be there: none was lost or doubled."""
    if t.rows(name, batch_id) != (expected or 0):
        raise quality.PipelineError(f"{name}: {t.rows(name, batch_id)} rows written, {expected or 0} expected")


def _commit(t: Transaction, audit: DataFrame, batch_id: str, began: datetime) -> None:
    """Write audit rows and publish; nothing of a rejected file is accepted."""
    utc = lambda x: F.lit(x.replace(tzinfo=None).isoformat(" ")).cast("timestamp_ntz")
    audit = audit.withColumns({"start_time": utc(began), "end_time": utc(datetime.now(timezone.utc)), "accepted_count": F.col("accepted_count") if "accepted_count" in audit.columns else F.lit(0)})
    kinds = dict(x.rsplit(" ", 1) for x in AUDIT.split(", "))
    t.append("audit", audit.select(*[(F.col(c) if c in audit.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()]), batch_id)
    t.commit()


def run_pending(store: Store, landing_folder: str, config: Config) -> dict[str, str]:
    """All batches without audit rows, in order; each is final once it is decided. A configuration with problems is refused; a processed batch whose
    folder now holds other data is left as it is, with a warning: of processed batches only those are read whose listing has changed."""
    require_usable(config)
    spark = store.spark
    listed = landing.scan_batches(spark, landing_folder)
    if store.exists("ingested"):
        then = store.read("ingested")
        data = listed.filter(F.col("file_name") != landing.MANIFEST)
        suspects = [r[0] for r in landing.suspected_redelivery(data, then).collect()]  # names of folders that were touched
        if suspects:
            now = landing.hashed(spark, landing.scan_batches(spark, landing_folder, suspects).filter(F.col("file_name") != landing.MANIFEST))
            changed = landing.changed_redelivery(now, then.filter(F.col("batch_id").isin(suspects))).orderBy("batch_id").limit(20).collect()
            if changed:
                warnings.warn(f"delivered anew with other data, not read again: {', '.join(r['batch_id'] for r in changed)}", stacklevel=2)
    batches = listed.select("batch_id").distinct()
    pending = landing.pending_batches(batches, store.read("audit")) if store.exists("audit") else batches.orderBy("batch_id")
    return {r["batch_id"]: run_batch(store, landing_folder, r["batch_id"], config) for r in pending.collect()}  # one row per delivered folder


def replay_history(store: Tables, config: Config) -> DataFrame:
    """All accepted rows classified in one pass: what the batches gave one by one."""
    rows = observed(store.read("raw"), config.conventions).withColumn("batch_no", F.regexp_extract("batch_id", "([0-9]+)", 1).cast("int"))
    hot = history.hot_records(rows, ["encounter_key"], config.hot_rows)
    return history.classify_history(rows, ["encounter_key"], "version_ts", "batch_no", LINEAGE, list(config.canonical), loose=["last_updated_ts"], ts_reason="version_ts_reason", blank=F.col("encounter_key").isNull(), hot=hot)


LINKAGE = ["_last", "_first", "_born", "_known_sex"]


def person_rows(raw: DataFrame, config: Config) -> DataFrame:
    """Per raw row: its identity (source and local id), what links it (columns with an underscore), and attributes that identify nobody: sex, age band, ZIP area."""
    conventions = config.conventions.select(F.col("source_system").alias("file_source_system"), "date_order", "century")
    rows = raw.join(conventions, "file_source_system", "left")  # every contract's system has conventions; a row is never lost here
    for out, c in (("_dob", "patient_dob"), ("_adm", "admit_date")):
        rows = clean.clean_date(rows, out, F.col(c), F.col("date_order"), F.col("century"), F.col("delivered_date"))
    rows = once(rows, _born=F.col("_dob.value"), _admit=F.col("_adm.value"), _sex=clean.clean_sex(F.col("patient_sex")), _last=clean.clean_last_name(F.col("patient_last_name"))["value"], _first=clean.clean_first_name(F.col("patient_first_name"))["value"])
    return rows.withColumn("_known_sex", F.nullif(F.col("_sex.value"), F.lit("UNKNOWN"))).select(
        "batch_id", *LINEAGE, "file_source_system", strip(F.col("patient_mrn")).alias("local_id"), *LINKAGE,
        F.col("_sex.value").alias("sex"), F.col("_sex.warning").alias("sex_reason"),
        *(lambda a: [a["value"].alias("age_band"), a["warning"].alias("age_band_reason")])(clean.age_band(F.col("_born"), F.col("_admit"))),
        *(lambda z: [z["value"].alias("zip3"), z["reason"].alias("zip3_reason")])(clean.zip3(F.col("patient_zip"))),
    )


def identity_states(persons: DataFrame) -> DataFrame:
    return identity.identity_states(persons, "file_source_system", "local_id", LINKAGE, F.col("_born").isNotNull())


def people(store: Tables, config: Config) -> DataFrame:
    """Attributes per raw row that identify nobody: key, link status, sex, age band, ZIP area. Batches leave their rows and the states of their identities; here the
    states merge, and no raw row is read again."""
    found = identity.resolved_identities(identity.merged_identities(store.read("identity_states")), "file_source_system", len(LINKAGE))
    return linked_people(store.read("person_rows"), found, config)


def linked_people(persons: DataFrame, found: DataFrame, config: Config) -> DataFrame:
    found = found.withColumn("patient_key", keyed_hash(config.secret, F.col("key_parts"))).drop("key_parts")
    linked = identity.attach_identities(persons, found, "file_source_system", "local_id")
    return linked.select("batch_id", *LINEAGE, "patient_key", F.col("link_status").alias("patient_link_status"), F.col("link_reason").alias("patient_link_reason"), "sex", "sex_reason", "age_band", "age_band_reason", "zip3", "zip3_reason")


def compact(store: Store) -> None:
    """Few files instead of some for each batch: what is looked up by record, one state for each identity, and the mart without replaced rows. Published together.

    States of batches that the mart doesn't cover yet lose their batch, so the next mart is rebuilt whole: compact after publishing it.
    """
    t = store.begin()
    for name in ("held", "fields"):
        t.replace(name, t.read(name), [BUCKET])
    t.replace("identity_states", identity.merged_identities(t.read("identity_states")))
    for name in ("people", *MART):
        if t.exists(name):
            t.fold(name)
    t.commit()


def publish_mart(store: Store, config: Config) -> dict[str, DataFrame]:
    """Bring the mart up to date, count the quality report and publish both, unless something is wrong with them: then what was published before stays."""
    t = store.begin()
    update_mart(t, config)
    quality_report(t, config)
    t.commit()
    return {n: store.read(n) for n in (*MART, "dq_report")}


MART = ("dim_provider", "dim_facility", "dim_payer", "dim_diagnosis", "dim_date", "dim_patient", "fact_version", "fact_current", "issues", "quarantine")
ISSUE_KEYS = ["version_key", "encounter_key", "source_system", "source_record_id", "batch_id", *LINEAGE]
PATIENT_ORDER = ["last_updated_ts_utc", "batch_id", *LINEAGE]
PATIENT_ATTRIBUTES = ["patient_link_status", "patient_link_reason", "sex", "sex_reason", "zip3", "zip3_reason"]


def rebuild_mart(store: Store | Transaction, config: Config) -> dict[str, DataFrame]:
    """Dimensions, facts, issues and quarantine from the published history, each written whole; returns them by name. On a store they are published together."""
    if isinstance(store, Store):
        t = store.begin()
        rebuild_mart(t, config)
        t.commit()
        return {n: store.read(n) for n in MART}
    versions, fields = committed(store, "versions"), committed(store, "fields")
    store.replace("people", people(store, config))
    _write_dimensions(store, config, fields)
    facts_now = store.replace("fact_version", _facts(store, versions, fields, store.read("people")))
    _require_facts(versions, facts_now)
    current = _current(versions)
    store.replace("fact_current", facts.fact_current(facts_now, current, "version_key", ["version_count", "first_batch"]))
    issues = store.replace("issues", _issues(facts_now))
    quality.require_none(quality.duplicate_rows(issues, ["version_key", "check_code"]), "two issues of one check")
    store.replace("dim_patient", _patients(facts_now))
    store.replace("quarantine", quality.quarantine(store.read("audit"), _gate_rejected(store), committed(store, "outcomes"), issues, current))
    _note_covered(store, store.batches("audit"), mart_basis(config))
    return {n: store.read(n) for n in MART}


def update_mart(store: Store | Transaction, config: Config) -> str:
    """The mart as ``rebuild_mart`` would write it, by what has changed since it was last written; returns UPDATED or REBUILT. On a store it is published.

    Batches decided since then, and the earlier rows of people whose link they change, give the versions whose facts are written; the encounters, people and
    rows of the quarantine that these touch follow. Facts, issues and the like are merged by key: what is written follows the batch, not the history. History
    is read by joins with the little that has changed. The code list's, the facilities' and the calendar's tables are written whole: they don't grow with the deliveries.
    It is rebuilt whole if there is none yet, if the rosters or the secret are others (they reach every fact), or if a new batch's identity states were compacted.
    """
    if isinstance(store, Store):
        t = store.begin()
        done = update_mart(t, config)
        t.commit()
        return done
    basis = mart_basis(config)
    covered = {r["batch_id"] for r in store.read("mart_state").filter(F.col("basis") == basis).collect()} if store.exists("mart_state") else set()  # one row per delivered folder
    decided = store.batches("audit")
    added = decided - covered
    loaded = store.batches("outcomes") & added
    if not store.batches("outcomes") & covered or not loaded <= store.batches("identity_states"):
        rebuild_mart(store, config)
        return "REBUILT"
    versions, fields = committed(store, "versions"), committed(store, "fields")
    _write_dimensions(store, config, fields)
    if not added:
        return "UPDATED"
    line, kept = ["batch_id", *LINEAGE], []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.persist())
        return kept[-1]

    try:
        # people of new rows, and of earlier rows whose identity links otherwise now
        states = store.read("identity_states", loaded)
        before = store.read("identity_states", store.batches("identity_states") - loaded)
        touched = before.join(states.select("source", "local_id").distinct(), ["source", "local_id"], "left_semi").unionByName(states)
        found = identity.resolved_identities(identity.merged_identities(touched), "file_source_system", len(LINKAGE))
        flipped = identity.changed_identities(before, states, len(LINKAGE)).withColumnRenamed("source", "file_source_system")
        earlier = store.read("person_rows", store.batches("person_rows") - loaded).join(flipped, ["file_source_system", "local_id"], "left_semi")
        persons = store.merge("people", line, linked_people(store.read("person_rows", loaded).unionByName(earlier), found, config))

        old = store.read("fact_version")
        fresh = versions.join(persons.select(*line), line, "left_semi")
        facts_new = store.merge("fact_version", ["version_key"], _facts(store, fresh, fields, persons))
        _require_facts(store.read("versions", loaded), facts_new)
        issues_new = store.merge("issues", ["version_key"], _issues(facts_new), facts_new)
        quality.require_none(quality.duplicate_rows(issues_new, ["version_key", "check_code"]), "two issues of one check")

        facts_now, encounters = store.read("fact_version"), facts_new.select("encounter_key").distinct()
        history_of = keep(versions.join(encounters, "encounter_key", "left_semi"))
        current = keep(_current(history_of))
        store.merge("fact_current", ["encounter_key"], facts.fact_current(facts_now, current, "version_key", ["version_count", "first_batch"]))
        were = old.join(facts_new.select("version_key"), "version_key", "left_semi").select("patient_key")
        patients = keep(were.unionByName(facts_new.select("patient_key")).distinct())
        store.merge("dim_patient", ["patient_key"], _patients(facts_now.join(patients, "patient_key", "left_semi")), patients)

        issues_of = store.read("issues").join(encounters, "encounter_key", "left_semi")
        set_aside = quality.quarantine(store.read("audit", added), _gate_rejected(store, added), store.read("outcomes", loaded), issues_of, current)
        store.merge("quarantine", ["version_key"], set_aside, history_of)
        _note_covered(store, decided, basis)
        return "UPDATED"
    finally:
        for df in kept:
            df.unpersist()


def mart_basis(config: Config) -> str:
    """What every fact depends on besides the batches: a digest of the providers, and of the secret under itself."""
    secret = keyed_hash(config.secret, F.array(F.lit("mart_basis/v1")))
    return "|".join(str(x) for x in quality.state_digest(_provider_dim(config)).withColumn("secret", secret).first())


def _note_covered(store: Transaction, batches: set[str | None], basis: str) -> None:
    store.replace("mart_state", store.spark.createDataFrame([(b, basis) for b in sorted(batches)], "batch_id string, basis string"))


def _provider_dim(config: Config) -> DataFrame:
    attributes = ["provider_last_name", "provider_first_name", "credential", "specialty", "primary_facility_id", "employment_status"]
    carried = [c for c in ("file_name", "source_row_number") if c in config.rosters.columns]
    return dimensions.scd2(config.rosters, "npi", "as_of_date", attributes, carried)


def _write_dimensions(store: Transaction, config: Config, fields: DataFrame) -> None:
    store.replace("dim_provider", _provider_dim(config))
    store.replace("dim_facility", config.facilities)
    store.replace("dim_payer", dimensions.payer_dim(store.spark))
    store.replace("dim_diagnosis", dimensions.reference_and_observed(config.codes, fields.select(F.col("primary_dx_code").alias("icd10_code")), "icd10_code"))
    store.replace("dim_date", dimensions.calendar_dim(fields, "admit_date", "discharge_date"))


def _facts(store: Transaction, versions: DataFrame, fields: DataFrame, persons: DataFrame) -> DataFrame:
    """Facts of versions: cleaned fields, the person, the provider at the admission, the length of the stay."""
    joined = facts.fact_versions(versions, fields.drop("batch_id", *LINEAGE), persons, "version_key", ["batch_id", *LINEAGE])
    placed = dimensions.point_in_time(joined, store.read("dim_provider"), "attending_npi", "admit_date", "attending_npi_reason", dim_key="npi")
    stay = clean.length_of_stay(F.col("admit_date"), F.col("discharge_date"))
    placed = placed.withColumnsRenamed({"sk": "provider_sk", "sk_reason": "provider_sk_reason"}).withColumn("_stay", stay)
    return placed.withColumns({
        "length_of_stay_days": F.col("_stay.value"), "length_of_stay_days_reason": F.col("_stay.reason"), "patient_key_reason": F.when(F.col("patient_key").isNull(), F.col("patient_link_reason")),
    }).drop("_stay")


def _require_facts(versions: DataFrame, fact_rows: DataFrame) -> None:
    """Every version met its fields, its person and its provider exactly once."""
    quality.require_none(versions.select("version_key").join(fact_rows.select("version_key"), "version_key", "left_anti"), "versions without facts")
    quality.require_none(quality.duplicate_rows(fact_rows, ["version_key"]), "versions with two facts")


def _current(versions: DataFrame) -> DataFrame:
    return history.current_state(versions, ["encounter_key"], "last_updated_ts_utc", ["batch_id", *LINEAGE], "batch_id")


def _issues(fact_rows: DataFrame) -> DataFrame:
    sources = [c for c in dict.fromkeys(s for s, *_ in quality.catalogue.CODE_MAP) if c in fact_rows.columns]
    quality.require_none(quality.unclassified(quality.long_reasons(fact_rows, ["version_key"], sources)), "unclassified reason codes")
    return quality.version_issues(fact_rows, ISSUE_KEYS, sources)


def _patients(fact_rows: DataFrame) -> DataFrame:
    return identity.latest_attributes(fact_rows, "patient_key", PATIENT_ORDER, PATIENT_ATTRIBUTES, ["sex", "zip3"])


def _gate_rejected(store: Transaction, batches: set[str | None] | None = None) -> DataFrame:
    if store.exists("gate_rejected_issues"):
        return store.read("gate_rejected_issues", batches)
    return store.read("issues").limit(0).select("batch_id", *LINEAGE, "source_system", "source_record_id", "check_code", "reason_code")


def volume_as_of(store: Tables, batch_id: str) -> DataFrame:
    """The volume report as it was known at the end of a batch. An encounter whose version of then has an ERROR is left out; it has no older one in its place."""
    known = history.state_as_of(store.read("fact_version"), ["encounter_key"], "last_updated_ts_utc", ["batch_id", *LINEAGE], "batch_id", batch_id)
    return facts.volume_report(known, store.read("issues"), store.read("dim_date"), store.read("dim_facility"))


def cohort(store: Tables, year: int = 2024, least: str = "5000.00") -> DataFrame:
    """The cohort of chronic conditions over the rebuilt star schema."""
    current = store.read("fact_current").withColumnsRenamed({"batch_id": "source_batch_id", "file_name": "source_file_name"})
    return facts.chronic_acute_cohort(current, store.read("issues"), store.read("dim_facility"), store.read("dim_diagnosis"), store.read("dim_provider"), year, least)


def quality_report(store: Store | Transaction, config: Config) -> DataFrame:
    """The quality report; a failed invariant raises before anything is published, since the tables then contradict the library's own rules."""
    t = store.begin() if isinstance(store, Store) else store
    report = t.replace("dq_report", build_report(t, config))
    quality.require_none(quality.failed_invariants(report), "failed invariants")
    if isinstance(store, Store):
        t.commit()
    return report


def export_all(store: Tables, config: Config, folder: str) -> None:
    """All exported tables, the audit and the cohort as CSV. Needs ``rebuild_mart`` and ``quality_report`` first."""
    exports.export_tables({n: committed(store, n) if n in ("versions", "outcomes", "fields") else store.read(n) for n in exports.EXPORTED}, folder)
    exports.export_audit(store.read("audit"), f"{folder.rstrip('/')}/batch_audit.csv")
    exports.export_cohort(cohort(store), f"{folder.rstrip('/')}/chronic_acute_encounters.csv")


def build_report(store: Tables, config: Config) -> DataFrame:
    """The whole quality report: 51 rows per file, two per batch, one more per rejected batch. Needs ``rebuild_mart`` first.

    Every number is an aggregate by (batch, file); the report joins a handful of such small tables.
    """
    by = ["batch_id", "file_name"]
    audit = store.read("audit")
    manifest = audit.filter(F.col("file_name") == landing.MANIFEST)
    files = audit.filter(F.col("file_name") != landing.MANIFEST).withColumnRenamed("status", "batch_status")
    accepted, rejected = files.filter("batch_status = 'ACCEPTED'"), files.filter("batch_status = 'REJECTED'")
    null, no = F.lit(None).cast("bigint"), F.lit(False)
    issues, outcomes, facts_v = store.read("issues"), committed(store, "outcomes"), store.read("fact_version")

    def counts(df: DataFrame, check: Column | str, evaluated: Column, observed: Column, expected: Column = null, codes: Column | None = None) -> DataFrame:
        check = F.lit(check) if isinstance(check, str) else check
        codes = F.lit(None).cast("string") if codes is None else codes
        return df.select(*by, check.alias("check_code"), evaluated.cast("bigint").alias("evaluated"), observed.cast("bigint").alias("observed"), expected.cast("bigint").alias("expected"), codes.alias("reason_codes"), no.alias("not_evaluated"))

    # each table gives its rows once, as numbers under common names; one sum by file adds them up
    versions, fact_current = committed(store, "versions"), store.read("fact_current")
    dims = {n: store.read(n) for n in ("dim_facility", "dim_diagnosis", "dim_payer", "dim_provider", "dim_patient", "dim_date")}
    foreign = [("FK_FACT_FACILITY", "facility_id", dims["dim_facility"], "facility_id"), ("FK_FACT_DIAGNOSIS", "primary_dx_code", dims["dim_diagnosis"], "icd10_code"), ("FK_FACT_PAYER", "payer_category", dims["dim_payer"], "payer_category"), ("FK_FACT_PROVIDER", "provider_sk", dims["dim_provider"], "sk"), ("FK_FACT_PATIENT", "patient_key", dims["dim_patient"], "patient_key")]
    dated = [(f"_{d}", d, dims["dim_date"], "date_key") for d in ("admit_date", "discharge_date")]
    flagged = quality.with_orphan_flags(quality.with_repeated(facts_v, ["version_key"]), [*foreign, *dated])
    valued = ["facility_id", "patient_key", "zip3", "attending_npi", "provider_sk", "admit_date", "discharge_date", "length_of_stay_days", "encounter_type", "claim_status", "primary_dx_code", "payer_category", "billed_amount_usd"]
    current = history.current_state(versions, ["encounter_key"], "last_updated_ts_utc", ["batch_id", *LINEAGE], "batch_id")
    same = ["encounter_key", "version_key", "version_count", *by, "source_row_number"]
    creates = F.col("outcome").isin(*history.CREATES_VERSION) | (F.coalesce("outcome_reason", F.lit("")) == "STALE_NEW_VERSION")
    one, repeated = F.lit(1), F.col("repeated")
    rows = (
        (store.read("raw"), {"raw": one}), (outcomes, {"outcomes": one, "history_expected": creates}), (store.read("people"), {"people": one}), (quality.with_repeated(versions, ["version_key"]), {"versions": one, "KEY_UNIQUE": repeated}),
        (quality.with_repeated(committed(store, "fields"), ["version_key"]), {"fields": one, "KEY_UNIQUE": repeated}), (quality.with_repeated(fact_current, ["encounter_key"]), {"current": one, "KEY_UNIQUE": repeated}),
        (flagged, {"facts": one, "KEY_UNIQUE": repeated, "VALUE_REASON_CONSISTENT": quality.inconsistent(valued, ["age_band", "sex"]), "FK_FACT_DATE": F.col("_admit_date") | F.col("_discharge_date"), **{n: F.col(n) for n, *_rest in foreign}}),
        (store.read("quarantine"), {"quarantine": F.col("quarantine_source").isin("HISTORY_ORDERING", "VERSION_DQ")}), (quality.with_repeated(issues, ["version_key", "check_code"]), {"KEY_UNIQUE": repeated}),
        (quality.difference_sizes(fact_current, current, same), {"CURRENT_MATCHES_HISTORY": F.col("n")}),
        # issues that no version accounts for make a file's partition too large
        (quality.issues_without_version(issues, versions, ["version_key", *by, "source_row_number"]).select(*by, "version_key").distinct(), {"strays": one}), (issues.filter("severity = 'ERROR'").select(*by, "version_key").distinct(), {"error_versions": one}),
    )
    names = list(dict.fromkeys(n for _, x in rows for n in x))
    numbers = [df.select(*by, *[(x[n].cast("bigint") if n in x else F.lit(0).cast("bigint")).alias(n) for n in names]) for df, x in rows]
    totals = reduce(DataFrame.unionByName, numbers).groupBy(*by).agg(*[F.sum(n).alias(n) for n in names])
    base = accepted.join(totals, by, "left").fillna(0, names).withColumns({"one": F.lit(1), "in_partition": F.col("versions") + F.col("strays")})
    c = F.col
    measured = {
        "RECON_RAW_ROWS": ("received_count", "raw", c("received_count")), "RECON_ROW_OUTCOMES": ("received_count", "outcomes", c("received_count")), "RECON_PATIENT_ROWS": ("received_count", "people", c("received_count")),
        "RECON_QUARANTINE_ROWS": ("received_count", "quarantine", c("quarantined") + c("error_versions")), "RECON_HISTORY_ROWS": ("versions", "versions", c("history_expected")), "RECON_VERSION_FIELD_ROWS": ("versions", "fields", c("versions")),
        "RECON_FACT_VERSION_ROWS": ("versions", "facts", c("versions")), "RECON_DQ_PARTITION": ("versions", "in_partition", c("versions")), "RECON_CURRENT_ROWS": ("versions", "current", null), "ROW_COUNT_MATCH": ("one", "received_count", c("expected_count")),
    }
    zero = ("FK_FACT_DATE", "VALUE_REASON_CONSISTENT", "CURRENT_MATCHES_HISTORY", "KEY_UNIQUE", *[n for n, *_rest in foreign])
    changed = quality.schema_version_changes(committed(store, "ingested"), "source_system", "batch_id", "version").select(*by, F.lit(1).alias("changed"))
    base = base.join(changed, by, "left").withColumns({"changed": F.coalesce("changed", F.lit(0)), "again": F.startswith(F.coalesce("reason", F.lit("")), F.lit("DUPLICATE_FILE")).cast("int")})

    def measure(check: str, evaluated: Column, observed: Column, expected: Column = null, codes: Column | None = None) -> Column:
        values = {"evaluated": evaluated, "observed": observed, "expected": expected}
        return F.struct(F.lit(check).alias("check_code"), *[x.cast("bigint").alias(k) for k, x in values.items()], (F.lit(None).cast("string") if codes is None else codes).alias("own_codes"))

    flag = lambda check, column: measure(check, F.lit(1), c(column), codes=F.when(c(column) == 1, check))
    counted = [(x[0], x[3]) for x in quality.catalogue.CHECKS if x[6] == "FILE" and x[3] in ("ROW", "VERSION") and x[5] != "RECONCILIATION" and x[0] not in measured]
    every_check = F.array(
        *[measure(k, c(a), c(b), x) for k, (a, b, x) in measured.items()],
        *[measure(k, F.lit(1), F.lit(0)) for k in quality.catalogue.STRUCTURAL if k not in measured],  # an accepted file passed them
        flag("SCHEMA_VERSION_CHANGED", "changed"), flag("DUPLICATE_FILE", "again"),
        *[measure(k, c("versions"), c(k), F.lit(0)) for k in zero],  # invariants
        *[measure(k, c("received_count") if grain == "ROW" else c("versions"), null) for k, grain in counted],  # see hits
    )

    # row and version checks: a count where there is one, else 0
    checks = quality.catalogue.checks(store.spark)
    reasons = outcomes.filter("outcome_reason IS NOT NULL").select(*by, F.lit("outcome_reason").alias("source"), c("outcome_reason").alias("reason_code"), "outcome", "match_type")
    found = quality.classified(reasons)
    replayed = (c("outcome") == "STALE") & (c("match_type") == "CONFLICT")
    by_row = found.select(*by, F.explode(F.array(c("check_code"), F.when(replayed, "STALE_REPLAY_CONFLICT"))).alias("check_code"), "reason_code").filter("check_code IS NOT NULL")
    hits = by_row.unionByName(issues.select(*by, "check_code", "reason_code")).groupBy(*by, "check_code").agg(F.count(F.lit(1)).alias("n"), clean.join_codes(c("reason_code")).alias("codes"))
    graded = base.select(*by, F.inline(every_check)).join(hits, [*by, "check_code"], "left")
    parts = [counts(graded, c("check_code"), c("evaluated"), F.coalesce("observed", "n", F.lit(0)), c("expected"), F.coalesce("own_codes", "codes"))]

    # rejected batches: structural checks by audit codes, gate checks by the stored issues
    parts.append(quality.structural_counts(rejected))
    if store.exists("gate_rejected_issues"):
        gate_rows = store.read("gate_rejected_issues").groupBy(*by, "check_code").agg(F.countDistinct("source_row_number").alias("n"), clean.join_codes(c("reason_code")).alias("codes"))
        gated = rejected.filter(F.contains("reason", F.lit("DQ_GATE_FAILED")))
        graded_gate = gated.crossJoin(F.broadcast(checks.filter("severity = 'ERROR' AND kind = 'QUALITY' AND grain IN ('ROW', 'VERSION')").select("check_code"))).join(gate_rows, [*by, "check_code"], "left")
        parts.append(counts(graded_gate, c("check_code"), c("received_count"), F.coalesce("n", F.lit(0)), codes=c("codes")))
    every = reduce(DataFrame.unionByName, parts)
    report = quality.report(files.select(*by, "source_system", "batch_status"), every)
    unread = (c("batch_status") == "REJECTED") & (c("status") == quality.NOT_EVALUATED) & c("reason_codes").isNull()
    report = report.withColumn("reason_codes", F.when(unread, "BATCH_REJECTED").otherwise(c("reason_codes")))

    # batch rows
    batches = audit.groupBy("batch_id").agg(F.max("status").alias("batch_status"), F.max(F.contains(F.coalesce("reason", F.lit("")), F.lit("DQ_GATE_FAILED"))).alias("by_gate"), F.sum("received_count").alias("received"))
    batches = batches.join(manifest.select("batch_id", F.array_join(F.array_sort(F.array_distinct(clean.audit_codes(c("reason")))), "|").alias("manifest_codes")), "batch_id", "left")
    bad_versions = issues.filter("severity = 'ERROR'").select("version_key").distinct().withColumn("bad", F.lit(True))
    gate = outcomes.join(bad_versions, "version_key", "left").groupBy("batch_id").agg(F.count(F.lit(1)).alias("gate_rows"), F.count_if((c("outcome") == "QUARANTINED") | c("bad")).alias("gate_errors"))
    batches = batches.join(gate, "batch_id", "left")
    if store.exists("gate_rejected_issues"):
        stored = store.read("gate_rejected_issues").groupBy("batch_id").agg(F.countDistinct(F.struct(*LINEAGE)).alias("stored"))
        batches = batches.join(stored, "batch_id", "left")
    else:
        batches = batches.withColumn("stored", null)
    loaded = quality.rows_per_file({n: (committed(store, n), *by) for n in ("raw", "outcomes", "versions", "fields")}).groupBy("batch_id").agg(F.sum("n").alias("loaded"))
    batches = batches.join(loaded, "batch_id", "left")
    is_rejected = c("batch_status") == "REJECTED"

    def batch_row(check: str, evaluated: Column, observed: Column, expected: Column, codes: Column) -> Column:
        return F.struct(F.lit(check).alias("check_code"), evaluated.cast("bigint").alias("evaluated"), observed.cast("bigint").alias("observed"), expected.cast("bigint").alias("expected"), codes.alias("reason_codes"))

    gate_read = F.when(is_rejected & c("by_gate"), c("received")).when(~is_rejected, F.coalesce("gate_rows", F.lit(0)))
    rows = F.array(
        batch_row("MANIFEST_VALID", F.lit(1), c("manifest_codes").isNotNull().cast("int"), null, c("manifest_codes")),
        batch_row("PUBLISH_GATE", gate_read, F.when(is_rejected & c("by_gate"), c("stored")).when(~is_rejected, F.coalesce("gate_errors", F.lit(0))), null, F.when(is_rejected & c("by_gate"), "DQ_GATE_FAILED").when(is_rejected, "BATCH_REJECTED")),
        F.when(is_rejected, batch_row("REJECTED_BATCH_NOT_LOADED", F.lit(1), F.coalesce("loaded", F.lit(0)), F.lit(0), F.lit(None).cast("string"))),
    )
    long = batches.select("batch_id", "batch_status", F.explode(rows).alias("m")).filter("m IS NOT NULL").select("batch_id", "batch_status", "m.*").join(F.broadcast(checks), "check_code")
    long = long.withColumns({"file_name": F.lit(None).cast("string"), "source_system": F.lit(None).cast("string"), "not_evaluated": F.lit(False)})
    share = F.when(c("kind") == "GATE", F.lit(config.max_error_share * 100).cast("decimal(7,2)"))
    return report.unionByName(quality.with_status(long, share))
