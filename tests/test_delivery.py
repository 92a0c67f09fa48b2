"""Landing folders end to end: validation, history, gate, rebuild, exports."""

import dataclasses
import hashlib
import json
import shutil
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewell.operators import facts, quality
from tidewell.plans import delivery
from tidewell.sources import exports, landing, reference

CANONICAL = [
    "source_system", "source_record_id", "facility_name", "patient_mrn", "patient_first_name", "patient_last_name", "patient_dob", "patient_sex", "patient_zip", "patient_phone", "admit_date", "discharge_date",
    "encounter_type", "attending_npi", "attending_provider_name", "primary_dx_code", "chief_complaint", "payer_name", "billed_amount", "claim_status", "last_updated_ts", "encounter_source",
]
V1 = CANONICAL[:-1]
V2 = [{"attending_npi": "attending_provider_npi", "billed_amount": "total_charge"}.get(c, c) for c in reversed(CANONICAL)]
GOOD_NPI = "1234567893"
ROW = dict(
    source_record_id="1", facility_name="north  clinic", patient_mrn="m1", patient_first_name="Ann Lee", patient_last_name="O'Hara", patient_dob="01/02/1980", patient_sex="F", patient_zip="12345", patient_phone="", admit_date="03/05/2024",
    discharge_date="03/07/2024", encounter_type="IP", attending_npi=GOOD_NPI, attending_provider_name="x", primary_dx_code="E11.9", chief_complaint="a, \"quoted\"\nline", payer_name="BCBS", billed_amount="$5,000.00", claim_status="Paid", last_updated_ts="2024-03-08 10:00:00",
)


def csv_bytes(columns, rows, bom=False):
    quote = lambda x: '"' + x.replace('"', '""') + '"' if any(c in x for c in ',"\n') else x
    back = {"attending_provider_npi": "attending_npi", "total_charge": "billed_amount"}
    lines = [",".join(columns)] + [",".join(quote(r.get(back.get(c, c), "")) for c in columns) for r in rows]
    return (b"\xef\xbb\xbf" if bom else b"") + ("\r\n".join(lines) + "\r\n").encode()


def deliver(root, number, files, **changes):
    folder = root / f"batch_{number:03d}"
    folder.mkdir(parents=True)
    entries = []
    for system, content, count in files:
        name = f"{system.lower()}.csv"
        (folder / name).write_bytes(content)
        entries.append({"file_name": name, "source_system": system, "row_count": count, "sha256": hashlib.sha256(content).hexdigest()})
    manifest = {"batch_id": folder.name, "delivered_at": f"2024-0{number + 5}-01T00:00:00Z", "files": entries} | changes
    (folder / "manifest.json").write_text(json.dumps(manifest))


@pytest.fixture(scope="module")
def config(spark):
    contracts = spark.createDataFrame(
        [("A", "a.csv", "a1", 1, V1, V1), ("B", "b.csv", "b1", 1, V1, V1), ("B", "b.csv", "b2", 2, V2, list(reversed(CANONICAL)))],
        "source_system string, file_name string, version string, version_position int, columns array<string>, canonical array<string>",
    )
    conventions = spark.createDataFrame([("A", "MDY", "USD", "UTC", None), ("B", "DMY", "USD_CENTS", "America/Chicago", 2000)], "source_system string, date_order string, amount_unit string, timestamp_timezone string, century int")
    facilities = spark.createDataFrame([("F1", "North Clinic", "A"), ("F2", "South", "B")], "facility_id string, facility_name string, source_system string").withColumn("facility_type", F.lit("t"))
    aliases = spark.createDataFrame([("B", "F2", "South", "North Clinic")], "source_system string, facility_id string, facility_name string, alias string")
    codes = spark.createDataFrame([("E11.9", "diabetes", "DIABETES", True)], "icd10_code string, description string, category string, is_chronic boolean")
    rosters = spark.sql(f"SELECT DATE'2024-01-01' AS as_of_date, '{GOOD_NPI}' AS npi, 'l' AS provider_last_name, 'f' AS provider_first_name, 'MD' AS credential, 's' AS specialty, 'F1' AS primary_facility_id, 'e' AS employment_status, 'r' AS file_name, 1 AS source_row_number")
    return delivery.Config(CANONICAL, contracts, conventions, facilities, aliases, codes, rosters, b"secret", Decimal("0.5"))


@pytest.fixture(scope="module")
def run(spark, config, tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    r = lambda **x: ROW | x
    a1 = [r(), r(source_record_id="2", last_updated_ts="2024-03-08T10:00:00Z"), r(), r(source_record_id="3", facility_name="?"), r(source_record_id=" "), r(source_record_id="4", last_updated_ts="never")]
    b1 = [r(billed_amount="12345", admit_date="05/03/2024", discharge_date="06/03/24", patient_mrn="m9")]
    deliver(root, 1, [("A", csv_bytes(V1, a1, bom=True), 6), ("B", csv_bytes(V2, b1), 1)])
    a2 = [r(claim_status="Denied", last_updated_ts="2024-03-09 10:00:00"), r(), r(last_updated_ts="2024-03-01 10:00:00"), r(source_record_id="2", billed_amount="1", last_updated_ts="2024-03-08 10:00:00")]
    deliver(root, 2, [("A", csv_bytes(V1, a2), 4), ("B", csv_bytes(V2, b1), 1)])
    deliver(root, 3, [("A", csv_bytes(V1, a2)[:-9] + b"\r\nx,y\r\n\r\n", 5), ("B", csv_bytes(V1[::-1], b1), 1)])
    deliver(root, 4, [("A", csv_bytes(V1, [r(source_record_id="9", facility_name="?"), r(source_record_id="8", admit_date="n/a")]), 2)])
    (root / "notes").mkdir()
    store = delivery.Store(spark, str(tmp_path_factory.mktemp("store")))
    return store, delivery.run_pending(store, str(root), config), str(root)


def audit(store):
    return {(r["batch_id"], r["file_name"]): r for r in store.read("audit").collect()}


def test_decisions(run):
    store, decided, _ = run
    assert decided == {"batch_001": "ACCEPTED", "batch_002": "ACCEPTED", "batch_003": "REJECTED", "batch_004": "REJECTED"}
    rows = audit(store)
    counts = rows["batch_001", "a.csv"]
    assert (counts["new_encounter"], counts["duplicate"], counts["quarantined"], counts["history_rows"]) == (3, 1, 2, 3)
    counts = rows["batch_002", "a.csv"]
    assert (counts["new_version"], counts["duplicate"], counts["stale_new_version"], counts["quarantined"], counts["history_rows"]) == (1, 1, 1, 1, 2) and counts["stale"] == 1
    assert rows["batch_002", "b.csv"]["reason"] == "DUPLICATE_FILE(first_batch=batch_001)" and rows["batch_002", "b.csv"]["duplicate"] == 1
    assert rows["batch_003", "a.csv"]["reason"].startswith("MALFORMED_RECORD(record=5,fields=2,expected=21); MALFORMED_RECORD(record=6,fields=0,expected=21)")
    assert rows["batch_003", "b.csv"]["reason"] == "UNKNOWN_SCHEMA_CHANGE(closest_version=b1,columns=21,expected_columns=21,order_differs)"
    assert rows["batch_004", "a.csv"]["reason"] == "DQ_GATE_FAILED"


def test_nothing_of_a_rejected_batch_counts(run):
    store, _, _ = run
    assert {r[0] for r in store.read("raw").select("batch_id").distinct().collect()} == {"batch_001", "batch_002"}
    assert {r[0] for r in store.read("versions").select("batch_id").distinct().collect()} == {"batch_001", "batch_002"}


def test_batches_read_touched_buckets_only(run, config):
    store, _, _ = run
    held = store.read("held").select("encounter_key", delivery.BUCKET).distinct().collect()
    assert {r[1] for r in store.read("held").select("encounter_key", delivery.key_bucket(config).alias("b")).distinct().collect()} == {r[1] for r in held}
    plan = delivery.committed(store, "held", [held[0][1]])._jdf.queryExecution().executedPlan().toString()
    assert any("PartitionFilters" in line and delivery.BUCKET in line.split("PartitionFilters")[1].split("]")[0] for line in plan.splitlines())
    assert delivery.BUCKET not in delivery.committed(store, "fields").columns


def test_a_batch_without_versions_comes_first(spark, config, tmp_path):
    root = tmp_path / "landing"
    deliver(root, 1, [("A", csv_bytes(V1, [ROW | {"source_record_id": " "}]), 1)])
    deliver(root, 2, [("A", csv_bytes(V1, [ROW]), 1)])
    store = delivery.Store(spark, str(tmp_path / "store"))
    assert delivery.run_pending(store, str(root), config) == {"batch_001": "REJECTED", "batch_002": "ACCEPTED"}
    assert audit(store)["batch_002", "a.csv"]["new_encounter"] == 1


def test_a_first_batch_that_dies_is_repeated(spark, config, tmp_path, monkeypatch):
    root = tmp_path / "landing"
    deliver(root, 1, [("A", csv_bytes(V1, [ROW, ROW | {"source_record_id": "2"}]), 2)])
    store = delivery.Store(spark, str(tmp_path / "store"))

    def die(*_):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="lost driver"):
        m.setattr(delivery, "_commit", die)
        delivery.run_pending(store, str(root), config)
    assert not store.exists("held") and not store.exists("raw")
    assert delivery.run_pending(store, str(root), config) == {"batch_001": "ACCEPTED"}
    assert audit(store)["batch_001", "a.csv"]["new_encounter"] == 2 and store.read("held").count() == 2


def test_a_store_of_an_earlier_layout_is_refused(spark, config, tmp_path):
    root = tmp_path / "landing"
    deliver(root, 1, [("A", csv_bytes(V1, [ROW]), 1)])
    store = delivery.Store(spark, str(tmp_path / "store"))
    store.append("versions", spark.sql("SELECT 'batch_000' AS batch_id, 'k' AS version_key"), "batch_000")
    with pytest.raises(ValueError, match="earlier layout"):
        delivery.run_pending(store, str(root), config)


def test_a_repeated_attempt_replaces_the_first(spark, tmp_path):
    store = delivery.Store(spark, str(tmp_path / "store"))
    rows = spark.sql("SELECT 'batch_001' AS batch_id, id, CAST(id AS INT) AS b FROM range(4)")
    store.append("t", rows, "batch_001", ["b"])
    assert store.rows("t") == store.rows("t", "batch_001") == 4
    store.append("t", rows.filter("id = 2").withColumn("more", F.lit(1)), "batch_001", ["b"])
    assert [(r["id"], r["more"]) for r in store.read("t").collect()] == [(2, 1)]
    store.append("t", rows.filter("id > 9"), "batch_001", ["b"])
    assert store.read("t").count() == 0 and set(store.read("t").columns) == {"batch_id", "id", "b", "more"}


def test_a_second_run_finds_nothing_to_do(run, config):
    store, _, root = run
    assert delivery.run_pending(store, root, config) == {}


def test_replay_gives_what_the_batches_gave(run, config):
    store, _, _ = run
    columns = ["batch_id", "file_name", "source_row_number", "outcome", "outcome_reason", "match_type", "version_key"]
    assert quality.symmetric_difference(store.read("outcomes").select(*columns), delivery.replay_history(store, config).select(*columns)).count() == 0


def test_mart(run, config):
    store, _, _ = run
    mart = delivery.rebuild_mart(store, config)
    first = {n: quality.state_digest(mart[n]).first() for n in mart}
    mart = delivery.rebuild_mart(store, config)
    assert {n: quality.state_digest(mart[n]).first() for n in mart} == first
    facts = {r["source_record_id"]: r for r in mart["fact_current"].filter("source_system = 'A'").collect()}
    one = facts["1"]
    assert (one["claim_status"], one["billed_amount_usd"], one["facility_id"], one["length_of_stay_days"], one["version_count"], one["age_band"], one["zip3"]) == ("DENIED", Decimal("5000.00"), "F1", 2, 3, "40-64", "123")
    assert one["provider_sk"] is not None and one["patient_link_status"] == "LINKED" and len(one["patient_key"]) == 64
    other = mart["fact_current"].filter("source_system = 'B'").first()
    assert (other["billed_amount_usd"], other["admit_date"].isoformat(), other["facility_id"]) == (Decimal("123.45"), "2024-03-05", "F2")
    assert other["patient_key"] != one["patient_key"]  # 1 February and 2 January
    levels = sorted((r["quarantine_level"], r["quarantine_source"], r["reason_codes"]) for r in mart["quarantine"].collect())
    assert ("VERSION", "VERSION_DQ", "FACILITY_UNRESOLVED") in levels and ("ROW", "HISTORY_ORDERING", "SOURCE_RECORD_ID_MISSING") in levels and ("FILE", "PUBLISH_GATE", "DQ_GATE_FAILED") in levels and ("ROW", "PUBLISH_GATE", "FACILITY_UNRESOLVED") in levels
    assert quality.orphans(mart["fact_version"], "provider_sk", mart["dim_provider"], "sk").count() == 0
    assert quality.orphans(mart["fact_version"], "admit_date", mart["dim_date"], "date_key").count() == 0
    assert sorted((r["source_record_id"], r["readmit_30d_flag"]) for r in delivery.cohort(store).collect()) == [("1", 0), ("2", 0)]
    report = delivery.quality_report(store, config)
    assert {r["status"] for r in quality.status_counts(report).collect()} == {"PASS", "WARN", "FAIL", "NOT_EVALUATED"}
    by = {(r["batch_id"], r["file_name"], r["check_code"]): r for r in report.collect()}
    assert len(by) == report.count()
    per_batch = {b: sum(k[0] == b for k in by) for b in ("batch_001", "batch_002", "batch_003", "batch_004")}
    assert per_batch == {"batch_001": 2 * 51 + 2, "batch_002": 2 * 51 + 2, "batch_003": 2 * 51 + 3, "batch_004": 51 + 3}
    assert quality.failed_invariants(report).count() == 0
    assert by["batch_002", "b.csv", "DUPLICATE_FILE"]["status"] == "WARN" and by["batch_001", "a.csv", "FACILITY_RESOLVED"]["status"] == "FAIL" and by["batch_003", "a.csv", "RECORD_SHAPE_VALID"]["status"] == "FAIL"
    assert by["batch_004", None, "PUBLISH_GATE"]["status"] == "FAIL" and by["batch_003", None, "PUBLISH_GATE"]["status"] == "NOT_EVALUATED" and by["batch_003", None, "REJECTED_BATCH_NOT_LOADED"]["status"] == "PASS"
    assert by["batch_001", "a.csv", "RECON_HISTORY_ROWS"]["status"] == "PASS" and by["batch_001", "a.csv", "RECON_QUARANTINE_ROWS"]["observed_count"] == 3


def test_bad_configuration_is_refused(run, config, spark):
    store, _, root = run
    changed = lambda **x: dataclasses.replace(config, **x)
    for bad, word in (
        (changed(contracts=config.contracts.union(config.contracts.limit(1))), "contracts"), (changed(conventions=config.conventions.filter("source_system = 'A'")), "a system without conventions"),
        (changed(conventions=config.conventions.union(config.conventions)), "two conventions"), (changed(codes=config.codes.union(config.codes)), "code list"), (changed(facilities=config.facilities.union(config.facilities)), "facilities"),
        (changed(aliases=config.aliases.union(config.aliases)), "facility names"), (changed(rosters=config.rosters.union(config.rosters)), "rosters"), (changed(rosters=config.rosters.withColumn("primary_facility_id", F.lit("F9"))), "PARENT_UNKNOWN"),
        (changed(canonical=[*CANONICAL, CANONICAL[0]]), "canonical columns"),
    ):
        with pytest.raises(quality.PipelineError, match=word):
            delivery.run_pending(store, root, bad)
    delivery.require_usable(config)


def test_a_changed_delivery_warns(run, config, tmp_path):
    store, _, root = run
    shutil.copytree(root, tmp_path / "again")
    with open(tmp_path / "again" / "batch_001" / "a.csv", "ab") as f:
        f.write(b"more")
    with pytest.warns(UserWarning, match="batch_001$"):
        assert delivery.run_pending(store, str(tmp_path / "again"), config) == {}


def test_failed_invariants_abort(run, config, spark, tmp_path):
    store, _, _ = run
    delivery.rebuild_mart(store, config)
    shutil.copytree(store.root, tmp_path / "copy")
    broken = delivery.Store(spark, str(tmp_path / "copy"))
    facts_now = store.read("fact_version").filter("source_record_id <> '2'")
    broken.replace("fact_version", facts_now)
    with pytest.raises(quality.PipelineError, match="failed invariants"):
        delivery.quality_report(broken, config)
    broken.replace("fact_version", store.read("fact_version"))
    delivery.quality_report(broken, config)
    stray = store.read("issues").limit(1).withColumn("source_row_number", F.lit(99))
    broken.replace("issues", store.read("issues").union(stray.select(*store.read("issues").columns)))
    with pytest.raises(quality.PipelineError, match="failed invariants"):
        delivery.quality_report(broken, config)


def test_the_callers_cached_tables_stay(run, config, spark, tmp_path):
    mine = spark.range(3).cache()
    mine.count()
    deliver(tmp_path / "landing", 1, [("A", csv_bytes(V1, [ROW]), 2), ("B", csv_bytes(V1, [ROW]), 1)])
    assert delivery.run_pending(delivery.Store(spark, str(tmp_path / "store")), str(tmp_path / "landing"), config) == {"batch_001": "REJECTED"}
    assert mine.is_cached and spark._jsparkSession.sharedState().cacheManager().lookupCachedData(mine._jdf).isDefined()
    mine.unpersist()


def test_every_table_is_exported(run, config, spark, tmp_path):
    store, _, _ = run
    delivery.rebuild_mart(store, config)
    delivery.quality_report(store, config)
    written = []
    for _ in range(2):  # the second replaces the first
        delivery.export_all(store, config, str(tmp_path))
        written.append({p.name: p.read_bytes() for p in tmp_path.iterdir() if not p.name.startswith(".")})
    assert written[0] == written[1]
    assert written[0].keys() == {f"{n}.csv" for n in (*exports.EXPORTED, "batch_audit", "chronic_acute_encounters")} and len(exports.EXPORTED) == 15
    for name, (_, order) in exports.EXPORTED.items():
        header, *lines = written[0][f"{name}.csv"].decode().splitlines()
        assert header.split(",") == store.read(name).drop(delivery.BUCKET).columns and len(lines) == store.read(name).count()
        if len(order) == 1:
            keys = [x.split(",")[header.split(",").index(order[0])] for x in lines]
            assert keys == sorted(keys)  # empty, for null, first
    read = lambda n: spark.read.csv(str(tmp_path / f"{n}.csv"), header=True).collect()
    rows = read("batch_audit")
    assert rows[0].asDict().keys() == exports.AUDIT_COLUMNS.keys() and [r["batch_id"] for r in rows] == sorted(r["batch_id"] for r in rows)
    first = rows[0]
    assert (first["accepted_count"], first["new_encounter_count"], first["reconciliation_status"]) == ("3", "3", "RECONCILED") and first["start_time"] < first["end_time"] and first["end_time"].endswith("Z")
    rejected = next(r for r in rows if r["status"] == "REJECTED")
    assert rejected["accepted_count"] == "0" and rejected["reconciliation_status"] is None
    assert len(read("dq_report")) == store.read("dq_report").count() and len(read("chronic_acute_encounters")[0]) == 28
    assert [r["file_name"] for r in read("dq_report") if r["batch_id"] == "batch_004"][0] is None  # nulls first


def test_volume_report(run, config):
    store, _, _ = run
    delivery.rebuild_mart(store, config)
    report = facts.volume_report(store.read("fact_current"), store.read("issues"), store.read("dim_date"), store.read("dim_facility")).collect()
    assert [(r["year"], r["month"], r["facility_id"], r["facility_name"], r["encounters"], r["billed_amount_usd"]) for r in report] == [(2024, 3, "F1", "North Clinic", 2, Decimal("10000.00")), (2024, 3, "F2", "South", 1, Decimal("123.45"))]
    assert delivery.volume_as_of(store, "batch_002").collect() == report and delivery.volume_as_of(store, "batch_000").collect() == []


def test_export(run, config, spark, tmp_path):
    store, _, _ = run
    table = delivery.rebuild_mart(store, config)["fact_current"]
    columns = ["encounter_key", "admit_date", "last_updated_ts_utc", "billed_amount_usd", "length_of_stay_days"]
    exports.export_csv(table, str(tmp_path / "x"), "fact_current", ["encounter_key"], columns=columns, single_file=True)
    got = spark.read.csv(str(tmp_path / "x"), header=True).collect()
    assert [r["encounter_key"] for r in got] == sorted(r["encounter_key"] for r in got) and len(got) == table.count()
    assert all(r["last_updated_ts_utc"].endswith("Z") for r in got)
    with pytest.raises(ValueError):
        exports.assert_exportable("t", ["patient_dob_raw"])
    with pytest.raises(ValueError):
        exports.assert_exportable("t", ["a"], "raw")
    with pytest.raises(TypeError):
        exports.formatted(spark.range(1).select(F.rand().alias("x")))


@pytest.mark.parametrize(
    "content, reason",
    [
        (b"a,b\n1,\xff\n", "ENCODING_ERROR(byte_offset=6)"), (b'a,b\n"1,2\n', "CSV_PARSE_ERROR(record=1)"), (b"", "HEADER_MISSING"), (b"\n1,2\n", "HEADER_MISSING"),
    ],
)
def test_unreadable_files(spark, content, reason):
    files = spark.createDataFrame([("batch_001", "a.csv", bytearray(content))], "batch_id string, file_name string, content binary")
    rows = landing.read_strict_csv(files).collect()
    assert [(r["kind"], r["detail"]) for r in rows] == [("failure", reason)]


def test_strict_csv_keeps_what_was_delivered(spark):
    content = "﻿a,b\r\n\"x\r\ny\",\r\n\r\n1,2,3\r\n".encode()
    files = spark.createDataFrame([("batch_001", "a.csv", bytearray(content))], "batch_id string, file_name string, content binary")
    records = landing.read_strict_csv(files)
    assert [r["fields"] for r in records.orderBy("row_number").collect()] == [["a", "b"], ["x\r\ny", ""], [], ["1", "2", "3"]]
    assert [r["detail"] for r in landing.record_shape_failures(records).orderBy("position").collect()] == ["record=2,fields=0,expected=2", "record=3,fields=3,expected=2"]


def test_manifest_problems_are_all_listed(spark):
    contracts = spark.createDataFrame([("A", "a.csv"), ("B", "b.csv")], "source_system string, file_name string")
    good = {"file_name": "a.csv", "source_system": "A", "row_count": 1, "sha256": "0" * 64}

    def codes(manifest, *present):
        rows = [("batch_001", n, bytearray(b""), "") for n in present]
        if manifest is not None:
            rows.append(("batch_001", "manifest.json", bytearray(manifest if isinstance(manifest, bytes) else json.dumps(manifest).encode()), ""))
        files = spark.createDataFrame(rows, "batch_id string, file_name string, content binary, sha256 string")
        return sorted((r["code"], r["detail"] or "") for r in landing.read_manifests(files, contracts)[1].collect())

    base = {"batch_id": "batch_001", "delivered_at": "2024-01-01T00:00:00Z"}
    assert codes(base | {"files": [good]}, "a.csv") == []
    assert codes(("﻿" + json.dumps(base | {"files": [good]})).encode(), "a.csv") == []
    assert codes(None, "a.csv") == [("MANIFEST_MISSING", "")]
    assert codes(b"{", "a.csv") == [("MANIFEST_INVALID", "not UTF-8 JSON")] == codes(b"\xff", "a.csv")
    assert codes(base | {"files": []}) == [("MANIFEST_INVALID", "files must be a non-empty list")]
    assert codes({"batch_id": "batch_002", "files": [good]}, "a.csv") == [("BATCH_ID_MISMATCH", "manifest batch_id differs from folder name"), ("MANIFEST_INVALID", "field=delivered_at")]
    bad = [good | {"row_count": "1"}, good | {"row_count": True, "sha256": "zz"}, 7, good | {"source_system": "Z"}, good | {"file_name": "b.csv"}, good, good]
    assert codes(base | {"files": bad}, "c.csv") == sorted(
        [("MANIFEST_INVALID", f"entry={e}") for e in ("1,field=row_count", "2,field=row_count", "2,field=sha256", "3", "5,field=file_name", "7,duplicate=file_name")] + [("UNKNOWN_SOURCE_SYSTEM", "entry=4"), ("FILE_MISSING", "entry=6"), ("UNEXPECTED_FILE", "count=1")]
    )


def test_reference_inputs(spark, tmp_path):
    (tmp_path / "codes.csv").write_text("icd10_code,description,category,is_chronic\nE11.9,d,c,Y\nE11.9,d,c,N\nbad,d,,?\n")
    assert sorted(r[0] for r in reference.code_problems(reference.read_codes(spark, str(tmp_path / "codes.csv"))).collect()) == ["blank text", "code format", "code not unique", "flag is neither Y nor N"]
    master = {"source_systems": [{"source_system": "A", "file_name": "a.csv", "date_order": "MDY", "amount_unit": "USD", "timestamp_timezone": "UTC", "notes": "two-digit years mean 20xx."}], "facilities": [{"facility_id": "F1", "facility_name": "N", "source_system": "A", "facility_type": "t", "city": "c", "state": "s", "bed_count": 1, "ownership": "o", "go_live_date": "2020-01-01"}]}
    (tmp_path / "m.json").write_text(json.dumps(master))
    facilities, conventions = reference.read_master(spark, str(tmp_path / "m.json"))
    assert facilities.first()["source_position"] == 1 and conventions.first()["century"] == 2000 and reference.facility_problems(facilities).count() == 0
    (tmp_path / "al.json").write_text(json.dumps({"source_systems": {"A": {"F1": {"facility_name": "N", "aliases": ["n ", "M"]}}}}))
    aliases = reference.read_aliases(spark, str(tmp_path / "al.json"))
    assert aliases.count() == 2
    assert [r[0] for r in reference.facility_index_problems(facilities, aliases).collect()] == ["two entries share one name"]
    rosters = tmp_path / "rosters"
    rosters.mkdir()
    head = "as_of_date,npi,provider_last_name,provider_first_name,credential,specialty,primary_facility_id,employment_status\n"
    (rosters / "roster_2024-01-01.csv").write_text(head + f"2024-01-01,{GOOD_NPI},a,b,c,d,F1,e\n2024-01-02,123,a,b,c,d,F1,e\n")
    assert sorted(r[0] for r in reference.roster_problems(reference.read_rosters(spark, str(rosters))).collect()) == ["date differs from the file's name", "provider number"]
