"""The whole quality report over delivered tables that are made from the driver's, with SQL that counts every check anew.

The tables (``TABLES``) are written once, in SQL that Spark and DuckDB both read, with known faults: rows that are lost, doubled or moved, values without
reasons, keys without dimensions, rejected batches. What a check counts is written twice: ``delivery.build_report``, and ``REPORT_SQL`` here.
"""

from __future__ import annotations

from decimal import Decimal
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession

from ..operators import checks, quality
from ..session import cut_lineage
from . import catalogue as base
from . import delivery
from .catalogue import query
from .views import CLASSIFIED_SQL

MAX_SHARE = Decimal("0.10")
N = "source_row_number"
#: Columns of facts that are null for every so-manyth row; every 37th of those lacks its reason too.
VALUED = {
    "facility_id": (5, "concat('F', CAST(source_row_number % 7 AS STRING))"), "patient_key": (11, "concat('K', CAST(source_row_number % 50 AS STRING))"), "zip3": (13, "'123'"), "attending_npi": (17, "'1'"),
    "provider_sk": (7, "concat('P', CAST(source_row_number % 9 AS STRING))"), "admit_date": (6, "last_updated_ts_utc"), "discharge_date": (8, "last_updated_ts_utc"), "length_of_stay_days": (9, "1"),
    "encounter_type": (19, "'I'"), "claim_status": (23, "'PAID'"), "primary_dx_code": (10, "concat('D', CAST(source_row_number % 4 AS STRING))"), "payer_category": (12, "concat('Y', CAST(source_row_number % 3 AS STRING))"), "billed_amount_usd": (14, "1"),
}
_VALUES = ", ".join(f"CASE WHEN {N} % {m} <> 0 THEN {x} END AS {c}, CASE WHEN {N} % {m} = 0 AND {N} % {37 * m} <> 0 THEN 'MISSING' END AS {c}_reason" for c, (m, x) in VALUED.items())
_UNKNOWN = ", ".join(f"CASE WHEN {N} % {m} = 0 THEN 'UNKNOWN' ELSE 'x' END AS {c}, CASE WHEN {N} % {m} = 0 AND {N} % {37 * m} <> 0 THEN 'MISSING' END AS {c}_reason" for c, m in (("age_band", 4), ("sex", 15)))
_BATCH = "concat('batch_00', CAST(batch_no AS STRING))"
_ROW = f"{_BATCH} AS batch_id, file_name, row_no AS {N}"
_PLACE = f"batch_id, file_name, {N}"
_VERSION = "concat(CAST(rec AS STRING), ':', CAST(v AS STRING))"
#: Issues: every so-manyth version, check, code, severity.
ISSUES = ((5, "FACILITY_RESOLVED", "FACILITY_MISSING", "ERROR"), (6, "ADMIT_DATE_VALID", "DATE_MISSING", "ERROR"), (10, "ADMIT_DATE_VALID", "DATE_INVALID", "ERROR"), (7, "SEX_KNOWN", "SEX_MISSING", "WARNING"), (11, "PAYER_MAPPED", "PAYER_UNMAPPED", "WARNING"), (13, "ZIP3_VALID", "ZIP_MISSING", "WARNING"))
_AUDIT = "file_name, concat('S', file_name) AS source_system"
#: In order: each may read ``classified`` and the ones before it.
TABLES = {
    "raw": f"SELECT {_ROW} FROM {{classified}} WHERE row_no % 997 <> 0",
    "person_rows": f"SELECT {_ROW} FROM {{classified}} WHERE row_no % 991 <> 0",
    "outcomes": f"SELECT {_ROW}, CASE WHEN rec IS NOT NULL AND v IS NOT NULL THEN {_VERSION} END AS version_key, outcome, outcome_reason, match_type FROM {{classified}} WHERE row_no % 977 <> 0",
    "versions": f"SELECT {_ROW}, {_VERSION} AS version_key, CAST(rec AS STRING) AS encounter_key, v AS last_updated_ts_utc FROM {{classified}} WHERE is_first_seen AND row_no % 971 <> 0",
    "fields": f"SELECT {_PLACE}, version_key FROM {{versions}} WHERE {N} % 983 <> 0 UNION ALL SELECT {_PLACE}, version_key FROM {{versions}} WHERE {N} % 211 = 0",
    "fact_version": f"SELECT {_PLACE}, version_key, {_VALUES}, {_UNKNOWN} FROM {{versions}} WHERE {N} % 401 <> 0",
    "fact_current": f"SELECT {_PLACE}, encounter_key, version_key, CASE WHEN {N} % 31 = 0 THEN n + 1 ELSE n END AS version_count FROM (SELECT *, count(*) OVER (PARTITION BY encounter_key) AS n, max(last_updated_ts_utc) OVER (PARTITION BY encounter_key) AS latest FROM {{versions}}) x WHERE last_updated_ts_utc = latest",
    "issues": " UNION ALL ".join(f"SELECT batch_id, file_name, CASE WHEN {N} % 499 = 0 THEN {N} + 1 ELSE {N} END AS {N}, version_key, '{check}' AS check_code, '{code}' AS reason_code, '{severity}' AS severity FROM {{versions}} WHERE {N} % {m} = 0 AND NOT ({N} % 30 = 0 AND {m} = 10)" for m, check, code, severity in ISSUES),
    "quarantine": f"SELECT batch_id, file_name, 'HISTORY_ORDERING' AS quarantine_source FROM {{outcomes}} WHERE outcome = 'QUARANTINED' AND {N} % 3 <> 0 UNION ALL SELECT batch_id, file_name, 'VERSION_DQ' FROM (SELECT DISTINCT batch_id, file_name, version_key FROM {{issues}} WHERE severity = 'ERROR') x UNION ALL SELECT 'batch_003', 'f0', 'BATCH_VALIDATION'",
    "audit": f"""SELECT {_BATCH} AS batch_id, {_AUDIT}, count(*) + CASE WHEN batch_no = 1 AND file_name = 'f1' THEN 1 ELSE 0 END AS expected_count, count(*) AS received_count, sum(CASE WHEN outcome = 'QUARANTINED' THEN 1 ELSE 0 END) AS quarantined, 'ACCEPTED' AS status,
  CASE WHEN batch_no > 0 AND file_name = 'f2' THEN 'DUPLICATE_FILE(first_batch=batch_000)' END AS reason FROM {{classified}} GROUP BY batch_no, file_name
  UNION ALL SELECT 'batch_003', {_AUDIT}, count(*), CASE WHEN file_name <> 'f1' THEN count(*) END, 0, 'REJECTED', CASE file_name WHEN 'f0' THEN 'SHA256_MISMATCH; MALFORMED_RECORD(record=5,fields=2,expected=21); MALFORMED_RECORD(additional_records=3)' WHEN 'f1' THEN 'ENCODING_ERROR(byte_offset=6)' ELSE 'SIBLING_FILE_REJECTED' END FROM {{classified}} WHERE batch_no = 0 GROUP BY file_name
  UNION ALL SELECT 'batch_004', {_AUDIT}, count(*), count(*), 0, 'REJECTED', 'DQ_GATE_FAILED' FROM {{classified}} WHERE batch_no = 1 GROUP BY file_name
  UNION ALL SELECT 'batch_005', 'manifest.json', CAST(NULL AS STRING), NULL, NULL, NULL, 'REJECTED', CASE WHEN count(*) > 0 THEN 'MANIFEST_INVALID(field=batch_id); MANIFEST_MISSING' END FROM {{classified}}
  UNION ALL SELECT 'batch_006', 'f0', 'Sf0', count(*), CASE WHEN count(*) < 0 THEN count(*) END, 0, 'REJECTED', 'CSV_PARSE_ERROR(record=9)' FROM {{classified}} WHERE batch_no = 2""",
    "ingested": "SELECT DISTINCT concat('batch_00', CAST(batch_no AS STRING)) AS batch_id, file_name, concat('S', file_name) AS source_system, CASE WHEN file_name = 'f1' AND batch_no > 0 OR file_name = 'f2' AND batch_no = 1 THEN 'v2' ELSE 'v1' END AS version FROM {classified}",
    "gate_rejected_issues": f"SELECT 'batch_004' AS batch_id, file_name, row_no AS {N}, CASE WHEN row_no % 2 = 0 THEN 'FACILITY_RESOLVED' ELSE 'ADMIT_DATE_VALID' END AS check_code, CASE WHEN row_no % 4 = 0 THEN 'FACILITY_MISSING' WHEN row_no % 2 = 0 THEN 'FACILITY_UNRESOLVED' ELSE 'DATE_MISSING' END AS reason_code FROM {{classified}} WHERE batch_no = 1 AND row_no % 3 = 0",
    "dim_facility": "SELECT DISTINCT facility_id FROM {fact_version} WHERE facility_id <> 'F6'", "dim_diagnosis": "SELECT DISTINCT primary_dx_code AS icd10_code FROM {fact_version}", "dim_payer": "SELECT DISTINCT payer_category FROM {fact_version} WHERE payer_category <> 'Y2'",
    "dim_provider": "SELECT DISTINCT provider_sk AS sk FROM {fact_version} WHERE provider_sk <> 'P8'", "dim_patient": "SELECT DISTINCT patient_key FROM {fact_version} WHERE patient_key <> 'K49'", "dim_date": "SELECT DISTINCT last_updated_ts_utc AS date_key FROM {versions} WHERE day(last_updated_ts_utc) <> 13",
}
TABLES["people"] = TABLES.pop("person_rows")


class Derived:
    """``TABLES`` as a store has them."""

    def __init__(self, spark: SparkSession, classified: DataFrame):
        self.spark, self.tables = spark, {"classified": cut_lineage(classified)}
        for name, sql in TABLES.items():
            read = {n: df for n, df in self.tables.items() if f"{{{n}}}" in sql}
            self.tables[name] = spark.sql(sql, **read).persist()  # a store has them written

    def exists(self, name: str) -> bool:
        return name in self.tables

    def read(self, name: str) -> DataFrame:
        return self.tables[name]


_CTES = ",\n".join(f"t_{n} AS ({sql.format(classified='classified', **{x: f't_{x}' for x in TABLES})})" for n, sql in TABLES.items())
_CHECKS = ", ".join(f"('{c[0]}', '{c[4]}', '{c[5]}', '{c[6]}', '{c[3]}')" for c in checks.CHECKS)
_CODES = ", ".join(f"('{code}', '{check}')" for source, codes, how, check in checks.CODE_MAP for code in codes if source == "outcome_reason" and how == "CHECK")
_STRUCTURE = ", ".join(f"('{code}', '{check}')" for source, codes, how, check in checks.CODE_MAP for code in codes if source == "audit_reason" and check in checks.STRUCTURAL)
_FOREIGN = (("FK_FACT_FACILITY", "facility_id", "dim_facility", "facility_id"), ("FK_FACT_DIAGNOSIS", "primary_dx_code", "dim_diagnosis", "icd10_code"), ("FK_FACT_PAYER", "payer_category", "dim_payer", "payer_category"), ("FK_FACT_PROVIDER", "provider_sk", "dim_provider", "sk"), ("FK_FACT_PATIENT", "patient_key", "dim_patient", "patient_key"))
_LOST = lambda c, dim, key: f"(f.{c} IS NOT NULL AND f.{c} NOT IN (SELECT {key} FROM t_{dim} WHERE {key} IS NOT NULL))"
_BAD = "\nUNION ALL ".join([
    *[f"SELECT '{check}' AS check_code, batch_id, file_name FROM t_fact_version f WHERE {_LOST(c, dim, key)}" for check, c, dim, key in _FOREIGN],
    f"SELECT 'FK_FACT_DATE', batch_id, file_name FROM t_fact_version f WHERE {_LOST('admit_date', 'dim_date', 'date_key')} OR {_LOST('discharge_date', 'dim_date', 'date_key')}",
    "SELECT 'VALUE_REASON_CONSISTENT', batch_id, file_name FROM t_fact_version f WHERE " + " OR ".join([*[f"({c} IS NULL) <> ({c}_reason IS NOT NULL)" for c in VALUED], *[f"({c} = 'UNKNOWN') <> ({c}_reason IS NOT NULL)" for c in ("age_band", "sex")]]),
    *[f"SELECT 'KEY_UNIQUE', batch_id, file_name FROM (SELECT *, count(*) OVER (PARTITION BY {key}) AS n FROM t_{t}) WHERE n > 1" for t, key in (("fact_version", "version_key"), ("fact_current", "encounter_key"), ("versions", "version_key"), ("fields", "version_key"), ("issues", "version_key, check_code"))],
    # a current row that says another number of versions than there are differs on both sides
    f"SELECT 'CURRENT_MATCHES_HISTORY', batch_id, file_name FROM (SELECT f.* FROM t_fact_current f JOIN (SELECT encounter_key, count(*) AS n FROM t_versions GROUP BY 1) c USING (encounter_key) WHERE f.version_count <> c.n), (VALUES (1), (2)) twice(side)",
])
REPORT_SQL = f"""WITH {CLASSIFIED_SQL},
{_CTES},
k AS (SELECT * FROM (VALUES {_CHECKS}) x(check_code, severity, kind, scope, grain)),
outcome_code AS (SELECT * FROM (VALUES {_CODES}) x(reason_code, check_code)), structure AS (SELECT * FROM (VALUES {_STRUCTURE}) x(code, check_code)),
f AS (SELECT *, status AS batch_status FROM t_audit WHERE file_name <> 'manifest.json'),
num AS (SELECT batch_id, file_name, sum(raw) AS raw, sum(outcomes) AS outcomes, sum(people) AS people, sum(versions) AS versions, sum(fields) AS fields, sum(facts) AS facts, sum(cur) AS cur, sum(quarantine) AS quarantine, sum(history) AS history, sum(strays) AS strays, sum(errors) AS errors FROM (
  SELECT batch_id, file_name, 1 AS raw, 0 AS outcomes, 0 AS people, 0 AS versions, 0 AS fields, 0 AS facts, 0 AS cur, 0 AS quarantine, 0 AS history, 0 AS strays, 0 AS errors FROM t_raw UNION ALL SELECT batch_id, file_name, 0, 1, 0, 0, 0, 0, 0, 0, CASE WHEN outcome IN ('NEW_ENCOUNTER', 'NEW_VERSION') OR outcome_reason = 'STALE_NEW_VERSION' THEN 1 ELSE 0 END, 0, 0 FROM t_outcomes
  UNION ALL SELECT batch_id, file_name, 0, 0, 1, 0, 0, 0, 0, 0, 0, 0, 0 FROM t_people UNION ALL SELECT batch_id, file_name, 0, 0, 0, 1, 0, 0, 0, 0, 0, 0, 0 FROM t_versions UNION ALL SELECT batch_id, file_name, 0, 0, 0, 0, 1, 0, 0, 0, 0, 0, 0 FROM t_fields UNION ALL SELECT batch_id, file_name, 0, 0, 0, 0, 0, 1, 0, 0, 0, 0, 0 FROM t_fact_version
  UNION ALL SELECT batch_id, file_name, 0, 0, 0, 0, 0, 0, 1, 0, 0, 0, 0 FROM t_fact_current UNION ALL SELECT batch_id, file_name, 0, 0, 0, 0, 0, 0, 0, 1, 0, 0, 0 FROM t_quarantine WHERE quarantine_source <> 'BATCH_VALIDATION'
  UNION ALL SELECT DISTINCT batch_id, file_name, 0, 0, 0, 0, 0, 0, 0, 0, 0, count(DISTINCT version_key) OVER (PARTITION BY batch_id, file_name), 0 FROM (SELECT * FROM t_issues i WHERE NOT EXISTS (SELECT 1 FROM t_versions w WHERE w.version_key = i.version_key AND w.source_row_number = i.source_row_number)) s
  UNION ALL SELECT batch_id, file_name, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, count(DISTINCT version_key) FROM t_issues WHERE severity = 'ERROR' GROUP BY 1, 2) x GROUP BY 1, 2),
b AS (SELECT f.*, raw, outcomes, people, versions, fields, facts, cur, quarantine, history, strays, errors FROM f LEFT JOIN num USING (batch_id, file_name) WHERE batch_status = 'ACCEPTED'),
bad AS ({_BAD}),
hit AS (SELECT batch_id, file_name, check_code, count(*) AS n, string_agg(DISTINCT reason_code, '|' ORDER BY reason_code) AS codes FROM (SELECT batch_id, file_name, check_code, reason_code FROM t_issues UNION ALL SELECT batch_id, file_name, check_code, reason_code FROM t_outcomes JOIN outcome_code ON outcome_reason = reason_code
  UNION ALL SELECT batch_id, file_name, 'STALE_REPLAY_CONFLICT', outcome_reason FROM t_outcomes WHERE outcome = 'STALE' AND match_type = 'CONFLICT') x GROUP BY ALL),
changed AS (SELECT batch_id, file_name, coalesce(version <> lag(version) OVER (PARTITION BY source_system ORDER BY batch_id), false) AS c FROM t_ingested),
code AS (SELECT batch_id, file_name, regexp_extract(trim(part), '^[A-Z0-9_]+') AS code FROM (SELECT batch_id, file_name, unnest(string_split(reason, ';')) AS part FROM t_audit WHERE status = 'REJECTED') x),
blocked AS (SELECT batch_id, file_name, string_agg(DISTINCT code, '|' ORDER BY code) FILTER (WHERE code IN ('ENCODING_ERROR', 'CSV_PARSE_ERROR', 'HEADER_MISSING')) AS by_code, bool_or(code = 'ENCODING_ERROR') AS encoding, bool_or(code = 'DQ_GATE_FAILED') AS gate FROM code GROUP BY 1, 2),
failed AS (SELECT batch_id, file_name, check_code, string_agg(DISTINCT code, '|' ORDER BY code) AS codes FROM code JOIN structure USING (code) GROUP BY ALL),
gated AS (SELECT batch_id, file_name, check_code, count(DISTINCT source_row_number) AS n, string_agg(DISTINCT reason_code, '|' ORDER BY reason_code) AS codes FROM t_gate_rejected_issues GROUP BY ALL),
counted AS (
  SELECT batch_id, file_name, source_system, batch_status, check_code, severity, kind,
    CASE WHEN check_code IN ('RECON_RAW_ROWS', 'RECON_ROW_OUTCOMES', 'RECON_PATIENT_ROWS', 'RECON_QUARANTINE_ROWS') THEN received_count WHEN grain = 'FILE' THEN 1 WHEN grain = 'ROW' THEN received_count ELSE versions END AS evaluated,
    CASE check_code WHEN 'RECON_RAW_ROWS' THEN raw WHEN 'RECON_ROW_OUTCOMES' THEN outcomes WHEN 'RECON_PATIENT_ROWS' THEN people WHEN 'RECON_QUARANTINE_ROWS' THEN quarantine WHEN 'RECON_HISTORY_ROWS' THEN versions WHEN 'RECON_VERSION_FIELD_ROWS' THEN fields WHEN 'RECON_FACT_VERSION_ROWS' THEN facts
      WHEN 'RECON_DQ_PARTITION' THEN versions + strays WHEN 'RECON_CURRENT_ROWS' THEN cur WHEN 'ROW_COUNT_MATCH' THEN received_count WHEN 'SCHEMA_VERSION_CHANGED' THEN CASE WHEN c THEN 1 ELSE 0 END WHEN 'DUPLICATE_FILE' THEN CASE WHEN reason LIKE 'DUPLICATE_FILE%' THEN 1 ELSE 0 END
      ELSE coalesce(hit.n, (SELECT count(*) FROM bad WHERE bad.check_code = k.check_code AND bad.batch_id = b.batch_id AND bad.file_name = b.file_name)) END AS observed,
    CASE check_code WHEN 'RECON_RAW_ROWS' THEN received_count WHEN 'RECON_ROW_OUTCOMES' THEN received_count WHEN 'RECON_PATIENT_ROWS' THEN received_count WHEN 'RECON_QUARANTINE_ROWS' THEN quarantined + errors WHEN 'RECON_HISTORY_ROWS' THEN history WHEN 'ROW_COUNT_MATCH' THEN expected_count
      WHEN 'RECON_VERSION_FIELD_ROWS' THEN versions WHEN 'RECON_FACT_VERSION_ROWS' THEN versions WHEN 'RECON_DQ_PARTITION' THEN versions ELSE 0 END AS expected,
    CASE check_code WHEN 'SCHEMA_VERSION_CHANGED' THEN CASE WHEN c THEN check_code END WHEN 'DUPLICATE_FILE' THEN CASE WHEN reason LIKE 'DUPLICATE_FILE%' THEN check_code END ELSE hit.codes END AS codes, CAST(NULL AS DECIMAL(7, 2)) AS threshold
  FROM b JOIN k ON scope = 'FILE' LEFT JOIN hit USING (batch_id, file_name, check_code) LEFT JOIN changed USING (batch_id, file_name)
  UNION ALL SELECT f.batch_id, f.file_name, source_system, batch_status, check_code, severity, kind,
    CASE WHEN check_code IN (SELECT check_code FROM structure) THEN CASE WHEN NOT hides THEN 1 END WHEN gates THEN received_count END,
    CASE WHEN check_code = 'ROW_COUNT_MATCH' THEN CASE WHEN NOT hides THEN received_count END WHEN check_code IN (SELECT check_code FROM structure) THEN CASE WHEN NOT hides THEN CASE WHEN failed.codes IS NULL THEN 0 ELSE 1 END END WHEN gates THEN coalesce(gated.n, 0) END,
    CASE WHEN check_code = 'ROW_COUNT_MATCH' AND NOT hides THEN expected_count END,
    CASE WHEN check_code IN (SELECT check_code FROM structure) THEN CASE WHEN hides AND check_code = 'FILE_CSV_PARSEABLE' THEN 'ENCODING_ERROR' WHEN hides THEN coalesce(by_code, 'BATCH_REJECTED') ELSE failed.codes END WHEN gates THEN gated.codes ELSE 'BATCH_REJECTED' END, NULL
  FROM (SELECT f.*, k.check_code, severity, kind, by_code, gate AND severity = 'ERROR' AND kind = 'QUALITY' AND grain IN ('ROW', 'VERSION') AS gates, (check_code = 'FILE_CSV_PARSEABLE' AND encoding) OR (check_code IN ('RECORD_SHAPE_VALID', 'SCHEMA_CONTRACT_MATCH', 'ROW_COUNT_MATCH') AND received_count IS NULL) AS hides
    FROM f JOIN k ON scope = 'FILE' JOIN blocked USING (batch_id, file_name) WHERE batch_status = 'REJECTED') f LEFT JOIN failed USING (batch_id, file_name, check_code) LEFT JOIN gated USING (batch_id, file_name, check_code)
  UNION ALL SELECT batch_id, NULL, NULL, batch_status, check_code, severity, kind,
    CASE check_code WHEN 'PUBLISH_GATE' THEN CASE WHEN batch_status = 'ACCEPTED' THEN gate_rows WHEN by_gate THEN received END ELSE 1 END,
    CASE check_code WHEN 'MANIFEST_VALID' THEN CASE WHEN manifest IS NULL THEN 0 ELSE 1 END WHEN 'PUBLISH_GATE' THEN CASE WHEN batch_status = 'ACCEPTED' THEN gate_errors WHEN by_gate THEN stored END ELSE 0 END, 0,
    CASE check_code WHEN 'MANIFEST_VALID' THEN manifest WHEN 'PUBLISH_GATE' THEN CASE WHEN by_gate THEN 'DQ_GATE_FAILED' WHEN batch_status = 'REJECTED' THEN 'BATCH_REJECTED' END END, CASE WHEN check_code = 'PUBLISH_GATE' THEN {MAX_SHARE * 100} END
  FROM (SELECT batch_id, max(status) AS batch_status, coalesce(bool_or(reason LIKE '%DQ_GATE_FAILED%'), false) AS by_gate, sum(received_count) AS received, (SELECT string_agg(DISTINCT code, '|' ORDER BY code) FROM code WHERE code.batch_id = a.batch_id AND code.file_name = 'manifest.json') AS manifest,
      (SELECT count(*) FROM t_outcomes o WHERE o.batch_id = a.batch_id) AS gate_rows, (SELECT count(*) FROM t_outcomes o WHERE o.batch_id = a.batch_id AND (outcome = 'QUARANTINED' OR version_key IN (SELECT version_key FROM t_issues WHERE severity = 'ERROR'))) AS gate_errors,
      (SELECT count(DISTINCT (file_name, source_row_number)) FROM t_gate_rejected_issues g WHERE g.batch_id = a.batch_id) AS stored FROM t_audit a GROUP BY batch_id) x JOIN k ON scope = 'BATCH' AND (check_code <> 'REJECTED_BATCH_NOT_LOADED' OR batch_status = 'REJECTED')),
report AS (SELECT batch_id, file_name, source_system, batch_status, check_code, CAST(evaluated AS BIGINT) AS evaluated_count, CAST(observed AS BIGINT) AS observed_count, CASE WHEN kind = 'RECONCILIATION' THEN CAST(expected AS BIGINT) END AS expected_count,
  CASE WHEN kind <> 'RECONCILIATION' AND evaluated > 0 THEN CAST(round_even(CAST(observed AS DECIMAL(20, 0)) * 100 / evaluated, 2) AS DECIMAL(7, 2)) END AS observed_pct,
  CASE WHEN observed IS NULL THEN 'NOT_EVALUATED' WHEN kind = 'GATE' THEN CASE WHEN observed * 100 > evaluated * threshold THEN 'FAIL' ELSE 'PASS' END WHEN kind = 'RECONCILIATION' THEN CASE WHEN observed = expected THEN 'PASS' ELSE 'FAIL' END WHEN kind = 'OBSERVATION' OR observed = 0 THEN 'PASS' WHEN severity = 'ERROR' THEN 'FAIL' ELSE 'WARN' END AS status, codes AS reason_codes FROM counted)"""
COLUMNS = ("batch_id", "file_name", "source_system", "batch_status", "check_code", "evaluated_count", "observed_count", "expected_count", "observed_pct", "status", "reason_codes")


def _report(spark: SparkSession, d: str) -> DataFrame:
    return delivery.build_report(Derived(spark, base._classified(spark, d)), SimpleNamespace(max_error_share=MAX_SHARE))


@query("delivered_report", f"{REPORT_SQL} SELECT {', '.join(COLUMNS)} FROM report")
def _(spark, d):
    return _report(spark, d).select(*COLUMNS)


@query("delivered_report_failures", f"{REPORT_SQL} SELECT batch_id, file_name, check_code, observed_count, expected_count FROM report WHERE status = 'FAIL' AND check_code IN ({', '.join(repr(c[0]) for c in checks.CHECKS if c[7])})")
def _(spark, d):
    return quality.failed_invariants(_report(spark, d)).select("batch_id", "file_name", "check_code", "observed_count", "expected_count")
