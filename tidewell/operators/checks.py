"""The data-quality catalogue: checks, and how every reason code is counted.

Both are small tables; operators join them as DataFrames (they are broadcast: their size is fixed here).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ERROR, WARNING, INFO = "ERROR", "WARNING", "INFO"

# Code, category, layer, grain, severity, kind, scope, invariant, field.
_ = None
CHECKS = (
    ("MANIFEST_VALID", "FILE_VALIDATION", "LANDING", "BATCH", ERROR, "QUALITY", "BATCH", False, _),
    ("PUBLISH_GATE", "PUBLISH_GATE", "CLEAN", "BATCH", ERROR, "GATE", "BATCH", False, _),
    ("FILE_SHA256_MATCH", "FILE_VALIDATION", "LANDING", "FILE", ERROR, "QUALITY", "FILE", False, _),
    ("FILE_ENCODING_VALID", "FILE_VALIDATION", "LANDING", "FILE", ERROR, "QUALITY", "FILE", False, _),
    ("FILE_CSV_PARSEABLE", "FILE_VALIDATION", "LANDING", "FILE", ERROR, "QUALITY", "FILE", False, _),
    ("RECORD_SHAPE_VALID", "FILE_VALIDATION", "LANDING", "FILE", ERROR, "QUALITY", "FILE", False, _),
    ("SCHEMA_CONTRACT_MATCH", "SCHEMA", "LANDING", "FILE", ERROR, "QUALITY", "FILE", False, _),
    ("ROW_COUNT_MATCH", "ROW_COUNT", "LANDING", "FILE", ERROR, "RECONCILIATION", "FILE", False, _),
    ("SCHEMA_VERSION_CHANGED", "SCHEMA", "LANDING", "FILE", WARNING, "QUALITY", "FILE", False, _),
    ("DUPLICATE_FILE", "DUPLICATE", "LANDING", "FILE", WARNING, "QUALITY", "FILE", False, _),
    ("SOURCE_RECORD_ID_PRESENT", "QUARANTINE", "CLEAN", "ROW", ERROR, "QUALITY", "FILE", False, _),
    ("LAST_UPDATED_TS_VALID", "QUARANTINE", "CLEAN", "ROW", ERROR, "QUALITY", "FILE", False, _),
    ("VERSION_CONFLICT_SAME_TS", "QUARANTINE", "CLEAN", "ROW", ERROR, "QUALITY", "FILE", False, _),
    ("DUPLICATE_ROW", "DUPLICATE", "CLEAN", "ROW", INFO, "OBSERVATION", "FILE", False, _),
    ("STALE_ROW", "DUPLICATE", "CLEAN", "ROW", INFO, "OBSERVATION", "FILE", False, _),
    ("STALE_REPLAY_CONFLICT", "DUPLICATE", "CLEAN", "ROW", WARNING, "QUALITY", "FILE", False, _),
    ("FACILITY_RESOLVED", "VALIDITY", "CLEAN", "VERSION", ERROR, "QUALITY", "FILE", False, "facility_id"),
    ("ADMIT_DATE_VALID", "VALIDITY", "CLEAN", "VERSION", ERROR, "QUALITY", "FILE", False, "admit_date"),
    ("DISCHARGE_DATE_VALID", "VALIDITY", "CLEAN", "VERSION", WARNING, "QUALITY", "FILE", False, "discharge_date"),
    ("DISCHARGE_NOT_BEFORE_ADMIT", "VALIDITY", "CLEAN", "VERSION", WARNING, "QUALITY", "FILE", False, "discharge_date"),
    ("ENCOUNTER_TYPE_MAPPED", "VALIDITY", "CLEAN", "VERSION", WARNING, "QUALITY", "FILE", False, "encounter_type"),
    ("CLAIM_STATUS_MAPPED", "VALIDITY", "CLEAN", "VERSION", WARNING, "QUALITY", "FILE", False, "claim_status"),
    ("PAYER_MAPPED", "VALIDITY", "CLEAN", "VERSION", WARNING, "QUALITY", "FILE", False, "payer_category"),
    ("PRIMARY_DX_VALID", "VALIDITY", "CLEAN", "VERSION", WARNING, "QUALITY", "FILE", False, "primary_dx_code"),
    ("PRIMARY_DX_IN_REFERENCE", "REFERENTIAL_INTEGRITY", "CLEAN", "VERSION", WARNING, "QUALITY", "FILE", False, "primary_dx_code"),
    ("ATTENDING_NPI_VALID", "VALIDITY", "CLEAN", "VERSION", WARNING, "QUALITY", "FILE", False, "attending_npi"),
    ("ATTENDING_NPI_IN_ROSTER", "REFERENTIAL_INTEGRITY", "CLEAN", "VERSION", WARNING, "QUALITY", "FILE", False, "attending_npi"),
    ("BILLED_AMOUNT_VALID", "VALIDITY", "CLEAN", "VERSION", WARNING, "QUALITY", "FILE", False, "billed_amount_usd"),
    ("LAST_UPDATED_TS_UNAMBIGUOUS", "VALIDITY", "CLEAN", "VERSION", WARNING, "QUALITY", "FILE", False, "last_updated_ts_utc"),
    ("PATIENT_KEY_PRESENT", "NULL", "CLEAN", "VERSION", WARNING, "QUALITY", "FILE", False, "patient_key"),
    ("PATIENT_LINKED", "VALIDITY", "CLEAN", "VERSION", WARNING, "QUALITY", "FILE", False, "patient_link_status"),
    ("AGE_BAND_KNOWN", "VALIDITY", "CLEAN", "VERSION", WARNING, "QUALITY", "FILE", False, "age_band"),
    ("SEX_KNOWN", "VALIDITY", "CLEAN", "VERSION", WARNING, "QUALITY", "FILE", False, "sex"),
    ("ZIP3_VALID", "VALIDITY", "CLEAN", "VERSION", WARNING, "QUALITY", "FILE", False, "zip3"),
    ("PROVIDER_ON_ROSTER_AT_ADMIT", "REFERENTIAL_INTEGRITY", "MART", "VERSION", WARNING, "QUALITY", "FILE", False, "provider_sk"),
    ("FK_FACT_FACILITY", "REFERENTIAL_INTEGRITY", "MART", "VERSION", ERROR, "RECONCILIATION", "FILE", True, _),
    ("FK_FACT_DIAGNOSIS", "REFERENTIAL_INTEGRITY", "MART", "VERSION", ERROR, "RECONCILIATION", "FILE", True, _),
    ("FK_FACT_PAYER", "REFERENTIAL_INTEGRITY", "MART", "VERSION", ERROR, "RECONCILIATION", "FILE", True, _),
    ("FK_FACT_PROVIDER", "REFERENTIAL_INTEGRITY", "MART", "VERSION", ERROR, "RECONCILIATION", "FILE", True, _),
    ("FK_FACT_PATIENT", "REFERENTIAL_INTEGRITY", "MART", "VERSION", ERROR, "RECONCILIATION", "FILE", True, _),
    ("FK_FACT_DATE", "REFERENTIAL_INTEGRITY", "MART", "VERSION", ERROR, "RECONCILIATION", "FILE", True, _),
    ("CURRENT_MATCHES_HISTORY", "RECONCILIATION", "MART", "VERSION", ERROR, "RECONCILIATION", "FILE", True, _),
    ("VALUE_REASON_CONSISTENT", "NULL", "MART", "VERSION", ERROR, "RECONCILIATION", "FILE", True, _),
    ("KEY_UNIQUE", "DUPLICATE", "ALL", "VERSION", ERROR, "RECONCILIATION", "FILE", True, _),
    ("RECON_RAW_ROWS", "RECONCILIATION", "RAW", "ROW", ERROR, "RECONCILIATION", "FILE", True, _),
    ("RECON_ROW_OUTCOMES", "RECONCILIATION", "CLEAN", "ROW", ERROR, "RECONCILIATION", "FILE", True, _),
    ("RECON_PATIENT_ROWS", "RECONCILIATION", "CLEAN", "ROW", ERROR, "RECONCILIATION", "FILE", True, _),
    ("RECON_HISTORY_ROWS", "RECONCILIATION", "CLEAN", "VERSION", ERROR, "RECONCILIATION", "FILE", True, _),
    ("RECON_VERSION_FIELD_ROWS", "RECONCILIATION", "CLEAN", "VERSION", ERROR, "RECONCILIATION", "FILE", True, _),
    ("RECON_FACT_VERSION_ROWS", "RECONCILIATION", "MART", "VERSION", ERROR, "RECONCILIATION", "FILE", True, _),
    ("RECON_DQ_PARTITION", "RECONCILIATION", "CLEAN", "VERSION", ERROR, "RECONCILIATION", "FILE", True, _),
    ("RECON_QUARANTINE_ROWS", "RECONCILIATION", "CLEAN", "ROW", ERROR, "RECONCILIATION", "FILE", True, _),
    ("REJECTED_BATCH_NOT_LOADED", "RECONCILIATION", "ALL", "BATCH", ERROR, "RECONCILIATION", "BATCH", True, _),
    ("RECON_CURRENT_ROWS", "RECONCILIATION", "MART", "VERSION", INFO, "OBSERVATION", "FILE", False, _),
)
STRUCTURAL = ("FILE_SHA256_MATCH", "FILE_ENCODING_VALID", "FILE_CSV_PARSEABLE", "RECORD_SHAPE_VALID", "SCHEMA_CONTRACT_MATCH", "ROW_COUNT_MATCH")

# Reason codes that several fields share.
DATE_CODES = ("DATE_MISSING", "DATE_PLACEHOLDER", "DATE_UNPARSEABLE", "DATE_INVALID", "DATE_CENTURY_UNKNOWN", "DATE_AFTER_DELIVERY")
NPI_CODES = ("NPI_MISSING", "NPI_PLACEHOLDER", "NPI_INVALID_FORMAT", "NPI_CHECKSUM_FAILED")
TIMESTAMP_CODES = ("TIMESTAMP_MISSING", "TIMESTAMP_PLACEHOLDER", "TIMESTAMP_UNPARSEABLE", "TIMESTAMP_INVALID", "TIMESTAMP_NONEXISTENT_LOCAL_TIME")

# Where a reason is read, the codes, how they count (CHECK; DERIVATIVE: counted elsewhere; CONSEQUENCE: of a sibling), the check.
CODE_MAP = (
    ("facility_id_reason", ("FACILITY_MISSING", "FACILITY_UNRESOLVED"), "CHECK", "FACILITY_RESOLVED"),
    ("admit_date_reason", DATE_CODES, "CHECK", "ADMIT_DATE_VALID"),
    ("discharge_date_reason", DATE_CODES, "CHECK", "DISCHARGE_DATE_VALID"),
    ("discharge_date_warning", ("DISCHARGE_BEFORE_ADMIT",), "CHECK", "DISCHARGE_NOT_BEFORE_ADMIT"),
    ("encounter_type_reason", ("ENCOUNTER_TYPE_UNMAPPED",), "CHECK", "ENCOUNTER_TYPE_MAPPED"),
    ("encounter_type_warning", ("ENCOUNTER_TYPE_MISSING",), "CHECK", "ENCOUNTER_TYPE_MAPPED"),
    ("claim_status_reason", ("CLAIM_STATUS_MISSING", "CLAIM_STATUS_UNMAPPED"), "CHECK", "CLAIM_STATUS_MAPPED"),
    ("payer_category_reason", ("PAYER_UNMAPPED",), "CHECK", "PAYER_MAPPED"),
    ("payer_category_warning", ("PAYER_MISSING",), "CHECK", "PAYER_MAPPED"),
    ("primary_dx_code_reason", ("DX_MISSING", "DX_PLACEHOLDER", "DX_ICD9", "DX_UNPARSEABLE"), "CHECK", "PRIMARY_DX_VALID"),
    ("primary_dx_code_warning", ("DX_NOT_IN_REFERENCE",), "CHECK", "PRIMARY_DX_IN_REFERENCE"),
    ("attending_npi_reason", NPI_CODES, "CHECK", "ATTENDING_NPI_VALID"),
    ("attending_npi_warning", ("NPI_NOT_IN_ROSTER",), "CHECK", "ATTENDING_NPI_IN_ROSTER"),
    ("billed_amount_usd_reason", ("AMOUNT_MISSING", "AMOUNT_PLACEHOLDER", "AMOUNT_SPREADSHEET_ERROR", "AMOUNT_UNPARSEABLE", "AMOUNT_FRACTIONAL_CENTS", "AMOUNT_K_SUFFIX_NOT_ALLOWED"), "CHECK", "BILLED_AMOUNT_VALID"),
    ("patient_link_reason", ("PATIENT_UNLINKED_NO_DOB", "PATIENT_UNLINKED_INCOMPLETE", "PATIENT_UNLINKED_CONFLICT"), "CHECK", "PATIENT_LINKED"),
    ("patient_link_reason", ("PATIENT_MRN_MISSING",), "DERIVATIVE", "PATIENT_KEY_PRESENT"),
    ("linkage_name", ("LAST_NAME_MISSING", "FIRST_NAME_MISSING"), "DERIVATIVE", "PATIENT_LINKED"),
    ("sex_reason", ("SEX_MISSING", "SEX_UNMAPPED"), "CHECK", "SEX_KNOWN"),
    ("age_band_reason", ("AGE_BAND_DOB_UNAVAILABLE", "AGE_BAND_DOB_AFTER_ADMIT"), "CHECK", "AGE_BAND_KNOWN"),
    ("age_band_reason", ("AGE_BAND_ADMIT_UNAVAILABLE",), "DERIVATIVE", "ADMIT_DATE_VALID"),
    ("zip3_reason", ("ZIP_MISSING", "ZIP_INVALID"), "CHECK", "ZIP3_VALID"),
    ("patient_key_reason", ("PATIENT_MRN_MISSING",), "CHECK", "PATIENT_KEY_PRESENT"),
    ("provider_sk_reason", ("PROVIDER_NOT_ON_ROSTER_AT_ADMIT",), "CHECK", "PROVIDER_ON_ROSTER_AT_ADMIT"),
    ("provider_sk_reason", NPI_CODES, "DERIVATIVE", "ATTENDING_NPI_VALID"),
    ("provider_sk_reason", ("NPI_NOT_IN_ROSTER",), "DERIVATIVE", "ATTENDING_NPI_IN_ROSTER"),
    ("provider_sk_reason", ("PROVIDER_ADMIT_DATE_UNKNOWN",), "DERIVATIVE", "ADMIT_DATE_VALID"),
    ("length_of_stay_days_reason", ("LENGTH_OF_STAY_ADMIT_UNAVAILABLE",), "DERIVATIVE", "ADMIT_DATE_VALID"),
    ("length_of_stay_days_reason", ("LENGTH_OF_STAY_DISCHARGE_UNAVAILABLE",), "DERIVATIVE", "DISCHARGE_DATE_VALID"),
    ("length_of_stay_days_reason", ("DISCHARGE_BEFORE_ADMIT",), "DERIVATIVE", "DISCHARGE_NOT_BEFORE_ADMIT"),
    ("last_updated_ts_warning", ("TIMESTAMP_AMBIGUOUS_LOCAL_TIME",), "CHECK", "LAST_UPDATED_TS_UNAMBIGUOUS"),
    ("outcome_reason", ("SOURCE_RECORD_ID_MISSING",), "CHECK", "SOURCE_RECORD_ID_PRESENT"),
    ("outcome_reason", TIMESTAMP_CODES, "CHECK", "LAST_UPDATED_TS_VALID"),
    ("outcome_reason", ("VERSION_CONFLICT_SAME_TS",), "CHECK", "VERSION_CONFLICT_SAME_TS"),
    ("outcome_reason", ("DUPLICATE_OF_HELD_VERSION", "DUPLICATE_IN_BATCH"), "CHECK", "DUPLICATE_ROW"),
    ("outcome_reason", ("STALE_REPLAY", "STALE_NEW_VERSION"), "CHECK", "STALE_ROW"),
    ("audit_reason", ("MANIFEST_MISSING", "MANIFEST_INVALID", "BATCH_ID_MISMATCH", "UNKNOWN_SOURCE_SYSTEM", "FILE_MISSING", "UNEXPECTED_FILE"), "CHECK", "MANIFEST_VALID"),
    ("audit_reason", ("SHA256_MISMATCH",), "CHECK", "FILE_SHA256_MATCH"),
    ("audit_reason", ("ENCODING_ERROR",), "CHECK", "FILE_ENCODING_VALID"),
    ("audit_reason", ("CSV_PARSE_ERROR",), "CHECK", "FILE_CSV_PARSEABLE"),
    ("audit_reason", ("MALFORMED_RECORD",), "CHECK", "RECORD_SHAPE_VALID"),
    ("audit_reason", ("HEADER_MISSING", "UNKNOWN_SCHEMA_CHANGE"), "CHECK", "SCHEMA_CONTRACT_MATCH"),
    ("audit_reason", ("ROW_COUNT_MISMATCH",), "CHECK", "ROW_COUNT_MATCH"),
    ("audit_reason", ("SIBLING_FILE_REJECTED",), "CONSEQUENCE", None),
    ("audit_reason", ("DQ_GATE_FAILED",), "CHECK", "PUBLISH_GATE"),
    ("audit_reason", ("DUPLICATE_FILE",), "CHECK", "DUPLICATE_FILE"),
    ("schema_version", ("SCHEMA_VERSION_CHANGED",), "CHECK", "SCHEMA_VERSION_CHANGED"),
)
#: Reasons of cleaned fields: what the publish gate may read.
GATE_SOURCES = tuple(dict.fromkeys(s for s, *_rest in CODE_MAP if s.endswith(("_reason", "_warning")) and s.split("_reason")[0].split("_warning")[0] in {
    "facility_id", "admit_date", "discharge_date", "encounter_type", "claim_status", "payer_category", "primary_dx_code", "attending_npi", "billed_amount_usd"}))


def checks(spark: SparkSession) -> DataFrame:
    kinds = "check_code string, check_category string, layer string, grain string, severity string, kind string, scope string, invariant boolean, field_name string"
    return spark.createDataFrame(list(CHECKS), kinds)


def code_map(spark: SparkSession) -> DataFrame:
    known = {c[0] for c in CHECKS}
    rows = [(source, code, how, check) for source, codes, how, check in CODE_MAP for code in codes]
    if len({r[:2] for r in rows}) != len(rows) or any((check is None) != (how == "CONSEQUENCE") or (check and check not in known) for _s, _c, how, check in rows):
        raise ValueError("the code map is inconsistent")
    return spark.createDataFrame(rows, "source string, reason_code string, classification string, check_code string")
