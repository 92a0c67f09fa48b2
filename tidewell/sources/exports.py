"""CSV exports with fixed formats, and the guard that keeps personal columns out of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns that identify a person, in any table.
PERSONAL = ("patient_mrn", "patient_first_name", "patient_last_name", "patient_dob", "patient_zip", "patient_phone")
EXPORTABLE = ("clean", "mart", "ops")


def assert_exportable(name: str, columns: Sequence[str], layer: str = "mart") -> None:
    """Refuse a table of another layer, or with a personal column (or its raw form)."""
    found = sorted({c for c in columns if c.lower() in PERSONAL or c.lower().removesuffix("_raw") in PERSONAL})
    if found or layer not in EXPORTABLE:
        raise ValueError(f"{name} must not be exported: {', '.join(found) or layer}")


def export_text(c: Column, kind: T.DataType) -> Column:
    """A value as export text: null is empty, booleans in lower case, dates ISO, instants with Z (microseconds only if there are any),
    decimals with two places. Floats are refused."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        raise TypeError("floats are not exported")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        whole, fine = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        text = F.when(F.date_format(c, "SSSSSS") == "000000", whole).otherwise(fine)
    elif isinstance(kind, T.DateType):
        text = F.date_format(c, "yyyy-MM-dd")
    elif isinstance(kind, T.DecimalType):
        text = c.cast(T.DecimalType(min(38, kind.precision - kind.scale + 2), 2)).cast("string")
    elif isinstance(kind, T.ArrayType):
        text = F.array_join(c, "|")
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(""))


def formatted(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[export_text(F.col(c), kinds[c]).alias(c) for c in columns or df.columns])


def export_csv(df: DataFrame, path: str, name: str, order: Sequence[str], layer: str = "mart", columns: Sequence[str] | None = None, single_file: bool = False) -> None:
    """Write a table as CSV, sorted by ``order`` with nulls first.

    The rows are range-partitioned and sorted, so files in name order are the table in order; ``single_file`` is for small reports only.
    """
    columns = list(columns or df.columns)
    assert_exportable(name, columns, layer)
    by = [F.asc_nulls_first(c) for c in order]
    rows = df.coalesce(1).sortWithinPartitions(*by) if single_file else df.orderBy(*by)
    formatted(rows, columns).write.mode("overwrite").option("header", True).option("emptyValue", "").option("lineSep", "\n").csv(path)


def export_file(df: DataFrame, path: str, name: str, order: Sequence[str], layer: str = "mart", columns: Sequence[str] | None = None) -> None:
    """Write a table as one CSV file with one header, sorted by ``order`` with nulls first.

    Tasks write the sorted parts; their bytes are then copied behind one another, in order of their names, by a stream that holds none of them, and the
    whole file is moved into its place. A failed export leaves the last one as it was; equal tables give equal bytes.
    """
    spark, columns = df.sparkSession, list(columns or df.columns)
    assert_exportable(name, columns, layer)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path
    new, parts = place(f"{path}.new"), f"{path}.parts"
    files = new.getFileSystem(conf)
    # rows that agree in ``order`` are told apart by what is exported of them
    rows = formatted_in_order(df, columns, order)
    try:
        rows.write.mode("overwrite").option("header", False).option("emptyValue", "").option("lineSep", "\n").csv(parts)
        out = files.create(new, True)
        try:
            out.write((",".join(columns) + "\n").encode())
            for p in sorted(s.getPath().toString() for s in files.listStatus(place(parts)) if s.getPath().getName().startswith("part-")):
                part = files.open(place(p))
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 16, False)
                part.close()
        finally:
            out.close()
    finally:
        files.delete(place(parts), True)
    moved(spark, f"{path}.new", path)


def formatted_in_order(df: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows as export text, sorted by ``order`` with nulls first, then by all that is exported."""
    by = df.select(*[F.col(c).alias(f"_by_{i}") for i, c in enumerate(order)], *[export_text(F.col(c), df.schema[c].dataType).alias(c) for c in columns])
    return by.orderBy(*[F.asc_nulls_first(f"_by_{i}") for i in range(len(order))], *columns).select(*columns)


def moved(spark: SparkSession, new: str, path: str) -> None:
    """Put a file or folder in the place of another by one rename where the file system can overwrite."""
    jvm = spark._jvm
    option = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(option, 1)
    overwrite[0] = option.OVERWRITE
    source, target = (jvm.org.apache.hadoop.fs.Path(x) for x in (new, path))
    conf = spark._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.getFileSystem(conf).getUri(), conf)
    context.rename(context.makeQualified(source), context.makeQualified(target), overwrite)


# The exported tables, the layer each belongs to, and the columns that order its rows.
EXPORTED = {
    "versions": ("clean", ("version_key",)),
    "outcomes": ("clean", ("batch_id", "file_name", "source_row_number")),
    "people": ("clean", ("batch_id", "file_name", "source_row_number")),
    "fields": ("clean", ("version_key",)),
    "dim_date": ("mart", ("date_key",)),
    "dim_facility": ("mart", ("facility_id",)),
    "dim_diagnosis": ("mart", ("icd10_code",)),
    "dim_payer": ("mart", ("payer_category",)),
    "dim_provider": ("mart", ("sk",)),
    "dim_patient": ("mart", ("patient_key",)),
    "fact_version": ("mart", ("version_key",)),
    "fact_current": ("mart", ("encounter_key",)),
    "issues": ("clean", ("version_key", "check_code")),
    "dq_report": ("ops", ("batch_id", "file_name", "check_code")),
    "quarantine": ("ops", ("batch_id", "file_name", "source_row_number", "quarantine_level")),
}


def export_tables(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Write all of ``EXPORTED`` as one CSV file each. All are checked before the first is written."""
    for name, (layer, order) in EXPORTED.items():
        missing = set(order) - set(tables[name].columns)
        if missing:
            raise ValueError(f"{name} lacks the columns that order its export: {', '.join(sorted(missing))}")
        assert_exportable(name, tables[name].columns, layer)
    for name, (layer, order) in EXPORTED.items():
        export_file(tables[name], f"{folder.rstrip('/')}/{name}.csv", name, order, layer)


# Columns of the audit export, and what they are called in the audit table.
AUDIT_COLUMNS = {
    "batch_id": "batch_id", "file_name": "file_name", "source_system": "source_system", "expected_count": "expected_count", "received_count": "received_count", "accepted_count": "accepted_count",
    "new_encounter_count": "new_encounter", "new_version_count": "new_version", "duplicate_count": "duplicate", "stale_count": "stale", "stale_new_version_count": "stale_new_version",
    "quarantined_count": "quarantined", "history_rows_written": "history_rows", "current_changed_count": "current_changed", "reconciliation_status": "reconciliation_status", "status": "status",
    "reason": "reason", "start_time": "start_time", "end_time": "end_time",
}


def audit_rows(audit: DataFrame) -> DataFrame:
    """The audit as exported: its 19 columns, times in UTC with milliseconds and Z."""
    stamp = lambda c: F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))
    return audit.select(*[(stamp(c) if n.endswith("_time") else F.col(c)).alias(n) for n, c in AUDIT_COLUMNS.items()])


def export_audit(audit: DataFrame, path: str) -> None:
    export_file(audit_rows(audit), path, "batch_audit", ["batch_id", "file_name"], "ops")


def export_cohort(cohort: DataFrame, path: str) -> None:
    """The cohort as CSV, in the order of its keys."""
    export_file(cohort, path, "chronic_acute_encounters", ["source_system", "source_record_id", "encounter_key"])
