"""Facts and the reports over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

READMIT_DAYS = (1, 30)


def fact_versions(versions: DataFrame, fields: DataFrame, people: DataFrame, key: str, lineage: Sequence[str]) -> DataFrame:
    """Versions with their cleaned fields (by key) and the attributes of the person (by lineage)."""
    return versions.join(fields, key).join(people, list(lineage))


def fact_current(facts: DataFrame, current: DataFrame, key: str, carried: Sequence[str]) -> DataFrame:
    return facts.join(current.select(key, *carried), key)


def without_errors(facts: DataFrame, issues: DataFrame, key: str) -> DataFrame:
    """Facts whose version has no ERROR. There is no fallback to an older version."""
    return facts.join(issues.filter("severity = 'ERROR'").select(key).distinct(), key, "left_anti")


def not_void(status: Column) -> Column:
    """Keeps rows of unknown status."""
    return ~status.eqNullSafe("VOID")


def monthly_volume(facts: DataFrame, date: str, by: Sequence[str], amount: str, status: str | None = None, issues: DataFrame | None = None, key: str = "version_key") -> DataFrame:
    """Count and total amount by year, month and ``by``. Rows without a date have no month; null amounts count but add nothing."""
    rows = facts if status is None else facts.filter(not_void(F.col(status)))
    rows = rows if issues is None else without_errors(rows, issues, key)
    dated = rows.filter(F.col(date).isNotNull()).withColumns({"year": F.year(date), "month": F.month(date)})
    return dated.groupBy("year", "month", *by).agg(F.count(F.lit(1)).alias("n"), F.sum(amount).alias("total"))


def volume_report(facts: DataFrame, issues: DataFrame, calendar: DataFrame, facilities: DataFrame, key: str = "version_key") -> DataFrame:
    """Encounters and billed dollars by month, facility (with its name, if it is known) and type, in order: current state, without VOID and without errors.

    Months come from the calendar, so encounters without a day in it are left out. ``facts``: facility_id, encounter_type, claim_status, admit_date, billed_amount_usd.
    """
    rows = without_errors(facts.filter(not_void(F.col("claim_status"))), issues, key)
    dated = rows.join(calendar.select(F.col("date_key").alias("admit_date"), "year", "month"), "admit_date")
    named = dated.join(facilities.select("facility_id", "facility_name"), "facility_id", "left")
    volume = named.groupBy("year", "month", "facility_id", "facility_name", "encounter_type").agg(F.count(F.lit(1)).alias("encounters"), F.sum("billed_amount_usd").alias("billed_amount_usd"))
    return order_by_all(volume)


def order_by_all(report: DataFrame) -> DataFrame:
    """A report's rows in the order of all its columns, nulls first."""
    return report.orderBy(*[F.asc_nulls_first(c) for c in report.columns])


def readmission_flag(index: DataFrame, candidates: DataFrame, person: str, key: str, start: str, end: str, days: tuple[int, int] = READMIT_DAYS) -> DataFrame:
    """``index`` with ``readmitted``: 1 if a candidate of the same person starts ``days`` after the row's end.

    A candidate's own row never counts. A range self-join on the person with a bucket of the date, so a person with very
    many stays meets only the stays of two neighbouring buckets; each index row leaves the join once.
    """
    width = days[1] + 1
    bucket = lambda d: F.floor(F.date_diff(d, F.lit("1970-01-01").cast("date")) / width)
    left = index.filter(F.col(person).isNotNull() & F.col(end).isNotNull()).select(F.col(key).alias("_key"), F.col(person).alias("_p"), F.col(end).alias("_end"))
    left = left.withColumn("_b", F.explode(F.array(bucket(F.col("_end")), bucket(F.col("_end")) + 1)))
    right = candidates.filter(F.col(person).isNotNull() & F.col(start).isNotNull()).select(F.col(key).alias("_other"), F.col(person).alias("_q"), F.col(start).alias("_start"))
    right = right.withColumn("_c", bucket(F.col("_start")))
    gap = F.date_diff("_start", "_end")
    hit = (F.col("_p") == F.col("_q")) & (F.col("_b") == F.col("_c")) & (F.col("_key") != F.col("_other")) & gap.between(*days)
    hits = left.join(right, hit, "left_semi").select("_key").distinct()
    flagged = index.join(hits.withColumn("_hit", F.lit(1)), F.col(key) == F.col("_key"), "left").drop("_key")
    return flagged.withColumn("readmitted", F.coalesce("_hit", F.lit(0))).drop("_hit")


def chronic_acute_cohort(current: DataFrame, issues: DataFrame, facilities: DataFrame, diagnoses: DataFrame, providers: DataFrame, year: int = 2024, least: str = "5000.00") -> DataFrame:
    """Current acute encounters of chronic conditions in one year above an amount, with the readmission flag (null unless inpatient)."""
    f = current.filter(not_void(F.col("claim_status")))
    inpatient = F.col("encounter_type") == "INPATIENT"
    again = f.filter(inpatient & F.col("facility_id").isNotNull() & F.col("admit_date").isNotNull() & F.col("discharge_date").isNotNull())
    chosen = f.filter(F.col("encounter_type").isin("INPATIENT", "OBSERVATION", "EMERGENCY") & (F.year("admit_date") == year) & (F.col("billed_amount_usd") >= F.lit(least).cast("decimal(18,2)")))
    chosen = without_errors(chosen, issues, "version_key")
    dx = diagnoses.filter("in_reference AND is_chronic").select(F.col("icd10_code").alias("primary_dx_code"), F.col("description").alias("dx_description"), F.col("category").alias("chronic_category"))
    chosen = chosen.join(facilities.select("facility_id", "facility_name", "facility_type"), "facility_id").join(dx, "primary_dx_code")
    doctors = providers.select(F.col("sk").alias("provider_sk"), F.col("specialty").alias("attending_specialty_at_encounter"), F.col("employment_status").alias("attending_employment_status_at_encounter"))
    chosen = chosen.join(doctors, "provider_sk", "left")
    flagged = readmission_flag(chosen, again, "patient_key", "encounter_key", "admit_date", "discharge_date")
    flagged = flagged.withColumn("readmit_30d_flag", F.when(inpatient, F.col("readmitted"))).withColumnRenamed("zip3", "patient_zip3")
    return flagged.select(*COHORT_COLUMNS)


# Columns of the cohort export, in order.
COHORT_COLUMNS = (
    "encounter_key", "source_system", "source_record_id", "facility_id", "facility_name", "facility_type", "patient_key", "age_band", "sex", "patient_zip3",
    "admit_date", "discharge_date", "length_of_stay_days", "encounter_type", "primary_dx_code", "dx_description", "chronic_category", "attending_npi",
    "attending_specialty_at_encounter", "attending_employment_status_at_encounter", "payer_category", "billed_amount_usd", "claim_status", "readmit_30d_flag",
    "version_count", "source_batch_id", "source_file_name", "source_row_number",
)
