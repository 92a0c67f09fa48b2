"""Reference inputs: code lists, masters, roster snapshots, aliases, source conventions; each with its problems as rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import is_icd10
from ..functions.text import full, normalise_key, strip

NPI = full("[0-9]{10}")


def _problems(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """A diagnosis reference: icd10_code, description, category, is_chronic (boolean)."""
    rows = spark.read.csv(path, header=True, schema="icd10_code string, description string, category string, is_chronic string")
    flag = F.when(F.col("is_chronic") == "Y", True).when(F.col("is_chronic") == "N", False)
    return rows.withColumn("is_chronic", flag)


def code_problems(codes: DataFrame) -> DataFrame:
    blank = strip(F.col("description")) == ""
    return _problems(
        codes.filter(~is_icd10(F.col("icd10_code"))).select(F.lit("code format").alias("problem")),
        codes.filter(F.col("is_chronic").isNull()).select(F.lit("flag is neither Y nor N").alias("problem")),
        codes.filter(blank | (strip(F.col("category")) == "")).select(F.lit("blank text").alias("problem")),
        codes.groupBy("icd10_code").count().filter("count > 1").select(F.lit("code not unique").alias("problem")),
    )


FACILITY = "facility_id string, facility_name string, source_system string, facility_type string, city string, state string, bed_count int, ownership string, go_live_date string"
SYSTEM = "source_system string, file_name string, date_order string, amount_unit string, timestamp_timezone string, notes string"


def read_master(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(facilities with their position, source conventions) of one JSON document."""
    document = spark.read.schema(f"source_systems array<struct<{SYSTEM.replace(' ', ':').replace(',:', ',')}>>, facilities array<struct<{FACILITY.replace(' ', ':').replace(',:', ',')}>>").json(path, multiLine=True)
    facilities = document.select(F.posexplode("facilities").alias("i", "f")).select((F.col("i") + 1).alias("source_position"), "f.*").withColumn("go_live_date", F.col("go_live_date").try_cast("date"))
    systems = document.select(F.explode("source_systems").alias("s")).select("s.*")
    # fixed value: the phrase by which notes state a century
    century = F.regexp_extract("notes", r"two-digit years mean (\d{2})xx", 1)
    conventions = systems.select("source_system", "file_name", "date_order", "amount_unit", "timestamp_timezone", (century.try_cast("int") * 100).alias("century"))
    return facilities, conventions


def facility_problems(facilities: DataFrame) -> DataFrame:
    """Of the columns that the table has."""
    texts = [c for c in ("facility_id", "facility_name", "source_system", "facility_type", "city", "state", "ownership") if c in facilities.columns]
    blank = reduce(lambda a, b: a | b, [strip(F.col(c)) == "" for c in texts])
    undated = F.col("go_live_date").isNull() if "go_live_date" in facilities.columns else F.lit(False)
    beds = ~F.coalesce(F.col("bed_count") >= 0, F.lit(False)) if "bed_count" in facilities.columns else F.lit(False)
    return _problems(
        facilities.filter(blank | undated).select(F.lit("blank or unreadable member").alias("problem")),
        facilities.filter(beds).select(F.lit("bed count").alias("problem")),
        facilities.groupBy("facility_id").count().filter("count > 1").select(F.lit("id not unique").alias("problem")),
    )


ROSTER = "as_of_date string, npi string, provider_last_name string, provider_first_name string, credential string, specialty string, primary_facility_id string, employment_status string"


def read_rosters(spark: SparkSession, folder: str) -> DataFrame:
    """All snapshots ``roster_YYYY-MM-DD.csv`` of a folder, with the file's name and date."""
    rows = spark.read.csv(folder, header=True, schema=ROSTER, pathGlobFilter="roster_*.csv")
    name = F.col("_metadata.file_name")
    return rows.select("*", name.alias("file_name"), F.regexp_extract(name, r"roster_(\d{4}-\d{2}-\d{2})\.csv", 1).try_cast("date").alias("file_date")).withColumn("as_of_date", F.col("as_of_date").try_cast("date"))


def roster_problems(rosters: DataFrame) -> DataFrame:
    texts = ["provider_last_name", "provider_first_name", "credential", "specialty", "primary_facility_id", "employment_status"]
    blank = reduce(lambda a, b: a | b, [strip(F.col(c)) == "" for c in texts])
    dated = F.col("as_of_date").eqNullSafe(F.col("file_date")) if "file_date" in rosters.columns else F.col("as_of_date").isNotNull()
    return _problems(
        rosters.filter(~dated).select(F.lit("date differs from the file's name").alias("problem")),
        rosters.filter(~F.coalesce(F.col("npi").rlike(NPI) & F.call_function("luhn_check", F.concat(F.lit("80840"), "npi")), F.lit(False))).select(F.lit("provider number").alias("problem")),
        rosters.filter(blank).select(F.lit("blank text").alias("problem")),
        rosters.groupBy("as_of_date", "npi").count().filter("count > 1").select(F.lit("number not unique in its snapshot").alias("problem")),
    )


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    """Aliases of a nested document, flat: source_system, facility_id, facility_name, alias."""
    nested = "source_systems map<string, map<string, struct<facility_name:string, aliases:array<string>>>>"
    document = spark.read.schema(nested).json(path, multiLine=True)
    systems = document.select(F.explode("source_systems").alias("source_system", "members"))
    members = systems.select("source_system", F.explode("members").alias("facility_id", "m"))
    return members.select("source_system", "facility_id", "m.facility_name", F.explode("m.aliases").alias("alias"))


def facility_index(facilities: DataFrame, aliases: DataFrame) -> DataFrame:
    """Lookup of names within a source system: source_system, name_key, facility_id. See ``facility_index_problems``."""
    names = facilities.select("source_system", normalise_key(F.col("facility_name")).alias("name_key"), "facility_id")
    return names.unionByName(aliases.select("source_system", normalise_key(F.col("alias")).alias("name_key"), "facility_id"))


def facility_index_problems(facilities: DataFrame, aliases: DataFrame) -> DataFrame:
    index = facility_index(facilities, aliases)
    master = facilities.select("facility_id", F.col("source_system").alias("own_system"), F.col("facility_name").alias("own_name"))
    joined = aliases.join(master, "facility_id", "left")
    return _problems(
        index.groupBy("source_system", "name_key").count().filter("count > 1").select(F.lit("two entries share one name").alias("problem")),
        index.filter("name_key = ''").select(F.lit("empty name").alias("problem")),
        joined.filter("own_system IS NULL").select(F.lit("alias without a facility").alias("problem")),
        joined.filter("own_system <> source_system").select(F.lit("alias in another system than its facility").alias("problem")),
        joined.filter("own_name <> facility_name").select(F.lit("alias entry names its facility differently").alias("problem")),
        facilities.groupBy("facility_id").count().filter("count > 1").select(F.lit("id not unique").alias("problem")),
    )


def resolve_facility(rows: DataFrame, index: DataFrame, name: str, source: str) -> DataFrame:
    """``rows`` with ``facility_id`` and ``facility_id_reason``: an exact match of the normalised name within the source's own facilities."""
    keyed = rows.withColumn("_key", normalise_key(F.col(name)))
    found = keyed.join(index.select(F.col("source_system").alias("_s"), F.col("name_key").alias("_n"), "facility_id"), (F.col("_key") == F.col("_n")) & (F.col(source) == F.col("_s")), "left")
    reason = F.when(F.col("_key") == "", "FACILITY_MISSING").when(F.col("facility_id").isNull(), "FACILITY_UNRESOLVED")
    return found.withColumn("facility_id_reason", reason).withColumn("facility_id", F.when(reason.isNull(), F.col("facility_id"))).drop("_key", "_s", "_n")
