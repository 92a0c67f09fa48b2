"""Registered queries of reference inputs, contracts, keyed pseudonyms and whole cleaned rows.

Inputs are written once, in SQL that Spark and DuckDB both read, from the driver's tables; what is wrong with them follows from the row's number.
"""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import keyed_hash
from ..operators import identity
from ..sources import landing, reference
from . import catalogue as base
from . import delivery, views
from .catalogue import PEOPLE_SQL, SQL, query
from .views import TEXTS_SQL


def _made(spark: SparkSession, d: str, sql: str, *tables: str) -> DataFrame:
    return spark.sql(sql, **{t: views.table(spark, d, t) for t in tables})


def _counted(problems: DataFrame) -> DataFrame:
    return problems.groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


CODES = """SELECT CASE o_orderkey % 6 WHEN 0 THEN concat('E', lpad(CAST(o_orderkey % 100 AS STRING), 2, '0')) WHEN 1 THEN concat('A1B.', CAST(o_orderkey % 10000 AS STRING)) WHEN 2 THEN '250.0' WHEN 3 THEN '' WHEN 5 THEN concat('E11.', CAST(o_orderkey + 10000 AS STRING)) END AS icd10_code,
  CASE WHEN o_orderkey % 5 = 0 THEN '  ' ELSE 'd' END AS description, CASE WHEN o_orderkey % 7 <> 0 THEN 'c' END AS category, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 3 = 0 END AS is_chronic, o_orderkey AS k FROM {orders}"""


@query(
    "code_list_problems",
    f"""WITH c AS ({CODES.format(orders="orders")}) SELECT problem, count(*) AS n FROM (SELECT 'code format' AS problem FROM c WHERE k % 6 > 1 UNION ALL SELECT 'flag is neither Y nor N' FROM c WHERE k % 4 = 0
  UNION ALL SELECT 'blank text' FROM c WHERE k % 5 = 0 OR k % 7 = 0 UNION ALL SELECT 'code not unique' FROM (SELECT icd10_code FROM c GROUP BY 1 HAVING count(*) > 1) x) GROUP BY problem""",
)
def _(spark, d):
    return _counted(reference.code_problems(_made(spark, d, CODES, "orders")))


FACILITIES = """SELECT concat('F', CAST(s_suppkey - CASE WHEN s_suppkey % 9 = 0 THEN 1 ELSE 0 END AS STRING)) AS facility_id, CASE WHEN s_suppkey % 7 = 3 THEN '  ' ELSE s_name END AS facility_name, concat('S', CAST(s_nationkey AS STRING)) AS source_system,
  CASE WHEN s_suppkey % 11 <> 0 THEN 't' END AS facility_type, CASE WHEN s_suppkey % 5 = 0 THEN -1 WHEN s_suppkey % 6 <> 0 THEN 3 END AS bed_count, s_suppkey AS k FROM {supplier}"""
ALIASES = """SELECT concat('S', CAST(s_nationkey + CASE WHEN s_suppkey % 6 = 1 THEN 100 ELSE 0 END AS STRING)) AS source_system, concat(CASE WHEN s_suppkey % 8 = 0 THEN 'X' ELSE 'F' END, CAST(s_suppkey AS STRING)) AS facility_id,
  CASE WHEN s_suppkey % 12 = 5 THEN 'other' ELSE s_name END AS facility_name, CASE WHEN s_suppkey % 4 = 0 THEN concat(' ', lower(s_name)) WHEN s_suppkey % 10 = 1 THEN ' ' ELSE concat('alias ', CAST(s_suppkey AS STRING)) END AS alias FROM {supplier}"""


@query(
    "facility_list_problems",
    f"""WITH f AS ({FACILITIES.format(supplier="supplier")}) SELECT problem, count(*) AS n FROM (SELECT 'blank or unreadable member' AS problem FROM f WHERE k % 7 = 3 OR k % 11 = 0 UNION ALL SELECT 'bed count' FROM f WHERE k % 5 = 0 OR k % 6 = 0
  UNION ALL SELECT 'id not unique' FROM (SELECT facility_id FROM f GROUP BY 1 HAVING count(*) > 1) x) GROUP BY problem""",
)
def _(spark, d):
    return _counted(reference.facility_problems(_made(spark, d, FACILITIES, "supplier").drop("k")))


@query(
    "facility_index_problems",
    f"""WITH f AS ({FACILITIES.format(supplier="supplier")}), a AS ({ALIASES.format(supplier="supplier")}), x AS (SELECT source_system, upper(trim(facility_name)) AS name FROM f UNION ALL SELECT source_system, upper(trim(alias)) FROM a),
j AS (SELECT a.*, f.source_system AS own, f.facility_name AS own_name FROM a LEFT JOIN f USING (facility_id)) SELECT problem, count(*) AS n FROM (SELECT 'two entries share one name' AS problem FROM (SELECT source_system, name FROM x GROUP BY ALL HAVING count(*) > 1) y UNION ALL SELECT 'empty name' FROM x WHERE name = ''
  UNION ALL SELECT 'alias without a facility' FROM j WHERE own IS NULL UNION ALL SELECT 'alias in another system than its facility' FROM j WHERE own <> source_system UNION ALL SELECT 'alias entry names its facility differently' FROM j WHERE own_name <> facility_name
  UNION ALL SELECT 'id not unique' FROM (SELECT facility_id FROM f GROUP BY 1 HAVING count(*) > 1) z) GROUP BY problem""",
)
def _(spark, d):
    return _counted(reference.facility_index_problems(_made(spark, d, FACILITIES, "supplier"), _made(spark, d, ALIASES, "supplier")))


ROSTERS = """SELECT CAST(o_orderdate AS DATE) AS as_of_date, CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) END AS file_date, CASE o_orderkey % 4 WHEN 0 THEN '1234567893' WHEN 1 THEN '1234567890' WHEN 2 THEN '123' END AS npi, CASE WHEN o_orderkey % 11 = 0 THEN ' ' ELSE 'x' END AS provider_last_name,
  'f' AS provider_first_name, 'MD' AS credential, CASE WHEN o_orderkey % 17 <> 0 THEN 's' END AS specialty, 'F1' AS primary_facility_id, 'e' AS employment_status, o_orderkey AS k FROM {orders}"""


@query(
    "roster_problems",
    f"""WITH r AS ({ROSTERS.format(orders="orders")}) SELECT problem, count(*) AS n FROM (SELECT 'date differs from the file''s name' AS problem FROM r WHERE k % 13 = 0 UNION ALL SELECT 'provider number' FROM r WHERE k % 4 <> 0 UNION ALL SELECT 'blank text' FROM r WHERE k % 11 = 0 OR k % 17 = 0
  UNION ALL SELECT 'number not unique in its snapshot' FROM (SELECT as_of_date, npi FROM r GROUP BY ALL HAVING count(*) > 1) x) GROUP BY problem""",
)
def _(spark, d):
    return _counted(reference.roster_problems(_made(spark, d, ROSTERS, "orders")))


CONTRACTS = """SELECT concat('S', CAST(s_suppkey % 50 AS STRING)) AS source_system, concat('f', CAST(s_suppkey % 50 - CASE WHEN s_suppkey % 50 = 49 THEN 1 ELSE 0 END AS STRING), '.csv') AS file_name, concat('v', CAST(s_suppkey - CASE WHEN s_suppkey % 10 = 0 THEN 1 ELSE 0 END AS STRING)) AS version, 1 AS version_position,
  split(concat('a', CAST(floor(s_suppkey / 100) AS STRING), CASE WHEN s_suppkey % 7 = 0 THEN ',b,b' ELSE ',b,c' END), ',') AS columns, split(CASE s_suppkey % 9 WHEN 0 THEN 'x,y,y' WHEN 1 THEN 'x,y,other' ELSE 'x,y,z' END, ',') AS canonical, s_suppkey AS k FROM {supplier}"""


@query(
    "contract_problems",
    f"""WITH c AS ({CONTRACTS.format(supplier="supplier")}) SELECT problem, count(*) AS n FROM (SELECT 'version ids are not unique' AS problem FROM (SELECT version FROM c GROUP BY 1 HAVING count(*) > 1) x UNION ALL SELECT 'identical header versions' FROM (SELECT source_system, columns FROM c GROUP BY ALL HAVING count(*) > 1) x
  UNION ALL SELECT 'a file name of two systems' FROM (SELECT file_name FROM c GROUP BY 1 HAVING count(DISTINCT source_system) > 1) x UNION ALL SELECT 'columns empty or duplicated' FROM c WHERE k % 7 = 0 UNION ALL SELECT 'two columns map to one canonical column' FROM c WHERE k % 9 = 0
  UNION ALL SELECT 'maps to an unknown column' FROM c WHERE k % 9 = 1) GROUP BY problem""",
)
def _(spark, d):
    return _counted(landing.contract_problems(_made(spark, d, CONTRACTS, "supplier"), ["x", "y", "z"]))


#: A secret for this query alone, and its two pads (a keyed hash is a hash of a hash, each behind the key under a pad).
SECRET = b"a secret for tests"
_PADS = [bytes(k ^ pad for k in SECRET.ljust(64, b"\0")).hex() for pad in (0x36, 0x5C)]
_QUOTED = lambda *parts: "'[\"patient/v1\",\"' || " + " || '\",\"' || ".join(parts) + " || '\"]'"


@query(
    "patient_keys",
    f"""WITH {PEOPLE_SQL}, m AS (SELECT src, local_id, CASE WHEN local_id = '' THEN NULL WHEN n = 1 THEN {_QUOTED("'LINKED'", "last_name", "first_name", "CAST(born AS VARCHAR)")} ELSE {_QUOTED("'UNLINKED'", "src", "local_id")} END AS message FROM i)
SELECT src, local_id, sha256(from_hex('{_PADS[1]}') || from_hex(sha256(from_hex('{_PADS[0]}') || encode(message)))) AS patient_key FROM m""",
)
def _(spark, d):
    found = identity.link_identities(base._people(spark, d), "src", "mrn", ["last_name", "first_name", "born"], F.col("born").isNotNull())
    return found.select("src", "local_id", keyed_hash(SECRET, F.col("key_parts")).alias("patient_key"))


@query(
    "identities_by_batch",
    f"""WITH {PEOPLE_SQL}, e AS (SELECT src, trim(mrn) AS local_id, count(DISTINCT (last_name, first_name, born)) FILTER (WHERE last_name IS NOT NULL AND born IS NOT NULL) AS n, bool_or(born IS NOT NULL) AS dated FROM p WHERE k % 3 < 2 GROUP BY ALL),
a AS (SELECT i.src, i.local_id, i.n, (SELECT bool_or(born IS NOT NULL) FROM p WHERE p.src = i.src AND trim(p.mrn) = i.local_id) AS dated, e.n AS n0, e.dated AS d0, e.src IS NOT NULL AS known, EXISTS (SELECT 1 FROM p WHERE p.src = i.src AND trim(p.mrn) = i.local_id AND k % 3 = 2) AS touched FROM i LEFT JOIN e USING (src, local_id))
SELECT src AS source, local_id FROM a WHERE touched AND (NOT known OR (local_id <> '' AND (least(n, 2) <> least(n0, 2) OR (n = 0 AND dated <> d0))))""",
)
def _(spark, d):
    # two batches of three hold two thirds of the rows: whose link does the third change?
    people = base._people(spark, d)
    states = [identity.identity_states(people.filter(f"k % 3 {part}"), "src", "mrn", ["last_name", "first_name", "born"], F.col("born").isNotNull()) for part in ("= 0", "= 1", "= 2")]
    return identity.changed_identities(states[0].unionByName(states[1]), states[2], 3)


_FIELDS = {"billed_amount_usd": "clean_amount", "admit_date": "clean_date", "encounter_type": "clean_encounter_type", "claim_status": "clean_claim_status", "payer_category": "clean_payer_category"}
_JOINED = " ".join(f"JOIN ({SQL[q]}) {c} ON {c}.k = t.k" for c, q in _FIELDS.items())


@query(
    "cleaned_fields",
    f"""WITH {TEXTS_SQL} SELECT CAST(t.k AS VARCHAR) AS version_key, {', '.join(f'{c}.value AS {c}, {c}.reason AS {c}_reason' for c in _FIELDS)}, encounter_type.warning AS encounter_type_warning, payer_category.warning AS payer_category_warning,
  CASE WHEN t.k % 3 = 0 THEN 'F1' END AS facility_id, CASE t.k % 3 WHEN 1 THEN 'FACILITY_MISSING' WHEN 2 THEN 'FACILITY_UNRESOLVED' END AS facility_id_reason, CASE WHEN t.k % 6 IN (0, 1) THEN 'E11.9' WHEN t.k % 6 = 5 THEN 'I10' END AS primary_dx_code,
  CASE t.k % 6 WHEN 2 THEN 'DX_ICD9' WHEN 3 THEN 'DX_PLACEHOLDER' WHEN 4 THEN 'DX_UNPARSEABLE' END AS primary_dx_code_reason, CASE WHEN t.k % 6 = 5 THEN 'DX_NOT_IN_REFERENCE' END AS primary_dx_code_warning FROM texts t {_JOINED}""",
)
def _(spark, d):
    c, k = F.col, F.col("k")
    versions = views.texts(spark, d).select(
        k.cast("string").alias("version_key"), F.lit("batch_000").alias("batch_id"), F.lit("f").alias("file_name"), k.alias("source_row_number"), F.lit(0).alias(delivery.BUCKET), F.lit("S").alias("file_source_system"), F.when(k % 3 == 0, " north  clinic").when(k % 3 == 1, "").otherwise("?").alias("facility_name"),
        c("dx").alias("primary_dx_code"), c("npi").alias("attending_npi"), c("day").alias("admit_date"), c("day").alias("discharge_date"), c("ord").alias("date_order"), "century", F.to_date(F.lit("2000-06-30")).alias("delivered_date"), c("kind").alias("encounter_type"), c("claim").alias("claim_status"),
        c("payer").alias("payer_name"), c("amount").alias("billed_amount"), c("unit").alias("amount_unit"), F.lit(None).cast("string").alias("last_updated_ts_warning"),
    )
    frame = spark.createDataFrame
    config = SimpleNamespace(
        facilities=frame([("F1", "North Clinic", "S")], "facility_id string, facility_name string, source_system string"), aliases=frame([], "source_system string, facility_id string, facility_name string, alias string"),
        codes=frame([("E11.9",)], "icd10_code string"), rosters=spark.sql("SELECT '1234567893' AS npi"),  # of a size that Spark knows, as a file is
    )
    fields = delivery.cleaned_fields(versions, config)
    own = [x for f in _FIELDS for x in (f, f"{f}_reason")]
    return fields.select("version_key", *own, "encounter_type_warning", "payer_category_warning", "facility_id", "facility_id_reason", "primary_dx_code", "primary_dx_code_reason", "primary_dx_code_warning")
