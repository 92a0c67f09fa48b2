"""Registered queries over the driver's tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaning as clean
from ..functions import keys
from ..functions.text import normalise_key
from ..operators import dimensions, facts, history, identity, quality
from ..sources import exports, landing
from . import views
from .views import CLASSIFIED_SQL, DELIVERY_SQL, ENCOUNTERS_SQL, ROSTER_SQL, TEXTS_SQL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


# --- history -----------------------------------------------------------------

LINEAGE = ["file_name", "row_no"]


def _classified(spark: SparkSession, d: str) -> DataFrame:
    return history.classify_history(views.delivery(spark, d), ["rec"], "v", "batch_no", LINEAGE, ["event_type", "bucket", "spelling"], loose=["spelling"])


def _versions(spark: SparkSession, d: str) -> DataFrame:
    return history.new_versions(_classified(spark, d)).select("rec", "v", "batch_no", "file_name", "row_no", "event_type", "bucket", "outcome")


@query("classify_outcomes", f"WITH {CLASSIFIED_SQL} SELECT batch_no, file_name, row_no, rec, v, outcome, outcome_reason, match_type, is_first_seen FROM classified")
def _(spark, d):
    return _classified(spark, d).select("batch_no", "file_name", "row_no", "rec", "v", "outcome", "outcome_reason", "match_type", "is_first_seen")


#: A third of all rows are of one record.
HOT_SQL = CLASSIFIED_SQL.replace("ELSE user_id END AS rec", "WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS rec")


@query("classify_hot_record", f"WITH {HOT_SQL} SELECT batch_no, file_name, row_no, rec, v, outcome, outcome_reason, match_type, is_first_seen FROM classified")
def _(spark, d):
    rows = views.delivery(spark, d)
    rows = rows.withColumn("rec", F.when(F.col("rec").isNotNull() & (F.col("row_no") % 3 == 0), F.lit(0)).otherwise(F.col("rec")))
    hot = history.hot_records(rows, ["rec"], 200)
    classified = history.classify_history(rows, ["rec"], "v", "batch_no", LINEAGE, ["event_type", "bucket", "spelling"], loose=["spelling"], hot=hot)
    return classified.select("batch_no", "file_name", "row_no", "rec", "v", "outcome", "outcome_reason", "match_type", "is_first_seen")


@query("classify_outcome_counts", f"WITH {CLASSIFIED_SQL} SELECT batch_no, outcome, outcome_reason, match_type, count(*) AS n FROM classified GROUP BY ALL")
def _(spark, d):
    return _classified(spark, d).groupBy("batch_no", "outcome", "outcome_reason", "match_type").agg(F.count(F.lit(1)).alias("n"))


@query("classify_one_batch", f"WITH {CLASSIFIED_SQL} SELECT file_name, row_no, outcome, outcome_reason FROM classified WHERE batch_no = 2")
def _(spark, d):
    rows = views.delivery(spark, d)
    held = _classified(spark, d).filter("batch_no < 2 AND is_first_seen").select(*rows.columns)
    last = history.classify_batch(rows.filter("batch_no = 2"), held, ["rec"], "v", "batch_no", LINEAGE, ["event_type", "bucket", "spelling"], loose=["spelling"])
    return last.select("file_name", "row_no", "outcome", "outcome_reason")


CURRENT_SQL = "SELECT rec, v, batch_no, event_type, count(*) OVER (PARTITION BY rec) AS version_count, min(batch_no) OVER (PARTITION BY rec) AS first_batch FROM versions {} QUALIFY row_number() OVER (PARTITION BY rec ORDER BY v DESC, file_name, row_no) = 1"


@query("current_state", f"WITH {CLASSIFIED_SQL} {CURRENT_SQL.format('')}")
def _(spark, d):
    return history.current_state(_versions(spark, d), ["rec"], "v", LINEAGE, "batch_no").select("rec", "v", "batch_no", "event_type", "version_count", "first_batch")


@query("as_of_state", f"WITH {CLASSIFIED_SQL} {CURRENT_SQL.format('WHERE batch_no <= 1')}")
def _(spark, d):
    return history.state_as_of(_versions(spark, d), ["rec"], "v", LINEAGE, "batch_no", 1).select("rec", "v", "batch_no", "event_type", "version_count", "first_batch")


@query("version_history", f"WITH {CLASSIFIED_SQL} SELECT rec, v, batch_no, outcome, v = max(v) OVER (PARTITION BY rec) AS is_current FROM versions")
def _(spark, d):
    v = _versions(spark, d)
    return history.version_history(v, history.current_state(v, ["rec"], "v", LINEAGE, "batch_no"), ["rec"], "v").select("rec", "v", "batch_no", "outcome", "is_current")


@query("append_versions_twice", f"WITH {CLASSIFIED_SQL} SELECT count(*) AS first_apply, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM versions h WHERE h.rec = w.rec AND h.v = w.v)) AS second_apply FROM versions w")
def _(spark, d):
    c = _classified(spark, d)
    first = history.new_versions(c)
    again = history.new_versions(c, first, ["rec", "v"])
    return first.agg(F.count(F.lit(1)).alias("first_apply")).crossJoin(again.agg(F.count(F.lit(1)).alias("second_apply")))  # one row each


COUNTS_SQL = """SELECT batch_no, file_name, count(*) AS received, count(*) FILTER (WHERE outcome = 'NEW_ENCOUNTER') AS new_encounter, count(*) FILTER (WHERE outcome = 'NEW_VERSION') AS new_version,
  count(*) FILTER (WHERE outcome = 'DUPLICATE') AS duplicate, count(*) FILTER (WHERE outcome = 'STALE') AS stale, count(*) FILTER (WHERE outcome_reason = 'STALE_NEW_VERSION') AS stale_new_version,
  count(*) FILTER (WHERE outcome = 'QUARANTINED') AS quarantined, count(*) FILTER (WHERE is_first_seen) AS history_rows, count(DISTINCT rec) FILTER (WHERE outcome IN ('NEW_ENCOUNTER', 'NEW_VERSION')) AS current_changed FROM classified GROUP BY ALL"""


@query("outcome_counts", f"WITH {CLASSIFIED_SQL} {COUNTS_SQL}")
def _(spark, d):
    return history.outcome_counts(_classified(spark, d), ["batch_no", "file_name"], ["rec"])


@query("batch_reconciliation", f"WITH {CLASSIFIED_SQL}, c AS ({COUNTS_SQL}) SELECT batch_no, file_name, received, received + 1 AS expected FROM c WHERE batch_no = 1")
def _(spark, d):
    counts = history.outcome_counts(_classified(spark, d), ["batch_no", "file_name"], ["rec"])
    # batch 1 is declared with one row more than it delivers: exactly its files fail
    declared = views.delivery(spark, d).groupBy("batch_no", "file_name").agg((F.count(F.lit(1)) + F.max((F.col("batch_no") == 1).cast("int"))).alias("row_count"))
    return history.reconcile(counts, declared, ["batch_no", "file_name"]).select("batch_no", "file_name", "received", "expected")


@query("row_lineage", f"WITH {CLASSIFIED_SQL}, c AS ({CURRENT_SQL.format('')}), n AS (SELECT batch_no, file_name, count(*) AS rows_in_file FROM delivery GROUP BY ALL) SELECT v.rec, v.batch_no, v.file_name, v.row_no, n.rows_in_file FROM c JOIN versions v ON v.rec = c.rec AND v.v = c.v JOIN n ON n.batch_no = v.batch_no AND n.file_name = v.file_name")
def _(spark, d):
    current = history.current_state(_versions(spark, d), ["rec"], "v", LINEAGE, "batch_no")
    files = quality.rows_per_file({"raw": (views.delivery(spark, d), "batch_no", "file_name")}).select(F.col("batch_id").alias("batch_no"), "file_name", F.col("n").alias("rows_in_file"))
    return current.join(files, ["batch_no", "file_name"]).select("rec", "batch_no", "file_name", "row_no", "rows_in_file")


# --- facts and reports ----------------------------------------------------------

VOLUME_SQL = "SELECT CAST(year(admit) AS INTEGER) AS year, CAST(month(admit) AS INTEGER) AS month, site, kind, count(*) AS n, CAST(sum(cents) AS BIGINT) AS total FROM encounters e WHERE status IS DISTINCT FROM 'VOID' AND admit IS NOT NULL {} GROUP BY ALL"
ISSUES_SQL = "issues AS (SELECT enc, 'AMOUNT_MISSING' AS reason_code, 'WARNING' AS severity FROM encounters WHERE cents IS NULL UNION ALL SELECT enc, 'DATE_MISSING', 'ERROR' FROM encounters WHERE admit IS NULL OR enc % 23 = 0)"


def _issues(e: DataFrame) -> DataFrame:
    warn = e.filter("cents IS NULL").select("enc", F.lit("AMOUNT_MISSING").alias("reason_code"), F.lit("WARNING").alias("severity"))
    return warn.unionByName(e.filter("admit IS NULL OR enc % 23 = 0").select("enc", F.lit("DATE_MISSING").alias("reason_code"), F.lit("ERROR").alias("severity")))


@query("monthly_volume_current", f"WITH {ENCOUNTERS_SQL}, {ISSUES_SQL} {VOLUME_SQL.format(chr(32) + 'AND NOT EXISTS (SELECT 1 FROM issues i WHERE i.enc = e.enc AND i.severity = ' + chr(39) + 'ERROR' + chr(39) + ')')}")
def _(spark, d):
    e = views.encounters(spark, d)
    return facts.monthly_volume(e, "admit", ["site", "kind"], "cents", "status", _issues(e), "enc")


@query("monthly_volume_as_of", f"WITH {CLASSIFIED_SQL}, k AS ({CURRENT_SQL.format('WHERE batch_no <= 1')}) SELECT CAST(year(v) AS INTEGER) AS year, CAST(month(v) AS INTEGER) AS month, event_type, count(*) AS n, CAST(sum(version_count) AS BIGINT) AS total FROM k GROUP BY ALL")
def _(spark, d):
    known = history.state_as_of(_versions(spark, d), ["rec"], "v", LINEAGE, "batch_no", 1)
    return facts.monthly_volume(known, "v", ["event_type"], "version_count")


@query(
    "readmission_flag",
    f"WITH {ENCOUNTERS_SQL} SELECT enc, CAST(CASE WHEN EXISTS (SELECT 1 FROM encounters r WHERE r.person = e.person AND r.enc <> e.enc AND r.status IS DISTINCT FROM 'VOID' AND date_diff('day', e.discharge, r.admit) BETWEEN 1 AND 30) THEN 1 ELSE 0 END AS INTEGER) AS readmitted FROM encounters e",
)
def _(spark, d):
    e = views.encounters(spark, d)
    return facts.readmission_flag(e, e.filter(facts.not_void(F.col("status"))), "person", "enc", "admit", "discharge").select("enc", "readmitted")


@query("length_of_stay", f"WITH {ENCOUNTERS_SQL} SELECT enc, CASE WHEN discharge >= admit THEN CAST(date_diff('day', admit, discharge) AS INTEGER) END AS days, CASE WHEN admit IS NULL THEN 'LENGTH_OF_STAY_ADMIT_UNAVAILABLE' WHEN discharge IS NULL THEN 'LENGTH_OF_STAY_DISCHARGE_UNAVAILABLE' WHEN discharge < admit THEN 'DISCHARGE_BEFORE_ADMIT' END AS reason FROM encounters")
def _(spark, d):
    return views.encounters(spark, d).withColumn("s", clean.length_of_stay(F.col("admit"), F.col("discharge"))).select("enc", F.col("s.value").alias("days"), "s.reason")


@query("parameterised_filter", f"WITH {ENCOUNTERS_SQL} SELECT enc, site, cents FROM encounters WHERE kind IN ('1-URGENT', '2-HIGH') AND year(admit) = 1997 AND cents >= 1000000 AND status IS DISTINCT FROM 'VOID'")
def _(spark, d):
    sql = "SELECT enc, site, cents FROM {e} WHERE kind IN (:k1, :k2) AND year(admit) = :y AND cents >= :least AND NOT (status <=> 'VOID')"
    return spark.sql(sql, args={"k1": "1-URGENT", "k2": "2-HIGH", "y": 1997, "least": 1000000}, e=views.encounters(spark, d))


@query(
    "chronic_acute_cohort",
    f"""WITH {ENCOUNTERS_SQL}, f AS (SELECT *, CASE kind WHEN '1-URGENT' THEN 'INPATIENT' WHEN '2-HIGH' THEN 'EMERGENCY' WHEN '3-MEDIUM' THEN 'OBSERVATION' ELSE 'OUTPATIENT' END AS type, CAST(CAST(cents AS DECIMAL(18, 0)) * 0.01 AS DECIMAL(18, 2)) AS usd FROM encounters)
SELECT CAST(enc AS VARCHAR) AS encounter_key, n_name AS facility_name, 'about ' || CAST(person % 10 AS VARCHAR) AS dx_description, CASE WHEN site % 5 <> 0 THEN 'x' || CAST(site AS VARCHAR) END AS attending_specialty_at_encounter, usd AS billed_amount_usd,
  CAST(CASE WHEN type = 'INPATIENT' THEN CASE WHEN EXISTS (SELECT 1 FROM f r WHERE r.type = 'INPATIENT' AND r.status IS DISTINCT FROM 'VOID' AND r.discharge IS NOT NULL AND r.person = f.person AND r.enc <> f.enc AND date_diff('day', f.discharge, r.admit) BETWEEN 1 AND 30) THEN 1 ELSE 0 END END AS INTEGER) AS readmit_30d_flag
FROM f JOIN nation ON n_nationkey = site WHERE status IS DISTINCT FROM 'VOID' AND type <> 'OUTPATIENT' AND person % 10 < 4 AND person % 10 <> 2 AND year(admit) = 1997 AND usd >= 1000 AND enc % 23 <> 0""",
)
def _(spark, d):
    c, text = F.col, lambda x: F.col(x).cast("string")
    kind = F.when(c("kind") == "1-URGENT", "INPATIENT").when(c("kind") == "2-HIGH", "EMERGENCY").when(c("kind") == "3-MEDIUM", "OBSERVATION").otherwise("OUTPATIENT")
    e = views.encounters(spark, d)
    blank = {n: F.lit(None).cast("string") for n in ("age_band", "sex", "zip3", "payer_category", "source_batch_id", "source_file_name", "source_row_number", "version_count", "attending_npi")}
    current = e.select(
        text("enc").alias("encounter_key"), text("enc").alias("version_key"), F.lit("S").alias("source_system"), text("enc").alias("source_record_id"), text("site").alias("facility_id"), text("person").alias("patient_key"),
        c("admit").alias("admit_date"), c("discharge").alias("discharge_date"), F.date_diff("discharge", "admit").alias("length_of_stay_days"), kind.alias("encounter_type"), (c("person") % 10).cast("string").alias("primary_dx_code"),
        text("site").alias("provider_sk"), (c("cents").cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)").alias("billed_amount_usd"), c("status").alias("claim_status"), *[v.alias(n) for n, v in blank.items()],
    )
    issues = e.filter("enc % 23 = 0").select(text("enc").alias("version_key"), F.lit("ERROR").alias("severity"))
    nation = views.table(spark, d, "nation")
    facilities = nation.select(text("n_nationkey").alias("facility_id"), c("n_name").alias("facility_name"), F.lit("t").alias("facility_type"))
    codes = spark.range(10).select(text("id").alias("icd10_code"), F.concat(F.lit("about "), text("id")).alias("description"), F.lit("c").alias("category"), (c("id") < 4).alias("is_chronic"), (c("id") != 2).alias("in_reference"))
    doctors = nation.filter("n_nationkey % 5 <> 0").select(text("n_nationkey").alias("sk"), F.concat(F.lit("x"), text("n_nationkey")).alias("specialty"), F.lit("e").alias("employment_status"))
    cohort = facts.chronic_acute_cohort(current, issues, facilities, codes, doctors, 1997, "1000.00")
    return cohort.select("encounter_key", "facility_name", "dx_description", "attending_specialty_at_encounter", "billed_amount_usd", "readmit_30d_flag")


# --- dimensions ---------------------------------------------------------------------

SCD2_SQL = f"""WITH {ROSTER_SQL}, n AS (SELECT *, dense_rank() OVER (ORDER BY as_of_date) - 1 AS i FROM roster),
g AS (SELECT *, CASE WHEN lag(i) OVER w = i - 1 AND lag(specialty) OVER w = specialty AND lag(facility) OVER w = facility THEN 0 ELSE 1 END AS chg FROM n WINDOW w AS (PARTITION BY npi ORDER BY i)),
r AS (SELECT *, sum(chg) OVER (PARTITION BY npi ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM g),
s AS (SELECT npi, run, min(i) AS i0, max(i) + 1 AS i1, arg_min(specialty, i) AS specialty, arg_min(facility, i) AS facility, min(as_of_date) AS started FROM r GROUP BY npi, run),
e AS (SELECT DISTINCT i, as_of_date FROM n),
dim AS (SELECT s.npi, s.specialty, s.facility, CASE WHEN i0 = 0 THEN DATE '0001-01-01' ELSE started END AS valid_from, coalesce(e.as_of_date, DATE '9999-12-31') AS valid_to, e.as_of_date IS NULL AS is_current, started AS snapshot_as_of_date
  FROM s LEFT JOIN e ON e.i = s.i1),
keyed AS (SELECT sha256('["provider/v1","' || npi || '","' || strftime(valid_from, '%Y-%m-%d') || '"]') AS sk, * FROM dim)"""


def _dim(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.scd2(views.roster(spark, d), "npi", "as_of_date", ["specialty", "facility"])


@query("scd2_dim", SCD2_SQL.replace("strftime(valid_from, '%Y-%m-%d')", "CAST(valid_from AS VARCHAR)") + " SELECT * FROM keyed")
def _(spark, d):
    return _dim(spark, d)


POINT_SQL = SCD2_SQL.replace("strftime(valid_from, '%Y-%m-%d')", "CAST(valid_from AS VARCHAR)") + (
    ", f AS (SELECT o_orderkey AS enc, CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE CAST(o_custkey + CASE WHEN o_orderkey % 31 = 0 THEN 100000000 ELSE 0 END AS VARCHAR) END AS npi, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS admit FROM orders)"
)


def _point(spark: SparkSession, d: str) -> DataFrame:
    o, k = views.table(spark, d, "orders"), F.col("o_orderkey")
    npi = F.when(k % 29 != 0, (F.col("o_custkey") + F.when(k % 31 == 0, 100000000).otherwise(0)).cast("string"))
    rows = o.select(k.alias("enc"), npi.alias("npi"), F.when(k % 13 != 0, F.col("o_orderdate").cast("date")).alias("admit"))
    return dimensions.point_in_time(rows, _dim(spark, d), "npi", "admit")


@query(
    "point_in_time_join",
    POINT_SQL
    + """ SELECT f.enc, k.sk, CASE WHEN k.sk IS NOT NULL THEN NULL WHEN f.npi IS NULL THEN 'NPI_MISSING' WHEN NOT EXISTS (SELECT 1 FROM keyed x WHERE x.npi = f.npi) THEN 'NPI_NOT_IN_ROSTER' WHEN f.admit IS NULL THEN 'PROVIDER_ADMIT_DATE_UNKNOWN' ELSE 'PROVIDER_NOT_ON_ROSTER_AT_ADMIT' END AS sk_reason
FROM f LEFT JOIN keyed k ON k.npi = f.npi AND k.valid_from <= f.admit AND f.admit < k.valid_to""",
)
def _(spark, d):
    return _point(spark, d).select("enc", "sk", "sk_reason")


@query("provider_at_encounter", POINT_SQL + " SELECT f.enc, k.specialty, k.facility, k.valid_from FROM f LEFT JOIN keyed k ON k.npi = f.npi AND k.valid_from <= f.admit AND f.admit < k.valid_to")
def _(spark, d):
    return _point(spark, d).join(_dim(spark, d).select("sk", "specialty", "facility", "valid_from"), "sk", "left").select("enc", "specialty", "facility", "valid_from")


@query(
    "calendar_dim",
    f"""WITH {ENCOUNTERS_SQL}, s AS (SELECT min(d) AS a, max(d) AS b FROM (SELECT admit AS d FROM encounters UNION ALL SELECT discharge FROM encounters)),
c AS (SELECT CAST(unnest(generate_series(date_trunc('year', a), date_trunc('year', b) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date_key FROM s)
SELECT date_key, CAST(year(date_key) AS INTEGER) AS year, CAST(quarter(date_key) AS INTEGER) AS quarter, CAST(month(date_key) AS INTEGER) AS month, monthname(date_key) AS month_name, strftime(date_key, '%Y-%m') AS year_month, CAST(day(date_key) AS INTEGER) AS day_of_month,
  CAST(isodow(date_key) AS INTEGER) AS iso_day_of_week, dayname(date_key) AS day_name, isodow(date_key) >= 6 AS is_weekend FROM c""",
)
def _(spark, d):
    return dimensions.calendar_dim(views.encounters(spark, d), "admit", "discharge")


@query("reference_and_observed", "SELECT p_partkey AS code, p_name AS description, true AS in_reference FROM part WHERE p_partkey % 3 <> 0 UNION ALL SELECT DISTINCT l_partkey, CAST(NULL AS VARCHAR), false FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 3 <> 0)")
def _(spark, d):
    known = views.table(spark, d, "part").filter("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("code"), F.col("p_name").alias("description"))
    return dimensions.reference_and_observed(known, views.table(spark, d, "lineitem").select(F.col("l_partkey").alias("code")), "code").select("code", "description", "in_reference")


# --- people ----------------------------------------------------------------------------

PEOPLE_SQL = """
p AS (SELECT 'S' || CAST(o_orderkey % 2 AS VARCHAR) AS src, CASE WHEN o_orderkey % 37 = 0 THEN '  ' ELSE ' ' || CAST(o_custkey AS VARCHAR) END AS mrn, CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS last_name,
  CASE WHEN o_custkey % 3 = 0 AND o_orderkey % 4 = 0 THEN 'B' ELSE 'A' END AS first_name, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE DATE '1950-01-01' + CAST(o_custkey % 9000 AS INTEGER) END AS born, o_orderkey AS k, CAST(o_orderdate AS DATE) AS seen,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'z' || CAST(o_orderkey % 2 AS VARCHAR) END AS zip FROM orders JOIN customer ON o_custkey = c_custkey),
i AS (SELECT src, trim(mrn) AS local_id, count(DISTINCT (last_name, first_name, born)) FILTER (WHERE last_name IS NOT NULL AND born IS NOT NULL) AS n, min(last_name) AS last_name, min(first_name) AS first_name, min(born) AS born FROM p GROUP BY ALL)"""


def _people(spark: SparkSession, d: str) -> DataFrame:
    o = views.table(spark, d, "orders").join(views.table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        F.concat(F.lit("S"), (k % 2).cast("string")).alias("src"), F.when(k % 37 == 0, "  ").otherwise(F.concat(F.lit(" "), c.cast("string"))).alias("mrn"), F.when(c % 5 != 0, F.col("c_mktsegment")).alias("last_name"),
        F.when((c % 3 == 0) & (k % 4 == 0), "B").otherwise("A").alias("first_name"), F.when(c % 7 != 0, F.date_add(F.to_date(F.lit("1950-01-01")), (c % 9000).cast("int"))).alias("born"), k.alias("k"),
        F.col("o_orderdate").cast("date").alias("seen"), F.when(k % 3 != 0, F.concat(F.lit("z"), (k % 2).cast("string"))).alias("zip"),
    )


@query(
    "link_identities",
    f"""WITH {PEOPLE_SQL} SELECT src, local_id, CASE WHEN local_id <> '' AND n = 1 THEN 'LINKED' ELSE 'UNLINKED' END AS link_status,
  CASE WHEN local_id = '' THEN 'PATIENT_MRN_MISSING' WHEN n = 1 THEN NULL WHEN n > 1 THEN 'PATIENT_UNLINKED_CONFLICT' WHEN born IS NOT NULL THEN 'PATIENT_UNLINKED_INCOMPLETE' ELSE 'PATIENT_UNLINKED_NO_DOB' END AS link_reason,
  sha256(CASE WHEN local_id = '' THEN NULL WHEN n = 1 THEN '["patient/v1","LINKED","' || last_name || '","' || first_name || '","' || CAST(born AS VARCHAR) || '"]' ELSE '["patient/v1","UNLINKED","' || src || '","' || local_id || '"]' END) AS digest FROM i""",
)
def _(spark, d):
    found = identity.link_identities(_people(spark, d), "src", "mrn", ["last_name", "first_name", "born"], F.col("born").isNotNull())
    return found.select("src", "local_id", "link_status", "link_reason", F.sha2(F.to_json("key_parts"), 256).alias("digest"))


@query("latest_attributes", f"WITH {PEOPLE_SQL}, q AS (SELECT * FROM p WHERE trim(mrn) <> '') SELECT mrn, arg_max(coalesce(zip, '-'), (seen, k)) AS zip, max(seen) AS seen, count(DISTINCT coalesce(zip, '-')) > 1 AS attributes_vary FROM q GROUP BY mrn")
def _(spark, d):
    rows = _people(spark, d).filter("trim(mrn) <> ''")
    return identity.latest_attributes(rows, "mrn", ["seen", "k"], ["zip"], ["zip"]).select("mrn", F.coalesce("zip", F.lit("-")).alias("zip"), "seen", "attributes_vary")


@query("entity_keys", f"WITH {DELIVERY_SQL} SELECT row_no, sha256('[\"encounter/v1\",\"' || file_name || '\",\"' || CAST(rec AS VARCHAR) || '\"]') AS record_key, sha256('[\"version/v1\",\"' || file_name || '\",\"' || CAST(rec AS VARCHAR) || '\",\"' || CAST(v AS VARCHAR) || 'T00:00:00.000000Z\"]') AS version_key FROM delivery WHERE rec IS NOT NULL AND v IS NOT NULL")
def _(spark, d):
    rows = views.delivery(spark, d).filter("rec IS NOT NULL AND v IS NOT NULL")
    return rows.select("row_no", keys.record_key("encounter/v1", F.col("file_name"), F.col("rec")).alias("record_key"), keys.version_key("version/v1", F.col("file_name"), F.col("rec"), F.col("v").cast("timestamp_ntz")).alias("version_key"))


# --- cleaning -------------------------------------------------------------------------------


def _cleaned(column: Callable[[], F.Column]) -> Query:
    return lambda spark, d: views.texts(spark, d).withColumn("c", column()).select("k", "c.value", "c.reason", "c.warning")


def _stepwise(clean_field: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: clean_field(views.texts(spark, d)).select("k", "c.value", "c.reason", "c.warning")


QUERIES["clean_amount"] = _stepwise(lambda t: clean.clean_amount(t, "c", F.col("amount"), F.col("unit")))
# written from how ``texts`` spells an amount, by the order's number; every fourth order is in cents
SQL["clean_amount"] = f"""WITH {TEXTS_SQL}, v AS (SELECT k, CASE k % 12 WHEN 0 THEN k % 1000 + 0.50 WHEN 1 THEN k WHEN 2 THEN (k % 90 + 1) * 1000 + k % 1000 + 0.25 WHEN 3 THEN k * 0.01 WHEN 4 THEN (k % 50) * 1000 + 500 END AS y,
  CASE k % 12 WHEN 5 THEN 'AMOUNT_PLACEHOLDER' WHEN 6 THEN 'AMOUNT_SPREADSHEET_ERROR' WHEN 7 THEN 'AMOUNT_FRACTIONAL_CENTS' WHEN 8 THEN 'AMOUNT_FRACTIONAL_CENTS' WHEN 9 THEN 'AMOUNT_UNPARSEABLE' WHEN 10 THEN 'AMOUNT_MISSING' WHEN 11 THEN 'AMOUNT_K_SUFFIX_NOT_ALLOWED' END AS reason FROM texts)
SELECT k, CAST(y AS DECIMAL(18, 2)) AS value, reason, CAST(NULL AS VARCHAR) AS warning FROM v"""

QUERIES["clean_date"] = _stepwise(lambda t: clean.clean_date(t, "c", F.col("day"), F.col("ord"), F.col("century"), F.to_date(F.lit("2000-06-30"))))
SQL["clean_date"] = f"""WITH {TEXTS_SQL}, t AS (SELECT *, regexp_extract(day, '^([0-9]+)[/-]([0-9]+)[/-]([0-9]+)$', ['a', 'b', 'y']) AS g, k % 10 AS r FROM texts),
v AS (SELECT *, CASE WHEN r IN (0, 8) THEN TRY_CAST(left(day, 10) AS DATE) WHEN r IN (1, 2, 3) THEN TRY_CAST(lpad(CAST(TRY_CAST(g.y AS INTEGER) + CASE WHEN length(g.y) = 2 THEN century ELSE 0 END AS VARCHAR), 4, '0') || '-' || CASE WHEN ord = 'MDY' THEN g.a || '-' || g.b ELSE g.b || '-' || g.a END AS DATE)
  WHEN r = 4 THEN CAST(strptime(day, '%b %d, %Y') AS DATE) WHEN r = 5 THEN CAST(strptime(day, '%d %B %Y') AS DATE) END AS x FROM t),
w AS (SELECT *, CASE WHEN day = '' THEN 'DATE_MISSING' WHEN r = 7 THEN 'DATE_PLACEHOLDER' WHEN r = 3 AND century IS NULL THEN 'DATE_CENTURY_UNKNOWN' WHEN x IS NULL THEN 'DATE_INVALID' WHEN x > DATE '2000-06-30' THEN 'DATE_AFTER_DELIVERY' END AS reason FROM v)
SELECT k, CASE WHEN reason IS NULL THEN x END AS value, reason, CAST(NULL AS VARCHAR) AS warning FROM w"""

QUERIES["clean_timestamp"] = _stepwise(lambda t: clean.clean_timestamp(t, "c", F.col("moment"), "UTC", F.col("ord")))
SQL["clean_timestamp"] = f"""WITH {TEXTS_SQL} SELECT k, CASE k % 6 WHEN 0 THEN CAST(left(moment, 19) AS TIMESTAMP) WHEN 1 THEN CAST(left(moment, 19) AS TIMESTAMP) - INTERVAL 330 MINUTE END AS value,
  CASE WHEN k % 6 IN (2, 3) THEN 'TIMESTAMP_INVALID' WHEN k % 6 = 4 THEN 'TIMESTAMP_UNPARSEABLE' WHEN k % 6 = 5 THEN 'TIMESTAMP_PLACEHOLDER' END AS reason, CAST(NULL AS VARCHAR) AS warning FROM texts"""

QUERIES["clean_encounter_type"] = _stepwise(lambda t: clean.clean_encounter_type(t, "c", F.col("kind")))
SQL["clean_encounter_type"] = f"WITH {TEXTS_SQL} SELECT k, CASE WHEN trim(kind) = '' THEN 'UNKNOWN' ELSE CASE regexp_replace(regexp_replace(upper(trim(kind)), ' +', ' ', 'g'), ' ?- ?', '-', 'g') WHEN 'IN-PATIENT' THEN 'INPATIENT' WHEN 'EMERGENCY ROOM' THEN 'EMERGENCY' WHEN 'WALK-IN URGENT' THEN 'URGENT_CARE' WHEN 'VIRTUAL' THEN 'TELEHEALTH' END END AS value, CASE WHEN kind = 'helicopter' THEN 'ENCOUNTER_TYPE_UNMAPPED' END AS reason, CASE WHEN trim(kind) = '' THEN 'ENCOUNTER_TYPE_MISSING' END AS warning FROM texts"

QUERIES["clean_claim_status"] = _stepwise(lambda t: clean.clean_claim_status(t, "c", F.col("claim")))
SQL["clean_claim_status"] = f"WITH {TEXTS_SQL} SELECT k, CASE regexp_replace(regexp_replace(upper(trim(claim)), ' +', ' ', 'g'), ' ?- ?', '-', 'g') WHEN 'CLOSED-PAID' THEN 'PAID' WHEN 'IN PROCESS' THEN 'SUBMITTED' WHEN 'VOIDED' THEN 'VOID' WHEN 'DENIED' THEN 'DENIED' END AS value, CASE WHEN trim(claim) = '' THEN 'CLAIM_STATUS_MISSING' WHEN claim = 'lost' THEN 'CLAIM_STATUS_UNMAPPED' END AS reason, CAST(NULL AS VARCHAR) AS warning FROM texts"

QUERIES["clean_payer_category"] = _stepwise(lambda t: clean.clean_payer_category(t, "c", F.col("payer")))
SQL["clean_payer_category"] = f"WITH {TEXTS_SQL} SELECT k, CASE WHEN payer = '' THEN 'UNKNOWN' ELSE CASE regexp_replace(regexp_replace(upper(trim(payer)), ' +', ' ', 'g'), ' ?- ?', '-', 'g') WHEN 'MEDICARE-PART B' THEN 'MEDICARE' WHEN 'N/A' THEN 'UNKNOWN' WHEN 'SELF PAY' THEN 'SELF_PAY' WHEN 'BCBS' THEN 'COMMERCIAL' END END AS value, CASE WHEN payer = 'barter' THEN 'PAYER_UNMAPPED' END AS reason, CASE WHEN payer = '' THEN 'PAYER_MISSING' END AS warning FROM texts"

QUERIES["clean_icd10"] = _cleaned(lambda: clean.clean_icd10(F.col("dx"), clean.icd10_code(F.col("dx")).isin("E11.9")))
SQL["clean_icd10"] = f"WITH {TEXTS_SQL} SELECT k, CASE WHEN dx IN ('e119', 'E11.9 - diabetes') THEN 'E11.9' WHEN dx = 'I10' THEN dx END AS value, CASE dx WHEN '250.00' THEN 'DX_ICD9' WHEN 'TBD' THEN 'DX_PLACEHOLDER' WHEN 'zz' THEN 'DX_UNPARSEABLE' END AS reason, CASE WHEN dx = 'I10' THEN 'DX_NOT_IN_REFERENCE' END AS warning FROM texts"

QUERIES["clean_npi"] = _cleaned(lambda: clean.clean_npi(F.col("npi")))
SQL["clean_npi"] = f"""WITH {TEXTS_SQL}, t AS (SELECT k, npi, regexp_replace(npi, '\\.0$', '') AS n FROM texts),
l AS (SELECT *, CASE WHEN regexp_full_match(n, '[0-9]{{10}}') THEN list_sum(list_transform(generate_series(1, 15), lambda i: CASE WHEN i % 2 = 1 THEN CAST(('80840' || n)[i] AS INTEGER) ELSE CASE WHEN CAST(('80840' || n)[i] AS INTEGER) > 4 THEN 2 * CAST(('80840' || n)[i] AS INTEGER) - 9 ELSE 2 * CAST(('80840' || n)[i] AS INTEGER) END END)) END AS total FROM t),
r AS (SELECT *, CASE WHEN npi = '' THEN 'NPI_MISSING' WHEN npi = 'N/A' THEN 'NPI_PLACEHOLDER' WHEN total IS NULL THEN 'NPI_INVALID_FORMAT' WHEN total % 10 <> 0 THEN 'NPI_CHECKSUM_FAILED' END AS reason FROM l)
SELECT k, CASE WHEN reason IS NULL THEN n END AS value, reason, CAST(NULL AS VARCHAR) AS warning FROM r"""

QUERIES["clean_sex"] = _cleaned(lambda: clean.clean_sex(F.col("sex")))
SQL["clean_sex"] = f"WITH {TEXTS_SQL} SELECT k, CASE WHEN upper(trim(sex)) IN ('F', 'FEMALE') THEN 'F' WHEN upper(trim(sex)) IN ('M', 'MALE') THEN 'M' ELSE 'UNKNOWN' END AS value, CAST(NULL AS VARCHAR) AS reason, CASE WHEN sex = '' THEN 'SEX_MISSING' WHEN sex = 'X' THEN 'SEX_UNMAPPED' END AS warning FROM texts"

QUERIES["zip3"] = _cleaned(lambda: clean.zip3(F.col("zip")))
SQL["zip3"] = f"WITH {TEXTS_SQL} SELECT k, CASE WHEN regexp_full_match(zip, '[0-9]{{5}}(-[0-9]{{4}})?') THEN left(zip, 3) END AS value, CASE WHEN zip = '' THEN 'ZIP_MISSING' WHEN NOT regexp_full_match(zip, '[0-9]{{5}}(-[0-9]{{4}})?') THEN 'ZIP_INVALID' END AS reason, CAST(NULL AS VARCHAR) AS warning FROM texts"

QUERIES["age_band"] = _cleaned(lambda: clean.age_band(F.col("born"), F.col("admit")))
SQL["age_band"] = f"""WITH {TEXTS_SQL}, a AS (SELECT k, CASE WHEN born IS NULL THEN 'AGE_BAND_DOB_UNAVAILABLE' WHEN born > admit THEN 'AGE_BAND_DOB_AFTER_ADMIT' END AS warning, year(admit) - year(born) - CASE WHEN month(admit) * 100 + day(admit) < month(born) * 100 + day(born) THEN 1 ELSE 0 END AS age FROM texts)
SELECT k, CASE WHEN warning IS NOT NULL THEN 'UNKNOWN' WHEN age <= 17 THEN '0-17' WHEN age <= 39 THEN '18-39' WHEN age <= 64 THEN '40-64' ELSE '65+' END AS value, CAST(NULL AS VARCHAR) AS reason, warning FROM a"""


@query("discharge_before_admit", f"WITH {TEXTS_SQL} SELECT k, CASE WHEN discharge < admit THEN 'DISCHARGE_BEFORE_ADMIT' END AS flag, CAST(year(admit) AS INTEGER) AS year, CAST(quarter(admit) AS INTEGER) AS quarter, CAST(month(admit) AS INTEGER) AS month FROM texts")
def _(spark, d):
    return views.texts(spark, d).select("k", clean.discharge_before_admit(F.col("admit"), F.col("discharge")).alias("flag"), *clean.admit_period(F.col("admit")))


@query("resolve_names", "WITH s AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN '  ' || lower(n_name) WHEN 1 THEN n_name WHEN 2 THEN '' ELSE n_name || '?' END AS given, n_nationkey FROM supplier JOIN nation ON s_nationkey = n_nationkey) SELECT s_suppkey, CASE WHEN s_suppkey % 4 < 2 THEN CAST(n_nationkey AS VARCHAR) END AS facility_id, CASE s_suppkey % 4 WHEN 2 THEN 'FACILITY_MISSING' WHEN 3 THEN 'FACILITY_UNRESOLVED' END AS facility_id_reason FROM s")
def _(spark, d):
    from ..sources.reference import resolve_facility

    nation = views.table(spark, d, "nation")
    s = views.table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    r = F.col("s_suppkey") % 4
    given = F.when(r == 0, F.concat(F.lit("  "), F.lower("n_name"))).when(r == 1, F.col("n_name")).when(r == 2, "").otherwise(F.concat("n_name", F.lit("?")))
    rows = s.select("s_suppkey", given.alias("given"), F.lit("S").alias("source"))
    index = nation.select(F.lit("S").alias("source_system"), normalise_key(F.col("n_name")).alias("name_key"), F.col("n_nationkey").cast("string").alias("facility_id"))
    return resolve_facility(rows, index, "given", "source").select("s_suppkey", "facility_id", "facility_id_reason")


@query("roster_flag", "SELECT DISTINCT o_custkey AS npi, CASE WHEN o_custkey % 11 <> 0 THEN NULL ELSE 'NPI_NOT_IN_ROSTER' END AS flag FROM orders")
def _(spark, d):
    listed = views.table(spark, d, "customer").filter("c_custkey % 11 <> 0").select(F.col("c_custkey").alias("npi"), F.lit(True).alias("in_roster"))
    rows = views.table(spark, d, "orders").select(F.col("o_custkey").alias("npi")).distinct().join(listed, "npi", "left")
    return rows.select("npi", clean.flag_not_in_roster(F.col("npi"), F.col("in_roster")).alias("flag"))


# --- quality ------------------------------------------------------------------------------------

REASONS_SQL = f"""{ENCOUNTERS_SQL},
reasons AS (SELECT enc, 'admit_date_reason' AS source, 'DATE_MISSING' AS reason_code FROM encounters WHERE admit IS NULL UNION ALL SELECT enc, 'discharge_date_reason', 'DATE_MISSING' FROM encounters WHERE discharge IS NULL
  UNION ALL SELECT enc, 'discharge_date_warning', 'DISCHARGE_BEFORE_ADMIT' FROM encounters WHERE discharge < admit UNION ALL SELECT enc, 'claim_status_reason', 'CLAIM_STATUS_MISSING' FROM encounters WHERE status IS NULL
  UNION ALL SELECT enc, 'billed_amount_usd_reason', 'AMOUNT_MISSING' FROM encounters WHERE cents IS NULL),
issues AS (SELECT enc, reason_code, CASE source WHEN 'admit_date_reason' THEN 'ADMIT_DATE_VALID' WHEN 'discharge_date_reason' THEN 'DISCHARGE_DATE_VALID' WHEN 'discharge_date_warning' THEN 'DISCHARGE_NOT_BEFORE_ADMIT' WHEN 'claim_status_reason' THEN 'CLAIM_STATUS_MAPPED' ELSE 'BILLED_AMOUNT_VALID' END AS check_code,
  CASE WHEN source = 'admit_date_reason' THEN 'ERROR' ELSE 'WARNING' END AS severity FROM reasons)"""


def _reasons(spark: SparkSession, d: str) -> DataFrame:
    e = views.encounters(spark, d)
    stay = clean.length_of_stay(F.col("admit"), F.col("discharge"))["reason"]
    return e.select(
        "enc", "site", "admit", "discharge", "status", "cents", F.when(F.col("admit").isNull(), "DATE_MISSING").alias("admit_date_reason"), F.when(F.col("discharge").isNull(), "DATE_MISSING").alias("discharge_date_reason"),
        clean.discharge_before_admit(F.col("admit"), F.col("discharge")).alias("discharge_date_warning"), F.when(F.col("status").isNull(), "CLAIM_STATUS_MISSING").alias("claim_status_reason"),
        F.when(F.col("cents").isNull(), "AMOUNT_MISSING").alias("billed_amount_usd_reason"), stay.alias("length_of_stay_days_reason"),
    )


SOURCES = ["admit_date_reason", "discharge_date_reason", "discharge_date_warning", "claim_status_reason", "billed_amount_usd_reason", "length_of_stay_days_reason"]


@query("version_issues_long", f"WITH {REASONS_SQL} SELECT enc, check_code, reason_code, severity FROM issues")
def _(spark, d):
    return quality.version_issues(_reasons(spark, d), ["enc"], SOURCES).select("enc", "check_code", "reason_code", "severity")


@query("worst_severity_partition", f"WITH {REASONS_SQL}, w AS (SELECT enc, max(CASE severity WHEN 'ERROR' THEN 2 ELSE 1 END) AS r FROM issues GROUP BY enc) SELECT e.enc, CASE WHEN r IS NULL THEN 'PASS' WHEN r = 1 THEN 'WARNING' ELSE 'ERROR' END AS worst FROM encounters e LEFT JOIN w USING (enc)")
def _(spark, d):
    rows = _reasons(spark, d)
    return quality.worst_severity(rows, quality.version_issues(rows, ["enc"], SOURCES), "enc")


@query("issue_counts", f"WITH {REASONS_SQL} SELECT check_code, count(*) AS n, string_agg(DISTINCT reason_code, '|' ORDER BY reason_code) AS reason_codes FROM issues GROUP BY check_code")
def _(spark, d):
    return quality.version_issues(_reasons(spark, d), ["enc"], SOURCES).groupBy("check_code").agg(F.count(F.lit(1)).alias("n"), clean.join_codes(F.col("reason_code")).alias("reason_codes"))


GATE_SQL = f"""WITH {CLASSIFIED_SQL}, bad AS (SELECT DISTINCT rec, v FROM versions WHERE row_no % 41 = 0),
gate AS (SELECT batch_no, file_name, row_no, CASE outcome_reason WHEN 'SOURCE_RECORD_ID_MISSING' THEN 'SOURCE_RECORD_ID_PRESENT' WHEN 'TIMESTAMP_MISSING' THEN 'LAST_UPDATED_TS_VALID' ELSE 'VERSION_CONFLICT_SAME_TS' END AS check_code, outcome_reason AS reason_code FROM classified WHERE outcome = 'QUARANTINED'
  UNION ALL SELECT c.batch_no, c.file_name, c.row_no, 'ADMIT_DATE_VALID', 'DATE_INVALID' FROM classified c JOIN bad b ON b.rec = c.rec AND b.v = c.v WHERE c.outcome <> 'QUARANTINED')"""


def _gate(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = _classified(spark, d).withColumn("version", F.when(F.col("rec").isNotNull() & F.col("v").isNotNull(), F.concat_ws(":", "rec", "v")))
    fields = c.filter("is_first_seen").select("version", F.when(F.col("row_no") % 41 == 0, "DATE_INVALID").alias("admit_date_reason"))
    return c, quality.gate_issues(c, fields, "version", ["batch_no", "file_name", "row_no"], ["admit_date_reason"])


@query("gate_issues", GATE_SQL + " SELECT * FROM gate")
def _(spark, d):
    return _gate(spark, d)[1]


@query("publish_gate", GATE_SQL + ", r AS (SELECT batch_no, count(*) AS received_rows FROM classified GROUP BY 1), e AS (SELECT batch_no, count(DISTINCT (file_name, row_no)) AS error_rows FROM gate GROUP BY 1) SELECT r.batch_no, received_rows, error_rows, CAST(5.00 AS DECIMAL(7, 2)) AS threshold_pct, CAST(round_even(CAST(error_rows AS DECIMAL(20, 0)) * 100 / received_rows, 2) AS DECIMAL(7, 2)) AS error_pct, error_rows * 100 > received_rows * 5 AS failed FROM r JOIN e USING (batch_no)")
def _(spark, d):
    outcomes, issues = _gate(spark, d)
    return quality.publish_gate(outcomes, issues, "batch_no", ["file_name", "row_no"], Decimal("0.05"))


@query("observed_pct", f"WITH {CLASSIFIED_SQL} SELECT batch_no, CAST(round_even(CAST(count(*) FILTER (WHERE outcome = 'DUPLICATE') AS DECIMAL(20, 0)) * 100 / count(*), 2) AS DECIMAL(7, 2)) AS pct FROM classified GROUP BY batch_no")
def _(spark, d):
    return _classified(spark, d).groupBy("batch_no").agg(clean.observed_pct(F.count_if(F.col("outcome") == "DUPLICATE"), F.count(F.lit(1))).alias("pct"))


@query(
    "quarantine_union",
    f"""WITH {CLASSIFIED_SQL}, f AS (SELECT 'batch_' || CAST(batch_no AS VARCHAR) AS batch_id, file_name, count(*) AS n FROM delivery WHERE batch_no = 2 GROUP BY ALL)
SELECT batch_id, file_name, CAST(NULL AS INTEGER) AS source_row_number, 'FILE' AS quarantine_level, CASE WHEN file_name = 'f0' THEN 'PUBLISH_GATE' ELSE 'BATCH_VALIDATION' END AS quarantine_source, CASE WHEN file_name = 'f0' THEN 'DQ_GATE_FAILED' ELSE 'ROW_COUNT_MISMATCH|SHA256_MISMATCH' END AS reason_codes, CAST(n AS INTEGER) AS row_count, CAST(NULL AS BOOLEAN) AS is_current_version FROM f
UNION ALL SELECT 'batch_' || CAST(batch_no AS VARCHAR), file_name, CAST(row_no AS INTEGER), 'ROW', 'HISTORY_ORDERING', outcome_reason, 1, NULL FROM classified WHERE outcome = 'QUARANTINED' AND batch_no < 2
UNION ALL SELECT 'batch_' || CAST(batch_no AS VARCHAR), file_name, CAST(row_no AS INTEGER), 'VERSION', 'VERSION_DQ', 'DATE_INVALID', 1, is_current FROM (SELECT *, v = max(v) OVER (PARTITION BY rec) AS is_current FROM versions) WHERE row_no % 41 = 0 AND batch_no < 2""",
)
def _(spark, d):
    named = F.concat(F.lit("batch_"), F.col("batch_no").cast("string")).alias("batch_id")
    c = _classified(spark, d).withColumn("version_key", F.concat_ws(":", "rec", "v"))
    system = F.lit("S").alias("source_system")
    rec = F.col("rec").cast("string")
    files = c.filter("batch_no = 2").groupBy("batch_no", "file_name").agg(F.count(F.lit(1)).alias("received_count"))
    reason = F.when(F.col("file_name") == "f0", "DQ_GATE_FAILED").otherwise("SHA256_MISMATCH; ROW_COUNT_MISMATCH(expected=1,received=2)")
    audit = files.select(named, "file_name", system, "received_count", F.lit("REJECTED").alias("status"), reason.alias("reason"))
    rows = c.filter("batch_no < 2").select(named, "file_name", F.col("row_no").alias("source_row_number"), system, rec.alias("source_record_id"), rec.alias("encounter_key"), "version_key", "outcome", "outcome_reason")
    versions = history.new_versions(c)
    issues = versions.filter("batch_no < 2 AND row_no % 41 = 0").select(named, "file_name", F.col("row_no").alias("source_row_number"), system, rec.alias("source_record_id"), rec.alias("encounter_key"), "version_key", F.lit("DATE_INVALID").alias("reason_code"), F.lit("ERROR").alias("severity"))
    current = history.current_state(versions, ["rec"], "v", LINEAGE, "batch_no")
    none = rows.limit(0).withColumn("reason_code", F.lit(""))
    return quality.quarantine(audit, none, rows, issues, current).select("batch_id", "file_name", "source_row_number", "quarantine_level", "quarantine_source", "reason_codes", "row_count", "is_current_version")


@query(
    "dq_report",
    f"""WITH {CLASSIFIED_SQL}, {'c AS (' + COUNTS_SQL + ')'}
SELECT 'batch_' || CAST(batch_no AS VARCHAR) AS batch_id, file_name, 'DUPLICATE_ROW' AS check_code, received AS evaluated_count, duplicate AS observed_count, CAST(NULL AS BIGINT) AS expected_count, 'PASS' AS status FROM c
UNION ALL SELECT 'batch_' || CAST(batch_no AS VARCHAR), file_name, 'RECON_RAW_ROWS', received, received, received, 'PASS' FROM c
UNION ALL SELECT 'batch_' || CAST(batch_no AS VARCHAR), file_name, 'VERSION_CONFLICT_SAME_TS', received, quarantined, NULL, CASE WHEN quarantined = 0 THEN 'PASS' ELSE 'FAIL' END FROM c
UNION ALL SELECT 'batch_' || CAST(batch_no AS VARCHAR), file_name, 'STALE_REPLAY_CONFLICT', received, stale, NULL, CASE WHEN stale = 0 THEN 'PASS' ELSE 'WARN' END FROM c
UNION ALL SELECT 'batch_' || CAST(batch_no AS VARCHAR), file_name, 'RECON_HISTORY_ROWS', history_rows, history_rows, new_encounter + new_version, CASE WHEN stale_new_version = 0 THEN 'PASS' ELSE 'FAIL' END FROM c
UNION ALL SELECT 'batch_' || CAST(batch_no AS VARCHAR), file_name, 'ZIP3_VALID', NULL, NULL, NULL, 'NOT_EVALUATED' FROM c""",
)
def _(spark, d):
    counts = history.outcome_counts(_classified(spark, d), ["batch_no", "file_name"], ["rec"]).withColumn("batch_id", F.concat(F.lit("batch_"), F.col("batch_no").cast("string")))
    files = counts.select("batch_id", "file_name", F.lit("S").alias("source_system"), F.lit("ACCEPTED").alias("batch_status"))
    null = F.lit(None).cast("bigint")
    made = {
        "DUPLICATE_ROW": ("received", "duplicate", null), "RECON_RAW_ROWS": ("received", "received", F.col("received")), "VERSION_CONFLICT_SAME_TS": ("received", "quarantined", null),
        "STALE_REPLAY_CONFLICT": ("received", "stale", null), "RECON_HISTORY_ROWS": ("history_rows", "history_rows", F.col("new_encounter") + F.col("new_version")),
    }
    structs = F.array(*[F.struct(F.lit(c).alias("check_code"), F.col(a).alias("evaluated"), F.col(b).alias("observed"), x.alias("expected")) for c, (a, b, x) in made.items()])
    measured = counts.select("batch_id", "file_name", F.explode(structs).alias("m")).select("batch_id", "file_name", "m.*", F.lit(None).cast("string").alias("reason_codes"), F.lit(False).alias("not_evaluated"))
    out = quality.report(files, measured).filter(F.col("check_code").isin(*made, "ZIP3_VALID"))
    return out.select("batch_id", "file_name", "check_code", "evaluated_count", "observed_count", "expected_count", "status")


@query("schema_version_change", "SELECT * FROM (SELECT event_type AS source, CAST(ts AS DATE) AS day, CAST(count(*) % 3 AS INTEGER) AS version, lag(CAST(count(*) % 3 AS INTEGER)) OVER (PARTITION BY event_type ORDER BY CAST(ts AS DATE)) AS previous_version FROM events GROUP BY 1, 2) WHERE previous_version IS NOT NULL AND previous_version <> version")
def _(spark, d):
    daily = views.table(spark, d, "events").groupBy(F.col("event_type").alias("source"), F.col("ts").cast("date").alias("day")).agg((F.count(F.lit(1)) % 3).cast("int").alias("version"))
    return quality.schema_version_changes(daily, "source", "day", "version")


@query("fk_orphans", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 7 <> 0)")
def _(spark, d):
    return quality.orphans(views.table(spark, d, "lineitem"), "l_partkey", views.table(spark, d, "part").filter("p_partkey % 7 <> 0"), "p_partkey").select("l_orderkey", "l_linenumber", "l_partkey")


@query("duplicate_keys", "SELECT l_partkey, l_suppkey, count(*) AS count FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _(spark, d):
    return quality.duplicate_rows(views.table(spark, d, "lineitem"), ["l_partkey", "l_suppkey"])


@query("value_reason_consistency", f"WITH {ENCOUNTERS_SQL} SELECT enc FROM encounters WHERE (cents IS NULL) <> (enc % 38 = 0)")
def _(spark, d):
    e = views.encounters(spark, d).withColumn("cents_reason", F.when(F.col("enc") % 38 == 0, "AMOUNT_MISSING"))
    return quality.inconsistent_reasons(e, ["cents"]).select("enc")


@query("current_matches_history", f"WITH {CLASSIFIED_SQL}, a AS ({CURRENT_SQL.format('')}), x AS (SELECT rec, v, version_count FROM a WHERE rec % 10 <> 0), b AS (SELECT rec, v, version_count FROM a) (SELECT *, 'left' AS side FROM (SELECT * FROM x EXCEPT ALL SELECT * FROM b)) UNION ALL (SELECT *, 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM x))")
def _(spark, d):
    current = history.current_state(_versions(spark, d), ["rec"], "v", LINEAGE, "batch_no").select("rec", "v", "version_count")
    return quality.symmetric_difference(current.filter("rec % 10 <> 0"), current)


@query("rows_per_table_and_file", f"WITH {CLASSIFIED_SQL} SELECT 'raw' AS \"table\", batch_no AS batch_id, file_name, count(*) AS n FROM delivery GROUP BY ALL UNION ALL SELECT 'versions', batch_no, file_name, count(*) FROM versions GROUP BY ALL")
def _(spark, d):
    return quality.rows_per_file({"raw": (views.delivery(spark, d), "batch_no", "file_name"), "versions": (_versions(spark, d), "batch_no", "file_name")})


# --- files ----------------------------------------------------------------------------------------

FILES_SQL = "files AS (SELECT 'batch_' || lpad(CAST(doc_id % 5 AS VARCHAR), 3, '0') AS batch_id, 'f' || CAST(doc_id AS VARCHAR) AS file_name, sha256(text) AS sha256 FROM documents)"


def _files(spark: SparkSession, d: str) -> DataFrame:
    docs = views.table(spark, d, "documents")
    return docs.select(F.concat(F.lit("batch_"), F.lpad((F.col("doc_id") % 5).cast("string"), 3, "0")).alias("batch_id"), F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("file_name"), F.sha2("text", 256).alias("sha256"))


@query("duplicate_files", f"WITH {FILES_SQL} SELECT a.batch_id, a.file_name, 'DUPLICATE_FILE(first_batch=' || min(b.batch_id) || ')' AS flag FROM files a JOIN files b ON a.sha256 = b.sha256 AND b.batch_id < a.batch_id GROUP BY ALL")
def _(spark, d):
    files = _files(spark, d)
    return landing.duplicate_files(files, files)


@query(
    "changed_redelivery",
    f"""WITH {FILES_SQL}, t AS (SELECT batch_id, file_name, CASE WHEN batch_id = 'batch_003' AND file_name LIKE '%3' THEN 'other' ELSE sha256 END AS sha256 FROM files WHERE batch_id <> 'batch_004' AND file_name <> 'f6'),
n AS (SELECT * FROM files WHERE batch_id IN (SELECT batch_id FROM t))
SELECT DISTINCT coalesce(n.batch_id, t.batch_id) AS batch_id FROM n FULL JOIN t ON n.batch_id = t.batch_id AND n.file_name = t.file_name WHERE n.sha256 IS DISTINCT FROM t.sha256""",
)
def _(spark, d):
    files = _files(spark, d)
    other = (F.col("batch_id") == "batch_003") & F.endswith("file_name", F.lit("3"))
    then = files.filter("batch_id <> 'batch_004' AND file_name <> 'f6'").withColumn("sha256", F.when(other, "other").otherwise(F.col("sha256")))
    return landing.changed_redelivery(files, then)


@query("pending_batches", f"WITH {FILES_SQL} SELECT DISTINCT batch_id FROM files WHERE batch_id > 'batch_002'")
def _(spark, d):
    files = _files(spark, d)
    return landing.pending_batches(files, files.filter("batch_id <= 'batch_002'"))


@query(
    "structural_checks",
    """WITH a AS (SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN 'SHA256_MISMATCH; ROW_COUNT_MISMATCH(expected=7,received=5)' WHEN 1 THEN 'ENCODING_ERROR(byte_offset=3)' WHEN 2 THEN 'CSV_PARSE_ERROR(record=2)' WHEN 3 THEN 'SIBLING_FILE_REJECTED' ELSE 'MALFORMED_RECORD(record=1); MALFORMED_RECORD(record=2)' END AS reason,
  o_orderkey % 5 IN (1, 2) AS unread FROM orders), c AS (SELECT unnest(['FILE_SHA256_MATCH', 'FILE_ENCODING_VALID', 'FILE_CSV_PARSEABLE', 'RECORD_SHAPE_VALID', 'SCHEMA_CONTRACT_MATCH', 'ROW_COUNT_MATCH']) AS check_code),
g AS (SELECT CAST(k AS VARCHAR) AS file_name, check_code, CASE check_code WHEN 'FILE_SHA256_MATCH' THEN reason LIKE '%SHA256%' WHEN 'FILE_ENCODING_VALID' THEN reason LIKE 'ENCODING%' WHEN 'FILE_CSV_PARSEABLE' THEN reason LIKE 'CSV%' WHEN 'RECORD_SHAPE_VALID' THEN reason LIKE 'MALFORMED%' WHEN 'SCHEMA_CONTRACT_MATCH' THEN false ELSE reason LIKE '%ROW_COUNT%' END AS hit,
  (check_code IN ('RECORD_SHAPE_VALID', 'SCHEMA_CONTRACT_MATCH', 'ROW_COUNT_MATCH') AND unread) OR (check_code = 'FILE_CSV_PARSEABLE' AND reason LIKE 'ENCODING%') AS skipped FROM a, c)
SELECT file_name, check_code, CAST(CASE WHEN skipped THEN NULL WHEN check_code = 'ROW_COUNT_MATCH' THEN 5 WHEN hit THEN 1 ELSE 0 END AS BIGINT) AS observed, skipped AS not_evaluated FROM g""",
)
def _(spark, d):
    k = F.col("o_orderkey")
    reason = F.when(k % 5 == 0, "SHA256_MISMATCH; ROW_COUNT_MISMATCH(expected=7,received=5)").when(k % 5 == 1, "ENCODING_ERROR(byte_offset=3)").when(k % 5 == 2, "CSV_PARSE_ERROR(record=2)").when(k % 5 == 3, "SIBLING_FILE_REJECTED").otherwise("MALFORMED_RECORD(record=1); MALFORMED_RECORD(record=2)")
    received = F.when(~(k % 5).isin(1, 2), F.lit(5)).cast("bigint")
    audit = views.table(spark, d, "orders").select(F.lit("batch_001").alias("batch_id"), k.cast("string").alias("file_name"), F.lit(7).cast("bigint").alias("expected_count"), received.alias("received_count"), reason.alias("reason"))
    return quality.structural_counts(audit).select("file_name", "check_code", "observed", "not_evaluated")


HEADER_SQL = "h AS (SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN ['a', 'b', 'c'] WHEN 1 THEN ['a', 'c', 'b'] WHEN 2 THEN ['a', 'b', 'c', 'd'] ELSE ['a', 'x', 'a'] END AS fields FROM orders)"


def _headers(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("o_orderkey")
    arr = lambda *x: F.array(*[F.lit(i) for i in x])
    fields = F.when(k % 4 == 0, arr("a", "b", "c")).when(k % 4 == 1, arr("a", "c", "b")).when(k % 4 == 2, arr("a", "b", "c", "d")).otherwise(arr("a", "x", "a"))
    headers = views.table(spark, d, "orders").select(k.alias("k"), F.lit("S").alias("source_system"), fields.alias("fields"))
    contracts = spark.createDataFrame([("S", "v1", 1, ["a", "b", "c"], ["a", "b", "c"]), ("S", "v2", 2, ["a", "b", "c", "d"], ["a", "b", "c", "e"])], "source_system string, version string, version_position int, columns array<string>, canonical array<string>")
    return headers, contracts


@query("header_match", f"WITH {HEADER_SQL} SELECT k, CASE k % 4 WHEN 0 THEN 'v1' WHEN 2 THEN 'v2' END AS version FROM h")
def _(spark, d):
    return landing.match_headers(*_headers(spark, d)).select("k", "version")


@query(
    "header_mismatch",
    f"""WITH {HEADER_SQL}, c AS (SELECT * FROM (VALUES ('v1', 1, ['a', 'b', 'c']), ('v2', 2, ['a', 'b', 'c', 'd'])) t(version, p, columns)),
x AS (SELECT k, fields, version, columns, row_number() OVER (PARTITION BY k ORDER BY len(list_intersect(list_distinct(fields), columns)) DESC, p DESC) AS rn FROM h, c WHERE k % 4 IN (1, 3)),
m AS (SELECT *, list_filter(columns, lambda e: NOT list_contains(fields, e)) AS missing, list_filter(generate_series(1, len(fields)), lambda i: NOT list_contains(columns, fields[i]) AND list_position(fields, fields[i]) = i) AS odd, list_filter(generate_series(1, len(fields)), lambda i: list_position(fields, fields[i]) < i) AS twice FROM x WHERE rn = 1)
SELECT k, 'closest_version=' || version || ',columns=' || len(fields) || ',expected_columns=' || len(columns) || CASE WHEN len(missing) > 0 THEN ',missing=' || array_to_string(missing, '|') ELSE '' END || CASE WHEN len(odd) > 0 THEN ',unexpected_positions=' || array_to_string(odd, '|') ELSE '' END
  || CASE WHEN len(twice) > 0 THEN ',duplicate_positions=' || array_to_string(twice, '|') ELSE '' END || CASE WHEN len(missing) + len(odd) + len(twice) = 0 THEN ',order_differs' ELSE '' END AS detail FROM m""",
)
def _(spark, d):
    headers, contracts = _headers(spark, d)
    return landing.describe_mismatch(landing.match_headers(headers, contracts).filter("version IS NULL"), contracts, ["k"])


@query("export_format", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS o_orderdate, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS flag, CAST(CAST(o_orderkey AS DECIMAL(18, 2)) AS VARCHAR) AS amount FROM orders")
def _(spark, d):
    k = F.col("o_orderkey")
    rows = views.table(spark, d, "orders").select("o_orderkey", "o_orderdate", F.col("o_orderdate").cast("date").alias("day"), F.when(k % 3 != 0, k % 2 == 0).alias("flag"), k.cast("decimal(18,2)").alias("amount"))
    return exports.formatted(rows)


def queries() -> dict[str, Query]:
    _all_registered()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _all_registered()
    return dict(SQL)


def _all_registered() -> None:
    from . import delivered_report, file_queries, reference_queries, report_queries, store_queries  # noqa: F401  (they register their queries here)
