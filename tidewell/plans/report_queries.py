"""Registered queries of whole reports, names, local times and facts."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaning as clean
from ..operators import dimensions, facts, history, quality
from . import catalogue as base
from . import views
from .catalogue import CURRENT_SQL, ISSUES_SQL, LINEAGE, query
from .views import CLASSIFIED_SQL, ENCOUNTERS_SQL

# --- cleaning ---------------------------------------------------------------------------

#: Wall-clock times around the changes of a zone that has summer time from the first Sunday in April to the last in October.
LOCAL_SQL = """local AS (SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN DATE '1997-04-06' WHEN 1 THEN DATE '1997-10-26' ELSE CAST(o_orderdate AS DATE) END + INTERVAL 1 HOUR * (o_orderkey % 4) + INTERVAL 1 MINUTE * (o_orderkey % 60) AS wall FROM orders),
sundays AS (SELECT y, min(x) FILTER (WHERE month(x) = 4) AS d1, max(x) FILTER (WHERE month(x) = 10) AS d2 FROM (SELECT x, year(x) AS y FROM (SELECT unnest(generate_series(TIMESTAMP '1990-01-01', TIMESTAMP '2005-12-31', INTERVAL 1 DAY)) AS x) WHERE isodow(x) = 7) GROUP BY y),
utc AS (SELECT k, wall, CASE WHEN wall >= d1 + INTERVAL 2 HOUR AND wall < d1 + INTERVAL 3 HOUR THEN NULL ELSE wall + INTERVAL 1 HOUR * CASE WHEN wall >= d1 + INTERVAL 2 HOUR AND wall < d2 + INTERVAL 2 HOUR THEN 5 ELSE 6 END END AS u, wall >= d2 + INTERVAL 1 HOUR AND wall < d2 + INTERVAL 2 HOUR AS twice FROM local JOIN sundays ON y = year(wall))"""


@query("local_timestamps", f"WITH {LOCAL_SQL} SELECT k, u AS value, CASE WHEN u IS NULL THEN 'TIMESTAMP_NONEXISTENT_LOCAL_TIME' END AS reason, CASE WHEN twice THEN 'TIMESTAMP_AMBIGUOUS_LOCAL_TIME' END AS warning FROM utc")
def _(spark, d):
    k = F.col("o_orderkey")
    day = F.when(k % 5 == 0, F.lit("1997-04-06").cast("date")).when(k % 5 == 1, F.lit("1997-10-26").cast("date")).otherwise(F.col("o_orderdate").cast("date"))
    wall = F.try_make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day), (k % 4).cast("int"), (k % 60).cast("int"), F.lit(0).cast("decimal(16,6)"))
    spelled = F.when(k % 2 == 0, F.date_format(wall, "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format(wall, "d/M/yyyy HH:mm:ss"))
    texts = views.table(spark, d, "orders").select(k.alias("k"), spelled.alias("t"))
    return clean.clean_timestamp(texts, "c", F.col("t"), "America/Chicago", "DMY").select("k", "c.value", "c.reason", "c.warning")


@query(
    "person_names",
    """WITH n AS (SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN ' o''' || lower(c_mktsegment) || '-' || c_custkey WHEN 1 THEN '--' WHEN 2 THEN NULL ELSE c_mktsegment || ' jr.' END AS l, CASE c_custkey % 3 WHEN 0 THEN '  ann' || c_custkey || '  lee' WHEN 1 THEN ' ' ELSE 'J.' || c_custkey END AS f, CASE c_custkey % 5 WHEN 0 THEN '  ' WHEN 1 THEN NULL ELSE ' x' END AS id FROM customer)
SELECT k, nullif(regexp_replace(upper(coalesce(l, '')), '[^A-Z0-9]', '', 'g'), '') AS last_name, CASE WHEN k % 4 IN (1, 2) THEN 'LAST_NAME_MISSING' END AS last_name_reason, nullif(regexp_replace(split_part(trim(upper(f)), ' ', 1), '[^A-Z0-9]', '', 'g'), '') AS first_name, CASE WHEN k % 3 = 1 THEN 'FIRST_NAME_MISSING' END AS first_name_reason, trim(coalesce(id, '')) <> '' AS has_id FROM n""",
)
def _(spark, d):
    k, segment = F.col("c_custkey"), F.col("c_mktsegment")
    last = F.when(k % 4 == 0, F.concat(F.lit(" o'"), F.lower(segment), F.lit("-"), k)).when(k % 4 == 1, "--").when(k % 4 == 3, F.concat(segment, F.lit(" jr.")))
    first = F.when(k % 3 == 0, F.concat(F.lit("  ann"), k, F.lit("  lee"))).when(k % 3 == 1, " ").otherwise(F.concat(F.lit("J."), k))
    given = F.when(k % 5 == 0, "  ").when(k % 5 != 1, " x")
    rows = views.table(spark, d, "customer").select(k.alias("k"), clean.clean_last_name(last).alias("l"), clean.clean_first_name(first).alias("f"), clean.has_record_id(given).alias("has_id"))
    return rows.select("k", F.col("l.value").alias("last_name"), F.col("l.reason").alias("last_name_reason"), F.col("f.value").alias("first_name"), F.col("f.reason").alias("first_name_reason"), "has_id")


@query("delivered_dates", "SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderdate AS DATE) WHEN 1 THEN CAST(o_orderdate + INTERVAL 90 MINUTE AS DATE) WHEN 2 THEN CAST(o_orderdate - INTERVAL 330 MINUTE AS DATE) END AS day FROM orders")
def _(spark, d):
    k, text = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    spelled = F.concat(text, F.when(k % 4 == 0, "Z").when(k % 4 == 1, "-01:30").when(k % 4 == 2, "+05:30").otherwise(""))
    return views.table(spark, d, "orders").select(k.alias("k"), clean.delivered_date(spelled).alias("day"))


# --- quality -----------------------------------------------------------------------------


@query(
    "issues_without_version",
    f"WITH {base.REASONS_SQL}, moved AS (SELECT e.enc, CASE WHEN e.enc % 9 = 0 THEN -1 ELSE e.site END AS site FROM issues JOIN encounters e USING (enc)) SELECT enc, site FROM moved i WHERE NOT EXISTS (SELECT 1 FROM encounters v WHERE v.enc = i.enc AND v.site = i.site)",
)
def _(spark, d):
    rows = base._reasons(spark, d)
    issues = quality.version_issues(rows, ["enc", "site"], base.SOURCES).withColumn("site", F.when(F.col("enc") % 9 == 0, -1).otherwise(F.col("site")))
    return quality.issues_without_version(issues, rows, ["enc", "site"]).select("enc", "site")


@query(
    "gate_rejected_rows",
    base.GATE_SQL
    + ", r AS (SELECT batch_no, count(*) AS n FROM classified GROUP BY 1), e AS (SELECT batch_no, count(DISTINCT (file_name, row_no)) AS bad FROM gate GROUP BY 1) SELECT g.batch_no, g.file_name, g.row_no, string_agg(DISTINCT g.reason_code, '|' ORDER BY g.reason_code) AS reason_codes FROM gate g JOIN r USING (batch_no) JOIN e USING (batch_no) WHERE bad * 100 > n * 3 GROUP BY ALL",
)
def _(spark, d):
    outcomes, issues = base._gate(spark, d)
    failed = quality.publish_gate(outcomes, issues, "batch_no", ["file_name", "row_no"], Decimal("0.03")).filter("failed").select("batch_no")
    return issues.join(failed, "batch_no", "left_semi").groupBy("batch_no", "file_name", "row_no").agg(clean.join_codes(F.col("reason_code")).alias("reason_codes"))


#: Counts for every check of the catalogue but some: what they are follows from the length of its name.
CHECK_VALUES = ", ".join(f"('{c[0]}', '{c[4]}', '{c[5]}')" for c in quality.catalogue.CHECKS if c[6] == "FILE")
REPORT_SQL = f"""WITH {CLASSIFIED_SQL}, f AS (SELECT batch_no, file_name, count(*) AS received, count(*) FILTER (WHERE outcome = 'DUPLICATE') AS dup FROM classified GROUP BY ALL),
k AS (SELECT * FROM (VALUES {CHECK_VALUES}) t(check_code, severity, kind)),
m AS (SELECT f.*, k.*, CASE WHEN length(check_code) % 5 = 0 THEN NULL WHEN kind = 'RECONCILIATION' THEN received - (CASE WHEN length(check_code) % 2 = batch_no % 2 THEN 0 ELSE 1 END) WHEN length(check_code) % 3 = 0 THEN 0 ELSE dup END AS observed FROM f, k),
report AS (SELECT CAST(batch_no AS VARCHAR) AS batch_id, file_name, check_code, CASE WHEN observed IS NULL THEN NULL ELSE received END AS evaluated_count, observed AS observed_count, CASE WHEN kind = 'RECONCILIATION' AND observed IS NOT NULL THEN received END AS expected_count,
  CASE WHEN kind <> 'RECONCILIATION' AND observed IS NOT NULL THEN CAST(round_even(CAST(observed AS DECIMAL(20, 0)) * 100 / received, 2) AS DECIMAL(7, 2)) END AS observed_pct,
  CASE WHEN observed IS NULL THEN 'NOT_EVALUATED' WHEN kind = 'RECONCILIATION' THEN CASE WHEN observed = received THEN 'PASS' ELSE 'FAIL' END WHEN kind = 'OBSERVATION' OR observed = 0 THEN 'PASS' WHEN severity = 'ERROR' THEN 'FAIL' ELSE 'WARN' END AS status FROM m)"""


def _report(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    files = base._classified(spark, d).groupBy("batch_no", "file_name").agg(F.count(F.lit(1)).alias("received"), F.count_if(c("outcome") == "DUPLICATE").alias("dup"))
    files = files.select(c("batch_no").cast("string").alias("batch_id"), "file_name", F.lit("S").alias("source_system"), F.lit("ACCEPTED").alias("batch_status"), "received", "dup")
    checks = [(x[0], x[5] == "RECONCILIATION", len(x[0])) for x in quality.catalogue.CHECKS if x[6] == "FILE" and len(x[0]) % 5]
    kinds = F.array(*[F.struct(F.lit(n).alias("check_code"), F.lit(r).alias("r"), F.lit(size).alias("size")) for n, r, size in checks])
    long = files.withColumn("k", F.explode(kinds)).select("*", "k.*")
    reconciled = c("received") - F.when(c("size") % 2 == c("batch_id").cast("int") % 2, 0).otherwise(1)
    observed = F.when(c("r"), reconciled).when(c("size") % 3 == 0, 0).otherwise(c("dup"))
    counts = long.select("batch_id", "file_name", "check_code", c("received").alias("evaluated"), observed.cast("bigint").alias("observed"), c("received").alias("expected"), F.lit(None).cast("string").alias("reason_codes"), F.lit(False).alias("not_evaluated"))
    return quality.report(files.drop("received", "dup"), counts)


@query("dq_report_whole", REPORT_SQL + " SELECT * FROM report")
def _(spark, d):
    return _report(spark, d).select("batch_id", "file_name", "check_code", "evaluated_count", "observed_count", "expected_count", "observed_pct", "status")


@query("dq_status_counts", REPORT_SQL + " SELECT status, count(*) AS n FROM report GROUP BY status")
def _(spark, d):
    return quality.status_counts(_report(spark, d))


@query("failed_invariants", REPORT_SQL + f" SELECT batch_id, file_name, check_code FROM report WHERE status = 'FAIL' AND check_code IN ({', '.join(repr(c[0]) for c in quality.catalogue.CHECKS if c[7])})")
def _(spark, d):
    return quality.failed_invariants(_report(spark, d)).select("batch_id", "file_name", "check_code")


DIGEST_COLUMNS = ("batch_no", "event_type", "file_name", "is_first_seen", "outcome", "rec", "row_no", "v")  # in the order in which the digest takes them
DIGEST_SQL = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in DIGEST_COLUMNS)


@query("state_digest", f"WITH {CLASSIFIED_SQL}, b AS (SELECT CAST('0x' || left(sha256({DIGEST_SQL}), 15) AS BIGINT) AS h FROM classified) SELECT count(*) AS n, bit_xor(h) AS hash_xor, CAST(sum(h) AS DECIMAL(38, 0)) AS hash_sum FROM b")
def _(spark, d):
    return quality.state_digest(base._classified(spark, d).select(*DIGEST_COLUMNS))


# --- facts ---------------------------------------------------------------------------------


_VOLUME_SQL = """SELECT CAST(year(admit) AS INTEGER) AS year, CAST(month(admit) AS INTEGER) AS month, CAST(site AS VARCHAR) AS facility_id, n_name AS facility_name, kind AS encounter_type, count(*) AS encounters, CAST(sum(CAST(cents AS DECIMAL(18, 0)) * 0.01) AS DECIMAL(28, 2)) AS billed_amount_usd
FROM {} e LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 6 <> 0) n ON n_nationkey = site WHERE status IS DISTINCT FROM 'VOID' AND admit IS NOT NULL AND NOT EXISTS (SELECT 1 FROM issues i WHERE i.enc = e.enc AND i.severity = 'ERROR') GROUP BY ALL ORDER BY ALL"""


def _volume(spark, d, e, known):
    c = F.col
    dollars = (c("cents").cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")
    rows = known.select(c("enc").alias("version_key"), c("site").cast("string").alias("facility_id"), c("kind").alias("encounter_type"), c("status").alias("claim_status"), c("admit").alias("admit_date"), dollars.alias("billed_amount_usd"))
    facilities = views.table(spark, d, "nation").filter("n_nationkey % 6 <> 0").select(c("n_nationkey").cast("string").alias("facility_id"), c("n_name").alias("facility_name"))
    return facts.volume_report(rows, base._issues(e).withColumnRenamed("enc", "version_key"), dimensions.calendar_dim(e, "admit", "discharge"), facilities)


@query("volume_report", f"WITH {ENCOUNTERS_SQL}, {ISSUES_SQL} {_VOLUME_SQL.format('encounters')}")
def _(spark, d):
    e = views.encounters(spark, d)
    return _volume(spark, d, e, e)


@query(
    "volume_report_as_of",
    f"WITH {ENCOUNTERS_SQL}, {ISSUES_SQL}, known AS (SELECT * FROM encounters WHERE enc % 4 <= 2 QUALIFY row_number() OVER (PARTITION BY person ORDER BY enc DESC) = 1) {_VOLUME_SQL.format('known')}",
)
def _(spark, d):
    # a person's encounters as versions of one record, delivered in four batches; as known at the end of the third
    e = views.encounters(spark, d)
    versions = e.withColumn("batch_id", F.concat(F.lit("batch_00"), (F.col("enc") % 4).cast("string")))
    return _volume(spark, d, e, history.state_as_of(versions, ["person"], "enc", [], "batch_id", "batch_002"))


@query(
    "fact_current",
    f"WITH {CLASSIFIED_SQL}, c AS ({CURRENT_SQL.format('')}) SELECT w.rec, w.v, w.batch_no, w.row_no, w.event_type, 'z' || CAST(w.row_no % 7 AS VARCHAR) AS zip, c.version_count FROM versions w JOIN c ON c.rec = w.rec AND c.v = w.v",
)
def _(spark, d):
    versions = base._versions(spark, d).withColumn("key", F.concat_ws(":", "rec", "v"))
    people = views.delivery(spark, d).select("batch_no", *LINEAGE, F.concat(F.lit("z"), (F.col("row_no") % 7).cast("string")).alias("zip"))
    rows = facts.fact_versions(versions.drop("event_type"), versions.select("key", "event_type"), people, "key", ["batch_no", *LINEAGE])
    current = history.current_state(versions, ["rec"], "v", LINEAGE, "batch_no")
    return facts.fact_current(rows, current, "key", ["version_count"]).select("rec", "v", "batch_no", "row_no", "event_type", "zip", "version_count")
