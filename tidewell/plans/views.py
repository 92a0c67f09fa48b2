"""Delivery-like inputs over the driver's tables, as DataFrames and as the same SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Deliveries: events in three batches by day of the month; some rows lack the record or the version's date.
DELIVERY_SQL = """
delivery AS (SELECT CAST(floor((day(ts) - 1) / 10) AS INTEGER) AS batch_no, 'f' || CAST(event_id % 3 AS VARCHAR) AS file_name, CAST(event_id AS BIGINT) AS row_no,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id END AS rec, CASE WHEN event_id % 89 = 0 THEN NULL ELSE CAST(ts AS DATE) - CAST(event_id % 5 AS INTEGER) END AS v,
  event_type, CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(event_id % 3 AS INTEGER) END AS bucket, CAST(event_id % 2 AS INTEGER) AS spelling FROM events)"""


def delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, id_ = table(spark, sf_dir, "events"), F.col("event_id")
    return e.select(
        F.floor((F.dayofmonth("ts") - 1) / 10).cast("int").alias("batch_no"), F.concat(F.lit("f"), (id_ % 3).cast("string")).alias("file_name"), id_.alias("row_no"),
        F.when(id_ % 97 != 0, F.col("user_id")).alias("rec"), F.when(id_ % 89 != 0, F.date_sub(F.col("ts").cast("date"), (id_ % 5).cast("int"))).alias("v"),
        "event_type", F.when(id_ % 7 != 0, (id_ % 3).cast("int")).alias("bucket"), (id_ % 2).cast("int").alias("spelling"),
    )


CLASSIFIED_SQL = (
    DELIVERY_SQL
    + """,
ok AS (SELECT * FROM delivery WHERE rec IS NOT NULL AND v IS NOT NULL),
win AS (SELECT *, max(v) OVER (PARTITION BY rec ORDER BY batch_no RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS held, row_number() OVER a AS nth,
  first_value(batch_no) OVER a AS b1, first_value(event_type) OVER a AS e1, first_value(bucket) OVER a AS k1, first_value(spelling) OVER a AS s1 FROM ok
  WINDOW a AS (PARTITION BY rec, v ORDER BY batch_no, file_name, row_no)),
win2 AS (SELECT *, min(CASE WHEN nth = 1 THEN v END) OVER (PARTITION BY rec, batch_no) AS earliest FROM win),
matched AS (SELECT *, CASE WHEN nth = 1 THEN NULL WHEN event_type IS NOT DISTINCT FROM e1 AND bucket IS NOT DISTINCT FROM k1 AND spelling IS NOT DISTINCT FROM s1 THEN 'EXACT'
  WHEN coalesce(event_type <> e1, false) OR coalesce(bucket <> k1, false) THEN 'CONFLICT' ELSE 'EQUIVALENT' END AS match_type FROM win2),
classified AS (
  SELECT batch_no, file_name, row_no, rec, v, event_type, bucket, match_type,
    CASE WHEN v < held THEN 'STALE' WHEN nth > 1 AND match_type = 'CONFLICT' THEN 'QUARANTINED' WHEN nth > 1 THEN 'DUPLICATE' WHEN held IS NULL AND v = earliest THEN 'NEW_ENCOUNTER' ELSE 'NEW_VERSION' END AS outcome,
    CASE WHEN v < held AND nth > 1 THEN 'STALE_REPLAY' WHEN v < held THEN 'STALE_NEW_VERSION' WHEN nth > 1 AND match_type = 'CONFLICT' THEN 'VERSION_CONFLICT_SAME_TS'
      WHEN nth > 1 AND b1 < batch_no THEN 'DUPLICATE_OF_HELD_VERSION' WHEN nth > 1 THEN 'DUPLICATE_IN_BATCH' END AS outcome_reason, nth = 1 AS is_first_seen FROM matched
  UNION ALL SELECT batch_no, file_name, row_no, rec, v, event_type, bucket, NULL, 'QUARANTINED', CASE WHEN rec IS NULL THEN 'SOURCE_RECORD_ID_MISSING' ELSE 'TIMESTAMP_MISSING' END, false FROM delivery WHERE rec IS NULL OR v IS NULL),
versions AS (SELECT * FROM classified WHERE is_first_seen)"""
)

#: Encounters: orders with status, type, period, amount in cents; some fields missing or out of order.
ENCOUNTERS_SQL = """
encounters AS (SELECT o_orderkey AS enc, o_custkey AS person, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS admit,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 12 AS INTEGER) - 1 END AS discharge,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderstatus = 'P' THEN 'VOID' WHEN o_orderstatus = 'F' THEN 'PAID' ELSE 'SUBMITTED' END AS status, o_orderpriority AS kind,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS cents, c_nationkey AS site FROM orders JOIN customer ON o_custkey = c_custkey)"""


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, key = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    status = F.when(key % 11 == 0, None).when(F.col("o_orderstatus") == "P", "VOID").when(F.col("o_orderstatus") == "F", "PAID").otherwise("SUBMITTED")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        key.alias("enc"), F.col("o_custkey").alias("person"), F.when(key % 13 != 0, day).alias("admit"), F.when(key % 17 != 0, F.date_add(day, (key % 12).cast("int") - 1)).alias("discharge"),
        status.alias("status"), F.col("o_orderpriority").alias("kind"), F.when(key % 19 != 0, F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"), F.col("c_nationkey").alias("site"),
    )


#: Roster snapshots: customers at three dates, with changing attributes and gaps.
ROSTER_SQL = """
roster AS (SELECT CAST(c_custkey AS VARCHAR) AS npi, s.d AS as_of_date, c_mktsegment || CASE WHEN c_custkey % 5 = 0 AND s.i >= 1 THEN '+' ELSE '' END || CASE WHEN c_custkey % 7 = 0 AND s.i = 2 THEN '*' ELSE '' END AS specialty,
  CAST(c_nationkey AS VARCHAR) AS facility FROM customer, (VALUES (0, DATE '1996-01-01'), (1, DATE '1997-07-01'), (2, DATE '1999-01-01')) s(i, d) WHERE NOT (c_custkey % 11 = 0 AND s.i = 1) AND NOT (c_custkey % 13 = 0 AND s.i = 2) AND NOT (c_custkey % 17 = 0 AND s.i = 0))"""


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    dates = F.array(*[F.struct(F.lit(i).alias("i"), F.to_date(F.lit(d)).alias("d")) for i, d in enumerate(("1996-01-01", "1997-07-01", "1999-01-01"))])
    rows = c.withColumn("s", F.explode(dates))
    i = F.col("s.i")
    rows = rows.filter(~((k % 11 == 0) & (i == 1)) & ~((k % 13 == 0) & (i == 2)) & ~((k % 17 == 0) & (i == 0)))
    specialty = F.concat("c_mktsegment", F.when((k % 5 == 0) & (i >= 1), "+").otherwise(""), F.when((k % 7 == 0) & (i == 2), "*").otherwise(""))
    return rows.select(k.cast("string").alias("npi"), F.col("s.d").alias("as_of_date"), specialty.alias("specialty"), F.col("c_nationkey").cast("string").alias("facility"))


#: Delivered texts: orders' amounts, dates, times and numbers in the many ways in which they are written.
TEXTS_SQL = """
texts AS (SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 3 THEN 'USD_CENTS' ELSE 'USD' END AS unit,
  CASE o_orderkey % 12 WHEN 0 THEN '$' || CAST(o_orderkey % 1000 AS VARCHAR) || '.50' WHEN 1 THEN 'USD ' || CAST(o_orderkey AS VARCHAR) WHEN 2 THEN CAST(o_orderkey % 90 + 1 AS VARCHAR) || ',' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') || '.25 usd'
    WHEN 3 THEN CAST(o_orderkey AS VARCHAR) WHEN 4 THEN CAST(o_orderkey % 50 AS VARCHAR) || '.5 K' WHEN 5 THEN ' n/a ' WHEN 6 THEN '#REF!' WHEN 7 THEN CAST(o_orderkey AS VARCHAR) || '.75' WHEN 8 THEN '12.345' WHEN 9 THEN '-5' WHEN 10 THEN '' ELSE CAST(o_orderkey % 9 AS VARCHAR) || 'K' END AS amount,
  CASE o_orderkey % 10 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 2 THEN strftime(o_orderdate, '%d-%m-%Y') WHEN 3 THEN strftime(o_orderdate, '%m/%d/%y') WHEN 4 THEN strftime(o_orderdate, '%b %d, %Y')
    WHEN 5 THEN strftime(o_orderdate, '%d %B %Y') WHEN 6 THEN '1997-02-30' WHEN 7 THEN 'tbd' WHEN 8 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') ELSE '' END AS day,
  CASE WHEN o_orderkey % 2 = 0 THEN 'MDY' ELSE 'DMY' END AS ord, CASE WHEN o_orderkey % 6 < 3 THEN 1900 END AS century,
  CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '+05:30' WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '-25:00' WHEN 3 THEN '1996-01-01 24:00:00' WHEN 4 THEN 'soon' ELSE 'pending' END AS moment,
  CASE o_orderkey % 5 WHEN 0 THEN CAST(1000000000 + o_orderkey AS VARCHAR) WHEN 1 THEN CAST(1000000000 + o_orderkey AS VARCHAR) || '.0' WHEN 2 THEN 'N/A' WHEN 3 THEN CAST(o_orderkey AS VARCHAR) ELSE '' END AS npi,
  CASE o_orderkey % 6 WHEN 0 THEN ' in-patient' WHEN 1 THEN 'Emergency  Room' WHEN 2 THEN 'walk - in urgent' WHEN 3 THEN '' WHEN 4 THEN 'Virtual' ELSE 'helicopter' END AS kind,
  CASE o_orderkey % 6 WHEN 0 THEN 'closed - paid' WHEN 1 THEN 'In   Process' WHEN 2 THEN 'VOIDED' WHEN 3 THEN ' ' WHEN 4 THEN 'Denied' ELSE 'lost' END AS claim,
  CASE o_orderkey % 6 WHEN 0 THEN 'medicare -part b' WHEN 1 THEN 'n/a' WHEN 2 THEN 'self  pay' WHEN 3 THEN '' WHEN 4 THEN 'BCBS' ELSE 'barter' END AS payer,
  CASE o_orderkey % 6 WHEN 0 THEN 'e119' WHEN 1 THEN 'E11.9 - diabetes' WHEN 2 THEN '250.00' WHEN 3 THEN 'TBD' WHEN 4 THEN 'zz' ELSE 'I10' END AS dx,
  CASE o_orderkey % 4 WHEN 0 THEN lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0') WHEN 1 THEN lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0') || '-1234' WHEN 2 THEN CAST(o_orderkey AS VARCHAR) || 'x' ELSE '' END AS zip,
  CASE o_orderkey % 5 WHEN 0 THEN 'f' WHEN 1 THEN ' Male ' WHEN 2 THEN 'X' WHEN 3 THEN '' ELSE 'FEMALE' END AS sex,
  CAST(o_orderdate AS DATE) AS admit, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) - CAST((o_orderkey * 37) % 36000 - 100 AS INTEGER) END AS born,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 12 AS INTEGER) - 1 END AS discharge FROM orders)"""


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    s = lambda x: x.cast("string")
    fmt = lambda p: F.date_format(d, p)

    def pick(n: int, *values: object) -> F.Column:
        out = F.when(k % n == 0, values[0])
        for i, v in enumerate(values[1:-1], 1):
            out = out.when(k % n == i, v)
        return out.otherwise(values[-1])

    pad = lambda x, n: F.lpad(s(x), n, "0")
    cat = F.concat
    amount = pick(
        12, cat(F.lit("$"), s(k % 1000), F.lit(".50")), cat(F.lit("USD "), s(k)), cat(s(k % 90 + 1), F.lit(","), pad(k % 1000, 3), F.lit(".25 usd")), s(k), cat(s(k % 50), F.lit(".5 K")), " n/a ", "#REF!",
        cat(s(k), F.lit(".75")), "12.345", "-5", "", cat(s(k % 9), F.lit("K")),
    )
    day = pick(10, fmt("yyyy-MM-dd"), fmt("MM/dd/yyyy"), fmt("dd-MM-yyyy"), fmt("MM/dd/yy"), fmt("MMM dd, yyyy"), fmt("dd MMMM yyyy"), "1997-02-30", "tbd", fmt("yyyy-MM-dd'T'HH:mm:ss"), "")
    moment = pick(6, fmt("yyyy-MM-dd'T'HH:mm:ss'Z'"), cat(fmt("yyyy-MM-dd HH:mm:ss"), F.lit("+05:30")), cat(fmt("yyyy-MM-dd HH:mm:ss"), F.lit("-25:00")), "1996-01-01 24:00:00", "soon", "pending")
    npi = pick(5, s(k + 1000000000), cat(s(k + 1000000000), F.lit(".0")), "N/A", s(k), "")
    admit = d.cast("date")
    return table(spark, sf_dir, "orders").select(
        k.alias("k"), F.when(k % 4 == 3, "USD_CENTS").otherwise("USD").alias("unit"), amount.alias("amount"), day.alias("day"), F.when(k % 2 == 0, "MDY").otherwise("DMY").alias("ord"),
        F.when(k % 6 < 3, 1900).alias("century"), moment.alias("moment"), npi.alias("npi"),
        pick(6, " in-patient", "Emergency  Room", "walk - in urgent", "", "Virtual", "helicopter").alias("kind"), pick(6, "closed - paid", "In   Process", "VOIDED", " ", "Denied", "lost").alias("claim"),
        pick(6, "medicare -part b", "n/a", "self  pay", "", "BCBS", "barter").alias("payer"), pick(6, "e119", "E11.9 - diabetes", "250.00", "TBD", "zz", "I10").alias("dx"),
        pick(4, pad(k % 100000, 5), cat(pad(k % 100000, 5), F.lit("-1234")), cat(s(k), F.lit("x")), "").alias("zip"), pick(5, "f", " Male ", "X", "", "FEMALE").alias("sex"),
        admit.alias("admit"), F.when(k % 9 != 0, F.date_sub(admit, ((k * 37) % 36000 - 100).cast("int"))).alias("born"), F.when(k % 17 != 0, F.date_add(admit, (k % 12).cast("int") - 1)).alias("discharge"),
    )
