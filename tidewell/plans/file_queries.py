"""Registered queries over delivered files, made from the driver's tables: manifests, strict CSV, file checks, batch decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaning as clean
from ..sources import csv_ranges, landing
from . import views
from .catalogue import SQL, query

#: CSV files of up to 100 orders each: quoted values, short and long and blank records, files that can't be read, wrong hashes and counts.
CSV_SQL = """rec AS (SELECT CAST(floor(o_orderkey / 100) AS BIGINT) AS f, o_orderkey AS k, row_number() OVER (PARTITION BY floor(o_orderkey / 100) ORDER BY o_orderkey) AS n, CASE WHEN o_orderkey % 5 = 0 THEN 'x,"' || chr(10) || 'y' ELSE o_orderpriority END AS v FROM orders),
fld AS (SELECT *, f % 13 = 5 AS unread, CASE WHEN k % 89 = 0 THEN 0 WHEN k % 17 = 0 THEN 3 ELSE 2 END AS width FROM rec),
fil AS (SELECT 'batch_' || lpad(CAST(CAST(floor(f / 4) AS BIGINT) AS VARCHAR), 6, '0') AS batch_id, 'f' || CAST(f AS VARCHAR) || '.csv' AS file_name, f, bool_or(unread) AS unread, count(*) AS received, count(*) + CASE WHEN f % 7 = 3 THEN 1 ELSE 0 END AS row_count, f % 11 = 2 AS other_hash FROM fld GROUP BY f)"""


def _csv_files(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(files with content and hash, manifest entries)."""
    k, c = F.col("o_orderkey"), F.col
    value = F.when(k % 5 == 0, F.lit('"x,""\ny"')).otherwise(c("o_orderpriority"))
    line = F.when(k % 89 == 0, "").otherwise(F.concat(k.cast("string"), F.lit(","), value, F.when(k % 17 == 0, ",more").otherwise("")))
    lines = views.table(spark, d, "orders").groupBy(F.floor(k / 100).alias("f")).agg(F.array_sort(F.collect_list(F.struct(k.alias("k"), line.alias("line")))).alias("r"))  # at most 100 rows
    text = F.concat(F.lit("a,b\r\n"), F.array_join(F.transform("r", lambda x: x["line"]), "\r\n"), F.lit("\r\n"), F.when(c("f") % 13 == 5, '"open').otherwise(""))
    batch = F.concat(F.lit("batch_"), F.lpad(F.floor(c("f") / 4).cast("string"), 6, "0"))
    named = lines.select("f", batch.alias("batch_id"), F.concat(F.lit("f"), c("f").cast("string"), F.lit(".csv")).alias("file_name"), F.size("r").alias("size"), F.encode(text, "UTF-8").alias("content"))
    files = named.select("batch_id", "file_name", "content", F.sha2("content", 256).alias("sha256"))
    expected = (c("size") + (c("f") % 7 == 3).cast("int")).cast("bigint")
    declared = F.when(c("f") % 11 == 2, "other").otherwise(F.sha2("content", 256))
    return files, named.select("batch_id", "file_name", F.lit("S").alias("source_system"), F.lit(1).alias("position"), expected.alias("row_count"), declared.alias("sha256"))


def _contracts(spark: SparkSession) -> DataFrame:
    kinds = "source_system string, version string, version_position int, columns array<string>, canonical array<string>"
    return spark.createDataFrame([("S", "v1", 1, ["a", "b"], ["a", "b"])], kinds)


@query(
    "csv_records",
    f"""WITH {CSV_SQL} SELECT 'f' || CAST(f AS VARCHAR) || '.csv' AS file_name, 'record' AS kind, CAST(n AS INTEGER) AS row_number, CASE width WHEN 0 THEN '' WHEN 2 THEN k || '|' || v ELSE k || '|' || v || '|more' END AS fields, CAST(NULL AS VARCHAR) AS detail FROM fld WHERE NOT unread
UNION ALL SELECT file_name, 'header', 0, 'a|b', NULL FROM fil WHERE NOT unread UNION ALL SELECT file_name, 'failure', NULL, NULL, 'CSV_PARSE_ERROR(record=' || CAST(received + 1 AS VARCHAR) || ')' FROM fil WHERE unread""",
)
def _(spark, d):
    return landing.read_strict_csv(_csv_files(spark, d)[0]).select("file_name", "kind", "row_number", F.array_join("fields", "|").alias("fields"), "detail")


FAILURES_SQL = f"""WITH {CSV_SQL}, shape AS (SELECT f, n, width, row_number() OVER (PARTITION BY f ORDER BY n) AS nth, count(*) OVER (PARTITION BY f) AS bad FROM fld WHERE NOT unread AND width <> 2),
fails AS (SELECT f, 'SHA256_MISMATCH' AS code, CAST(NULL AS VARCHAR) AS detail FROM fil WHERE other_hash UNION ALL SELECT f, 'CSV_PARSE_ERROR', 'record=' || CAST(received + 1 AS VARCHAR) FROM fil WHERE unread
  UNION ALL SELECT f, 'MALFORMED_RECORD', 'record=' || n || ',fields=' || width || ',expected=2' FROM shape WHERE nth <= 5 UNION ALL (SELECT DISTINCT f, 'MALFORMED_RECORD', 'additional_records=' || CAST(bad - 5 AS VARCHAR) FROM shape WHERE bad > 5)
  UNION ALL SELECT f, 'ROW_COUNT_MISMATCH', 'expected=' || row_count || ',received=' || received FROM fil WHERE NOT unread AND row_count <> received)"""


@query("csv_records_in_ranges", SQL["csv_records"])
def _(spark, d):
    files = _csv_files(spark, d)[0].persist()
    ranges = csv_ranges.cut(files, 1000)  # every file in many ranges, cut inside quotes too
    return csv_ranges.read_strict_csv_ranges(ranges, files).select("file_name", "kind", "row_number", F.array_join("fields", "|").alias("fields"), "detail")


@query("file_checks", FAILURES_SQL + " SELECT file_name, code, detail FROM fails JOIN fil USING (f)")
def _(spark, d):
    files, entries = _csv_files(spark, d)
    return landing.check_files(files, entries, landing.read_strict_csv(files).persist(), _contracts(spark))[0].select("file_name", "code", "detail")


@query("record_shapes", FAILURES_SQL + " SELECT file_name, detail FROM fails JOIN fil USING (f) WHERE code = 'MALFORMED_RECORD'")
def _(spark, d):
    return landing.block_shape_failures(landing.read_blocks(_csv_files(spark, d)[0])).select("file_name", "detail")


@query(
    "batch_decisions",
    FAILURES_SQL
    + """, own AS (SELECT f, string_agg(DISTINCT code, '|' ORDER BY code) AS codes FROM fails GROUP BY f), x AS (SELECT fil.*, codes, max(codes IS NOT NULL) OVER (PARTITION BY batch_id) AS rejected FROM fil LEFT JOIN own USING (f))
SELECT batch_id, file_name, row_count AS expected_count, CASE WHEN NOT unread THEN received END AS received_count, CASE WHEN rejected THEN 'REJECTED' ELSE 'ACCEPTED' END AS status, CASE WHEN rejected THEN coalesce(codes, 'SIBLING_FILE_REJECTED') ELSE '' END AS codes FROM x""",
)
def _(spark, d):
    files, entries = (x.persist() for x in _csv_files(spark, d))
    records = landing.read_strict_csv(files).persist()  # parsed once, asked several things
    failures, _ = landing.check_files(files, entries, records, _contracts(spark))
    received = records.filter("kind <> 'failure'").groupBy("batch_id", "file_name").agg(F.count_if(F.col("kind") == "record").alias("received"))
    decided = landing.decide_batches(entries, failures.limit(0), failures, received)
    codes = F.array_join(F.array_sort(F.array_distinct(clean.audit_codes(F.col("reason")))), "|")
    return decided.select("batch_id", "file_name", "expected_count", "received_count", "status", codes.alias("codes"))


@query("canonical_rows", f"WITH {CSV_SQL} SELECT file_name, CAST(n AS INTEGER) AS source_row_number, 'v1' AS schema_version, v AS b, CAST(k AS VARCHAR) AS a, CAST(NULL AS VARCHAR) AS c FROM fld JOIN fil USING (f) WHERE NOT fil.unread AND width = 2")
def _(spark, d):
    files, entries = _csv_files(spark, d)
    by = ["batch_id", "file_name"]
    listed = files.select(*by, "content").join(entries.select(*by, "source_system"), by)  # before files are taken apart: they are few, their rows many
    blocks = landing.read_blocks(listed, carried=["source_system"])
    matched = landing.match_headers(blocks.withColumnRenamed("header", "fields"), _contracts(spark)).filter("version IS NOT NULL").withColumnRenamed("source_system", "file_source_system")
    records = landing.records_of(matched, kept=["file_source_system", "version", "canonical"])
    whole = records.filter("kind = 'record' AND size(fields) = 2")  # only batches without malformed records come this far
    return landing.canonical_values(whole, ["b", "a", "c"]).select("file_name", "source_row_number", "schema_version", "b", "a", "c")


@query(
    "manifest_problems",
    """WITH m AS (SELECT o_orderkey AS k, o_orderkey % 7 AS r FROM orders)
SELECT CAST(k AS VARCHAR) AS batch_id, code, detail FROM (
  SELECT k, 'MANIFEST_MISSING' AS code, CAST(NULL AS VARCHAR) AS detail FROM m WHERE r = 0 UNION ALL SELECT k, 'MANIFEST_INVALID', 'not UTF-8 JSON' FROM m WHERE r = 1 UNION ALL SELECT k, 'BATCH_ID_MISMATCH', 'manifest batch_id differs from folder name' FROM m WHERE r = 2
  UNION ALL SELECT k, 'MANIFEST_INVALID', 'entry=1,field=row_count' FROM m WHERE r = 3 UNION ALL SELECT k, 'UNKNOWN_SOURCE_SYSTEM', 'entry=1' FROM m WHERE r = 4 UNION ALL SELECT k, 'UNEXPECTED_FILE', 'count=1' FROM m WHERE r = 5
  UNION ALL SELECT k, 'FILE_MISSING', 'entry=1' FROM m WHERE r = 5)""",
)
def _(spark, d):
    k = F.col("o_orderkey")
    r, name = k % 7, k.cast("string")
    entry = F.concat(F.lit('{"file_name": "a.csv", "source_system": "'), F.when(r == 4, "Z").otherwise("A"), F.lit('", "row_count": '), F.when(r == 3, '"1"').otherwise("1"), F.lit(', "sha256": "'), F.lit("0" * 64), F.lit('"}'))
    text = F.when(r == 1, "{").otherwise(F.concat(F.lit('{"batch_id": "'), F.when(r == 2, "other").otherwise(name), F.lit('", "delivered_at": "2024-01-01T00:00:00Z", "files": ['), entry, F.lit("]}")))
    data = F.struct(F.when(r == 5, "b.csv").otherwise("a.csv").alias("file_name"), F.lit("x").alias("text"))
    every = F.filter(F.array(F.when(r != 0, F.struct(F.lit(landing.MANIFEST).alias("file_name"), text.alias("text"))), data), lambda x: x.isNotNull())
    files = views.table(spark, d, "orders").select(name.alias("batch_id"), F.inline(every)).select("batch_id", "file_name", F.encode("text", "UTF-8").alias("content"), F.lit("").alias("sha256"))
    contracts = spark.createDataFrame([("A", "a.csv")], "source_system string, file_name string")
    return landing.read_manifests(files, contracts)[1].select("batch_id", "code", "detail")
