"""Plans that must stay good for many rows: no method too long to be compiled, no frame per small file."""

from tests.conftest import SF
from tests.test_csv_ranges import ODD, generated, rows
from tidewell.plans import catalogue
from tidewell.sources import csv_ranges, landing


def test_cleaned_fields_compile_and_rows_stay_in_their_tasks(spark):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan shows its code only after it ran
    try:
        execution = catalogue.queries()["cleaned_fields"](spark, SF)._jdf.queryExecution()
        code = execution.debug().codegenToSeq()
        assert max(code.apply(i)._3().maxMethodCodeSize() for i in range(code.size())) < 8000  # HotSpot interprets longer ones
        plan = execution.executedPlan().toString()
        assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_ranges_of_many_files_share_batches(spark):
    schema = csv_ranges.arrow_schema(csv_ranges.STATES)
    rows = [("b", f"f{i}", 0, 0, False, i, None) for i in range(csv_ranges.ROWS + 1)]
    assert [b.num_rows for b in csv_ranges.batched(rows, schema)] == [csv_ranges.ROWS, 1]
    large = [("b", "f", 0, i, b"x" * (csv_ranges.BATCH_BYTES // 2)) for i in range(3)]
    assert [b.num_rows for b in csv_ranges.batched(large, csv_ranges.arrow_schema(csv_ranges.RANGES), sized=(4,))] == [2, 1]
    plan = catalogue.queries()["csv_records_in_ranges"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "InPandas" not in plan  # a frame per range, file or record costs milliseconds


def test_small_files_share_batches(spark):
    plan = catalogue.queries()["csv_records"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "InPandas" not in plan


def test_canonical_rows_come_in_batches(spark):
    plan = catalogue.queries()["canonical_rows"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "InPandas" not in plan


def test_record_shapes_come_in_batches(spark):
    plan = catalogue.queries()["record_shapes"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "InPandas" not in plan


def test_canonical_rows_are_parsed_once(spark):
    plan = catalogue.queries()["canonical_rows"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_record_shapes_are_parsed_once_and_meet_no_headers(spark):
    plan = catalogue.queries()["record_shapes"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan


def test_blocks_of_any_size_hold_the_same_records(spark):
    wide = b"a,b\n" + b"".join(b"1\n" if i % 3 == 0 else b'"x\ny",2\n' for i in range(40))  # more wrong records than are listed
    contents = [*ODD, wide, *(generated(i) for i in range(60))]
    files = spark.createDataFrame([("batch_001", f"f{i}.csv", bytearray(c)) for i, c in enumerate(contents)], "batch_id string, file_name string, content binary").repartition(4)
    sequential = rows(csv_ranges.read_strict_csv_ranges(csv_ranges.cut(files), files))
    listed = lambda df: sorted(df.select("file_name", "position", "code", "detail").collect())
    shapes = listed(landing.record_shape_failures(landing.read_strict_csv(files)))
    assert sum(r["file_name"] == f"f{len(ODD)}.csv" for r in shapes) == landing.LISTED + 1
    for held in (0, 20, landing.HELD_BYTES):
        blocks = landing.read_blocks(files, held=held)
        assert rows(landing.records_of(blocks)) == sequential
        assert listed(landing.block_shape_failures(blocks)) == shapes
    assert landing.read_blocks(files, held=20).filter("file_name = 'f%d.csv'" % len(ODD)).count() > 5
