import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewell.functions import cleaning as c
from tidewell.functions import keys


def cleaned(spark, column, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("c", column()).select("i", "c.*").orderBy("i").collect()
    return [(r["value"], r["reason"], r["warning"]) for r in rows]


def stepwise(spark, clean_field, texts):
    rows = clean_field(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")).select("i", "x.*").orderBy("i").collect()
    return [(r["value"], r["reason"], r["warning"]) for r in rows]


def test_vocabulary(spark):
    words = c.vocabulary(spark)
    assert c.vocabulary_problems(words).count() == 0 and words.count() == 26 + 11 + 23
    assert c.vocabulary_problems(words.union(spark.sql("SELECT 'claim_status', 'DENIED', ' paid', 'PAID'"))).collect() == [("claim_status", "PAID")]


def test_amounts(spark):
    cases = {
        "$1,234.50": Decimal("1234.50"), "USD 7": Decimal("7.00"), "7usd": Decimal("7.00"), "1.5K": Decimal("1500.00"), " 12 ": Decimal("12.00"), "0.10": Decimal("0.10"), "1.500": Decimal("1.50"), " 5 ": Decimal("5.00"),
        "1.234567 K": "AMOUNT_FRACTIONAL_CENTS", "1.23456 K": Decimal("1234.56"), "1.005": "AMOUNT_FRACTIONAL_CENTS", "-5": "AMOUNT_UNPARSEABLE", "1,23": "AMOUNT_UNPARSEABLE", "$5 USD": "AMOUNT_UNPARSEABLE", "5\n": Decimal("5.00"), "": "AMOUNT_MISSING",
        None: "AMOUNT_MISSING", "tbd": "AMOUNT_PLACEHOLDER", "#n/a": "AMOUNT_SPREADSHEET_ERROR", "٣": "AMOUNT_UNPARSEABLE", "9" * 40: "AMOUNT_UNPARSEABLE",
        "1,234,567": Decimal("1234567.00"), "9,9999": "AMOUNT_UNPARSEABLE", "1,234,5678": "AMOUNT_UNPARSEABLE", "1234,567": "AMOUNT_UNPARSEABLE", ",123": "AMOUNT_UNPARSEABLE", "12,345,67": "AMOUNT_UNPARSEABLE", "USD": "AMOUNT_UNPARSEABLE", "$": "AMOUNT_UNPARSEABLE", "k": "AMOUNT_UNPARSEABLE",
        "usd\t3 k  USD": "AMOUNT_UNPARSEABLE", "3 k  USD": Decimal("3000.00"), "1.": "AMOUNT_UNPARSEABLE", "1.2.3": "AMOUNT_UNPARSEABLE", "$ 8": Decimal("8.00"), "5 5": "AMOUNT_UNPARSEABLE", "u\u017fd 5": "AMOUNT_UNPARSEABLE",
    }
    for got, want in zip(stepwise(spark, lambda d: c.clean_amount(d, "x", F.col("t")), cases), cases.values(), strict=True):
        assert got == ((want, None, None) if isinstance(want, Decimal) else (None, want, None))
    cents = {"12345": Decimal("123.45"), "1.0": Decimal("0.01"), "1.5": "AMOUNT_FRACTIONAL_CENTS", "5K": "AMOUNT_K_SUFFIX_NOT_ALLOWED", "$5": "AMOUNT_UNPARSEABLE"}
    for got, want in zip(stepwise(spark, lambda d: c.clean_amount(d, "x", F.col("t"), "USD_CENTS"), cents), cents.values(), strict=True):
        assert got[:2] == ((want, None) if isinstance(want, Decimal) else (None, want))


@pytest.mark.parametrize("order, day", [("MDY", datetime.date(2024, 3, 5)), ("DMY", datetime.date(2024, 5, 3))])
def test_dates(spark, order, day):
    texts = ["03/05/2024", "3-5-2024", "2024-03-05", "2024-03-05T23:59:59", "Mar 5, 2024", "5 March 2024", "Sept. 5 2023", "03/05/24", "2024-02-30", "2024-03-05T24:00:00", "03/05-2024", "Foo 5, 2024", "0000-01-01", "N/A", " ", "2024-03-07", "2024-03-05\n", "2024-03-05t10:00:00", "2024-03-05TT10:00:00", "Mar. 05, 2024", "5 Mar. 2024", "5 Mar, 2024", "3/5/024", "2024-3-5"]
    got = stepwise(spark, lambda d: c.clean_date(d, "x", F.col("t"), order, None, F.to_date(F.lit("2024-06-01"))), texts)
    march = datetime.date(2024, 3, 5)
    want = [day, day, march, march, march, march, datetime.date(2023, 9, 5), "DATE_CENTURY_UNKNOWN", "DATE_INVALID", "DATE_INVALID", "DATE_UNPARSEABLE", "DATE_UNPARSEABLE", "DATE_INVALID", "DATE_PLACEHOLDER", "DATE_MISSING", datetime.date(2024, 3, 7), march, "DATE_UNPARSEABLE", "DATE_UNPARSEABLE", march, march, "DATE_UNPARSEABLE", "DATE_UNPARSEABLE", "DATE_UNPARSEABLE"]
    assert [g[0] or g[1] for g in got] == want
    late = stepwise(spark, lambda d: c.clean_date(d, "x", F.col("t"), order, 2000, F.to_date(F.lit("2024-03-06"))), ["01/01/24", "2024-03-07", "2024-03-06"])
    assert [x[0] or x[1] for x in late] == [datetime.date(2024, 1, 1), "DATE_AFTER_DELIVERY", datetime.date(2024, 3, 6)]


def test_timestamps_know_gaps_and_overlaps(spark):
    texts = ["2024-03-10 02:30:00", "2024-11-03 01:30:00", "2024-07-01T12:00:00Z", "2024-07-01 12:00:00-05:00", "07/01/2024 12:00:00", "2024-07-01 12:00:60", "2024-07-01 12:00:00+24:00", "2024-07-01", "pending", None]
    got = stepwise(spark, lambda d: c.clean_timestamp(d, "x", F.col("t"), "America/Chicago", "MDY"), texts)
    noon = datetime.datetime(2024, 7, 1, 12)
    assert [g[0] or g[1] for g in got] == [
        "TIMESTAMP_NONEXISTENT_LOCAL_TIME", datetime.datetime(2024, 11, 3, 6, 30), noon, noon.replace(hour=17), noon.replace(hour=17), "TIMESTAMP_INVALID", "TIMESTAMP_INVALID", "TIMESTAMP_UNPARSEABLE", "TIMESTAMP_PLACEHOLDER", "TIMESTAMP_MISSING",
    ]
    assert [g[2] for g in got] == [None, "TIMESTAMP_AMBIGUOUS_LOCAL_TIME", *[None] * 8]


def test_categories_codes_and_numbers(spark):
    assert stepwise(spark, lambda d: c.clean_encounter_type(d, "x", F.col("t")), ["walk - in  urgent", "", "ufo", "Other"]) == [("URGENT_CARE", None, None), ("UNKNOWN", None, "ENCOUNTER_TYPE_MISSING"), (None, "ENCOUNTER_TYPE_UNMAPPED", None), ("UNKNOWN", None, None)]
    assert stepwise(spark, lambda d: c.clean_claim_status(d, "x", F.col("t")), ["voided", None])[1] == (None, "CLAIM_STATUS_MISSING", None)
    assert cleaned(spark, lambda: c.clean_icd10(F.col("t"), F.lit(False)), ["e119", "E11.9-x", "250.00", "E1", "n/a"]) == [("E11.9", None, "DX_NOT_IN_REFERENCE"), ("E11.9", None, "DX_NOT_IN_REFERENCE"), (None, "DX_ICD9", None), (None, "DX_UNPARSEABLE", None), (None, "DX_PLACEHOLDER", None)]
    good = "1234567893"
    wrong = [good[:i] + str((int(good[i]) + 1) % 10) + good[i + 1 :] for i in range(10)]
    got = cleaned(spark, lambda: c.clean_npi(F.col("t")), [good, good + ".0", "123", *wrong])
    assert [g[0] or g[1] for g in got] == [good, good, "NPI_INVALID_FORMAT", *["NPI_CHECKSUM_FAILED"] * 10]
    assert cleaned(spark, lambda: c.clean_last_name(F.col("t")), ["O'Neil-Ág 2", "--"]) == [("ONEILÁG2", None, None), (None, "LAST_NAME_MISSING", None)]
    assert cleaned(spark, lambda: c.clean_first_name(F.col("t")), [" Mary\tAnn"])[0][0] == "MARY"
    assert [x[0] or x[1] for x in cleaned(spark, lambda: c.zip3(F.col("t")), ["12345-6789", "12345", "1234", ""])] == ["123", "123", "ZIP_INVALID", "ZIP_MISSING"]


def test_ages_and_stays(spark):
    rows = spark.sql("SELECT * FROM VALUES (DATE'2004-02-29', DATE'2022-02-28'), (DATE'2004-02-29', DATE'2022-03-01'), (DATE'2023-01-01', DATE'2022-01-01'), (NULL, DATE'2022-01-01') AS t(b, a)")
    got = rows.withColumn("x", c.age_band(F.col("b"), F.col("a"))).withColumn("s", c.length_of_stay(F.col("b"), F.col("a"))).collect()
    assert [(r["x"]["value"], r["x"]["warning"]) for r in got] == [("0-17", None), ("18-39", None), ("UNKNOWN", "AGE_BAND_DOB_AFTER_ADMIT"), ("UNKNOWN", "AGE_BAND_DOB_UNAVAILABLE")]
    assert [r["s"]["reason"] for r in got] == [None, None, "DISCHARGE_BEFORE_ADMIT", "LENGTH_OF_STAY_ADMIT_UNAVAILABLE"]


def test_keys_and_shares(spark):
    import hashlib
    import hmac

    row = spark.range(1).select(keys.json_key("v", F.lit('é"\\')).alias("k"), keys.keyed_hash(b"s", F.array(F.lit("a"), F.lit("é"))).alias("h"), c.observed_pct(F.lit(2469), F.lit(20000)).alias("p"), c.observed_pct(F.lit(0), F.lit(0)).alias("n")).first()
    assert row["k"] == hashlib.sha256('["v","é\\"\\\\"]'.encode()).hexdigest()
    assert row["h"] == hmac.new(b"s", '["a","é"]'.encode(), hashlib.sha256).hexdigest()
    assert row["p"] == Decimal("12.34") and row["n"] is None
    codes = spark.range(1).select(c.audit_codes(F.lit("A_B; C(x=1,y=2);  ")).alias("c")).first()["c"]
    assert codes == ["A_B", "C"]
