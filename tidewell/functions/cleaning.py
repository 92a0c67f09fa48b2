"""Field cleaning: delivered text -> ``struct<value, reason, warning>``.

A blank field, a placeholder or a text that can't be read gives a null value with a reason code; a value that is used but
doubtful carries a warning. Nothing here raises on data, whatever the session's ANSI setting: only ``try_`` casts are used.

Amounts, dates, times and categories take and return a table, since they work in steps (``text.Steps``): a text is taken apart once, by its shape
(digits as 9, letters as a) and its tokens; which layout it has is then a look at a short list of shapes. The other fields are column expressions.
"""

from __future__ import annotations

from string import ascii_letters, ascii_uppercase, digits

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import PLACEHOLDERS, Steps, collapse, field, first_reason, full, is_placeholder, lookup, normalise_key, strip

USD, USD_CENTS = "USD", "USD_CENTS"
MDY, DMY = "MDY", "DMY"

# What spreadsheets write into broken cells.
SPREADSHEET_ERRORS = ("#NULL!", "#DIV/0!", "#VALUE!", "#REF!", "#NAME?", "#NUM!", "#N/A", "#SPILL!", "#CALC!")

# Known spellings by category.
ENCOUNTER_TYPES = {
    "EMERGENCY": ("ED", "ER", "Emergency", "Emergency Room", "EMERGENCY DEPT"),
    "INPATIENT": ("Inpatient", "IP", "INPT", "IN-PATIENT", "inpatient admission"),
    "OBSERVATION": ("Observation", "OBS", "Obs Stay"),
    "OUTPATIENT": ("Outpatient", "OP", "Out Patient", "Office Visit", "Clinic Visit"),
    "TELEHEALTH": ("Telehealth", "TELEMED", "Video Visit", "Virtual"),
    "URGENT_CARE": ("Urgent Care", "UC", "Walk-in Urgent"),
    "UNKNOWN": ("OTHER",),
}
CLAIM_STATUSES = {
    "PAID": ("Paid", "Paid in Full", "Closed-Paid"),
    "DENIED": ("Denied", "Rejected"),
    "SUBMITTED": ("Submitted", "Pending", "In Process"),
    "VOID": ("Void", "VOIDED", "Cancelled"),
}
PAYER_CATEGORIES = {
    "MEDICARE": ("Medicare", "MCR", "Medicare Part A", "Medicare - Part B"),
    "MEDICAID": ("Medicaid", "IA Medicaid", "State Medicaid Plan", "BadgerCare Plus"),
    "COMMERCIAL": ("Aetna", "Aetna Inc", "Cigna", "Cigna Health", "UnitedHealthcare", "UHC", "BCBS", "Blue Cross Blue Shield"),
    "SELF_PAY": ("Self Pay", "Self-Pay", "SelfPay", "Uninsured"),
    "OTHER": ("TRICARE", "Workers Comp"),
    "UNKNOWN": ("N/A",),
}
# Names of months.
MONTHS = {
    "jan": 1, "january": 1, "feb": 2, "february": 2, "mar": 3, "march": 3, "apr": 4, "april": 4, "may": 5, "jun": 6, "june": 6,
    "jul": 7, "july": 7, "aug": 8, "august": 8, "sep": 9, "sept": 9, "september": 9, "oct": 10, "october": 10, "nov": 11, "november": 11, "dec": 12, "december": 12,
}


VOCABULARIES = {"encounter_type": ENCOUNTER_TYPES, "claim_status": CLAIM_STATUSES, "payer_category": PAYER_CATEGORIES}


def vocabulary(spark: SparkSession) -> DataFrame:
    """The spellings as a relation: field, category, spelling, and the key by which delivered texts find them."""
    rows = [(name, category, spelling) for name, table in VOCABULARIES.items() for category, spelled in table.items() for spelling in spelled]
    return spark.createDataFrame(rows, "field string, category string, spelling string").withColumn("key", normalise_key(F.col("spelling")))


def vocabulary_problems(words: DataFrame) -> DataFrame:
    """Keys that belong to two categories of one field; none: the vocabulary may be used."""
    return words.groupBy("field", "key").agg(F.count_distinct("category").alias("n")).filter("n > 1").select("field", "key")


def _blank(text: Column, prefix: str) -> list[tuple[Column, str]]:
    return [(text == "", f"{prefix}_MISSING"), (F.upper(text).isin(*PLACEHOLDERS), f"{prefix}_PLACEHOLDER")]


def _all_digits(c: Column) -> Column:
    return (c != "") & (F.translate(c, digits, "") == "")


def _shape(text: Column) -> Column:
    return F.translate(text, digits + ascii_letters, "9" * len(digits) + "a" * len(ascii_letters))


def _as_column(x: Column | str) -> Column:
    return F.lit(x) if isinstance(x, str) else x


#: What may stand between a number and its marks.
INNER_SPACE = " \t\n\r\f\v"


def clean_amount(df: DataFrame, out: str, c: Column, unit: Column | str = USD) -> DataFrame:
    """``df`` with ``out``: money as DECIMAL(18,2) dollars. Amounts too large for that type count as unparseable.

    Marks are taken off the ends first (currency before or after, then K); what is left must be a number: groups of three after commas, or none.
    """
    s = Steps(df, out)
    s.add(text=strip(c), cents=_as_column(unit) == USD_CENTS)
    s.add(upper=F.translate(s["text"], "usdk", "USDK"))
    t = s["upper"]
    s.add(lead=F.when(F.startswith(t, F.lit("USD")), 3).when(F.startswith(t, F.lit("$")), 1).otherwise(0), tail=F.when(F.endswith(t, F.lit("USD")), 3).otherwise(0))
    s.add(body=F.btrim(F.substring(t, s["lead"] + 1, F.length(t) - s["lead"] - s["tail"]), F.lit(INNER_SPACE)))
    s.add(kilo=F.endswith(s["body"], F.lit("K")))
    s.add(number=F.when(s["kilo"], F.rtrim(F.substring(s["body"], F.lit(1), F.length(s["body"]) - 1), F.lit(INNER_SPACE))).otherwise(s["body"]))
    s.add(whole=F.substring_index(s["number"], ".", 1), dotted=F.contains(s["number"], F.lit(".")))
    s.add(fraction=F.when(s["dotted"], F.substring(s["number"], F.length(s["whole"]) + 2, F.length(s["number"]))).otherwise("0"), plain=F.translate(s["whole"], ",", ""), groups=_shape(s["whole"]))
    first = F.replace(s["groups"], F.lit(",999"), F.lit(""))  # the first group, if the others have three digits each
    grouped = (s["plain"] == s["whole"]) | (F.length(first).between(1, 3) & (first == F.substring_index(s["groups"], ",", 1)))
    s.add(read=_all_digits(s["plain"]) & grouped & _all_digits(s["fraction"]), places=F.length(F.rtrim(s["fraction"], F.lit("0"))))
    exact = F.concat(s["plain"], F.lit("."), F.rpad(F.substring(s["fraction"], 1, 5), 5, "0")).try_cast("decimal(38,5)")
    s.add(exact=F.when(s["read"], exact))
    s.add(dollars=F.when(s["cents"], s["exact"] / 100).when(s["kilo"], s["exact"] * 1000).otherwise(s["exact"]).try_cast("decimal(18,2)"))
    marked = (s["lead"] > 0).cast("int") + (s["tail"] > 0).cast("int")
    reason = first_reason(
        *_blank(s["text"], "AMOUNT"),
        (F.upper(s["text"]).isin(*SPREADSHEET_ERRORS), "AMOUNT_SPREADSHEET_ERROR"),
        (~s["read"] | (marked > 1), "AMOUNT_UNPARSEABLE"),
        (s["cents"] & s["kilo"], "AMOUNT_K_SUFFIX_NOT_ALLOWED"),
        (s["cents"] & (marked > 0), "AMOUNT_UNPARSEABLE"),
        (s["places"] > F.when(s["cents"], 0).when(s["kilo"], 5).otherwise(2), "AMOUNT_FRACTIONAL_CENTS"),
        (s["dollars"].isNull(), "AMOUNT_UNPARSEABLE"),
    )
    return s.done(s["dollars"], reason)


def clean_category(df: DataFrame, out: str, c: Column, table: dict[str, tuple[str, ...]], prefix: str, blank: str | None = None) -> DataFrame:
    """``df`` with ``out``: a category by spelling. A blank is ``blank`` with a warning, or a reason if there is none for it."""
    keyed = F.create_map(*[x for category, spelled in table.items() for spelling in spelled for x in (normalise_key(F.lit(spelling)), F.lit(category))])
    s = Steps(df, out)
    s.add(text=strip(c))
    s.add(found=F.when(s["text"] == "", F.lit(blank)).otherwise(F.try_element_at(keyed, normalise_key(s["text"]))))
    missing, unmapped = F.lit(f"{prefix}_MISSING"), F.lit(f"{prefix}_UNMAPPED")
    if blank is None:
        return s.done(s["found"], F.when(s["text"] == "", missing).when(s["found"].isNull(), unmapped))
    return s.done(s["found"], F.when(s["found"].isNull(), unmapped), F.when(s["text"] == "", missing))


def clean_encounter_type(df: DataFrame, out: str, c: Column) -> DataFrame:
    return clean_category(df, out, c, ENCOUNTER_TYPES, "ENCOUNTER_TYPE", "UNKNOWN")


def clean_claim_status(df: DataFrame, out: str, c: Column) -> DataFrame:
    return clean_category(df, out, c, CLAIM_STATUSES, "CLAIM_STATUS")


def clean_payer_category(df: DataFrame, out: str, c: Column) -> DataFrame:
    return clean_category(df, out, c, PAYER_CATEGORIES, "PAYER", "UNKNOWN")


def _wall(year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column) -> Column:
    """A wall-clock time, or null if there is no such time. Years start at 1; seconds end at 59."""
    ok = (year >= 1) & (hour < 24) & (minute < 60) & (second < 60)
    return F.when(ok, F.try_make_timestamp_ntz(year, month, day, hour, minute, second.cast("decimal(16,6)")))


ONE_OR_TWO = ("9", "99")
#: Layouts as shapes; runs of letters count as one.
ISO_DAY, ISO_MOMENT = "9999-99-99", "9999-99-99a99:99:99"
NUMBERS = [f"{a}{x}{b}{x}" for x in "/-" for a in ONE_OR_TWO for b in ONE_OR_TWO]
MONTH_FIRST = [f"a{dot} {d}{comma} 9999" for dot in ("", ".") for d in ONE_OR_TWO for comma in ("", ",")]
DAY_FIRST = [f"{d} a{dot} 9999" for dot in ("", ".") for d in ONE_OR_TWO]


def clean_date(df: DataFrame, out: str, c: Column, order: Column | str, century: Column | int | None, delivered: Column) -> DataFrame:
    """``df`` with ``out``: a DATE no later than ``delivered`` (a DATE in UTC). ``century`` is added to two-digit years; null: none is known."""
    s = Steps(df, out)
    s.add(text=strip(c))
    s.add(shape=F.regexp_replace(_shape(s["text"]), "a+", "a"), token=F.split(s["text"], "[^0-9A-Za-z]+"), mdy=_as_column(order) == MDY, century=F.lit(century).cast("int") if century is None or isinstance(century, int) else century)
    timed = (s["shape"] == ISO_MOMENT) & (F.substring(s["text"], 11, 1) == "T") & (F.length(s["text"]) == len(ISO_MOMENT))
    layout = F.when((s["shape"] == ISO_DAY) | timed, "iso").when(s["shape"].isin(*[f"{n}{y}" for n in NUMBERS for y in ("99", "9999")]), "numbers").when(s["shape"].isin(*MONTH_FIRST), "month first").when(s["shape"].isin(*DAY_FIRST), "day first")
    s.add(layout=layout)
    token = lambda i: F.get(s["token"], F.lit(i))
    kind = lambda *values: F.when(s["layout"] == "iso", values[0]).when(s["layout"] == "numbers", values[1]).when(s["layout"] == "month first", values[2]).when(s["layout"] == "day first", values[3])
    name = lambda i: lookup(MONTHS, F.lower(token(i)))
    number = lambda x: x.try_cast("int")
    swap = lambda a, b: F.when(s["mdy"], a).otherwise(b)
    s.add(
        short=(s["layout"] == "numbers") & (F.length(token(2)) == 2),
        year=number(kind(token(0), token(2), token(2), token(2))),
        month=kind(number(token(1)), number(swap(token(0), token(1))), name(0), name(1)),
        day=number(kind(F.substring(token(2), 1, 2), swap(token(1), token(0)), token(1), token(0))),
        clock=F.when((s["layout"] == "iso") & (s["shape"] == ISO_MOMENT), F.array(*[number(F.substring(s["text"], at, 2)) for at in (12, 15, 18)])).otherwise(F.array(*[F.lit(0)] * 3)),
    )
    year = F.when(s["short"], s["year"] + s["century"]).otherwise(s["year"])
    s.add(read=_wall(year, s["month"], s["day"], *[F.get(s["clock"], F.lit(i)) for i in range(3)]).cast("date"))
    reason = first_reason(
        *_blank(s["text"], "DATE"),
        (s["layout"].isNull() | (s["layout"].endswith("first") & s["month"].isNull()), "DATE_UNPARSEABLE"),
        (s["short"] & s["century"].isNull(), "DATE_CENTURY_UNKNOWN"),
        (s["read"].isNull(), "DATE_INVALID"),
        (s["read"] > delivered, "DATE_AFTER_DELIVERY"),
    )
    return s.done(s["read"], reason)


ISO_STAMPS = [f"9999-99-99{x}99:99:99{y}" for x in "a " for y in ("", "a", "+99:99", "-99:99")]


def clean_timestamp(df: DataFrame, out: str, c: Column, zone: Column | str, order: Column | str) -> DataFrame:
    """``df`` with ``out``: an instant as UTC TIMESTAMP_NTZ. Without an offset the text is local time of ``zone``: a time that the zone skips is no value, of
    a time that it has twice the earlier instant is taken, with a warning."""
    zone = _as_column(zone)
    s = Steps(df, out)
    s.add(text=strip(c), mdy=_as_column(order) == MDY)
    s.add(shape=_shape(s["text"]), rest=F.upper(F.substring(s["text"], 20, 6)))
    at = lambda i, n: F.substring(s["text"], i, n).try_cast("int")
    iso = s["shape"].isin(*ISO_STAMPS) & F.substring(s["text"], 11, 1).isin("T", "t", " ") & ((F.length(s["text"]) != 20) | (s["rest"] == "Z"))
    s.add(iso=iso, numbers=s["shape"].isin(*[f"{n}9999 99:99:99" for n in NUMBERS]), token=F.split(s["text"], "[^0-9]+"))
    token = lambda i: F.get(s["token"], F.lit(i)).try_cast("int")
    swap = lambda a, b: F.when(s["mdy"], token(a)).otherwise(token(b))
    pick = lambda fixed, free: F.when(s["iso"], fixed).when(s["numbers"], free)
    wall = _wall(pick(at(1, 4), token(2)), pick(at(6, 2), swap(0, 1)), pick(at(9, 2), swap(1, 0)), pick(at(12, 2), token(3)), pick(at(15, 2), token(4)), pick(at(18, 2), token(5)))
    # only digits are cast: a cast that fails costs many times one that doesn't
    shifted = s["iso"] & (F.length(s["rest"]) == 6)
    hours, minutes = (F.when(shifted, F.substring(s["rest"], i, 2).try_cast("int")) for i in (2, 5))
    sign = F.when(F.startswith(s["rest"], F.lit("-")), -1).otherwise(1)
    s.add(wall=wall, off=F.when(s["rest"] == "Z", 0).when((hours <= 23) & (minutes <= 59), (hours * 60 + minutes) * sign), stated=s["iso"] & (s["rest"] != ""))
    s.add(local=F.when(~s["stated"], F.convert_timezone(zone, F.lit("UTC"), s["wall"])))
    back = lambda t: F.convert_timezone(F.lit("UTC"), zone, t) == s["wall"]
    s.add(skipped=~back(s["local"]), twice=back(s["local"] + F.expr("INTERVAL '1' HOUR")))
    reason = first_reason(
        *_blank(s["text"], "TIMESTAMP"),
        (~(s["iso"] | s["numbers"]), "TIMESTAMP_UNPARSEABLE"),
        (s["wall"].isNull() | (s["stated"] & s["off"].isNull()), "TIMESTAMP_INVALID"),
        (s["skipped"], "TIMESTAMP_NONEXISTENT_LOCAL_TIME"),
    )
    instant = F.when(s["stated"], s["wall"] - F.make_dt_interval(F.lit(0), F.lit(0), s["off"])).otherwise(s["local"])
    return s.done(instant, reason, F.when(s["twice"], F.lit("TIMESTAMP_AMBIGUOUS_LOCAL_TIME")))


def clean_icd10(c: Column, in_reference: Column | None = None) -> Column:
    """A diagnosis code in dotted form. ``in_reference``: whether the reference has it (see ``icd10_code``)."""
    text = strip(c)
    head = F.upper(strip(F.substring_index(text, "-", 1)))
    code = icd10_code(c)
    reason = first_reason(
        (text == "", "DX_MISSING"),
        (is_placeholder(text), "DX_PLACEHOLDER"),
        (shape(head).isin("999", "999.9", "999.99"), "DX_ICD9"),
        (~is_icd10(code), "DX_UNPARSEABLE"),
    )
    warning = None if in_reference is None else F.when(~F.coalesce(in_reference, F.lit(False)), F.lit("DX_NOT_IN_REFERENCE"))
    return field(code, reason, warning)


def resolve_icd10(df: DataFrame, out: str, c: Column, known: DataFrame) -> DataFrame:
    """``df`` with ``out``: ``clean_icd10`` in steps, with the reference ``known`` (icd10_code) looked up by the code."""
    s = Steps(df, out)
    s.add(text=strip(c))
    s.add(head=F.upper(strip(F.substring_index(s["text"], "-", 1))))
    s.add(code=_dotted(s["head"]))
    reference = known.select(F.col("icd10_code").alias(f"_{out}_dx"), F.lit(True).alias(f"_{out}_known"))
    s.df = s.df.join(reference, s["code"] == s["dx"], "left")
    s.names += [f"_{out}_dx", f"_{out}_known"]
    s.add(looks=shape(s["code"]))
    s.add(read=_is_icd10_shape(s["looks"]))
    reason = first_reason((s["text"] == "", "DX_MISSING"), (F.upper(s["text"]).isin(*PLACEHOLDERS), "DX_PLACEHOLDER"), (shape(s["head"]).isin("999", "999.9", "999.99"), "DX_ICD9"), (~s["read"], "DX_UNPARSEABLE"))
    return s.done(s["code"], reason, F.when(s["known"].isNull(), F.lit("DX_NOT_IN_REFERENCE")))


def shape(c: Column) -> Column:
    """A text with its capital letters as A and its digits as 9."""
    return F.translate(c, ascii_uppercase + digits, "A" * 26 + "9" * 10)


def is_icd10(code: Column) -> Column:
    """Whether a code has a category (letter, digit, letter or digit) and, behind a dot, nothing or one to four letters and digits."""
    return _is_icd10_shape(shape(code))


def _is_icd10_shape(looks: Column) -> Column:
    detail = F.substring(looks, 5, 1 << 20)
    detailed = (F.substring(looks, 4, 1) == ".") & F.length(detail).between(1, 4) & (F.translate(detail, "A9", "") == "")
    return F.coalesce(F.substring(looks, 1, 3).isin("A99", "A9A") & ((F.length(looks) == 3) | detailed), F.lit(False))


def icd10_code(c: Column) -> Column:
    """The text before the first hyphen, upper case, with a dot after three characters: the key to join the reference on."""
    return _dotted(F.upper(strip(F.substring_index(strip(c), "-", 1))))


def _dotted(head: Column) -> Column:
    return F.when(~F.contains(head, F.lit(".")) & (F.length(head) > 3), F.concat(F.substring(head, 1, 3), F.lit("."), F.substring(head, 4, 1 << 20))).otherwise(head)


def clean_npi(c: Column) -> Column:
    """A ten-digit provider number whose check digit is right (Luhn over the fixed prefix 80840 and the number)."""
    text = strip(c)
    number = F.regexp_replace(text, r"\.0\z", "")
    reason = first_reason(
        (text == "", "NPI_MISSING"),
        (is_placeholder(text), "NPI_PLACEHOLDER"),
        (~number.rlike(full("[0-9]{10}")), "NPI_INVALID_FORMAT"),
        (~F.call_function("luhn_check", F.concat(F.lit("80840"), number)), "NPI_CHECKSUM_FAILED"),
    )
    return field(number, reason)


def resolve_npi(df: DataFrame, out: str, c: Column) -> DataFrame:
    """``df`` with ``out``: ``clean_npi`` in steps."""
    s = Steps(df, out)
    s.add(text=strip(c))
    s.add(number=F.regexp_replace(s["text"], r"\.0\z", ""))
    s.add(ten=(F.length(s["number"]) == 10) & _all_digits(s["number"]))
    right = F.when(s["ten"], F.call_function("luhn_check", F.concat(F.lit("80840"), s["number"])))
    reason = first_reason(*_blank(s["text"], "NPI"), (~s["ten"], "NPI_INVALID_FORMAT"), (~right, "NPI_CHECKSUM_FAILED"))
    return s.done(s["number"], reason)


def flag_not_in_roster(npi: Column, in_roster: Column) -> Column:
    return F.when(npi.isNotNull() & ~F.coalesce(in_roster, F.lit(False)), F.lit("NPI_NOT_IN_ROSTER"))


def clean_last_name(c: Column) -> Column:
    name = F.regexp_replace(F.upper(strip(c)), r"[^\p{L}\p{N}]", "")
    return field(name, F.when(name == "", F.lit("LAST_NAME_MISSING")))


def clean_first_name(c: Column) -> Column:
    name = F.regexp_replace(F.substring_index(F.upper(collapse(c)), " ", 1), r"[^\p{L}\p{N}]", "")
    return field(name, F.when(name == "", F.lit("FIRST_NAME_MISSING")))


def clean_sex(c: Column) -> Column:
    """F or M; anything else is UNKNOWN with a warning, which can never link."""
    text = F.upper(strip(c))
    value = F.when(text.isin("F", "FEMALE"), "F").when(text.isin("M", "MALE"), "M").otherwise("UNKNOWN")
    return field(value, None, F.when(text == "", "SEX_MISSING").when(value == "UNKNOWN", "SEX_UNMAPPED"))


def age_in_years(born: Column, at: Column) -> Column:
    birthday_ahead = (F.month(at) * 100 + F.dayofmonth(at)) < (F.month(born) * 100 + F.dayofmonth(born))
    return F.year(at) - F.year(born) - birthday_ahead.cast("int")


def age_band(born: Column, admitted: Column) -> Column:
    age = age_in_years(born, admitted)
    warning = first_reason((born.isNull(), "AGE_BAND_DOB_UNAVAILABLE"), (admitted.isNull(), "AGE_BAND_ADMIT_UNAVAILABLE"), (born > admitted, "AGE_BAND_DOB_AFTER_ADMIT"))
    band = F.when(warning.isNotNull(), "UNKNOWN").when(age <= 17, "0-17").when(age <= 39, "18-39").when(age <= 64, "40-64").otherwise("65+")
    return field(band, None, warning)


def zip3(c: Column) -> Column:
    """The first three digits of a five-digit or ZIP+4 code."""
    text = strip(c)
    return field(F.substring(text, 1, 3), F.when(text == "", "ZIP_MISSING").when(~text.rlike(full("[0-9]{5}(?:-[0-9]{4})?")), "ZIP_INVALID"))


def length_of_stay(admitted: Column, discharged: Column) -> Column:
    """Whole days; 0 on the same day."""
    reason = first_reason((admitted.isNull(), "LENGTH_OF_STAY_ADMIT_UNAVAILABLE"), (discharged.isNull(), "LENGTH_OF_STAY_DISCHARGE_UNAVAILABLE"), (discharged < admitted, "DISCHARGE_BEFORE_ADMIT"))
    return field(F.date_diff(discharged, admitted), reason)


def discharge_before_admit(admitted: Column, discharged: Column) -> Column:
    """A flag only: neither date is taken away."""
    return F.when(discharged < admitted, F.lit("DISCHARGE_BEFORE_ADMIT"))


def admit_period(d: Column) -> list[Column]:
    return [F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month")]


def calendar(d: Column) -> list[Column]:
    """Attributes of a day; weekdays count from Monday = 1."""
    weekday = F.weekday(d) + 1
    return [
        *admit_period(d), F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "yyyy-MM").alias("year_month"), F.dayofmonth(d).alias("day_of_month"),
        weekday.alias("iso_day_of_week"), F.date_format(d, "EEEE").alias("day_name"), (weekday >= 6).alias("is_weekend"),
    ]


def has_record_id(c: Column) -> Column:
    return strip(c) != ""


def delivered_date(c: Column) -> Column:
    """The UTC day of an ISO-8601 time with an offset; null if it has none."""
    ok = c.rlike(full(r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,6})?)?(?:Z|[+-][0-9]{2}:[0-9]{2})"))
    return F.when(ok, F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.try_to_timestamp(c).cast("timestamp_ntz")).cast("date"))


def observed_pct(observed: Column, evaluated: Column) -> Column:
    """observed x 100 / evaluated with two decimals, half to even; null if nothing was evaluated."""
    share = observed.cast("decimal(20,0)") * 100 / F.nullif(evaluated.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.bround(share, 2).cast("decimal(7,2)")


def join_codes(codes: Column) -> Column:
    """Distinct codes of a group, sorted, joined by ``|``; null if there are none. An aggregate."""
    return F.nullif(F.array_join(F.array_sort(F.collect_set(codes)), "|"), F.lit(""))


def audit_codes(reason: Column) -> Column:
    """Leading codes of an audit reason such as ``A; B(x=1)``, as an array."""
    parts = F.transform(F.split(F.coalesce(reason, F.lit("")), ";"), lambda p: strip(p))
    return F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.regexp_extract(p, r"\A([A-Z0-9_]+)", 1))

