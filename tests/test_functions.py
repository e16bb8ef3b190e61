"""Column functions and the dialect hazards they settle."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from shelfspark.functions import clean as S
from shelfspark.functions import metrics as M
from shelfspark.functions.keys import date_key, surrogate_key


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("y")).first()["y"]


def test_title_case_breaks_on_punctuation(spark):
    # H2: words start after '-', '.', '_' but not after an apostrophe
    assert one(spark, S.title_case("x"), "mary-jane o'NEIL a.b c_d") == "Mary-Jane O'neil A.B C_D"
    assert one(spark, S.title_case("x"), None) is None


def test_join_parts_null_rules(spark):
    df = spark.createDataFrame([("a", None, "c")], "a string, b string, c string")
    row = df.select(S.join_parts(", ", "a", "b", "c").alias("n"),
                    S.join_parts(", ", "a", "b", "c", on_null="skip").alias("s")).first()
    assert row["n"] is None          # H3 warehouse rule
    assert row["s"] == "a, c"        # Spark rule


def test_email_strict_and_lenient(spark):
    # H4: the lenient pattern lets a missing dot pass
    assert one(spark, S.valid_email("x"), " A@B.COM ") == "a@b.com"
    assert one(spark, S.valid_email("x"), "a@bcom") is None
    assert one(spark, S.valid_email("x", lenient=True), "a@bcom") == "a@bcom"
    assert one(spark, S.email_valid_flag("x"), "  ") is False


def test_parse_date_formats_and_strict(spark):
    # H5: ISO and extra formats; bad text is NULL
    assert one(spark, S.parse_date("x"), "2024-04-01") == dt.date(2024, 4, 1)
    assert one(spark, S.parse_date("x"), "04/01/2024") == dt.date(2024, 4, 1)
    assert one(spark, S.parse_date("x"), "not a date") is None
    assert one(spark, S.parse_date("x"), "   ") is None


def test_parse_numbers_money_bool(spark):
    assert one(spark, S.parse_number("x"), "3.7") == 4                       # S15 rounds
    assert one(spark, S.parse_number("x"), "abc") is None
    assert one(spark, S.parse_money("x"), "$1,234.56") == Decimal("1234.56")  # S7
    assert one(spark, S.parse_money("x"), "") is None
    assert one(spark, S.parse_money("x", default="0"), "abc") == Decimal("0.00")
    assert one(spark, S.parse_bool("x"), "ON") is True                      # S16
    assert one(spark, S.parse_bool("x"), "no") is False
    assert one(spark, S.parse_bool("x"), "maybe") is None
    assert one(spark, S.percent_to_rate("x"), "15") == Decimal("0.150000")   # M32
    assert one(spark, S.parse_measure("x"), "1.5 kg") == Decimal("1.50")


def test_phone_rules(spark):
    assert one(spark, S.phone("x"), "(555) 123-4567") == "5551234567"
    assert one(spark, S.phone("x"), "+1 555 123 4567") is None               # 11 digits, exact 10
    assert one(spark, S.phone("x", exact=None, minimum=10), "+1 555 123 4567") == "15551234567"
    assert one(spark, S.phone("x"), "555-1234") is None


def test_file_date_and_supplier_pattern(spark):
    assert one(spark, S.file_date("x"), "land/orders/orders_2024-06-13.json") == dt.date(2024, 6, 13)
    assert one(spark, S.file_date("x"), "land/orders/orders_latest.json") is None
    # the supplier feed's day part only matches 0-2 digits: day 13 is not recognised
    from shelfspark import config
    assert one(spark, S.file_date("x", config.SUPPLIER_FILE_DATE_PATTERN), "s_2024-06-13.json") is None
    assert one(spark, S.file_date("x", config.SUPPLIER_FILE_DATE_PATTERN), "s_2024-06-12.json") == dt.date(2024, 6, 12)


def test_zoned_vs_wall_clock_hour(spark):
    # H7: the wall-clock hour of a zoned text differs from the instant's UTC hour
    df = spark.createDataFrame([("2024-06-01T10:30:00-05:00",)], "x string")
    row = df.select(F.hour(S.parse_ts("x", zoned=True)).alias("utc"),
                    F.hour(S.parse_ts(F.regexp_replace("x", r"[+-]\d\d:\d\d$", ""))).alias("local")).first()
    assert row["utc"] == 15 and row["local"] == 10


def test_json_paths(spark):
    df = spark.createDataFrame([('{"a":{"b":" x "},"n":"3","arr":[{"p":1},{"p":2}]}',)], "x string")
    v = S.parse_payload("x")
    row = df.select(S.json_field(v, "$.a.b").alias("b"), S.json_path(v, "$.n", "int").alias("n"),
                    S.json_path(v, "$.arr[1].p", "int").alias("p"), S.json_field(v, "$.zz").alias("z")).first()
    assert (row["b"], row["n"], row["p"], row["z"]) == ("x", 3, 2, None)


def test_surrogate_key_never_null(spark):
    df = spark.createDataFrame([(None, 1), ("a", None)], "a string, b int")
    keys = [r["k"] for r in df.select(surrogate_key("a", "b").alias("k")).collect()]
    assert all(k is not None and len(k) == 32 for k in keys)
    assert keys[0] != keys[1]


def test_whole_years_and_bands(spark):
    as_of = dt.date(2023, 2, 28)
    df = spark.createDataFrame([(dt.date(2000, 2, 29),), (dt.date(2000, 3, 1),), (dt.date(2030, 1, 1),)], "d date")
    ages = [r["a"] for r in df.select(M.whole_years("d", as_of).alias("a")).collect()]
    assert ages == [23, 22, None]    # 29 Feb anniversary falls on 28 Feb; future -> NULL
    bands = spark.createDataFrame([(17,), (18,), (36,), (56,), (None,)], "a int") \
        .select(M.age_band("a").alias("b")).collect()
    assert [r["b"] for r in bands] == [None, "Young", "Middle-aged", "Senior", None]


def test_store_and_order_metrics(spark):
    sizes = spark.createDataFrame([(4999,), (5000,), (10000,), (10001,), (None,)], "s int") \
        .select(M.store_size_band("s").alias("b")).collect()
    assert [r["b"] for r in sizes] == ["Small", "Medium", "Medium", "Large", None]
    hours = spark.createDataFrame([(4,), (5,), (12,), (17,), (22,), (None,)], "h int") \
        .select(M.time_of_day("h").alias("b")).collect()
    assert [r["b"] for r in hours] == ["Night", "Morning", "Afternoon", "Evening", "Night", "Night"]
    d = dt.date(2024, 1, 10)
    df = spark.createDataFrame([(d, d), (dt.date(2024, 1, 11), d), (None, d), (None, dt.date(2024, 2, 1))],
                               "dl date, est date")
    st = [r["s"] for r in df.select(M.delivery_status("dl", "est", dt.date(2024, 1, 20)).alias("s")).collect()]
    assert st == ["On Time", "Delayed", "Potentially Delayed", "In Transit"]


def test_calendar_attributes(spark):
    from shelfspark.plans.gold import dim_date

    cal = dim_date(spark)
    assert cal.count() == 180
    row = cal.filter(F.col("full_date") == dt.date(2024, 4, 7)).first()
    assert row["day_of_week"] == 0 and row["day_name"] == "Sun"      # H10: 0 = Sunday
    assert row["date_key"] == 20240407 and row["season"] == "Spring"
    assert cal.filter("holiday_flag").count() == 4


def test_safe_ratio_zero_guard(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (1, 4)], "n int, d int")
    out = [r["r"] for r in df.select(M.safe_ratio("n", "d", 100.0).alias("r")).collect()]
    assert out == [None, None, 25.0]


def test_date_key(spark):
    assert one(spark, date_key("x"), dt.date(2024, 4, 1), "x date") == 20240401
