import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillsight.functions import calendar, casts, keys, labels, measures
from tillsight.sources.frames import report_frames


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], schema).select(column).first()[0]


@pytest.mark.parametrize("text,want", [("NA", None), ("NULL", None), ("null", None), (None, None), ("na", "na"), ("0", "0")])
def test_null_tokens(spark, text, want):
    df = spark.createDataFrame([(text, text)], "a string, b string")
    assert casts.null_if(df, ["a"]).first() == (want, text)


@pytest.mark.parametrize("text,want", [
    ("24924.50", Decimal("24924.50")), ("1.005", Decimal("1.01")), ("-0.004", Decimal("0.00")), ("NA", None),
    ("", None), (None, None), ("99999999999999999.00", None)])
def test_try_decimal(spark, text, want):
    assert one(spark, casts.try_decimal("c", 18, 2), c=("string", text)) == want


@pytest.mark.parametrize("cast,bad", [(casts.to_int, "x"), (casts.to_int, "1.6"), (casts.parse_date, "2010-02-30"),
                                      (casts.parse_date, "05/02/2010"), (casts.parse_date, "2010-2-5"),
                                      (casts.parse_date, "+201-01-01"), (casts.parse_date, " 201-01-01"),
                                      (casts.to_bool, "maybe")])
def test_strict_casts_fail(spark, cast, bad):
    with pytest.raises(PySparkException):
        one(spark, cast("c"), c=("string", bad))


def test_parse_date(spark):
    assert one(spark, casts.parse_date("c"), c=("string", "2010-02-05")) == dt.date(2010, 2, 5)
    assert one(spark, casts.parse_date("c"), c=("string", None)) is None


def test_date_parts_and_months(spark):
    df = spark.createDataFrame([(dt.date(2010, 1, 1),), (dt.date(2012, 12, 28),)], "store_date date")
    assert rows(df.select(*calendar.date_parts())) == [
        (2010, 1, "Jan", 53, "2010-01"), (2012, 12, "Dec", 52, "2012-12")]
    months = spark.range(0, 14).select(F.col("id").cast("int").alias("m"))
    names = [r[0] for r in months.orderBy("m").select(calendar.month_name("m")).collect()]
    assert names == [None, *calendar.MONTH_NAMES, None]
    assert one(spark, calendar.month_ordinal("y", "m"), y=("int", 2011), m=("int", 3)) == 15


def test_surrogate_key_keeps_nulls_apart(spark):
    df = spark.createDataFrame([(1, None, 3), (1, 3, None), (1, 3, 3)], "a int, b int, c int")
    got = [r[0] for r in df.select(keys.surrogate_key("a", "b", "c")).collect()]
    assert len(set(got)) == 3 and all(len(k) == 32 for k in got)
    import hashlib
    assert got[2] == hashlib.md5(b"1-3-3").hexdigest()
    assert got[0] == hashlib.md5(b"1-_dbt_utils_surrogate_key_null_-3").hexdigest()


def test_measures(spark):
    assert one(spark, measures.row_sum("a", "b"), a=("decimal(18,2)", None), b=("decimal(18,2)", Decimal("2.50"))) == Decimal("2.50")
    assert one(spark, measures.pct_of(F.col("a"), F.col("b")), a=("double", 1.0), b=("double", 0.0)) is None
    assert one(spark, measures.pct_change(F.col("a"), F.col("b")), a=("double", 3.0), b=("double", 2.0)) == 50.0
    assert one(spark, measures.mean_of("a", "b"), a=("double", 0.0), b=("bigint", 0)) is None
    df = spark.createDataFrame([(10.0, -2.0, 4.0)], "total_sales double, min_weekly_sales double, max_weekly_sales double")
    assert tuple(df.select(*measures.range_bounds()).first()) == (12.0, 6.0)


@pytest.mark.parametrize("rule,text,want", [
    ("token", "yes", "TRUE"), ("token", "1", "TRUE"), ("token", "False", "FALSE"), ("token", None, "FALSE"),
    ("truthy", "FALSE", "TRUE"), ("truthy", "", "FALSE"), ("truthy", None, "FALSE"), ("equals", "TRUE", "FALSE")])
def test_holiday_label_on_text(spark, rule, text, want):
    assert one(spark, labels.holiday_label("c", rule), c=("string", text)) == want


@pytest.mark.parametrize("rule", ["token", "truthy", "equals"])
def test_holiday_label_on_flag(spark, rule):
    got = [one(spark, labels.holiday_label("c", rule), c=("boolean", v)) for v in (True, False, None)]
    assert got == ["TRUE", "FALSE", "FALSE"]


@pytest.mark.parametrize("value", [0.0, 2.5, 3.5, 1234.5678, 999999.5, -12.25, 0.05])
def test_display_texts_match_python(spark, value):
    assert one(spark, labels.money("v", "M"), v=("double", value)) == f"${value:,.0f}M"
    assert one(spark, labels.money("v", "M", digits=1), v=("double", value)) == f"${value:,.1f}M"
    assert one(spark, labels.percent("v"), v=("double", value)) == f"{value:.1f}%"
    assert one(spark, labels.fixed(F.col("v"), 0, commas=False), v=("double", value)) == f"{value:.0f}"


def test_display_text_for_missing(spark):
    assert one(spark, labels.money("v", "M", missing="-"), v=("double", None)) == "-"


def test_report_frame_casts_by_declared_type(spark):
    df = spark.createDataFrame([(Decimal("1.50"), "12", True), (None, None, None)], "a decimal(18,2), b string, c boolean")
    parts = list(report_frames(df, rows=1))
    assert [len(p) for p in parts] == [1, 1]
    assert parts[0]["a"].dtype == float and list(parts[0]["b"]) == ["12"] and list(parts[0]["c"]) == [True]
    assert [list(p.columns) for p in report_frames(df.limit(0))] == [["a", "b", "c"]]
