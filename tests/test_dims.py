import datetime as dt

import pytest
from conftest import rows
from pyspark.errors import PySparkException

from tillsight.operators import dims

D = dt.date
DEPT = "store_id string, dept_id string, store_date string, weekly_sales string, isholiday string"


def departments(spark, *items):
    return spark.createDataFrame([(s, d, day, "1", h) for s, d, day, h in items], DEPT)


def test_date_dim_numbers_distinct_dates(spark):
    raw = departments(spark, ("1", "1", "2010-02-12", "TRUE"), ("1", "2", "2010-02-05", "FALSE"),
                      ("2", "1", "2010-02-05", "FALSE"), ("2", "1", None, "FALSE"))
    assert rows(dims.date_dim(raw)) == [(1, D(2010, 2, 5), False), (2, D(2010, 2, 12), True)]


def test_date_with_both_flags_gives_two_rows(spark):
    raw = departments(spark, ("1", "1", "2010-02-05", "TRUE"), ("1", "2", "2010-02-05", "FALSE"))
    assert rows(dims.date_dim(raw)) == [(1, D(2010, 2, 5), False), (2, D(2010, 2, 5), True)]


def test_increment_modes(spark):
    old = dims.date_dim(departments(spark, ("1", "1", "2010-02-05", "FALSE"), ("1", "1", "2010-02-12", "TRUE")))
    raw = departments(spark, ("1", "1", "2010-02-05", "FALSE"), ("1", "1", "2013-01-04", "FALSE"))
    stable = dims.upsert(old, dims.date_dim_increment(raw, old), ["date_id"])
    assert rows(stable) == [(1, D(2010, 2, 5), False), (2, D(2010, 2, 12), True), (3, D(2013, 1, 4), False)]
    swapped = dims.upsert(old, dims.date_dim_increment(raw, old, "as_written"), ["date_id"])
    assert rows(swapped) == [(1, D(2013, 1, 4), False), (2, D(2010, 2, 12), True)]
    again = dims.upsert(swapped, dims.date_dim_increment(raw, swapped, "as_written"), ["date_id"])
    assert (1, D(2010, 2, 5), False) in rows(again)


def test_not_in_is_emptied_by_a_null(spark):
    src = spark.createDataFrame([(D(2010, 1, 1), True), (D(2010, 1, 8), True)], "store_date date, isholiday boolean")
    old = spark.createDataFrame([(D(2010, 1, 1),)], "store_date date")
    with_null = spark.createDataFrame([(D(2010, 1, 1),), (None,)], "store_date date")
    assert rows(dims.new_dates(src, old)) == rows(dims.new_dates_not_in(src, old)) == [(D(2010, 1, 8), True)]
    assert rows(dims.new_dates_not_in(src, with_null)) == []
    assert rows(dims.new_dates(src, with_null)) == [(D(2010, 1, 8), True)]


def test_store_dim_picks_one_row_per_store(spark):
    stores = spark.createDataFrame([("1", "B", "10"), ("1", "A", "30"), ("1", "A", "20"), ("9", "C", "1")],
                                   "store_id string, store_type string, store_size string")
    raw = departments(spark, ("1", "1", "2010-02-05", "TRUE"), ("1", "2", "2010-02-05", "TRUE"),
                      ("1", "1", "2010-02-12", "TRUE"), ("2", "1", "2010-02-05", "TRUE"))
    assert rows(dims.store_dim(raw, stores)) == [(1, 1, "A", 20), (1, 2, "A", 20), (2, 1, None, None)]


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("cast(id % 2 AS int) AS k", "id AS v")
    out = dims.first_per_key(df, ["k"], ["v"])
    assert rows(out) == [(0, 0), (1, 1)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().toString()


def test_upsert_replaces_adds_and_keeps(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([("c", 2), ("d", 3)], "v string, k int")
    assert rows(dims.upsert(target, source, ["k"])) == [(1, "a"), (2, "c"), (3, "d")]


def test_upsert_rejects_null_keys(spark):
    target = spark.createDataFrame([(1, 1, "a")], "k int, j int, v string")
    source = spark.createDataFrame([(1, None, "b")], "k int, j int, v string")
    with pytest.raises(PySparkException, match="null merge key"):
        dims.upsert(target, source, ["k", "j"]).collect()
