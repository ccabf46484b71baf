from conftest import rows
from pyspark.sql import functions as F

from tillsight.operators import quality


def test_unique_counts_repeated_values(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (2, "c"), (None, "d"), (None, "d")], "k int, v string")
    assert rows(quality.unique(df, "t", "k")) == [("unique_t_k", 2, False)]
    assert rows(quality.unique(df, "t", "k", "v")) == [("unique_combination_t_k__v", 2, False)]
    assert rows(quality.unique(df.where("k = 3"), "t", "k")) == [("unique_t_k", 0, True)]


def test_not_null_counts_each_column(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "k int, v string")
    assert rows(quality.not_null(df, "t", "k", "v")) == [("not_null_t_k", 1, False), ("not_null_t_v", 2, False)]


def test_flag_conflicts(spark):
    df = spark.createDataFrame([("2010-01-01", True), ("2010-01-01", False), ("2010-01-08", True), (None, True), (None, False)],
                               "store_date string, isholiday boolean")
    assert rows(quality.flag_conflicts(df)) == [("2010-01-01", 2)]
