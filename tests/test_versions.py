import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillsight.operators import versions as v
from tillsight.schemas import VRSN_COLUMNS

SCHEMA = "key string, a int, b int, note string"
CHECK = ["a", "b"]
T = [f"2024-01-0{n} 00:00:00" for n in range(1, 8)]


def source(spark, *items):
    return spark.createDataFrame([tuple(i) for i in items], SCHEMA)


def first(spark, *items, ts=T[0]):
    return v.open_version(source(spark, *items), "key", ts)


def shown(df):
    text = "yyyy-MM-dd HH:mm:ss"
    return rows(df.select("key", "a", "b", "note", F.date_format("dbt_valid_from", text),
                          F.date_format("dbt_valid_to", text)))


def test_unchanged_source_changes_nothing(spark):
    h = first(spark, ("x", 1, None, "n"), ("y", None, None, "n"))
    again = v.apply_versions(h, source(spark, ("x", 1, None, "n"), ("y", None, None, "n")), "key", CHECK, T[1])
    assert rows(again) == rows(h)


def test_change_closes_and_opens_at_the_same_instant(spark):
    h = first(spark, ("x", 1, 1, "n"))
    out = v.apply_versions(h, source(spark, ("x", 2, 1, "n")), "key", CHECK, T[1])
    assert shown(out) == [("x", 1, 1, "n", T[0], T[1]), ("x", 2, 1, "n", T[1], None)]
    assert out.select("dbt_scd_id").distinct().count() == 2


@pytest.mark.parametrize("old,new,versions", [(1, None, 2), (None, 1, 2), (None, None, 1), (1, 1, 1)])
def test_comparison_is_null_safe(spark, old, new, versions):
    out = v.apply_versions(first(spark, ("x", old, 1, "n")), source(spark, ("x", new, 1, "n")), "key", CHECK, T[1])
    assert out.count() == versions


def test_new_missing_and_unchecked(spark):
    h = first(spark, ("gone", 1, 1, "n"), ("same", 1, 1, "old note"))
    out = v.apply_versions(h, source(spark, ("same", 1, 1, "new note"), ("new", 5, 5, "n")), "key", CHECK, T[1])
    assert shown(out) == [("gone", 1, 1, "n", T[0], None), ("new", 5, 5, "n", T[1], None),
                          ("same", 1, 1, "old note", T[0], None)]


@pytest.mark.parametrize("items", [[("x", 1, 1, "n"), ("x", 2, 1, "n")], [("x", 1, 1, "n"), ("x", 1, 1, "n")],
                                   [(None, 1, 1, "n")]])
def test_duplicate_or_null_keys_abort(spark, items):
    with pytest.raises(PySparkException, match="in the source"):
        v.apply_versions(first(spark, ("x", 1, 1, "n")), source(spark, *items), "key", CHECK, T[1]).collect()


def test_reading_versions(spark):
    h = first(spark, ("x", 1, 1, "n"), ("y", 1, 1, "n"))
    h = v.apply_versions(h, source(spark, ("x", 2, 1, "n"), ("y", 1, 1, "n")), "key", CHECK, T[2])
    h = v.apply_versions(h, source(spark, ("x", 3, 1, "n"), ("y", 1, 1, "n")), "key", CHECK, T[4])
    assert rows(v.current_rows(h), "key", "a") == [("x", 3), ("y", 1)]
    for ts, want in ((T[0], 1), (T[1], 1), (T[2], 2), (T[3], 2), (T[4], 3)):
        assert rows(v.as_of(h, ts).where("key = 'x'"), "a") == [(want,)]
    assert rows(v.version_history(h, "key").where("key = 'x'"), "version_no", "a") == [(1, 1), (2, 2), (3, 3)]
    assert tuple(v.version_counts(h).first()) == (4, 2, 2)


def test_other_column_names(spark):
    h = v.open_version(source(spark, ("x", 1, 1, "n")), "key", T[0], VRSN_COLUMNS)
    out = v.apply_versions(h, source(spark, ("x", 2, 1, "n")), "key", CHECK, T[1], VRSN_COLUMNS)
    assert rows(out.where("vrsn_end_date IS NULL"), "a") == [(2,)]
    assert out.where("vrsn_end_date IS NOT NULL").count() == 1


def replay(batches):
    """The rule spelled out: versions as [key, value, from, to]."""
    out = []
    for n, batch in enumerate(batches):
        for key, value in batch.items():
            live = next((r for r in out if r[0] == key and r[3] is None), None)
            if live and live[1] == value:
                continue
            if live:
                live[3] = T[n]
            out.append([key, value, T[n], None])
    return sorted((tuple(r) for r in out), key=repr)


BATCH = st.dictionaries(st.sampled_from("pqrs"), st.one_of(st.none(), st.integers(0, 2)), max_size=4)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(BATCH, min_size=1, max_size=3))
def test_any_sequence_of_batches(spark, batches):
    h = v.open_version(source(spark), "key", T[0])
    for n, batch in enumerate(batches):
        src = source(spark, *[(k, a, 0, "n") for k, a in batch.items()])
        h = v.apply_versions(h, src, "key", CHECK, T[n])
        h = spark.createDataFrame(h.collect(), h.schema)
    got = rows(h.select("key", "a", F.date_format("dbt_valid_from", "yyyy-MM-dd HH:mm:ss"),
                        F.date_format("dbt_valid_to", "yyyy-MM-dd HH:mm:ss")))
    assert got == replay(batches)


def delivered(spark, *items):
    return spark.createDataFrame(list(items), "store int, dept int, at string, a int, b int").withColumn(
        "at", F.col("at").cast("timestamp"))


def test_deliveries_in_one_pass_open_the_same_versions(spark):
    """Keys may be null in part; 'gone' stays open, 'back' is compared with the version before it was missing."""
    items = [(1, 1, T[0], 1, None), (1, 1, T[2], 1, None), (1, 1, T[4], 2, None),
             (None, 2, T[0], 5, 5), (None, 2, T[2], None, 5), (3, None, T[0], 7, 7),
             (4, 4, T[0], 8, 8), (4, 4, T[4], 8, 9), (5, 5, T[2], 0, 0)]
    both = delivered(spark, *items).withColumn("key", F.concat_ws("-", F.coalesce("store", F.lit(0)), F.coalesce("dept", F.lit(0))))
    runs = [both.where(F.col("at") == F.lit(t).cast("timestamp")).drop("at") for t in (T[0], T[2], T[4])]
    h = v.open_version(runs[0], "key", T[0])
    for src, t in zip(runs[1:], (T[2], T[4]), strict=True):
        h = v.apply_versions(h, src, "key", CHECK, t)
    out = v.with_version_id(v.versions_of_deliveries(both, ["store", "dept"], CHECK, "at"), "key")
    assert rows(out, *h.columns) == rows(h) and out.count() == 8


def test_deliveries_refuse_a_key_twice_in_one(spark):
    out = v.versions_of_deliveries(delivered(spark, (1, None, T[0], 1, 1), (1, None, T[0], 1, 1)), ["store", "dept"], CHECK, "at")
    with pytest.raises(Exception, match="duplicate key in the source"):
        out.collect()


def test_two_deliveries_read_the_lines_as_often_as_one(spark, tmp_path):
    """One pass for both deliveries' sales, one for the economics, one for the calendar."""
    from tillsight import fixtures
    from tillsight.registry import QUERIES

    for name, schema in (("lineitem", fixtures.LINEITEM), ("part", fixtures.PART), ("supplier", fixtures.SUPPLIER)):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    plan = QUERIES["scd2_snapshot"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation" in line and "l_shipdate" in line for line in plan.splitlines()) == 3
