"""Steps shuffle rows once, without their hashes, and leave no shuffle files behind."""

import datetime as dt
import re
import time

from pyspark.sql import functions as F

from tillsight.operators import facts
from tillsight.operators import versions as v
from tillsight.operators.snapshot import BUCKET, MONTH, SnapshotTable, dealt
from tillsight.schemas import CHECK_COLUMNS
from tillsight.session import shuffles_freed
from tillsight.sources.warehouse import Warehouse

FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {found.apply(i).getName() for i in range(found.size())}
    return {n for n in names if n.startswith("shuffle_")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def source(spark, amounts):
    sales = [(s, d, dt.date(2010, 1, w), float(a)) for (s, d, w), a in amounts.items()]
    sold = spark.createDataFrame(sales, "store_id int, dept_id int, store_date date, amount double").select(
        "store_id", "dept_id", "store_date", F.col("amount").cast("decimal(18,2)").alias("store_weekly_sales"))
    raw = spark.createDataFrame([("1", "2010-01-08", *["1.5"] * 9)], ", ".join(f"{c} string" for c in (
        "store_id", "store_date", "temperature", "fuel_price", "cpi", "unemployment", *[f"markdown{k}" for k in range(1, 6)])))
    dates = spark.createDataFrame([(1, dt.date(2010, 1, 8))], "date_id long, store_date date")
    stores = spark.createDataFrame([(1, 1, "A", 10)], "store_id int, dept_id int, store_type string, store_size int")
    return facts.enriched(sold, facts.economics(raw), dates, stores)


def test_shuffle_files_go_with_the_write(spark, tmp_path):
    before = shuffle_files(spark)
    Warehouse(spark, str(tmp_path)).write(spark.range(1000).repartition(3), "numbers")
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    with shuffles_freed(spark):
        with shuffles_freed(spark):
            pass
        assert spark.conf.get(FREE) == "true"
    assert spark.conf.get(FREE, "false") == "false"


def test_rows_are_dealt_by_their_parts_and_without_hashes(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        src = v.narrowed(source(spark, {(1, 1, 8): 2}), facts.KEY, facts.KEY_PARTS)
        known = v.open_version(src, facts.KEY, "2024-01-01 00:00:00").drop("dbt_scd_id").repartition(*facts.DEALT_BY)
        for text in (plan(v.reject_duplicates(src, facts.KEY, facts.KEY_PARTS)),
                     plan(v.differences(known, src, facts.KEY, CHECK_COLUMNS, facts.KEY_PARTS))):
            dealt_by = {re.sub(r"#\d+L?", "", m) for m in re.findall(r"hashpartitioning\(([^)]*), \d+\)", text)}
            assert dealt_by == {"store_id, dept_id", "store_id, store_date"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_versions_of_null_parts_and_of_keys_that_are_no_hashes(spark, tmp_path):
    first = {(1, 1, 8): 1, (1, None, 8): 2, (None, 1, 8): 3, (None, None, 8): 4, (2, 2, 15): 5}
    second = first | {(1, None, 8): 20, (None, None, 8): 40, (None, 2, 8): 6}
    for plain in (False, True):
        table = SnapshotTable(Warehouse(spark, f"{tmp_path}/{plain}"))
        frames = [source(spark, d) for d in (first, second)]
        if plain:
            frames = [f.withColumn(facts.KEY, F.concat_ws("/", F.lit("k"), *[F.coalesce(F.col(c).cast("string"), F.lit("?"))
                                                                            for c in facts.KEY_PARTS])) for f in frames]
        keys = {(r.store_id, r.dept_id, r.store_date): r.snapshot_key for r in frames[1].collect()}
        assert table.run(frames[0], "2024-01-01 00:00:00") == {"opened": 5, "replaced": 0, "months_rewritten": 1}
        was = {r.snapshot_key: r for r in table.current().collect()}
        assert table.run(frames[1], "2024-02-01 00:00:00") == {"opened": 1, "replaced": 2, "months_rewritten": 1}
        got = table.history().collect()
        assert len(got) == 8 and all(r.snapshot_key == keys[r.store_id, r.dept_id, r.store_date] for r in got)
        assert len({r.dbt_scd_id for r in got}) == 8
        ended = [r for r in got if r.dbt_valid_to is not None]
        assert {float(r.store_weekly_sales) for r in ended} == {2.0, 4.0}
        assert all(r.dbt_scd_id == was[r.snapshot_key].dbt_scd_id and r.date_id == was[r.snapshot_key].date_id for r in ended)
        assert sorted(float(r.store_weekly_sales) for r in got if r.dbt_valid_to is None) == [1.0, 3.0, 5.0, 6.0, 20.0, 40.0]


def test_large_months_go_to_several_buckets(spark):
    frame = spark.range(100).select(F.lit("2010-01").alias(MONTH), F.col("id").cast("int").alias("store_id"))
    assert dealt(frame, "store_id", 100).select(BUCKET).distinct().count() == 1
    assert dealt(frame, "store_id", 2_000_000).select(BUCKET).distinct().count() > 4
