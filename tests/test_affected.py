"""Versioning by affected keys does what a comparison of the whole source does."""

import random
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_pipeline import T1, T2, T3, pipe, silver  # noqa: F401

from tillsight.plans import affected
from tillsight.plans.pipeline import Pipeline


def history(pipe):  # noqa: F811
    return rows(pipe.snapshot.history().drop("insert_date", "update_date", "dbt_scd_id"))


def whole(pipe, run_ts):  # noqa: F811
    return pipe.snapshot.run(pipe.snapshot_source(run_ts), run_ts)


def test_economics_alone_open_versions(pipe, delivery):  # noqa: F811
    silver(pipe, delivery, T1)
    pipe.landing.correct("fact_raw", "store_id = '1' AND store_date = '2010-02-05'", {"fuel_price": "9.99"})
    assert silver(pipe, delivery, T2)["replaced"] == 2
    assert pipe.snapshot.current().where("fuel_price = 9.99").count() == 2
    (delivery / "fact_late.csv").write_text("h,h,h,h,h,h,h,h,h,h,h,h\n2,2010-03-05,1.0,2.0,NA,NA,NA,NA,NA,3.0,4.0,FALSE\n")
    assert silver(pipe, delivery, T3)["replaced"] == 1
    assert whole(pipe, T3) == {"opened": 0, "replaced": 0, "months_rewritten": 0}


def test_an_unchanged_run_reads_no_source(pipe, delivery, monkeypatch):  # noqa: F811
    silver(pipe, delivery, T1)
    monkeypatch.setattr(Pipeline, "snapshot_source", lambda *a, **k: pytest.fail("the source was read"))
    assert pipe.run_snapshot(T2) == {"opened": 0, "replaced": 0, "months_rewritten": 0}
    assert pipe.snapshot.last_run() == 2 and pipe.snapshot.current().count() == 7


def test_only_months_of_the_keys_are_read(pipe, delivery):  # noqa: F811
    silver(pipe, delivery, T1)
    (delivery / "department_b.csv").write_text("h,h,h,h,h\n3,1,2010-03-05,5.00,FALSE\n")
    pipe.load(str(delivery))
    pipe.build_dims(T2)
    held = []
    run = pipe.snapshot.run
    pipe.snapshot.run = lambda *a, **k: held.append(k["held"]) or run(*a, **k)
    assert pipe.run_snapshot(T2) == {"opened": 1, "replaced": 0, "months_rewritten": 1}
    assert held == [{"2010-03"}]


def test_a_failed_run_sees_its_keys_again(pipe, delivery):  # noqa: F811
    silver(pipe, delivery, T1)
    pipe.landing.correct("department_raw", "dept_id = '2'", {"weekly_sales": "1.00"})
    source = pipe.snapshot_source
    pipe.snapshot_source = lambda *a, **k: source(*a, **k).withColumn("store_id", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        pipe.run_snapshot(T2)
    pipe.snapshot_source = source
    assert pipe.run_snapshot(T3)["replaced"] == 3


def test_random_deliveries_equal_whole_comparisons(spark, tmp_path):
    r = random.Random(3)
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "stores.csv").write_text("h,h,h\n" + "".join(f"{s},A,{s}00\n" for s in range(1, 5)))
    one, other = Pipeline(spark, str(tmp_path / "one")), Pipeline(spark, str(tmp_path / "other"))
    free = [(s, d, w) for s in range(1, 5) for d in range(1, 4) for w in range(1, 5)]
    r.shuffle(free)
    weeks = [(s, w) for s in range(1, 5) for w in range(1, 5)]
    r.shuffle(weeks)
    for n in range(6):
        kind = r.choice(["sales", "economics", "both", "none", "correct"]) if n else "both"
        if kind in ("sales", "both"):
            (folder / f"department_{n}.csv").write_text("h,h,h,h,h\n" + "".join(
                f"{s},{d},2010-{w:02d}-01,{r.randint(1, 99)}.00,FALSE\n" for s, d, w in [free.pop() for _ in range(5)]))
        if kind in ("economics", "both"):
            (folder / f"fact_{n}.csv").write_text("h\n" + "".join(
                f"{s},2010-{w:02d}-01,{r.randint(1, 50)}.5,2.0,NA,NA,NA,NA,NA,3.0,4.0,FALSE\n" for s, w in [weeks.pop() for _ in range(2)]))
        ts = f"2026-01-{n + 1:02d} 00:00:00"
        for p in (one, other):
            p.load(str(folder), run_ts=ts)
            if kind == "correct":
                p.landing.correct("department_raw", "store_id = '1'", {"weekly_sales": f"{n}.50"})
                p.landing.correct("fact_raw", "store_id = '2'", {"cpi": f"{n}.25"})
            p.build_dims(ts)
        one.run_snapshot(ts)
        whole(other, ts)
        assert history(one) == history(other), kind


def test_stream_folder_is_shared(pipe, delivery):  # noqa: F811
    silver(pipe, delivery, T1)
    assert Path(pipe.wh.path(affected.STREAM, "commits")).exists()
