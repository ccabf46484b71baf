"""The four documented scenarios, end to end on delivered files."""

import os
import time

import pytest
from conftest import DEPARTMENTS, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillsight.plans.pipeline import DATE_DIM, MARTS, STORE_DIM, Pipeline
from tillsight.sources.frames import report_frames
from tillsight.streaming import feed

T1, T2, T3 = "2026-03-15 14:36:01", "2026-03-15 14:57:43", "2026-03-16 09:00:00"
FIRST = "store_id = '1' AND dept_id = '1' AND store_date = '2010-02-05'"


@pytest.fixture
def pipe(spark, tmp_path):
    return Pipeline(spark, str(tmp_path / "wh"))


def silver(pipe, delivery, ts, mode="once"):
    """A run without marts and checks."""
    pipe.load(str(delivery), mode, ts)
    pipe.build_dims(ts)
    return pipe.run_snapshot(ts)


def versions_of_first(pipe):
    text = "yyyy-MM-dd HH:mm:ss"
    return rows(pipe.snapshot.history().where("store_id = 1 AND dept_id = 1 AND store_date = '2010-02-05'").select(
        F.col("store_weekly_sales").cast("string"), F.date_format("dbt_valid_from", text),
        F.date_format("dbt_valid_to", text)))


def test_scenarios(pipe, delivery):
    # First run, checks pass.
    report = pipe.run(str(delivery), T1)
    assert report.loaded == {"stores_raw": 2, "department_raw": 7, "fact_raw": 4}
    assert report.snapshot == {"opened": 7, "replaced": 0, "months_rewritten": 2}
    assert report.failed_checks == [] and pipe.wh.table("checks").count() == 13
    assert rows(pipe.run_warnings(), "failures") == [(0,), (0,)]
    assert pipe.wh.table(STORE_DIM).columns == ["store_id", "dept_id", "store_type", "store_size",
                                                "insert_date", "update_date"]
    assert all(pipe.mart(m).count() > 0 for m in MARTS)
    missing = pipe.snapshot.current().where("store_id = 2 AND store_date = '2010-03-05'").first()
    assert missing.fuel_price is None and missing.store_type == "B" and missing.date_id == 3

    # Idempotent.
    before = rows(pipe.snapshot.history())
    again = pipe.run(str(delivery), T2)
    assert again.snapshot == {"opened": 0, "replaced": 0, "months_rewritten": 0}
    assert rows(pipe.snapshot.history()) == before

    # A correction versions one row and rewrites its month only.
    pipe.landing.correct("department_raw", FIRST, {"weekly_sales": "99999.99"})
    fixed = pipe.run(str(delivery), T2)
    assert fixed.snapshot == {"opened": 0, "replaced": 1, "months_rewritten": 1}
    assert versions_of_first(pipe) == [("24924.50", T1, T2), ("99999.99", T2, None)]
    assert pipe.snapshot.history().count() == 8 and pipe.snapshot.closed().count() == 1
    assert pipe.mart("sales_by_dept").where("store_id = 1 AND dept_id = 1").first().max_weekly_sales > 99999

    # New weeks arrive.
    (delivery / "department_new.csv").write_text(
        "h,h,h,h,h\n1,1,2013-01-04,25000.00,FALSE\n1,2,2013-01-04,18500.00,FALSE\n"
        "2,1,2013-01-04,31000.00,FALSE\n2,2,2013-01-04,22000.00,FALSE\n")
    grown = pipe.run(str(delivery), T3)
    assert grown.loaded["department_raw"] == 4
    assert grown.snapshot == {"opened": 4, "replaced": 0, "months_rewritten": 1}
    assert str(pipe.snapshot.current().agg(F.max("store_date")).first()[0]) == "2013-01-04"
    assert rows(pipe.wh.table(DATE_DIM).where("store_date = '2013-01-04'"), "date_id") == [(4,)]
    assert grown.failed_checks == []


def test_full_replace_of_the_files(pipe, delivery):
    silver(pipe, delivery, T1)
    (delivery / "department.csv").write_text(DEPARTMENTS.replace("24924.50", "99999.99"))
    assert silver(pipe, delivery, T2, "replace")["replaced"] == 1
    assert versions_of_first(pipe) == [("24924.50", T1, T2), ("99999.99", T2, None)]


def test_duplicate_keys_stop_the_run_before_it_commits(pipe, delivery):
    silver(pipe, delivery, T1)
    pipe.landing.load("department_raw", str(delivery), "force_append")
    with pytest.raises(PySparkException, match="duplicate snapshot_key"):
        pipe.run_snapshot(T2)
    assert pipe.snapshot.last_run() == 1 and pipe.snapshot.history().count() == 7


def test_leftovers_of_a_failed_run_are_overwritten(pipe, delivery, tmp_path):
    silver(pipe, delivery, T1)
    pipe.landing.correct("department_raw", FIRST, {"weekly_sales": "99999.99"})
    pipe.run_snapshot(T2)
    (tmp_path / "wh/silver/fact_snapshot/commits/run=000002/_COMMIT").unlink()
    assert versions_of_first(pipe) == [("24924.50", T1, None)]
    assert pipe.snapshot.closed().count() == 0
    pipe.run_snapshot(T3)
    assert versions_of_first(pipe) == [("24924.50", T1, T3), ("99999.99", T3, None)]


def test_leftover_closed_rows_do_not_come_back(pipe, delivery, tmp_path):
    silver(pipe, delivery, T1)
    pipe.landing.correct("department_raw", FIRST, {"weekly_sales": "99999.99"})
    pipe.run_snapshot(T2)
    (tmp_path / "wh/silver/fact_snapshot/commits/run=000002/_COMMIT").unlink()
    pipe.landing.correct("department_raw", FIRST, {"weekly_sales": "24924.50"})
    assert pipe.run_snapshot(T3) == {"opened": 0, "replaced": 0, "months_rewritten": 0}
    assert pipe.snapshot.last_run() == 2 and pipe.snapshot.closed().count() == 0
    assert versions_of_first(pipe) == [("24924.50", T1, None)]


def test_unchecked_attributes_keep_their_old_value(pipe, delivery):
    silver(pipe, delivery, T1)
    pipe.landing.correct("stores_raw", "store_id = '1'", {"store_type": "C"})
    assert silver(pipe, delivery, T2)["replaced"] == 0
    assert rows(pipe.snapshot.current().where("store_id = 1"), "store_type") == [("A",)] * 4
    assert rows(pipe.wh.table(STORE_DIM).where("store_id = 1"), "store_type") == [("C",)] * 2


def test_full_refresh_renumbers_dates(pipe, delivery):
    silver(pipe, delivery, T1)
    (delivery / "department_old.csv").write_text("h,h,h,h,h\n1,1,2010-01-01,1.00,FALSE\n")
    pipe.load(str(delivery))
    pipe.build_dims(T2)
    assert rows(pipe.wh.table(DATE_DIM).where("store_date = '2010-01-01'"), "date_id") == [(4,)]
    pipe.build_dims(T2, full_refresh=True)
    assert rows(pipe.wh.table(DATE_DIM).where("store_date = '2010-01-01'"), "date_id") == [(1,)]


def test_streams(pipe, delivery):
    silver(pipe, delivery, T1)
    inbox = delivery.parent / "inbox"
    inbox.mkdir()
    (inbox / "department_a.csv").write_text(
        "h,h,h,h,h\n1,1,2010-02-05,1.00,FALSE\nbroken\n7,1,2013-01-04,2.00,FALSE\n")
    stamp = lambda n: f"2026-04-0{n + 1} 00:00:00"
    feed.start_snapshot(pipe, str(inbox), stamp, available_now=True).awaitTermination()
    assert [r[0] for r in versions_of_first(pipe)] == ["1.00", "24924.50"]
    assert [r.corrupt_record for r in pipe.landing.quarantine("department_raw").collect()] == ["broken"]
    new = pipe.snapshot.current().where("store_id = 7").first()
    assert new.date_id == 4 and pipe.wh.table(STORE_DIM).where("store_id = 7").count() == 1
    # The batch run that follows agrees with the stream.
    pipe.build_dims(T2)
    assert pipe.run_snapshot(T2) == {"opened": 0, "replaced": 0, "months_rewritten": 0}
    assert pipe.snapshot.history().count() == 9
    (inbox / "department_b.csv").write_text("h,h,h,h,h\n5,1,2010-02-05,2.00,FALSE\n")
    feed.start_snapshot(pipe, str(inbox), stamp, available_now=True).awaitTermination()
    assert pipe.snapshot.current().count() == 9
    feed.start_landing(pipe, "fact_raw", str(delivery), available_now=True).awaitTermination()
    assert pipe.landing.table("fact_raw").count() == 4


def test_key_delivered_twice_in_a_stream_batch(pipe, delivery, tmp_path):
    """A repeated line, two values in one file and a late correction in one batch: one open version each."""
    silver(pipe, delivery, T1)
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    older, newer = inbox / "department_a.csv", inbox / "department_b.csv"
    head = "h,h,h,h,h\n"
    older.write_text(head + "9,1,2010-02-05,5.00,FALSE\n" * 2 + "1,1,2010-02-05,7.00,FALSE\n8,1,2010-02-05,3.00,FALSE\n"
                     + "8,1,2010-02-05,4.00,FALSE\n")
    newer.write_text(head + "1,1,2010-02-05,6.00,FALSE\n")
    os.utime(older, (1_700_000_000, 1_700_000_000))
    os.utime(newer, (1_700_000_100, 1_700_000_100))
    feed.start_snapshot(pipe, str(inbox), lambda b: T2, available_now=True).awaitTermination()
    assert pipe.landing.table("department_raw").count() == 13
    assert [r[0] for r in versions_of_first(pipe)] == ["24924.50", "6.00"]
    opened = pipe.snapshot.current().where("store_id IN (8, 9)").selectExpr("store_id", "cast(store_weekly_sales AS string)")
    assert rows(opened) == [(8, "4.00"), (9, "5.00")]
    # The batch run that follows agrees with the stream.
    pipe.build_dims(T3)
    assert pipe.run_snapshot(T3) == {"opened": 0, "replaced": 0, "months_rewritten": 0}


def test_rewritten_file_adds_its_new_weeks(pipe, delivery):
    """The documented replacement: the same file with four rows more."""
    silver(pipe, delivery, T1)
    path = delivery / "department.csv"
    path.write_text(DEPARTMENTS + "1,1,2013-01-04,25000.00,FALSE\n1,2,2013-01-04,18500.00,FALSE\n"
                    "2,1,2013-01-04,31000.00,FALSE\n2,2,2013-01-04,22000.00,FALSE\n")
    later = time.time() + 60
    os.utime(path, (later, later))
    assert silver(pipe, delivery, T2, "changed") == {"opened": 4, "replaced": 0, "months_rewritten": 1}
    assert str(pipe.snapshot.current().agg(F.max("store_date")).first()[0]) == "2013-01-04"


def test_a_date_with_both_flags_is_named_before_the_run_stops(pipe, delivery):
    with open(delivery / "department.csv", "a") as f:
        f.write("9,9,2010-02-05,5.00,TRUE\n")
    pipe.load(str(delivery))
    pipe.build_dims(T1)
    assert pipe.warn_dates() == ["2010-02-05"]
    with pytest.raises(PySparkException, match="duplicate snapshot_key"):
        pipe.run(str(delivery), T1)
    assert rows(pipe.wh.table("warnings"), "flags") == [(2,)]


def test_reports_and_pruning(pipe, delivery):
    for ts in (T1, T2, T3):
        pipe.run(str(delivery), ts)
    assert len(pipe.wh.versions("gold/sales_by_dept")) == 2
    names = pipe.build_reports()
    assert all(pipe.report(n).count() > 0 for n in names)
    assert sum(len(f) for f in report_frames(pipe.report("weekly_series"), rows=2)) == 3


def test_runs_without_a_commit_file_are_not_overwritten(pipe, delivery, tmp_path):
    silver(pipe, delivery, T1)
    silver(pipe, delivery, T2)
    for marker in (tmp_path / "wh/silver/fact_snapshot/commits").glob("run=*/_COMMIT"):
        marker.unlink()
    with pytest.raises(RuntimeError, match="no commit file"):
        pipe.run_snapshot(T3)


def test_empty_delivery(pipe, tmp_path):
    folder = tmp_path / "none"
    folder.mkdir()
    for name in ("stores", "department", "fact"):
        (folder / f"{name}.csv").write_text("h\n")
    report = pipe.run(str(folder), T1)
    assert report.snapshot["opened"] == 0 and report.failed_checks == []
    assert pipe.mart("sales_by_dept").count() == 0
    assert "avg_markdown5" in pipe.mart("economic_factors").columns
