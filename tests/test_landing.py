import os
import time

import pytest
from conftest import DEPARTMENTS, rows
from pyspark.sql import functions as F

from tillsight.schemas import LANDINGS
from tillsight.sources import landing
from tillsight.sources.csv_files import read_csv, split_bad
from tillsight.sources.landing import LandingZone
from tillsight.sources.warehouse import Warehouse

TABLE = "department_raw"


@pytest.fixture
def zone(spark, tmp_path):
    return LandingZone(Warehouse(spark, str(tmp_path / "wh")))


def test_columns_map_by_position_and_tokens_become_null(zone, delivery):
    assert zone.load_all(str(delivery)) == {"stores_raw": 2, "department_raw": 7, "fact_raw": 4}
    fact = zone.table("fact_raw")
    assert fact.where("markdown1 IS NOT NULL").count() == 1
    assert fact.where("markdown2 IS NOT NULL OR markdown3 IS NOT NULL").count() == 0
    assert rows(zone.table("stores_raw"), "store_id", "store_type", "store_size") == [
        ("1", "A", "151315"), ("2", "B", "37392")]
    assert zone.table(TABLE).where("insert_date IS NULL OR update_date IS NULL").count() == 0


def test_quotes_and_empty_fields(spark, tmp_path):
    (tmp_path / "stores.csv").write_text('h,h,h\n"1","A, big",""\n2,,"NULL"\n3,"say ""hi""",5\n')
    good, bad = split_bad(read_csv(spark, str(tmp_path), LANDINGS["stores_raw"]), LANDINGS["stores_raw"])
    assert bad.collect() == []
    assert rows(good) == [("1", "A, big", None), ("2", None, None), ("3", 'say "hi"', "5")]


def test_split_finds_malformed_lines_whatever_columns_are_read(spark, tmp_path):
    (tmp_path / "stores.csv").write_text("h,h,h\n1,A,5\n2,B\n3,C,6,7\n4,A,8\n")
    good, bad = split_bad(read_csv(spark, str(tmp_path), LANDINGS["stores_raw"]), LANDINGS["stores_raw"])
    assert len(good.collect()) == len(good.select("store_id").collect()) == 2
    assert rows(good.select("store_type")) == [("A",), ("A",)]
    assert rows(bad, "store_id", "corrupt_record") == [("2", "2,B"), ("3", "3,C,6,7")]


def test_malformed_lines_are_set_aside(zone, delivery):
    with open(delivery / "department.csv", "a") as f:
        f.write("3,1,2010-02-05\n3,2,2010-02-05,1.00,FALSE,extra\n")
    assert zone.load(TABLE, str(delivery)) == 7
    good = zone.table(TABLE)
    assert good.select("store_id").count() == good.count() == len(good.collect()) == 7
    assert sorted(r.corrupt_record for r in zone.quarantine(TABLE).collect()) == [
        "3,1,2010-02-05", "3,2,2010-02-05,1.00,FALSE,extra"]


def test_once_skips_loaded_files_and_takes_new_ones(zone, delivery):
    assert zone.load(TABLE, str(delivery)) == 7
    assert zone.load(TABLE, str(delivery)) == 0
    (delivery / "department_2.csv").write_text("h,h,h,h,h\n1,1,2013-01-04,25000.00,FALSE\n")
    assert zone.load(TABLE, str(delivery)) == 1
    assert zone.load(TABLE, str(delivery)) == 0


def test_rewritten_file_is_taken_by_changed_only(zone, delivery):
    zone.load(TABLE, str(delivery))
    path = delivery / "department.csv"
    path.write_text(DEPARTMENTS + "1,1,2013-01-04,25000.00,FALSE\n")
    later = time.time() + 60
    os.utime(path, (later, later))
    assert zone.load(TABLE, str(delivery)) == 0
    assert zone.load(TABLE, str(delivery), "changed") == 8
    assert zone.load(TABLE, str(delivery), "changed") == 0
    assert zone.table(TABLE).count() == 8  # the file's earlier lines are replaced


def test_quoted_line_breaks_are_read_where_asked_for(spark, tmp_path):
    from dataclasses import replace

    (tmp_path / "stores.csv").write_text('h,h,h\n"1","A\nbig","5"\n2,B,6\n')
    landing = replace(LANDINGS["stores_raw"], multi_line=True)
    good, bad = split_bad(read_csv(spark, str(tmp_path), landing), landing)
    assert rows(good) == [("1", "A\nbig", "5"), ("2", "B", "6")] and bad.collect() == []


def test_correction_rewrites_only_files_with_matching_rows(zone, delivery, tmp_path):
    zone.load(TABLE, str(delivery))
    (delivery / "department_2.csv").write_text("h,h,h,h,h\n9,1,2013-01-04,25000.00,FALSE\n")
    zone.load(TABLE, str(delivery))
    zone.correct(TABLE, "store_id = '9'", {"weekly_sales": "1.00"})
    assert rows(zone._files(TABLE, ["fix-000001"]), "good_rows", "replaces") == [(1, ["stream-000001"])]
    assert zone.table(TABLE).count() == 8 and zone.table(TABLE).where("weekly_sales = '1.00'").count() == 1
    zone.correct(TABLE, "store_id = '77'", {"weekly_sales": "2.00"})
    assert zone.load(TABLE, str(delivery), "changed") == 0


def test_force_append_repeats_and_replace_resets(zone, delivery):
    zone.load(TABLE, str(delivery))
    assert zone.load(TABLE, str(delivery), "force_append") == 7
    assert zone.table(TABLE).count() == 14
    assert zone.load(TABLE, str(delivery), "replace") == 7
    assert zone.table(TABLE).count() == 7
    assert zone.load(TABLE, str(delivery)) == 0
    with pytest.raises(ValueError):
        zone.load(TABLE, str(delivery), "sometimes")


def test_once_after_replace_does_not_repeat_files(zone, delivery):
    assert zone.load(TABLE, str(delivery), "replace") == 7
    assert zone.load(TABLE, str(delivery), "once") == 0
    assert zone.table(TABLE).count() == 7


def test_incomplete_load_is_not_read_and_is_redone(zone, delivery, tmp_path):
    zone.load(TABLE, str(delivery), "replace")
    marker = next((tmp_path / "wh" / "bronze" / TABLE).glob("v=*/_loads/*"))
    marker.unlink()
    assert zone.table(TABLE).count() == 0
    assert zone.load(TABLE, str(delivery), "replace") == 7


def test_correct_updates_matching_rows_only(zone, delivery):
    zone.load(TABLE, str(delivery))
    hit = (F.col("store_id") == "1") & (F.col("dept_id") == "1") & (F.col("store_date") == "2010-02-05")
    zone.correct(TABLE, hit, {"weekly_sales": "99999.99"})
    got = zone.table(TABLE)
    assert got.count() == 7
    assert rows(got.where("weekly_sales = '99999.99'"), "store_id", "dept_id", "store_date") == [("1", "1", "2010-02-05")]
    assert zone.load(TABLE, str(delivery)) == 0


def test_empty_folder_gives_empty_table(zone, tmp_path):
    (tmp_path / "none").mkdir()
    assert zone.load(TABLE, str(tmp_path / "none")) == 0
    assert zone.table(TABLE).columns[:2] == ["store_id", "dept_id"]


def test_warehouse_keeps_old_version_until_new_one_is_complete(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "w"))
    with pytest.raises(LookupError):
        wh.table("t")
    wh.write(spark.range(3), "t")
    assert wh.write(wh.table("t").union(spark.range(2)), "t").count() == 5
    (tmp_path / "w" / "t" / "v=000003").mkdir()
    assert wh.versions("t") == [1, 2] and wh.table("t").count() == 5
    wh.write(spark.range(1), "t")
    assert wh.versions("t") == [1, 2, 4]
    wh.prune("t", keep=1)
    assert wh.versions("t") == [4] and wh.table("t").count() == 1
    assert spark.sql("SELECT count(*) FROM t").first()[0] == 1


def test_changed_opens_changed_files_only(spark, tmp_path, monkeypatch):
    """Several loads of at most the named number of files; the scan of each opens its files and no others."""
    inbox, zone = tmp_path / "in", LandingZone(Warehouse(spark, str(tmp_path / "wh")))
    inbox.mkdir()
    for i in range(12):
        (inbox / f"department_{i:02d}.csv").write_text(f"h,h,h,h,h\n{i},1,2010-02-05,1.00,FALSE\n")
    assert zone.load("department_raw", str(inbox)) == 12
    for i in range(0, 12, 3):
        (inbox / f"department_{i:02d}.csv").write_text(f"h,h,h,h,h\n{i},1,2010-02-05,1.00,FALSE\n{i},2,2010-02-05,2.00,FALSE\n")
    opened = []
    store = zone.store

    def seen(lines, *args, **kwargs):
        lines.collect()
        scan = lines._jdf.queryExecution().executedPlan().collectLeaves().head()
        opened.append(scan.metrics().apply("numFiles").value())
        store(lines, *args, **kwargs)

    monkeypatch.setattr(zone, "store", seen)
    monkeypatch.setattr(landing, "FILES_A_LOAD", 3)
    assert zone.load("department_raw", str(inbox), "changed") == 8
    assert opened == [3, 1]
    assert zone.table("department_raw").count() == 16
    assert zone.load("department_raw", str(inbox), "changed") == 0
