import datetime as dt

from tillsight import fixtures
from tillsight.registry import stored
from tillsight.registry.base import Retail


def test_a_query_builds_the_mart_it_reads_from_lines_landed_once(spark, tmp_path):
    def line(store, part, year, flag):
        return part, store, 1, 2.0, 100.0, 0.1, 0.02, flag, dt.datetime(year, 3, 6)

    tables = {"lineitem": (fixtures.LINEITEM, [line(1, 1, 1995, "N"), line(1, 2, 1998, "R"), line(2, 1, 2001, "N")]),
              "part": (fixtures.PART, [(1, 10), (2, 20)]), "supplier": (fixtures.SUPPLIER, [(1, 0), (2, 1)])}
    for name, (schema, items) in tables.items():
        spark.createDataFrame(items, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    r = Retail(spark, str(tmp_path))
    got = {(h.store_id, h.dept_id, float(h.store_weekly_sales), h.valid_to is None) for h in stored.kept_snapshot(r).collect()}
    assert got == {(1, 10, 90.0, True), (1, 20, 90.0, False), (1, 20, -90.0, True), (2, 10, 90.0, True)}
    pipe = stored._stored(spark, str(tmp_path))
    assert not any(pipe.wh.exists(f"gold/{m}") for m in ("sales_by_dept", "sales_by_store"))
    assert stored.kept_sales_by_dept(r).count() == 3
    assert pipe.wh.exists("gold/sales_by_dept") and not pipe.wh.exists("gold/sales_by_store")
    assert all(f.endswith(".zstd.parquet") for f in pipe.snapshot.history().inputFiles())
