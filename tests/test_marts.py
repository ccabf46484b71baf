"""Marts against the joins spelled out row by row in Python."""

import datetime as dt
from collections import defaultdict
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillsight.functions.casts import decimals_to_double
from tillsight.plans import departments, holiday, marts

D, day = Decimal, dt.date(2010, 2, 5)
DATES = [day + dt.timedelta(weeks=k) for k in range(6)]
MD = "markdown1 decimal(18,2), markdown2 decimal(18,2), markdown3 decimal(18,2), markdown4 decimal(18,2), markdown5 decimal(18,2)"
FACTS = ("store_id int, dept_id int, store_date date, store_weekly_sales decimal(18,2), fuel_price decimal(10,4), "
         f"temperature decimal(10,4), cpi decimal(18,4), unemployment decimal(10,4), {MD}")


def facts():
    out = []
    for store, depts in ((1, (1, 2, 3)), (2, (1,)), (3, (1, 2))):
        for n, date in enumerate(DATES):
            for dept in depts:
                sold = None if (store, dept, n) in ((1, 2, 0), (2, 1, 3)) else D(store * 100 + dept * 10 + n) + D("0.37") - (D(400) if n == 4 else 0)
                econ = [D("2.5720") + n, D("40.1000"), D("211.0963"), D("8.1060")] if (store, n) != (2, 2) else [None] * 4
                md = [D("10.10") * n if n > 2 else None, None, D("3.00"), None, D(store)] if store != 2 else [None] * 5
                out.append((store, dept, date, sold, *econ, *md))
    return out


STORES = [(1, 1, "A", 100), (1, 2, "A", 100), (1, 3, "A", 100), (2, 1, "B", 50), (3, 1, "A", 70), (3, 2, "A", 70)]
# Store 4 is in no sales row; the last date has both flags, so its sales count under each.
DIM = [*STORES, (4, 1, "C", 1)]
CALENDAR = [(n + 1, d, n == 1) for n, d in enumerate(DATES)] + [(7, DATES[5], True)]


@pytest.fixture(scope="module")
def frames(spark):
    return (spark.createDataFrame(facts(), FACTS).cache(),
            spark.createDataFrame(DIM, "store_id int, dept_id int, store_type string, store_size int"),
            spark.createDataFrame(CALENDAR, "date_id bigint, store_date date, isholiday boolean"))


def figures(values):
    got = [v for v in values if v is not None]
    total = sum(got) if got else None
    return (total, None if not got else float(total) / len(got), max(got, default=None), min(got, default=None))


@pytest.mark.parametrize("grain", ["rows", "weeks"])
def test_sales_by_store_repeats_sales_per_department(frames, grain):
    df, stores, dates = frames
    base = marts.row_measures(df)
    base = marts.store_week(base) if grain == "weeks" else base
    groups, weeks = defaultdict(list), defaultdict(set)
    for f in facts():
        for s in DIM:
            for c in CALENDAR:
                if s[0] == f[0] and c[1] == f[2]:
                    groups[f[0], s[2], s[3], c[2]].append(f[3])
                    weeks[f[0], s[2], s[3], c[2]].add(f[2])
    want = sorted(((*k, len(weeks[k]), *figures(v)) for k, v in groups.items()), key=repr)
    assert rows(marts.sales_by_store(base, stores, dates)) == want


def test_sales_by_store_without_repetition(frames):
    df, stores, dates = frames
    got = marts.sales_by_store(marts.row_measures(df), stores, dates, fan_out=False)
    total = sum(f[3] for f in facts() if f[0] == 1 and f[3] is not None)
    twice = sum(f[3] for f in facts() if f[0] == 1 and f[2] == DATES[5])
    assert got.where("store_id = 1").agg(F.sum("total_sales")).first()[0] == total + twice


@pytest.mark.parametrize("grain", ["rows", "weeks"])
def test_sales_by_storetype_month(frames, grain):
    df, stores, _ = frames
    base = marts.row_measures(df)
    base = marts.store_week(base) if grain == "weeks" else base
    groups, seen = defaultdict(list), defaultdict(set)
    for f in facts():
        for s in DIM:
            if s[0] == f[0]:
                key = (s[2], f[2].year, f[2].month, f"{f[2]:%Y-%m}")
                groups[key].append(f[3])
                seen[key].add(f[0])
    want = sorted(((*k, figures(v)[1], figures(v)[0], len(seen[k])) for k, v in groups.items()), key=repr)
    assert rows(marts.sales_by_storetype_month(base, stores)) == want


def test_sales_by_dept_and_date(frames):
    df, _, dates = frames
    by_dept = rows(marts.sales_by_dept(marts.row_measures(df)))
    assert len(by_dept) == 6
    sold = [f[3] for f in facts() if f[:2] == (1, 2)]
    assert (1, 2, 6, *figures(sold)) in by_dept
    by_date = marts.sales_by_date_parts(marts.row_measures(df), dates)
    assert by_date.count() == 7
    sold = [f[3] for f in facts() if f[2] == DATES[5]]
    for flag in (True, False):
        assert rows(by_date.where((F.col("store_date") == DATES[5]) & (F.col("isholiday") == flag)),
                    "month_name", "total_sales", "avg_weekly_sales", "num_stores") == [
            ("Mar", figures(sold)[0], figures(sold)[1], 6)]


@pytest.mark.parametrize("grain", ["rows", "weeks"])
def test_markdowns(frames, grain):
    df, stores, _ = frames
    base = marts.row_measures(df)
    base = marts.store_week(base) if grain == "weeks" else base
    got = {r.store_id: r for r in marts.markdown_by_year_store(base, stores).collect()}
    once = {r.store_id: r for r in marts.markdown_by_year_store(base, stores, per_week=True).collect()}
    first = [f for f in facts() if f[0] == 1]
    assert got[1].total_markdown1 == sum(f[8] or 0 for f in first)
    assert got[1].avg_markdown1 == float(sum(f[8] for f in first if f[8] is not None)) / 9
    assert got[1].total_all_markdowns == sum((f[8] or 0) + f[10] + f[12] for f in first)
    assert got[2].total_markdown1 == 0 and got[2].avg_markdown1 is None and got[2].store_type == "B"
    assert once[1].total_markdown1 * 3 == got[1].total_markdown1
    assert once[1].total_sales == got[1].total_sales
    assert once[1].avg_markdown1 == pytest.approx(got[1].avg_markdown1)


def test_economic_factors(frames):
    df, _, _ = frames
    got = {(r.store_id, r.store_date): r for r in marts.economic_factors(marts.row_measures(df)).collect()}
    assert len(got) == 18
    row = got[1, DATES[0]]
    assert row.avg_weekly_sales == float(sum(f[3] for f in facts() if f[0] == 1 and f[2] == DATES[0] and f[3])) / 2
    assert row.avg_fuel_price == 2.572 and row.avg_markdown2 is None
    assert got[2, DATES[2]].avg_fuel_price is None
    again = rows(marts.economic_factors(marts.store_week(marts.row_measures(df))))
    assert again == rows(marts.economic_factors(marts.row_measures(df)))


def test_week_measures_equal_the_joined_rows(frames, spark):
    df, _, _ = frames
    econ_columns = ["store_id", "store_date", *[c for c in df.columns if c not in (
        "store_id", "dept_id", "store_date", "store_weekly_sales")]]
    econ = df.select(*econ_columns).distinct()
    # A store-week delivered twice repeats its sales, as the join does.
    econ = econ.unionByName(econ.where("store_id = 3").limit(1))
    sold = df.select("store_id", "dept_id", "store_date", "store_weekly_sales")
    joined = sold.join(econ, ["store_id", "store_date"], "left")
    for mart in (marts.economic_factors, lambda w: marts.markdown_by_year_store(w, frames[1])):
        assert rows(mart(marts.week_measures(sold, econ))) == rows(mart(marts.row_measures(joined)))


def test_share_and_top_lists(frames):
    df, stores, dates = frames
    by_dept = marts.sales_by_dept(marts.row_measures(df))
    per_store = defaultdict(D)
    for f in facts():
        per_store[f[0]] += f[3] or 0
    got = {r.store_type: r for r in departments.share_by_store_type(by_dept, stores).collect()}
    assert got["A"].total_sales == per_store[1] * 3 + per_store[3] * 2
    assert sum(r.pct for r in got.values()) == pytest.approx(100)
    plain = {r.store_type: r for r in departments.share_by_store_type(by_dept, stores, fan_out=False).collect()}
    assert plain["A"].total_sales == per_store[1] + per_store[3]

    top = departments.top_departments(by_dept, 3).collect()
    assert [r.total_sales for r in top] == sorted((r.total_sales for r in by_dept.collect()), reverse=True)[:3]
    assert [r.label for r in departments.top_departments(by_dept, 3, ascending_result=True).collect()] == [
        r.label for r in reversed(top)]
    ties = by_dept.withColumn("total_sales", F.lit(D("1.00")).cast("decimal(38,2)"))
    assert [(r.store_id, r.dept_id) for r in departments.top_departments(ties, 2).collect()] == [(1, 1), (1, 2)]

    by_store = marts.sales_by_store(marts.row_measures(df), stores, dates)
    labelled = holiday.store_labels(by_store, n=1).collect()
    assert {r.store_id for r in labelled if r.label} == {r.store_id for r in holiday.top_stores(by_store, 1).collect()}
    assert len(labelled) == by_store.count()
    assert decimals_to_double(by_store).schema["total_sales"].dataType.simpleString() == "double"
