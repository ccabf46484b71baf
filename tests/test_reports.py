import datetime as dt

import pytest
from conftest import rows

from tillsight.plans import economy, holiday, markdowns, seasons, storetypes

BY_STORE = ("store_id int, store_type string, store_size int, isholiday boolean, weeks_of_data bigint, "
            "total_sales decimal(38,2), avg_weekly_sales double")


@pytest.fixture(scope="module")
def by_store(spark):
    from decimal import Decimal as D
    return spark.createDataFrame([
        (1, "A", 10, True, 1, D("30.00"), 30.0), (1, "A", 10, False, 3, D("60.00"), 20.0),
        (2, "B", 5, False, 2, D("10.00"), 5.0), (3, "C", 5, None, 1, D("100.00"), 50.0)], BY_STORE)


def test_holiday_figures(by_store):
    assert holiday.summary(by_store).first().asDict() == {
        "grand_total": 200, "holiday_total": 30, "nonholiday_total": 170, "holiday_avg": 30.0,
        "nonholiday_avg": 25.0, "pct_diff": 20.0}
    assert rows(holiday.share_positions(by_store), "holiday", "pct", "cumsum", "midpoint", "label") == [
        ("FALSE", 85.0, 100.0, 57.5, "85.0%"), ("TRUE", 15.0, 15.0, 7.5, "15.0%")]
    assert rows(holiday.average_rows(by_store)) == [
        ("Holiday", 30.0, "$30"), ("Non-Holiday", 25.0, "$25")]
    assert rows(holiday.store_pivot(by_store)) == [(1, 6e-05, 3e-05), (2, 1e-05, 0.0), (3, 1e-04, 0.0)]
    split = rows(holiday.store_split(by_store), "store_id", "isholiday", "flag_total", "flag_pct")
    assert split == [(1, False, 70, 70.0), (1, True, 30, 30.0), (2, False, 70, 70.0)]


BY_DATE = ("store_date date, sales_year int, sales_month int, month_name string, isholiday boolean, "
           "total_sales decimal(38,2), avg_weekly_sales double")


@pytest.fixture(scope="module")
def by_date(spark):
    from decimal import Decimal as D
    items = [(2010, 2, 5, False, 4), (2010, 2, 12, True, 8), (2010, 12, 31, True, 6), (2011, 2, 4, False, 2),
             (2011, 3, 4, False, 1)]
    names = {2: "Feb", 3: "Mar", 12: "Dec"}
    return spark.createDataFrame([(dt.date(y, m, d), y, m, names[m], h, D(v) * 1000000, float(v))
                                  for y, m, d, h, v in items], BY_DATE)


def test_seasons(by_date):
    assert set(rows(seasons.by_month(by_date))) == {(2, "Feb", 14.0, 14 / 3), (3, "Mar", 1.0, 1.0), (12, "Dec", 6.0, 6.0)}
    assert rows(seasons.year_over_year(by_date), "sales_year", "week_num", "total_sales_m") == [
        (2010, 1, 4.0), (2010, 2, 8.0), (2010, 3, 6.0), (2011, 1, 2.0), (2011, 2, 1.0)]
    assert set(rows(seasons.holiday_months(by_date))) == {(2, "Feb", 3.0, 8.0), (12, "Dec", 0.0, 6.0)}
    assert set(rows(seasons.holiday_by_month(by_date))) == {
        (2, "Feb", "FALSE", 3.0), (2, "Feb", "TRUE", 8.0), (3, "Mar", "FALSE", 1.0), (12, "Dec", "TRUE", 6.0)}
    assert seasons.holiday_weeks(by_date).count() == 2
    assert rows(seasons.year_boundaries(by_date)) == [(2011, dt.date(2011, 1, 1))]


def yearly(spark, *totals):
    from decimal import Decimal as D
    cols = ", ".join(f"total_markdown{k} decimal(38,2)" for k in range(1, 6))
    return spark.createDataFrame(
        [(1, y, D(sales), *[D(t) / 5] * 5, D(t)) for y, sales, t in totals],
        f"store_id int, sales_year int, total_sales decimal(38,2), {cols}, total_all_markdowns decimal(38,2)")


def test_markdown_reports(spark):
    df = yearly(spark, (2010, 100, 0), (2011, 50000000, 5000000), (2012, 0, 7500000))
    got = {r.sales_year: r for r in markdowns.by_year(df).collect()}
    assert got[2010].label == "No markdown\ndata" and got[2010].pct_sales == 0
    assert got[2011].label == "Total: $5M\n(10.0% of sales)" and got[2011].md1_m == 1.0
    assert got[2012].pct_sales == 0
    assert rows(markdowns.year_change(df)) == [(2011, 2012, 50.0)]
    assert rows(markdowns.year_change(df.where("sales_year < 2012"))) == []
    assert markdowns.long_form(df).count() == 15
    assert rows(markdowns.in_year(df, 2011)) == [(2011, 5.0)]
    assert tuple(markdowns.profile(df).first()) == (3, 1, "2010,2011,2012", 2010, 2012)


def test_storetype_reports(spark):
    from decimal import Decimal as D
    df = spark.createDataFrame([("A", 1, D(1000000)), ("A", 1, D(2000000)), ("A", 2, D(4000000)), ("B", 1, D(500000)),
                                ("D", 1, D(3000000)), (None, 2, D(1000000))],
                               "store_type string, sales_month int, total_sales decimal(38,2)")
    assert rows(storetypes.last_month(df.where("store_type < 'D'"))) == [("A", 2, 4.0, "$4M"), ("B", 1, 0.5, "$0M")]
    assert rows(storetypes.month_totals(df)) == [
        (1, "Jan", D(3000000), D(500000), None, D(3000000)), (2, "Feb", D(4000000), None, None, D(1000000)),
        (99, "TOTAL", D(7000000), D(500000), D(0), D(4000000))]  # every type counts: the row sums to the mart
    assert rows(storetypes.month_table(df)) == [
        (1, "Jan", "$3M", "$0M", "-", "$3M"), (2, "Feb", "$4M", "-", "-", "$1M"), (99, "TOTAL", "$7M", "$0M", "$0M", "$4M")]
    assert rows(storetypes.month_pivot(df)) == rows(storetypes.month_totals(df).where("sales_month < 99"))


def test_storetypes_that_occur(spark):
    """Columns follow the types found, names never clash, and the long form holds the same figures."""
    from decimal import Decimal as D
    df = spark.createDataFrame([("A", 1, D(1)), ("a", 1, D(2)), ("Other", 2, D(4)), ("D", 1, D(8)), (None, 2, D(16))],
                               "store_type string, sales_month int, total_sales decimal(38,2)")
    types = storetypes.store_types(df)
    assert types == ["A", "D", "Other", "a"]
    wide = storetypes.month_totals(df, types)
    assert wide.columns[2:] == ["type_a", "type_d", "type_other_2", "type_a_2", "type_other"]
    assert rows(wide) == [(1, "Jan", D(1), D(8), None, D(2), None), (2, "Feb", None, None, D(4), None, D(16)),
                          (99, "TOTAL", D(1), D(8), D(4), D(2), D(16))]
    long = {(t, m): v for t, m, _, v in rows(storetypes.month_long(df))}
    assert long == {("A", 1): D(1), ("D", 1): D(8), ("a", 1): D(2), ("Other", 2): D(4), (None, 2): D(16),
                    ("A", 99): D(1), ("D", 99): D(8), ("a", 99): D(2), ("Other", 99): D(4), (None, 99): D(16)}
    with pytest.raises(ValueError, match="month_long"):
        storetypes.store_types(df, most=3)
    assert storetypes.store_types(df.limit(0)) == [] and storetypes.month_totals(df.limit(0), []).columns[2:] == ["type_other"]


def test_trends(spark):
    df = spark.createDataFrame([(float(x), 3.0 * x + 2) for x in range(5)] + [(None, 1.0)],
                               "avg_fuel_price double, avg_weekly_sales double")
    got = economy.trend(df, "avg_fuel_price").first()
    assert (got.slope, got.intercept, got.x_min, got.x_max) == pytest.approx((3.0, 2.0, 0.0, 4.0))
    line = economy.trend_line(df, "avg_fuel_price").collect()
    assert len(line) == 100 and (line[0].x, line[99].x) == (0.0, 4.0)
    assert all(p.y == pytest.approx(3 * p.x + 2) for p in line)
