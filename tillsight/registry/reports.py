"""The numbers behind each report."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import measures
from ..plans import departments, economy, holiday, markdowns, seasons, storetypes
from .base import Retail, near, query, rounded

_TOP20 = "SELECT * FROM by_dept ORDER BY total_sales DESC NULLS LAST, store_id, dept_id LIMIT 20"
_LABELS = """'Dept ' || dept_id || chr(10) || '(Store ' || store_id || ')' AS label,
       'Dept ' || dept_id || ' (Store ' || store_id || ')' AS label_line"""
_TOP20_REPORT = f"""
SELECT store_id, dept_id, total_sales, avg_weekly_sales, max_weekly_sales, min_weekly_sales, {_LABELS},
       cast(abs(cast(total_sales AS decimal(38,2)) - cast(min_weekly_sales AS decimal(18,2))) AS double) AS error_low,
       cast(abs(cast(max_weekly_sales AS decimal(18,2)) - cast(total_sales AS decimal(38,2))) AS double) AS error_high
FROM ({_TOP20})"""


# --- departments -----------------------------------------------------------------------------

@query("top20_dept", _TOP20_REPORT)
def top20_dept(r: Retail) -> DataFrame:
    return departments.top_departments(r.by_dept)


@query("top20_dept_asc", _TOP20_REPORT + " ORDER BY total_sales")
def top20_dept_asc(r: Retail) -> DataFrame:
    return departments.top_departments(r.by_dept, ascending_result=True)


@query("range_bounds", """
SELECT store_id, dept_id,
       cast(abs(cast(total_sales AS decimal(38,2)) - cast(min_weekly_sales AS decimal(18,2))) AS double) AS error_low,
       cast(abs(cast(max_weekly_sales AS decimal(18,2)) - cast(total_sales AS decimal(38,2))) AS double) AS error_high
FROM by_dept""")
def range_bounds(r: Retail) -> DataFrame:
    return r.by_dept.select("store_id", "dept_id", *measures.range_bounds())


@query("unit_scale", """
SELECT store_id, dept_id, total_sales / 1e6 AS total_sales_m, total_sales / 1e9 AS total_sales_b,
       avg_weekly_sales / 1e3 AS avg_weekly_sales_k
FROM by_dept""")
def unit_scale(r: Retail) -> DataFrame:
    return departments.in_units(r.by_dept)


@query("grand_total", "SELECT cast(sum(store_weekly_sales) AS double) AS grand_total FROM enriched")
def grand_total(r: Retail) -> DataFrame:
    return departments.grand_total(r.by_dept)


@query("dept_share", """
SELECT store_id, dept_id, total_sales / (SELECT cast(sum(store_weekly_sales) AS double) FROM enriched) * 100.0 AS pct
FROM by_dept""")
def dept_share(r: Retail) -> DataFrame:
    return departments.share_of_total(r.by_dept)


def _share_sql(stores: str) -> str:
    return f"""
SELECT store_type, cast(total AS double) AS total_sales,
       cast(total AS double) / cast(sum(total) OVER () AS double) * 100.0 AS pct
FROM (SELECT s.store_type, sum(cast(d.total_sales AS decimal(28,2))) AS total
      FROM by_dept d LEFT JOIN {stores} s ON d.store_id = s.store_id GROUP BY s.store_type)"""


@query("share_by_store_type", _share_sql("store_dim"))
def share_by_store_type(r: Retail) -> DataFrame:
    return departments.share_by_store_type(r.by_dept, r.store_dim)


@query("share_by_store_type_dedup", _share_sql("(SELECT DISTINCT store_id, store_type FROM store_dim)"))
def share_by_store_type_dedup(r: Retail) -> DataFrame:
    return departments.share_by_store_type(r.by_dept, r.store_dim, fan_out=False)


# --- holidays --------------------------------------------------------------------------------

@query("holiday_summary", f"""
SELECT cast(grand_total AS double) AS grand_total, cast(holiday_total AS double) AS holiday_total,
       cast(nonholiday_total AS double) AS nonholiday_total,
       {near("holiday_avg", 6)} AS holiday_avg, {near("nonholiday_avg", 6)} AS nonholiday_avg,
       {near("(holiday_avg - nonholiday_avg) / nonholiday_avg * 100", 6)} AS pct_diff
FROM holiday_totals""")
def holiday_summary(r: Retail) -> DataFrame:
    return rounded(holiday.summary(r.by_store), 6, "holiday_avg", "nonholiday_avg", "pct_diff")


_SHARE = """
SELECT holiday, cast(total AS double) AS total, cast(total AS double) / cast(grand_total AS double) * 100.0 AS pct
FROM (SELECT 'FALSE' AS holiday, nonholiday_total AS total, grand_total FROM holiday_totals
      UNION ALL SELECT 'TRUE', holiday_total, grand_total FROM holiday_totals)"""


@query("holiday_share", _SHARE)
def holiday_share(r: Retail) -> DataFrame:
    return holiday.share(r.by_store)


@query("holiday_share_cum", f"""
SELECT holiday, total, pct, cumsum, cumsum - pct / 2 AS midpoint, format('{{:.1f}}%', pct) AS label
FROM (SELECT *, sum(pct) OVER (ORDER BY holiday DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumsum
      FROM ({_SHARE}))""")
def holiday_share_cum(r: Retail) -> DataFrame:
    return holiday.share_positions(r.by_store)


@query("holiday_avg_rows", f"""
SELECT type, {near("avg", 6)} AS avg, '$' || format('{{:,.0f}}', avg) AS label
FROM (SELECT 'Non-Holiday' AS type, nonholiday_avg AS avg FROM holiday_totals
      UNION ALL SELECT 'Holiday', holiday_avg FROM holiday_totals)""")
def holiday_avg_rows(r: Retail) -> DataFrame:
    return rounded(holiday.average_rows(r.by_store), 6, "avg")


@query("store_holiday_pivot", """
SELECT store_id,
       cast(coalesce(sum(cast(total_sales AS decimal(28,2))) FILTER (holiday = 'FALSE'), 0) AS double) / 1e6 AS nonholiday_m,
       cast(coalesce(sum(cast(total_sales AS decimal(28,2))) FILTER (holiday = 'TRUE'), 0) AS double) / 1e6 AS holiday_m
FROM labelled_stores GROUP BY store_id""")
def store_holiday_pivot(r: Retail) -> DataFrame:
    return holiday.store_pivot(r.by_store)


_TOP10 = """
SELECT store_id, cast(sum(cast(total_sales AS decimal(28,2))) AS double) AS total_sales FROM by_store GROUP BY store_id
ORDER BY total_sales DESC NULLS LAST, store_id LIMIT 10"""


@query("top10_stores", _TOP10)
def top10_stores(r: Retail) -> DataFrame:
    return holiday.top_stores(r.by_store)


@query("top_store_labels", f"""
SELECT store_id, store_type, holiday, total_sales / 1e6 AS total_sales_m,
       CASE WHEN store_id IN (SELECT store_id FROM ({_TOP10})) THEN format('{{:.0f}}M', total_sales / 1e6)
            ELSE '' END AS label
FROM labelled_stores""")
def top_store_labels(r: Retail) -> DataFrame:
    return holiday.store_labels(r.by_store)


@query("store_holiday_split", """
SELECT store_id, store_type, store_size, isholiday, total_sales, avg_weekly_sales, weeks_of_data,
       cast(sum(amount) OVER (PARTITION BY isholiday) AS double) AS flag_total,
       cast(sum(amount) OVER (PARTITION BY isholiday) AS double) / cast(sum(amount) OVER () AS double) * 100.0 AS flag_pct
FROM (SELECT *, cast(total_sales AS decimal(28,2)) AS amount FROM by_store WHERE isholiday IS NOT NULL)""")
def store_holiday_split(r: Retail) -> DataFrame:
    return holiday.store_split(r.by_store)


# --- economics -------------------------------------------------------------------------------

_EXACT_MEAN = "cast(sum(cast({c} AS decimal(28,10))) AS double) / count({c}) AS {c}"


@query("econ_weekly", f"""
SELECT store_date, sales_year, {near("avg(avg_weekly_sales)", 6)} AS avg_weekly_sales,
       {", ".join(_EXACT_MEAN.format(c=c) for c in economy.SERIES[1:])}
FROM factors GROUP BY store_date, sales_year""")
def econ_weekly(r: Retail) -> DataFrame:
    return rounded(economy.weekly(r.factors), 6, "avg_weekly_sales")


@query("fuel_by_month", """
SELECT sales_year, sales_month,
       cast(sum(cast(avg_fuel_price AS decimal(28,10))) AS double) / count(avg_fuel_price) AS avg_fuel_price,
       (sales_year - 2010) * 12 + sales_month AS month_num
FROM factors GROUP BY sales_year, sales_month""")
def fuel_by_month(r: Retail) -> DataFrame:
    return economy.fuel_by_month(r.factors)


def _trend_sql(x: str) -> str:
    return f"""
SELECT {near(f"regr_slope(avg_weekly_sales, {x})", 6)} AS slope, {near(f"regr_intercept(avg_weekly_sales, {x})", 6)} AS intercept,
       min({x}) AS x_min, max({x}) AS x_max
FROM factors"""


@query("trend_fuel", _trend_sql("avg_fuel_price"))
def trend_fuel(r: Retail) -> DataFrame:
    return rounded(economy.trend(r.factors, "avg_fuel_price"), 6, "slope", "intercept")


@query("trend_unemployment", _trend_sql("avg_unemployment"))
def trend_unemployment(r: Retail) -> DataFrame:
    return rounded(economy.trend(r.factors, "avg_unemployment"), 6, "slope", "intercept")


@query("trend_line", f"""
SELECT cast(point AS int) AS point, {near("x", 6)} AS x, {near("slope * x + intercept", 6)} AS y
FROM (SELECT point, slope, intercept, x_min + (x_max - x_min) * point / 99.0::double AS x
      FROM (SELECT regr_slope(avg_weekly_sales, avg_fuel_price) AS slope,
                   regr_intercept(avg_weekly_sales, avg_fuel_price) AS intercept,
                   min(avg_fuel_price) AS x_min, max(avg_fuel_price) AS x_max FROM factors), range(100) t(point))""")
def trend_line(r: Retail) -> DataFrame:
    return rounded(economy.trend_line(r.factors, "avg_fuel_price"), 6, "x", "y")


@query("econ_corr", f"""
SELECT {near("corr(avg_weekly_sales, avg_temperature)", 6)} AS corr_temperature,
       {near("corr(avg_weekly_sales, avg_fuel_price)", 6)} AS corr_fuel_price,
       {near("corr(avg_weekly_sales, avg_unemployment)", 6)} AS corr_unemployment,
       {near("corr(avg_weekly_sales, avg_cpi)", 6)} AS corr_cpi
FROM factors""")
def econ_corr(r: Retail) -> DataFrame:
    df = economy.correlations(r.factors)
    return rounded(df, 6, *df.columns)


# --- calendar --------------------------------------------------------------------------------

@query("sales_by_month", f"""
SELECT sales_month, month_name, cast(sum(cast(total_sales AS decimal(28,2))) AS double) / 1e6 AS total_sales_m,
       {near("avg(avg_weekly_sales)", 6)} AS avg_weekly
FROM by_date GROUP BY sales_month, month_name""")
def sales_by_month(r: Retail) -> DataFrame:
    return rounded(seasons.by_month(r.by_date), 6, "avg_weekly")


@query("yoy_week_num", """
SELECT sales_year, store_date, row_number() OVER (PARTITION BY sales_year ORDER BY store_date, isholiday) AS week_num,
       total_sales_m
FROM labelled_dates""")
def yoy_week_num(r: Retail) -> DataFrame:
    return seasons.year_over_year(r.by_date)


@query("holiday_weeks", """
SELECT store_date, total_sales_m, avg_weekly_sales FROM labelled_dates WHERE holiday = 'TRUE'""")
def holiday_weeks(r: Retail) -> DataFrame:
    return seasons.holiday_weeks(r.by_date)


@query("holiday_by_month", f"""
SELECT sales_month, month_name, holiday, {near("avg(avg_weekly_sales)", 6)} AS avg_weekly
FROM labelled_dates GROUP BY sales_month, month_name, holiday""")
def holiday_by_month(r: Retail) -> DataFrame:
    return rounded(seasons.holiday_by_month(r.by_date), 6, "avg_weekly")


@query("holiday_months", f"""
SELECT sales_month, month_name,
       {near("coalesce(avg(avg_weekly_sales) FILTER (holiday = 'FALSE'), 0)", 6)} AS nonholiday_avg,
       {near("avg(avg_weekly_sales) FILTER (holiday = 'TRUE')", 6)} AS holiday_avg
FROM labelled_dates GROUP BY sales_month, month_name HAVING count(*) FILTER (holiday = 'TRUE') > 0""")
def holiday_months(r: Retail) -> DataFrame:
    return rounded(seasons.holiday_months(r.by_date), 6, "nonholiday_avg", "holiday_avg")


@query("year_boundaries", """
SELECT DISTINCT sales_year, make_date(sales_year, 1, 1) AS boundary FROM by_date
WHERE sales_year > (SELECT min(sales_year) FROM by_date)""")
def year_boundaries(r: Retail) -> DataFrame:
    return seasons.year_boundaries(r.by_date)


# --- markdowns -------------------------------------------------------------------------------

# The short names that the markdown report gives the totals.
_SUMS = ["md1", "md2", "md3", "md4", "md5", "total_all", "total_sales"]
_SOURCES = [*[f"total_markdown{k}" for k in range(1, 6)], "total_all_markdowns", "total_sales"]
_BY_YEAR = f"""
SELECT sales_year, {', '.join(f'cast(sum(cast({s} AS decimal(28,2))) AS double) AS {c}'
                              for s, c in zip(_SOURCES, _SUMS, strict=True))}
FROM markdowns GROUP BY sales_year"""


@query("markdown_by_year", f"""
SELECT *, CASE WHEN total_all_m > 0
               THEN 'Total: $' || format('{{:,.0f}}', total_all_m) || 'M' || chr(10) || '(' ||
                    format('{{:.1f}}', pct_sales) || '% of sales)'
               ELSE 'No markdown' || chr(10) || 'data' END AS label
FROM (SELECT *, {', '.join(f'{c} / 1e6 AS {c}_m' for c in _SUMS)},
             CASE WHEN total_sales > 0 THEN total_all / total_sales * 100.0 ELSE 0.0 END AS pct_sales
      FROM ({_BY_YEAR}))""")
def markdown_by_year(r: Retail) -> DataFrame:
    return markdowns.by_year(r.markdowns)


@query("markdown_in_year", f"SELECT sales_year, total_all / 1e6 AS total_all_m FROM ({_BY_YEAR}) WHERE sales_year = 1998")
def markdown_in_year(r: Retail) -> DataFrame:
    return markdowns.in_year(r.markdowns, 1998)


@query("markdown_long", " UNION ALL ".join(
    f"SELECT sales_year, 'Markdown {k}' AS markdown, md{k} / 1e6 AS amount_m FROM ({_BY_YEAR})" for k in range(1, 6)))
def markdown_long(r: Retail) -> DataFrame:
    return markdowns.long_form(r.markdowns)


@query("markdown_yoy", f"""
SELECT from_year, sales_year AS to_year, (total_all - before) / before * 100.0 AS yoy_change
FROM (SELECT sales_year, total_all, row_number() OVER (ORDER BY sales_year) AS n,
             lag(sales_year) OVER (ORDER BY sales_year) AS from_year, lag(total_all) OVER (ORDER BY sales_year) AS before
      FROM ({_BY_YEAR}) WHERE total_all > 0) WHERE n = 2""")
def markdown_yoy(r: Retail) -> DataFrame:
    return markdowns.year_change(r.markdowns)


@query("profile", """
SELECT count(*) AS row_count, count(DISTINCT store_id) AS stores,
       string_agg(DISTINCT cast(sales_year AS varchar), ',' ORDER BY cast(sales_year AS varchar)) AS years,
       min(sales_year) AS first_year, max(sales_year) AS last_year
FROM markdowns""")
def profile(r: Retail) -> DataFrame:
    return markdowns.profile(r.markdowns)


# --- store types -----------------------------------------------------------------------------

_LINE = """
SELECT store_type, sales_month, cast(sum(cast(total_sales AS decimal(28,2))) AS double) / 1e6 AS total_sales_m
FROM by_type GROUP BY store_type, sales_month"""
_OF_TYPE = {f"type_{t.lower()}": f"store_type = '{t}'" for t in "ABC"} | {
    "type_other": "coalesce(store_type NOT IN ('A', 'B', 'C'), true)"}
_TYPE_SUM = "cast(sum(cast(total_sales AS decimal(28,2))) FILTER ({}) AS double)"
_PIVOT = "SELECT sales_month, " + ", ".join(
    f"{_TYPE_SUM.format(rule)} AS {c}" for c, rule in _OF_TYPE.items()) + " FROM by_type GROUP BY sales_month"
_MONTH_NAME = "strftime(make_date(2000, sales_month, 1), '%b') AS month_name"


@query("storetype_month_line", _LINE)
def storetype_month_line(r: Retail) -> DataFrame:
    return storetypes.monthly_line(r.by_type)


@query("storetype_size_totals", """
SELECT store_type, store_size, cast(sum(cast(total_sales AS decimal(28,2))) AS double) AS total_sales,
       count(DISTINCT store_id) AS stores
FROM by_store GROUP BY store_type, store_size""")
def storetype_size_totals(r: Retail) -> DataFrame:
    return storetypes.by_type_and_size(r.by_store)


@query("storetype_last_month", f"""
SELECT store_type, sales_month, total_sales_m, '$' || format('{{:,.0f}}', total_sales_m) || 'M' AS label
FROM (SELECT *, row_number() OVER (PARTITION BY store_type ORDER BY sales_month DESC) AS rn FROM ({_LINE}))
WHERE rn = 1""")
def storetype_last_month(r: Retail) -> DataFrame:
    return storetypes.last_month(r.by_type)


@query("storetype_month_pivot", f"SELECT sales_month, {_MONTH_NAME}, {', '.join(_OF_TYPE)} FROM ({_PIVOT})")
def storetype_month_pivot(r: Retail) -> DataFrame:
    return storetypes.month_pivot(r.by_type)


_TOTALS = f"""
SELECT sales_month, {_MONTH_NAME}, {', '.join(_OF_TYPE)} FROM ({_PIVOT})
UNION ALL
SELECT 99, 'TOTAL', """ + ", ".join(f"coalesce({_TYPE_SUM.format(rule)}, 0)" for rule in _OF_TYPE.values()) + " FROM by_type"


@query("storetype_month_totals", _TOTALS)
def storetype_month_totals(r: Retail) -> DataFrame:
    return storetypes.month_totals(r.by_type)


@query("storetype_month_table", "SELECT sales_month, month_name, " + ", ".join(
    f"coalesce('$' || format('{{:,.0f}}', {c} / 1e6) || 'M', '-') AS {c}" for c in _OF_TYPE)
    + f" FROM ({_TOTALS})")
def storetype_month_table(r: Retail) -> DataFrame:
    return storetypes.month_table(r.by_type)


_LONG = "SELECT store_type, {} AS sales_month, {} AS month_name, " + _TYPE_SUM.format("true") + " AS total_sales FROM by_type GROUP BY {}"


@query("storetype_month_found", f"SELECT sales_month, {_MONTH_NAME}, {', '.join(_OF_TYPE)} FROM ({_PIVOT})")
def storetype_month_found(r: Retail) -> DataFrame:
    """The pivot with a column for each type that occurs."""
    return storetypes.month_pivot(r.by_type, storetypes.store_types(r.by_type))


@query("storetype_month_long",
       _LONG.format("sales_month", _MONTH_NAME.removesuffix(" AS month_name"), "store_type, sales_month")
       + " UNION ALL " + _LONG.format("99", "'TOTAL'", "store_type"))
def storetype_month_long(r: Retail) -> DataFrame:
    return storetypes.month_long(r.by_type)
