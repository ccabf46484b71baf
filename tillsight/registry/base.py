"""Frames shared by the queries, their SQL counterparts, and the query table."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures
from ..functions.casts import decimals_to_double
from ..operators import dims, facts
from ..plans import marts
from ..schemas import MARKDOWNS
from ..session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Retail:
    """Lazy frames over one folder of tables; nothing runs until a query does."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = tune(spark), folder

    @cached_property
    def stores_raw(self) -> DataFrame:
        return fixtures.stores_raw(self.spark, self.folder)

    @cached_property
    def department_raw(self) -> DataFrame:
        return fixtures.department_raw(self.spark, self.folder)

    @cached_property
    def department_keys(self) -> DataFrame:
        return fixtures.department_keys(self.spark, self.folder)

    @cached_property
    def fact_raw(self) -> DataFrame:
        return fixtures.fact_raw(self.spark, self.folder)

    @cached_property
    def sales(self) -> DataFrame:
        return facts.sales(self.department_raw)

    @cached_property
    def economics(self) -> DataFrame:
        return facts.economics(self.fact_raw)

    @cached_property
    def date_dim(self) -> DataFrame:
        return dims.date_dim(self.department_keys)

    @cached_property
    def store_dim(self) -> DataFrame:
        return dims.store_dim(self.department_raw, self.stores_raw)

    @cached_property
    def enriched(self) -> DataFrame:
        return facts.enriched(self.sales, self.economics, self.date_dim, self.store_dim)

    # The marts read current sales. Dimension and economics rows are unique on their keys here, so
    # the joins of ``enriched`` keep its rows as they are, and each mart starts from the columns it needs.

    @cached_property
    def rows(self) -> DataFrame:
        return marts.row_measures(self.sales)

    @cached_property
    def weeks(self) -> DataFrame:
        return marts.week_measures(self.sales, self.economics)

    @cached_property
    def by_dept(self) -> DataFrame:
        return marts.sales_by_dept(self.rows)

    @cached_property
    def by_store(self) -> DataFrame:
        return marts.sales_by_store(self.rows, self.store_dim, self.date_dim)

    @cached_property
    def by_date(self) -> DataFrame:
        return marts.sales_by_date_parts(self.rows, self.date_dim)

    @cached_property
    def by_type(self) -> DataFrame:
        return marts.sales_by_storetype_month(self.rows, self.store_dim)

    @cached_property
    def markdowns(self) -> DataFrame:
        return marts.markdown_by_year_store(self.weeks, self.store_dim)

    @cached_property
    def factors(self) -> DataFrame:
        return marts.economic_factors(self.weeks)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round means, slopes and correlations of doubles, whose last bits depend on the order of addition, so
    that they can be compared. ``near`` is the same in SQL. The report functions themselves never round."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def query(name: str, sql: str | None = None):
    """Register a query under a name, with the SQL that must give the same rows."""
    def add(fn: Callable[[Retail], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return decimals_to_double(fn(Retail(spark, folder)))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return fn

    return add


# --- SQL side --------------------------------------------------------------------------------

def avg(column: str, alias: str | None = None) -> str:
    text = f"cast(sum({column}) AS double) / nullif(count({column}), 0)"
    return text if alias is None else f"{text} AS {alias}"


def near(expr: str, digits: int) -> str:
    return f"round({expr}, {digits})"


def total(expr: str, alias: str) -> str:
    return f"cast(sum({expr}) AS double) AS {alias}"


_FRIDAY = "cast(date_trunc('week', l_shipdate) AS date) + 4"
_HOLIDAY = "CASE WHEN weekofyear(store_date) IN (6, 36, 47, 52) THEN 'TRUE' ELSE 'FALSE' END"


def _department_raw(amount: str) -> str:
    return f"""
    SELECT cast(store_id AS varchar) AS store_id, cast(dept_id AS varchar) AS dept_id,
           cast(store_date AS varchar) AS store_date,
           CASE WHEN (store_id * 7 + dept_id) % 97 = 0 THEN 'NA' ELSE cast(amount AS varchar) END AS weekly_sales,
           {_HOLIDAY} AS isholiday
    FROM (SELECT store_id, p_size AS dept_id, store_date, cast(sum({amount}) AS decimal(28,2)) AS amount
          FROM line JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""


_MARKDOWN_RAW = ", ".join(
    f"coalesce(cast(sum(CASE WHEN l_linenumber = {k} AND di > 0 AND year(store_date) >= 1997 "
    f"THEN cast(px * di AS decimal(18,2)) END) AS varchar), 'NA') AS markdown{k}" for k in range(1, 6))


def _sales(source: str, where: str = "store_date IS NOT NULL") -> str:
    return f"""
    SELECT cast(store_id AS int) AS store_id, cast(dept_id AS int) AS dept_id, cast(store_date AS date) AS store_date,
           try_cast(weekly_sales AS decimal(18,2)) AS store_weekly_sales
    FROM {source} WHERE {where}"""


def _date_dim(source: str, where: str = "true") -> str:
    return f"""
    SELECT row_number() OVER (ORDER BY store_date, isholiday) AS date_id, store_date, isholiday
    FROM (SELECT DISTINCT cast(store_date AS date) AS store_date, cast(isholiday AS boolean) AS isholiday
          FROM {source} WHERE {where})"""


def _enriched(sales: str, dates: str) -> str:
    """Every sale with what is known of its store-week, its date and its department."""
    parts = " || '-' || ".join(f"coalesce(cast({c} AS varchar), '_dbt_utils_surrogate_key_null_')"
                               for c in ("store_id", "dept_id", "store_date"))
    measures = ", ".join(["store_weekly_sales", "fuel_price", "temperature", "cpi", "unemployment", *MARKDOWNS])
    return f"""
    SELECT md5({parts}) AS snapshot_key, store_id, dept_id, date_id, store_date, store_type, store_size, {measures}
    FROM {sales}
    LEFT JOIN (SELECT store_date, date_id FROM {dates}) USING (store_date)
    LEFT JOIN store_dim USING (store_id, dept_id)
    LEFT JOIN economics USING (store_id, store_date)"""


_FIGURES = ", ".join([
    total("store_weekly_sales", "total_sales"), avg("store_weekly_sales", "avg_weekly_sales"),
    "cast(max(store_weekly_sales) AS double) AS max_weekly_sales",
    "cast(min(store_weekly_sales) AS double) AS min_weekly_sales"])


def _by_store(stores: str) -> str:
    return f"""
    SELECT f.store_id, s.store_type, s.store_size, d.isholiday,
           count(DISTINCT f.store_date) AS weeks_of_data, {_FIGURES}
    FROM enriched f JOIN {stores} s ON s.store_id = f.store_id JOIN date_dim d ON d.store_date = f.store_date
    GROUP BY f.store_id, s.store_type, s.store_size, d.isholiday"""


def _by_type(stores: str) -> str:
    return f"""
    SELECT s.store_type, cast(year(f.store_date) AS int) AS sales_year, cast(month(f.store_date) AS int) AS sales_month,
           strftime(f.store_date, '%Y-%m') AS year_month, {avg('store_weekly_sales', 'avg_weekly_sales')},
           {total('store_weekly_sales', 'total_sales')}, count(DISTINCT f.store_id) AS num_stores
    FROM enriched f JOIN {stores} s ON s.store_id = f.store_id
    GROUP BY ALL"""


_MD_FIGURES = ", ".join([
    *[avg(m, f"avg_{m}") for m in MARKDOWNS],
    *[total(f"coalesce({m}, 0)", f"total_{m}") for m in MARKDOWNS],
    total(" + ".join(f"coalesce({m}, 0)" for m in MARKDOWNS), "total_all_markdowns")])

# Named building blocks, each a query over tables and earlier blocks.
TABLES = {
    "line": f"""
    SELECT cast(l_suppkey AS int) AS store_id, l_partkey, l_linenumber, l_returnflag, {_FRIDAY} AS store_date,
           cast(l_extendedprice AS decimal(18,2)) AS px, cast(l_discount AS decimal(4,2)) AS di,
           cast(l_tax AS decimal(4,2)) AS tx, cast(l_quantity AS decimal(10,2)) AS qty,
           cast(cast(l_extendedprice AS decimal(18,2)) * (1 - cast(l_discount AS decimal(4,2))) AS decimal(18,2)) AS amount
    FROM lineitem""",
    "stores_raw": """
    SELECT cast(s_suppkey AS varchar) AS store_id,
           CASE s_nationkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS store_type,
           cast(34000 + (s_suppkey * 997) % 185000 AS varchar) AS store_size
    FROM supplier""",
    "department_raw": _department_raw("CASE WHEN l_returnflag = 'R' THEN -amount ELSE amount END"),
    "department_gross": _department_raw("amount"),
    "fact_raw": f"""
    SELECT cast(store_id AS varchar) AS store_id, cast(store_date AS varchar) AS store_date,
           cast(sum(qty) AS varchar) AS temperature, cast(max(tx) + 2 AS varchar) AS fuel_price,
           {_MARKDOWN_RAW}, cast(max(px) AS varchar) AS cpi, cast(min(di) * 100 AS varchar) AS unemployment,
           {_HOLIDAY} AS isholiday
    FROM line GROUP BY store_id, line.store_date""",
    "sales": _sales("department_raw"),
    "economics": f"""
    SELECT cast(store_id AS int) AS store_id, cast(store_date AS date) AS store_date,
           try_cast(temperature AS decimal(10,4)) AS temperature, try_cast(fuel_price AS decimal(10,4)) AS fuel_price,
           try_cast(cpi AS decimal(18,4)) AS cpi, try_cast(unemployment AS decimal(10,4)) AS unemployment,
           {', '.join(f'try_cast({m} AS decimal(18,2)) AS {m}' for m in MARKDOWNS)}
    FROM fact_raw WHERE store_date IS NOT NULL""",
    "date_dim": _date_dim("department_raw"),
    "store_dim": """
    SELECT store_id, dept_id, store_type, store_size FROM (
        SELECT d.store_id, d.dept_id, s.store_type, cast(s.store_size AS int) AS store_size,
               row_number() OVER (PARTITION BY d.store_id, d.dept_id ORDER BY s.store_type, cast(s.store_size AS int)) AS rn
        FROM (SELECT DISTINCT cast(store_id AS int) AS store_id, cast(dept_id AS int) AS dept_id FROM department_raw) d
        LEFT JOIN stores_raw s ON cast(s.store_id AS int) = d.store_id) WHERE rn = 1""",
    "store_one": "SELECT DISTINCT store_id, store_type, store_size FROM store_dim",
    "enriched": _enriched("sales", "date_dim"),
    "by_dept": f"""
    SELECT store_id, dept_id, count(DISTINCT store_date) AS weeks_of_data, {_FIGURES}
    FROM enriched GROUP BY store_id, dept_id""",
    "by_store": _by_store("store_dim"),
    "by_store_dedup": _by_store("store_one"),
    "by_date": f"""
    SELECT f.store_date, cast(year(f.store_date) AS int) AS sales_year, cast(month(f.store_date) AS int) AS sales_month,
           strftime(f.store_date, '%b') AS month_name, cast(weekofyear(f.store_date) AS int) AS week_of_year,
           strftime(f.store_date, '%Y-%m') AS year_month, d.isholiday,
           {total('store_weekly_sales', 'total_sales')}, {avg('store_weekly_sales', 'avg_weekly_sales')},
           count(f.store_id) AS num_stores
    FROM enriched f LEFT JOIN date_dim d ON d.store_date = f.store_date GROUP BY ALL""",
    "by_type": _by_type("store_dim"),
    "by_type_dedup": _by_type("(SELECT DISTINCT store_id, store_type FROM store_dim)"),
    "store_types": "SELECT store_id, max(store_type) AS store_type FROM store_dim GROUP BY ALL",
    "markdowns": f"""
    SELECT store_id, store_type, cast(sales_year AS int) AS sales_year,
           {total('store_weekly_sales', 'total_sales')}, {_MD_FIGURES}
    FROM (SELECT * EXCLUDE (store_type), year(store_date) AS sales_year FROM enriched) LEFT JOIN store_types USING (store_id)
    GROUP BY store_id, store_type, sales_year""",
    "markdowns_dedup": f"""
    SELECT f.store_id, s.store_type, cast(year(f.store_date) AS int) AS sales_year,
           {total('sold', 'total_sales')}, {_MD_FIGURES}
    FROM (SELECT store_id, store_date, sum(store_weekly_sales) AS sold, {', '.join(f'max({m}) AS {m}' for m in MARKDOWNS)}
          FROM enriched GROUP BY store_id, store_date) f
    LEFT JOIN store_types s ON f.store_id = s.store_id
    GROUP BY f.store_id, s.store_type, year(f.store_date)""",
    "factors": f"""
    SELECT store_id, store_date, cast(year(store_date) AS int) AS sales_year, cast(month(store_date) AS int) AS sales_month,
           {avg('store_weekly_sales', 'avg_weekly_sales')},
           {', '.join(avg(m, f'avg_{m}') for m in ['temperature', 'fuel_price', 'cpi', 'unemployment', *MARKDOWNS])}
    FROM enriched GROUP BY store_id, store_date""",
    "labelled_stores": "SELECT *, CASE WHEN isholiday THEN 'TRUE' ELSE 'FALSE' END AS holiday FROM by_store",
    "labelled_dates": """
    SELECT *, CASE WHEN isholiday THEN 'TRUE' ELSE 'FALSE' END AS holiday, total_sales / 1e6 AS total_sales_m FROM by_date""",
    "holiday_totals": """
    SELECT sum(total_sales) AS grand_total, coalesce(sum(total_sales) FILTER (holiday = 'TRUE'), 0) AS holiday_total,
           coalesce(sum(total_sales) FILTER (holiday = 'FALSE'), 0) AS nonholiday_total,
           avg(avg_weekly_sales) FILTER (holiday = 'TRUE') AS holiday_avg,
           avg(avg_weekly_sales) FILTER (holiday = 'FALSE') AS nonholiday_avg
    FROM (SELECT holiday, avg_weekly_sales, cast(total_sales AS decimal(28,2)) AS total_sales FROM labelled_stores)""",
}


def with_tables(sql: str) -> str:
    """The statement behind a WITH clause of the blocks it uses, directly or through others."""
    used: set[str] = set()

    def visit(text: str) -> None:
        for name in TABLES:
            if name not in used and re.search(rf"\b{name}\b", text):
                used.add(name)
                visit(TABLES[name])

    visit(sql)
    clause = ",\n".join(f"{name} AS ({TABLES[name]})" for name in TABLES if name in used)
    return f"WITH {clause}\n{sql}" if clause else sql
