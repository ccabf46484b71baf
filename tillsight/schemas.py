"""Declared schemas. Nothing in the package infers one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Landing columns in file order. File headers differ, so columns map by position.
STORES_COLUMNS = ["store_id", "store_type", "store_size"]
DEPARTMENT_COLUMNS = ["store_id", "dept_id", "store_date", "weekly_sales", "isholiday"]
FACT_COLUMNS = ["store_id", "store_date", "temperature", "fuel_price", "markdown1", "markdown2",
                "markdown3", "markdown4", "markdown5", "cpi", "unemployment", "isholiday"]

# The markdown columns.
MARKDOWNS = ["markdown1", "markdown2", "markdown3", "markdown4", "markdown5"]

# The measures whose change opens a new version of a sales record.
CHECK_COLUMNS = ["store_weekly_sales", "fuel_price", "temperature", "cpi", "unemployment", *MARKDOWNS]

AUDIT_COLUMNS = ["insert_date", "update_date"]

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(10, 4)
INDEX = T.DecimalType(18, 4)
TOTAL = T.DecimalType(38, 2)


@dataclass(frozen=True)
class Landing:
    """One landed file family: target table, file-name pattern, columns in file order.

    ``multi_line`` reads quoted line breaks inside fields; its files are then not split over tasks.
    """

    table: str
    pattern: str
    columns: tuple[str, ...]
    multi_line: bool = False

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


LANDINGS = {
    "stores_raw": Landing("stores_raw", "stores*.csv", tuple(STORES_COLUMNS)),
    "department_raw": Landing("department_raw", "department*.csv", tuple(DEPARTMENT_COLUMNS)),
    "fact_raw": Landing("fact_raw", "fact*.csv", tuple(FACT_COLUMNS)),
}


@dataclass(frozen=True)
class VersionColumns:
    """Names of the four version-metadata columns of a versioned table."""

    valid_from: str = "dbt_valid_from"
    valid_to: str = "dbt_valid_to"
    scd_id: str = "dbt_scd_id"
    updated_at: str = "dbt_updated_at"


# The older naming of the same table, kept so that queries written for it still run.
VRSN_COLUMNS = VersionColumns(valid_from="vrsn_start_date", valid_to="vrsn_end_date")
