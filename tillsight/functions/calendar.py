"""Calendar parts of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names in order.
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def date_parts(date: str = "store_date") -> list[Column]:
    """Year, month, short month name, ISO week and yyyy-MM of a date column."""
    d = F.col(date)
    return [
        F.year(d).alias("sales_year"),
        F.month(d).alias("sales_month"),
        F.date_format(d, "MMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
    ]


def month_name(month: str | Column) -> Column:
    """Month number to short name by lookup; null outside 1-12."""
    m = F.col(month) if isinstance(month, str) else month
    return F.get(F.array(*[F.lit(n) for n in MONTH_NAMES]), m - 1)


def month_ordinal(year: str, month: str, base_year: int = 2010) -> Column:
    """Months counted from the start of ``base_year``, the first one being 1."""
    return (F.col(year) - F.lit(base_year)) * F.lit(12) + F.col(month)
