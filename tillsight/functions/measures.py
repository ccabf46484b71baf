"""Arithmetic on measures: null defaults, row sums, ratios, scaling."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_default(c: str | Column, default: int = 0) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(default))


def row_sum(*columns: str | Column) -> Column:
    """Sum across columns of a row, nulls as zero."""
    return reduce(add, [null_default(c) for c in columns])


def mean_of(total: str | Column, n: str | Column) -> Column:
    """Exact total over count as DOUBLE; null for an empty group."""
    total = F.col(total) if isinstance(total, str) else total
    n = F.col(n) if isinstance(n, str) else n
    return F.try_divide(total.cast("double"), n.cast("double"))


def pct_of(part: Column, whole: Column) -> Column:
    """Part as a percentage of the whole; null where the whole is zero or null."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)


def pct_change(new: Column, old: Column) -> Column:
    """Relative change in percent; null where the old value is zero or null."""
    new, old = new.cast("double"), old.cast("double")
    return F.try_divide(new - old, old) * F.lit(100.0)


def scaled(c: str | Column, unit: float) -> Column:
    """Value in thousands (1e3), millions (1e6) or billions (1e9)."""
    return (F.col(c) if isinstance(c, str) else c).cast("double") / F.lit(float(unit))


def range_bounds(total: str = "total_sales", low: str = "min_weekly_sales",
                 high: str = "max_weekly_sales") -> list[Column]:
    """Absolute distances of a total from its minimum and maximum (negative minima occur)."""
    return [
        F.abs(F.col(total) - F.col(low)).alias("error_low"),
        F.abs(F.col(high) - F.col(total)).alias("error_high"),
    ]
