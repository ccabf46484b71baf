"""Report datasets over the economics mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import month_ordinal
from ..functions.measures import mean_of

SERIES = ["avg_weekly_sales", "avg_temperature", "avg_fuel_price", "avg_unemployment", "avg_cpi"]
VALUE, TOTAL = "decimal(18,8)", "decimal(37,16)"


def weekly(economics: DataFrame) -> DataFrame:
    """Unweighted mean over stores per date. A store-week's economics are short decimals, so they sum exactly."""
    def exact(c: str) -> Column:
        value = F.col(c).cast("decimal(28,10)")
        return mean_of(F.sum(value), F.count(value)).alias(c)

    return economics.groupBy("store_date", "sales_year").agg(
        F.avg(SERIES[0]).alias(SERIES[0]), *[exact(c) for c in SERIES[1:]])


def fuel_by_month(economics: DataFrame, base_year: int = 2010) -> DataFrame:
    """Mean over stores and weeks. Prices have four decimals, so summing them as decimals is exact."""
    price = F.col("avg_fuel_price").cast("decimal(28,10)")
    return (economics.groupBy("sales_year", "sales_month")
            .agg(mean_of(F.sum(price), F.count(price)).alias("avg_fuel_price"))
            .withColumn("month_num", month_ordinal("sales_year", "sales_month", base_year)))


def _moments(x: str, y: str) -> list[Column]:
    """Exact sums over the pairs without nulls, named after x; values are taken to eight decimals."""
    a = F.when(F.col(y).isNotNull(), F.col(x)).cast(VALUE)
    b = F.when(F.col(x).isNotNull(), F.col(y)).cast(VALUE)
    found = {"n": F.count(a), "x": F.sum(a), "y": F.sum(b), "xx": F.sum(a * a), "xy": F.sum(a * b), "yy": F.sum(b * b),
             "flat_x": F.min(a) == F.max(a), "flat_y": F.min(b) == F.max(b)}
    return [v.alias(f"{x}_{name}") for name, v in found.items()]


def _spreads(x: str) -> tuple[Column, Column, Column]:
    """n times the sums of (x-mean)^2, (x-mean)(y-mean) and (y-mean)^2 from the moments; null where one is constant.

    The moments are moved to the whole number next to each mean while they are still exact, so that nothing is lost
    where a range lies far from zero. They do not depend on the order of addition, hence neither does the result.
    A sum of products past 10^21 raises an error.
    """
    n, sx, sy, sxx, sxy, syy, flat_x, flat_y = (
        F.col(f"{x}_{c}") for c in ("n", "x", "y", "xx", "xy", "yy", "flat_x", "flat_y"))
    n, sx, sy = n.cast("decimal(11,0)"), sx.cast("decimal(26,8)"), sy.cast("decimal(26,8)")
    near_x, near_y = (F.round(mean_of(s, n)).cast("decimal(10,0)") for s in (sx, sy))
    x0, y0 = (sx - n * near_x).cast("decimal(26,8)"), (sy - n * near_y).cast("decimal(26,8)")

    def moved(total: Column, near: Column, rest: Column, other: Column, other0: Column) -> Column:
        less = (near * rest).cast(TOTAL)
        return ((total.cast(TOTAL) - less).cast(TOTAL) - (other * other0).cast(TOTAL)).cast("double")

    xx, xy, yy = (moved(sxx, near_x, sx, near_x, x0), moved(sxy, near_x, sy, near_y, x0), moved(syy, near_y, sy, near_y, y0))
    n, x0, y0 = n.cast("double"), x0.cast("double"), y0.cast("double")
    return F.when(~flat_x, n * xx - x0 * x0), n * xy - x0 * y0, F.when(~flat_y, n * yy - y0 * y0)


def trend(economics: DataFrame, x: str, y: str = "avg_weekly_sales") -> DataFrame:
    """Least-squares slope and intercept of y over x, and the range of x; the same on any number of partitions."""
    sums = economics.agg(*_moments(x, y), F.min(x).alias("x_min"), F.max(x).alias("x_max"))
    xx, xy, _ = _spreads(x)
    means = [mean_of(f"{x}_{c}", f"{x}_n") for c in "yx"]
    return (sums.withColumn("slope", xy / xx)
            .select("slope", (means[0] - F.col("slope") * means[1]).alias("intercept"), "x_min", "x_max"))


def trend_line(economics: DataFrame, x: str, y: str = "avg_weekly_sales", points: int = 100) -> DataFrame:
    """Evenly spaced points on the trend from the smallest to the largest x."""
    at = F.col("x_min") + (F.col("x_max") - F.col("x_min")) * F.col("point") / F.lit(float(points - 1))
    return (trend(economics, x, y)
            .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
            .withColumn("x", at)
            .select("point", "x", (F.col("slope") * F.col("x") + F.col("intercept")).alias("y")))


def correlations(economics: DataFrame) -> DataFrame:
    """Correlation of sales with each economic measure, null where one is constant; the same on any number of
    partitions."""
    def corr(c: str) -> Column:
        xx, xy, yy = _spreads(c)
        return xy / (F.sqrt(xx) * F.sqrt(yy))

    sums = economics.agg(*[m for c in SERIES[1:] for m in _moments(c, SERIES[0])])
    return sums.select(*[corr(c).alias(f"corr_{c[4:]}") for c in SERIES[1:]])
