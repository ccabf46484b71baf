from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction
from math import sqrt

import pytest

from tillsight.plans import economy


def exact(pairs):
    """(slope, intercept, correlation) over rationals."""
    xs, ys = [[Fraction(Decimal(repr(v)).quantize(Decimal("1e-8"), ROUND_HALF_UP)) for v in side] for side in zip(*pairs)]
    mx, my = sum(xs) / len(xs), sum(ys) / len(ys)
    xx, yy = (sum((v - m) ** 2 for v in side) for side, m in ((xs, mx), (ys, my)))
    xy = sum((a - mx) * (b - my) for a, b in zip(xs, ys))
    return float(xy / xx), float(my - xy / xx * mx), float(xy) / sqrt(float(xx)) / sqrt(float(yy))


def frame(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in economy.SERIES))


def test_same_result_on_any_partitioning(spark):
    r = random.Random(1)
    # CPI far from zero with a small range: sums of plain squares would lose most digits.
    rows = [(r.uniform(-5e3, 3e5), r.uniform(-9, 99), r.uniform(2, 5), r.uniform(3, 14), 1e6 + 0.3 + r.uniform(0, 1e-2)) for _ in range(3000)]
    rows += [(None, 1e4, 1e4, 1e4, 9e6), (5.0, None, None, None, None)]
    seen = set()
    for n in (1, 8, 40):
        data = frame(spark, r.sample(rows, len(rows))).repartition(n)
        trends = [tuple(economy.trend(data, c).first()) for c in economy.SERIES[1:]]
        seen.add((tuple(trends), tuple(economy.correlations(data).first())))
    assert len(seen) == 1
    trends, corr = seen.pop()
    for i, c in enumerate(economy.SERIES[1:], 1):
        slope, intercept, rho = exact([(v[i], v[0]) for v in rows if v[0] is not None and v[i] is not None])
        assert trends[i - 1][:2] == pytest.approx((slope, intercept), rel=1e-9)
        assert corr[i - 1] == pytest.approx(rho, rel=1e-9)
        assert trends[i - 1][2:] == (min(v[i] for v in rows if v[i] is not None), max(v[i] for v in rows if v[i] is not None))


def test_constant_and_missing_values(spark):
    flat = frame(spark, [(float(i), 2.7, 2.5, 1.0, 100.1) for i in range(5)] + [(None, 3.0, 3.0, 3.0, 3.0)])
    got = economy.trend(flat, "avg_fuel_price").first()
    assert (got["slope"], got["intercept"], got["x_min"], got["x_max"]) == (None, None, 2.5, 3.0)
    assert set(economy.correlations(flat).first()) == {None}
    none = frame(spark, [])
    assert set(economy.trend(none, "avg_cpi").first()) == {None} and set(economy.correlations(none).first()) == {None}
    with pytest.raises(Exception, match="(?i)overflow|out of range|cannot be represented"):
        economy.trend(frame(spark, [(1e12, 1.0, 1.0, 1.0, 1.0), (0.0, 2.0, 2.0, 2.0, 2.0)]), "avg_cpi").collect()
