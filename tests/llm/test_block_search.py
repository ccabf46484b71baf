from __future__ import annotations

import math
import random

import numpy as np

from tillsight.llm import block_search as op


def brute(rows, k=20):
    good = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for q, a in good:
        if q % 20 == 0:
            scored = []
            for i, b in good:
                if i != q and len(a) == len(b):
                    s = 0.0
                    for x, y in zip(a, b):
                        s += x * y
                    scored.append((-s, i))
            out += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def found(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, dim string").repartition(3)


def test_odd_vectors(spark):
    r = random.Random(8)
    rows = [(i, [float(np.float32(r.gauss(0, 1))) for _ in range(12)]) for i in range(300)]
    rows += [(400 + i, [1.0, 0.0, 2.0] * 4) for i in range(60)]  # ties
    rows += [(500, None), (520, []), (540, [0.0] * 12), (560, [1.0] * 11 + [float("nan")]), (580, [float("inf")] + [1.0] * 11),
             (600, [None] + [1.0] * 11), (None, [1.0] * 12), (620, [1.0, 2.0]), (640, [2.0, 1.0]), (660, [5.0]), (-20, [0.5] * 12),
             (680, [1e-9] * 12), (700, [1e6] * 12), (1, [3.0] * 12)]
    assert found(op.query(frame(spark, rows))) == brute(rows)


def test_small_blocks_and_heavy_pruning(spark):
    r = np.random.default_rng(2)
    rows = [(int(i), (r.normal(size=16) * r.choice([0.1, 1, 30])).tolist()) for i in range(700)]
    usable = op.usable(frame(spark, rows))
    assert found(op.nearest(usable.where("id % 20 = 0"), usable, 5, block=64)) == brute(rows, 5)


def test_bounds_hold():
    r = np.random.default_rng(3)
    x, y = r.normal(size=(50, 40)) * r.exponential(size=(50, 1)), r.normal(size=(60, 40))
    (qx, sx, ex, nx), (qy, sy, ey, ny) = op.quantise(x), op.quantise(y)
    near = (qx * sx[:, None]) @ (qy * sy[:, None]).T
    off = ex[:, None] * (ny + ey)[None, :] + nx[:, None] * ey[None, :]
    assert (np.abs(near - x @ y.T) <= off + 1e-12).all()


def test_few_and_none(spark):
    assert found(op.query(frame(spark, [(0, [1.0]), (7, [2.0])]))) == [(0, 1, 7, 2.0)]
    assert found(op.query(frame(spark, [(0, [1.0])]))) == [] and found(op.query(frame(spark, []))) == []


def test_a_table_united_with_itself(spark):
    r = np.random.default_rng(7)
    rows = [(int(i), r.normal(size=8).tolist()) for i in range(100)]
    twice = frame(spark, rows).union(frame(spark, rows))
    for block in (16, op.BLOCK):
        usable = op.usable(twice)
        got = found(op.nearest(usable.where("id % 20 = 0"), usable, 20, block))
        want = [(q, n, i, s) for q, first, i, s in brute(rows, 10) for n in (2 * first - 1, 2 * first)]
        assert got == sorted(want)


def test_different_vectors_under_one_query_id(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [5.0, 1.0]), (2, [1.0, 7.0])]
    assert found(op.query(frame(spark, rows))) == [(20, 1, 1, 5.0), (20, 1, 2, 7.0), (20, 2, 1, 1.0), (20, 2, 2, 1.0)]


def test_candidates_are_not_dealt_by_length(spark):
    usable = op.usable(frame(spark, [(i, [float(i + 1), 1.0]) for i in range(50)]))
    plan = op.nearest(usable, usable)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(dim" not in plan
