from __future__ import annotations

from fractions import Fraction
from math import floor

import numpy as np
import pytest
from pyspark.sql import types as T

from tillsight.llm import embedding_whitening as op

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("x", T.StringType()), T.StructField("I", T.StringType())])


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "a", "b")
                                  for i, v in rows], SCHEMA).repartition(parts)


def brute(rows, k=8):
    """Number, deviations by id, eigenvalue shares and whitened vectors by a dense eigendecomposition."""
    x = [[floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums)] for v in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    k = min(k, int((values > 1e-9 * values.max()).sum()))
    values, vectors = values[order], vectors[:, order]
    return n, deviation, values[:k] / values.sum(), centred @ vectors[:, :k] / np.sqrt(values[:k])


def agree(got, rows, sort=lambda r: r[0]):
    n, deviation, share, white = brute(rows)
    k = len(share)
    assert len(got) == len(rows) * k and {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-9 and len({r.identity_error for r in got}) == 1
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    mine = np.array([[by[i][c].whitened for c in range(1, k + 1)] for i, _ in rows])
    sign = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine * sign - white).max() < 1e-6
    assert np.allclose([by[rows[0][0]][c].explained for c in range(1, k + 1)], share, rtol=1e-9)
    assert [by[i][1].deviation for i, _ in rows] == deviation


def test_against_dense_eigenvectors(spark):
    r = np.random.default_rng(1)
    base = r.normal(size=(300, 12)) * np.geomspace(1, 0.2, 12) + r.normal(size=12)
    rows = [(i, v.astype(np.float32)) for i, v in enumerate(base)]
    agree(op.query(frame(spark, rows, 7)).collect(), rows)


@pytest.mark.parametrize("shape", ["few", "constant", "repeated", "one"])
def test_directions_without_variance(spark, shape):
    r = np.random.default_rng(2)
    base = r.normal(size=(5 if shape == "few" else 60, 10))
    if shape == "constant":
        base[:, 3] = 0.25
    if shape == "repeated":
        base[:, 7] = base[:, 2]
        base[:, 8] = base[:, 2]
        base[:, 9] = base[:, 2]
    if shape == "one":
        base[:, 1:] = base[:, :1]
    rows = [(i, v.astype(np.float32)) for i, v in enumerate(base)]
    agree(op.query(frame(spark, rows)).collect(), rows)


def test_small_variance_beside_large(spark):
    r = np.random.default_rng(3)
    base = r.normal(size=(400, 6)) * np.array([1e6, 1e4, 100, 1, 1, 1])
    base[:, 5] = base[:, 0]
    rows = [(i, v.astype(np.float32)) for i, v in enumerate(base)]
    got = op.query(frame(spark, rows)).collect()
    assert max(c.component for c in got) == 5 and got[0].identity_error < 1e-9
    n, deviation, *_ = brute(rows)
    assert {c.vec_id: c.deviation for c in got} == {i: d if d < 1 << 63 else None for (i, _), d in zip(rows, deviation)}


def test_odd_rows(spark):
    r = np.random.default_rng(4)
    good = [(i, r.normal(size=9).astype(np.float32)) for i in range(40)]
    odd = [(100, None), (101, []), (102, [None] + [1.0] * 8), (103, [float("nan")] * 9), (104, [float("inf")] * 9),
           (105, [1.0, 2.0]), (None, None), (106, [3e38] * 9)]
    agree(op.query(frame(spark, good + odd)).collect(), good)
    twice = op.query(frame(spark, [*good, *good, (None, good[0][1])])).collect()
    assert len(twice) == 81 * 8 and sum(r.vec_id is None for r in twice) == 8
    assert op.query(frame(spark, odd[:5])).collect() == []
    assert op.query(frame(spark, [(1, [1.0, 2.0])])).collect() == []
    assert op.query(frame(spark, [(i, [1.0, 2.0]) for i in range(5)])).collect() == []
    assert op.query(frame(spark, [])).columns == [f.split()[0] for f in op.WHITE.split(", ")]


def test_whole_table(spark):
    rows = [(r.vec_id, np.array(r.embedding, np.float32)) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    agree(op.query(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")).collect(), rows)
