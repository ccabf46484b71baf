from __future__ import annotations

import re

import pytest

from tillsight.llm import curriculum_mix as op


def shared_again(sizes, weights, total=1.5, cap=2.0):
    """Share by weight, cut at the cap, share the excess again, until nobody is above."""
    ask, out = total * sum(sizes), [0.0] * len(sizes)
    open_ = list(range(len(sizes)))
    while open_ and ask > 1e-9:
        unit = ask / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] >= cap * sizes[i]]
        if not full:
            for i in open_:
                out[i] = unit * weights[i]
            break
        for i in full:
            out[i] = cap * sizes[i]
            ask -= out[i]
        open_ = [i for i in open_ if i not in full]
    return out


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 100, 100, 3], [0, 5, 0, 7], [0, 0], [1000, 1, 1, 1, 1, 1, 1]])
def test_targets(spark, sizes):
    plans = op.schedules()
    frame = spark.createDataFrame([(f"k{i}", f"s{i:02d}", s) for i, s in enumerate(sizes)], "key string, name string, source_size long")
    got = {r["key"]: r["target"] for r in op.targets(frame, plans).collect()}
    want = shared_again(sizes, [op.WEIGHTS[i % 3] for i in range(len(sizes))])
    assert [got[f"k{i}"] for i in range(len(sizes))] == pytest.approx(want, abs=1e-6)


def test_inversion_undoes_the_integral(spark):
    from pyspark.sql import functions as F

    plans = [*op.schedules(), [(0.0, 0.0), (0.25, 4.0), (1.0, 1.0)]]
    shares = [i / 20 for i in range(21)]
    frame = spark.createDataFrame([(p, s) for p in range(len(plans)) for s in shares], "plan int, share double")
    for r in frame.withColumn("t", op.invert(F.col("plan"), F.col("share"), plans)).collect():
        knots, done = plans[r["plan"]], 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            x = min(max(r["t"] - t0, 0.0), t1 - t0)
            done += x * (w0 + (w0 + (w1 - w0) * x / (t1 - t0))) / 2
        assert done / op.integral(knots) == pytest.approx(r["share"], abs=1e-9)


def test_every_document_and_source(odd_docs, odd_rows):
    rows = op.assign(odd_docs, carry=True).collect()
    assert len(rows) == len(odd_rows)
    sizes, taken, target = {}, {}, {}
    for r in rows:
        n = len(re.findall(op.words.__globals__["WORD"], r["row"]["text"] or ""))
        assert r["size"] == n and 0 <= r["taken"] <= 2 * n and sum(p["taken"] for p in r["passes"]) == r["taken"]
        s = r["row"]["source"]
        sizes[s] = sizes.get(s, 0) + n
        taken[s] = taken.get(s, 0) + r["taken"]
        target[s] = (r["source_size"], r["target"])
        assert all(0 <= p["position"] <= 1 for p in r["passes"])
    assert {s: t[0] for s, t in target.items()} == sizes
    names = sorted((s for s in sizes if s is not None)) + [None]
    want = shared_again([sizes[s] for s in names], [op.WEIGHTS[i % 3] for i in range(len(names))])
    for s, w in zip(names, want):
        assert target[s][1] == pytest.approx(w) and abs(taken[s] - w) <= 1


def test_reruns_agree_and_positions_rise(odd_docs):
    a, b = ([tuple(r) for r in op.query(d).collect()] for d in (odd_docs, odd_docs.repartition(5)))
    assert sorted(a, key=repr) == sorted(b, key=repr)
    positions = [r[6] for r in a if r[6] is not None]
    assert positions == sorted(positions)


def test_mixture_keeps_columns(odd_docs, no_docs):
    got = op.mixture(odd_docs)
    assert got.columns == odd_docs.columns and 0 < got.count() < 2 * odd_docs.count()
    assert op.query(no_docs).collect() == [] and op.mixture(no_docs).collect() == []
