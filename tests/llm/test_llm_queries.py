"""The registered queries: SQL agrees, and the pipeline's stages hold what they promise."""

from __future__ import annotations

from pathlib import Path

import pytest

import compare
import corpus_pipeline
from tillsight.llm import curriculum_mix
from tillsight.llm.queries import ORACLES, QUERIES

from .test_jaccard_join import brute
from .test_retrieval_packing import held

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="needs the generated tables")


def test_one_query_per_operator():
    assert [q.split("_")[0] for q in QUERIES] == [*(f"op{n}" for n in range(1, 14)), "pipeline"]
    assert set(ORACLES) < set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_agrees(spark, name):
    text, n = compare.difference(spark, SMALL, name)
    assert text == "" and n > 0


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, frames[-1], SMALL)
        frames.append(spark.createDataFrame(out.collect(), out.schema))
    assert all(f.columns == docs.columns for f in frames[:-1])
    rows = [{r["doc_id"]: r["text"] for r in f.collect()} for f in frames[:-1]]
    good, single, apart, mixed = rows[1:]
    assert set(good) < set(rows[0])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    clean = [i for i in rows[0] if labels.get(i) == 1]
    assert sum(i in good for i in clean) >= 0.97 * len(clean)
    last = {}
    for i, t in good.items():
        last[t] = max(i, last.get(t, i))
    assert set(single) == set(last.values())
    assert set(apart) == {c for _, _, c in brute(sorted(single.items()), 5, 80)}
    want = {r["doc_id"]: sum(2 * p["taken"] > r["size"] for p in r["passes"]) for r in curriculum_mix.assign(frames[3]).collect()}
    got = {}
    for r in frames[4].collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {i: n for i, n in want.items() if n}
    held(frames[5].collect(), frames[4].collect(), 2048)


def test_run_is_the_stages_in_a_row(spark):
    assert corpus_pipeline.run(spark, SMALL).count() == QUERIES["pipeline"](spark, SMALL).count() > 0
