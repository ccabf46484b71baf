"""The order that the mixture writes is the order of the packed sequences."""

from __future__ import annotations

import random

import public_tokenizers as P
from pyspark.sql import functions as F

import corpus_pipeline
from tillsight.llm import retrieval_packing as op


def documents(spark, n=120):
    r = random.Random(6)
    rows = [(n - i, " ".join(r.choice("sun moon star sea hill".split()) for _ in range(r.randint(5, 60))), "early" if i < n // 2 else "late", i)
            for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, position long")


def test_places_follow_the_written_files(spark, tmp_path):
    docs = documents(spark)
    docs.repartitionByRange(5, "position").sortWithinPartitions("position").write.parquet(str(tmp_path / "mixed"))
    got = corpus_pipeline.in_order(spark.read.parquet(str(tmp_path / "mixed")), "place").collect()
    assert len(got) == 120 and all(r["place"] == r["position"] for r in got)


def test_early_sources_lie_in_earlier_sequences(spark, tmp_path):
    docs = documents(spark)
    docs.repartitionByRange(5, "position").sortWithinPartitions("position").write.parquet(str(tmp_path / "mixed"))
    placed = corpus_pipeline.in_order(spark.read.parquet(str(tmp_path / "mixed")), "place")
    tokens = op.settle(op.encode_documents(placed, P.path("word_bpe_49k.json"), order="place"))
    rows = op.pack(tokens, 64, 800).withColumn("shard", F.shiftright("doc_no", 32)).collect()
    assert len({r["shard"] for r in rows}) > 3
    position = {r["doc_id"]: r["position"] for r in docs.collect()}
    seeds = [position[r["doc_id"]] for r in sorted(rows, key=lambda r: r["sequence_id"]) if r["offset"] == 0]
    assert seeds == sorted(seeds) and len(seeds) == len({r["sequence_id"] for r in rows})
    numbers = {s: [r["sequence_id"] for r in rows if (position[r["doc_id"]] < 60) == (s == "early")] for s in ("early", "late")}
    mean = {s: sum(x) / len(x) for s, x in numbers.items()}
    assert mean["early"] < mean["late"]
