from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np

from tillsight.llm import exact_dedup as op


def test_perfect_hash_is_minimal_and_byte_checked():
    for n in (1, 2, 5, 1000):
        keys = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(n)), np.uint8).reshape(-1, 32)
        displacements = op.perfect_hash(keys)
        at, _ = op.look_up(keys, displacements, keys)
        assert sorted(at) == list(range(n))
        slots = np.empty_like(keys)
        slots[at] = keys
        assert op.look_up(keys, displacements, slots)[1].all()
        strangers = np.roll(keys, 1, axis=1)
        assert not op.look_up(strangers, displacements, slots)[1].any()


def test_groups_and_winners(odd_docs, odd_rows):
    want = defaultdict(list)
    for r in odd_rows:
        want[r[1] or ""].append(r[0])
    got = op.query(odd_docs).collect()
    assert len(got) == len(odd_rows)
    by = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in want.items()}
    kept = Counter()
    for r in got:
        ids = by[r["text_sha256"]]
        known = [i for i in ids if i is not None]
        assert r["group_size"] == len(ids) and r["keep_id"] == (max(known) if known else None)
        kept[r["text_sha256"]] += r["kept"]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert set(kept.values()) == {1} and set(kept) == set(by)


def test_result_does_not_depend_on_the_history(odd_docs):
    from pyspark.sql import functions as F

    rows = op.digests(odd_docs)
    found = [sorted(map(repr, op.dedup(rows, c).collect())) for c in (F.lit(False), F.lit(True), F.col("doc_id") < 10)]
    assert found[0] == found[1] == found[2]


def test_keep_one(odd_docs, odd_rows):
    got = op.keep_one(odd_docs)
    assert got.columns == odd_docs.columns
    rows = got.collect()
    assert Counter(r["text"] or "" for r in rows) == Counter({t: 1 for t in {r[1] or "" for r in odd_rows}})


def test_empty(no_docs):
    assert op.query(no_docs).collect() == [] and op.keep_one(no_docs).collect() == []


def test_large_ids_beside_null_ones(spark):
    from pyspark.sql import functions as F

    big = 1 << 53
    rows = [(big + 1, "a"), (None, "b"), (big + 3, "c"), (big + 5, "d"), (None, "c"), (big + 7, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted([(big + 1, big + 7, False), (None, None, True), (big + 3, big + 3, True), (big + 5, big + 5, True),
                   (None, big + 3, False), (big + 7, big + 7, True)], key=repr)
    digests = op.digests(docs)
    for history in (F.lit(True), F.lit(False), F.col("doc_id") > big + 3, F.col("doc_id").isNull()):
        got = op.dedup(digests, history).select("doc_id", "keep_id", "kept").collect()
        assert sorted(map(tuple, got), key=repr) == want
