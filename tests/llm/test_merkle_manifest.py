from __future__ import annotations

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tillsight.llm import merkle_manifest as op

from .conftest import row


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, arity):
    """(root, siblings before and after each leaf, level by level)."""
    ways, of = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        parents, held = [], []
        for low in range(0, len(nodes), arity):
            run = nodes[low:low + arity]
            for k in range(len(run)):
                for d in of[low + k]:
                    ways[d].append((run[:k], run[k + 1:]))
            parents.append(h("".join(run)))
            held.append([d for ids in of[low:low + arity] for d in ids])
        nodes, of = parents, held
    return nodes[0], ways


def brute(rows, arity=16):
    """Sorted result rows of (doc_id, source, lang, n_chars, text)."""
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append(r)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    below = []
    for s in names:
        own = sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        below.append((own, tree([leaf(r) for r in own], arity)))
    if not below:
        return []
    root, upper = tree([t[0] for _, t in below], arity)
    out = []
    for (own, (subroot, ways)), up in zip(below, upper):
        for r, way in zip(own, ways):
            node = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                node = leaf([*r[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4])])
            for before, after in [*way, *up]:
                node = h("".join(before) + node + "".join(after))
            proof = h("".join("".join(b + a) for b, a in [*way, *up]))
            out.append((r[0], leaf(r), subroot, root, proof, node, node == root))
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r) for r in op.query(frame).collect()), key=repr)


def five(r):
    return (r[0], r[2 + 1], r[2], r[4], r[1])


def test_odd_documents(odd_docs, odd_rows, no_docs):
    got = found(odd_docs)
    assert got == brute([five(r) for r in odd_rows])
    assert {r[-1] for r in got} == {True, False}
    assert found(no_docs) == []


def test_runs_of_many_sizes(spark):
    rows = [(i, f"s{s}", "en", i, f"Text {i} of {s}") for s, n in enumerate([1, 2, 15, 16, 17, 33, 256, 257, 273]) for i in range(n)]
    rows += [(5, None, None, None, None)] * 3
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert found(frame.repartition(7)) == brute(rows)


@pytest.mark.parametrize("sources", [1, 20])
def test_many_and_single_sources(spark, sources):
    rows = [(i, f"s{i % sources}", "en", i, f"T{i}") for i in range(40)]
    assert found(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")) == brute(rows)


def test_one_document(spark):
    frame = spark.createDataFrame([(3, "s", "en", 1, "x")], "doc_id long, source string, lang string, n_chars long, text string")
    assert found(frame) == brute([(3, "s", "en", 1, "x")])


def test_binary_tree(spark):
    leaves = spark.range(11).select(F.lit("s").alias("source"), "id", op.digest(F.col("id").cast("string")).alias("digest"))
    out = op.manifest(leaves, "source", ["id"], arity=2)
    want = tree([h(str(i)) for i in range(11)], 2)[0]
    back = out.select("root", op.fold(F.col("digest"), F.col("up")).alias("back")).collect()
    assert len(back) == 11 and {bytes(r.root).hex() for r in back} == {bytes(r.back).hex() for r in back} == {want}
