from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tillsight.llm import jaccard_join as op
from tillsight.llm.components import components
from tillsight.llm.shingles import Shingler

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, k):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def root(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def brute(rows, k, percent):
    """(id, set size, smallest id reached) of each row."""
    sets = [shingle_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(parent, i)] = root(parent, j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        ids.setdefault(root(parent, i), []).append(doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        known = [d for d in ids[root(parent, i)] if d is not None]
        out.append((doc, len(sets[i]), min(known) if known else None))
    return sorted(out, key=repr)


def test_shingles_against_python():
    texts = ["", " \t", "One", "one\x0btwo", "a b c a b c", "A\u00a0b c d é É", "x" * 300 + " y z w", "the  the\nthe the"]
    for k in (1, 3, 5):
        got = Shingler(k).sets([t.encode() for t in texts])
        for text, values in zip(texts, got):
            assert len(values) == len(shingle_set(text, k))
        names = {}
        for text, values in zip(texts, got):
            assert names.setdefault(tuple(values), shingle_set(text, k)) == shingle_set(text, k)
    # What else is in the batch changes nothing.
    assert all((a == Shingler(3).sets([t.encode()])[0]).all() for a, t in zip(Shingler(3).sets([t.encode() for t in texts]), texts))


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_odd_documents(odd_docs, odd_rows, k, percent):
    got = sorted(map(tuple, op.join(odd_docs, k, percent).collect()), key=repr)
    assert got == brute([(r[0], r[1]) for r in odd_rows], k, percent)


def test_chains_of_edits_and_shared_passages(spark):
    r = random.Random(2)
    passage = [f"p{i}" for i in range(30)]
    base = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(120):
        if i % 3 == 0:  # edits of one base, from none to many: some link, some only nearly
            text = list(base)
            for _ in range(i // 9):
                text[r.randrange(len(text))] = f"e{r.randrange(10**6)}"
        elif i % 3 == 1:  # a drift: each links to the next only
            text = [f"c{j}" for j in range(i, i + 60)]
        else:
            text = [f"u{r.randrange(10**6)}" for _ in range(r.randint(1, 12))] + passage
        rows.append((i, " ".join(text)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, op.join(frame, 3, 90).collect()), key=repr)
    assert got == brute(rows, 3, 90)
    kept = {r["doc_id"] for r in op.keep_first(frame, 3, 90).collect()}
    assert kept == {c for _, _, c in got}


def test_components(spark):
    r = random.Random(4)
    links = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(40)]
    parent = {x: x for link in links for x in link}
    for a, b in links:
        a, b = root(parent, a), root(parent, b)
        parent[max(a, b)] = min(a, b)
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(parent, x) for a, b in links if a != b for x in (a, b)}


def test_keep_first_and_empty(odd_docs, no_docs):
    kept = op.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    # Only A-Z is folded, so the copies in capitals are a component of their own.
    assert {1, 60} <= set(ids) and not {2, 61, 62} & set(ids) and {5, 6, 7, 8, 9} <= set(ids)
    assert op.query(no_docs).collect() == [] and op.keep_first(no_docs).collect() == []


def test_prefix_sizes():
    assert [op.prefix_size(n, 90) for n in (1, 9, 10, 11, 100)] == [1, 1, 2, 2, 11]
    assert op.common(np.array([1, 3, 9], np.uint64), np.array([3, 4, 9, 12], np.uint64)) == 2
