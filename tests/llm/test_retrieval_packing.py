from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from tillsight.llm import retrieval_packing as op
from tillsight.llm.word_bpe import WordBpe

PATH = P.path("word_bpe_49k.json")


def plain():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_words_equal_the_files_own_tokenizer():
    fast, slow, r = WordBpe(PATH, remembered=300), plain(), random.Random(3)
    signs = "abcdefgHIJ   \n\t\r\x0b\x1c\x00\x85\xa0\u2028éÜß×÷'’.,!?-019ΣςİĄж漢a\u0301\u0300😀ﬁŉ½²ªº<|startoftext|>"
    for i in range(4000):
        alphabet = signs if i % 2 else "abcdstredvlm   éß'.,019"
        text = "".join(r.choice(alphabet) for _ in range(r.randint(0, 30)))
        assert fast.encode(text).tolist() == slow.encode(text, add_special_tokens=False).ids, repr(text)


def test_scores_are_bm25():
    r = np.random.default_rng(1)
    docs = [r.integers(0, 50, r.integers(1, 40)).astype(np.uint16) for _ in range(12)]
    df = np.zeros(1 << 16, np.int64)
    for d in docs:
        df[np.unique(d)] += 1
    mean = float(np.mean([len(d) for d in docs]))
    index = op.Index(docs, df, 12, mean)
    for q in range(12):
        want = []
        for d in docs:
            s = 0.0
            for t in set(docs[q].tolist()):
                tf, idf = (d == t).sum(), max(0.0, np.log((12 - df[t] + 0.5) / (df[t] + 0.5)))
                s += idf * tf * (op.K1 + 1) / (tf + op.K1 * (1 - op.B + op.B * len(d) / mean))
            want.append(s)
        assert np.allclose(index.scores(q), want)


def test_neighbour_fills_the_seeds_window():
    docs = [np.array([1, 2, 3, 4] * 3, np.uint16), np.array([9, 8] * 6, np.uint16), np.array([5, 6, 2, 4] * 3, np.uint16),
            np.array([7, 7, 9] * 4, np.uint16), *[np.array([20 + i] * 12, np.uint16) for i in range(6)]]
    df = np.zeros(1 << 16, np.int64)
    for d in docs:
        df[np.unique(d)] += 1
    windows = op.fill([len(d) for d in docs], op.Index(docs, df, len(docs), 12.0), 24)
    assert [p[0] for p in windows[0]] == [0, 2] and [p[0] for p in windows[1]] == [1, 3]


def test_powers_and_cuts():
    assert op.powers(1500) == [1024, 256, 128, 64, 16, 8, 4]
    assert op.cut([(0, 5, 3), (1, 0, 4)], [4, 2, 1]) == [[(0, 5, 3), (1, 0, 1)], [(1, 1, 2)], [(1, 3, 1)]]


def held(rows, docs, window):
    """Every id of every document in one piece, sequences gapless and full or a power of two."""
    slow, by, sequences = plain(), defaultdict(list), defaultdict(list)
    for r in rows:
        by[r["doc_no"]].append(r)
        sequences[r["sequence_id"]].append(r)
    found = []
    for pieces in by.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0
            at += r["length"]
        assert at == pieces[0]["doc_tokens"]
        found.append((pieces[0]["doc_id"], tuple((r["start"], r["length"], r["ids_crc32"]) for r in sorted(pieces, key=lambda r: r["start"]))))
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == window or at & (at - 1) == 0
    texts = defaultdict(list)
    for d in docs:
        texts[d["doc_id"]].append(np.array(slow.encode(d["text"] or "", add_special_tokens=False).ids + [1], "<u4"))
    assert len(found) == len(docs)
    for doc_id, pieces in found:
        assert any(len(ids) == sum(p[1] for p in pieces) and all(
            zlib.crc32(ids[s:s + n].tobytes()) == c for s, n, c in pieces) for ids in texts[doc_id])


def test_pack_odd_documents(odd_docs):
    from pyspark.sql import functions as F

    held(op.query(odd_docs, PATH).collect(), odd_docs.collect(), op.WINDOW)
    tokens = op.settle(op.encode_documents(odd_docs, PATH))
    rows = op.pack(tokens, 64, 500).withColumn("ids_crc32", F.crc32("ids")).collect()
    held(rows, odd_docs.collect(), 64)
    assert len({r["sequence_id"] >> 32 for r in rows}) > 5


def test_empty(no_docs):
    assert op.query(no_docs, PATH).collect() == []
