from __future__ import annotations

from collections import defaultdict

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from tillsight.llm import token_counts as op

PATH, PATTERN = P.path("byte_bpe_50k.tiktoken"), P.PATTERN


def brute(parts):
    """Tokens of each section by the tokenizer library's own offsets, -1 for none."""
    document, sections = op.lay_out([p or "" for p in parts])
    counts = defaultdict(int)
    encoding, width = op.encoder(PATH, PATTERN)
    byte = np.cumsum([0] + [len(c.encode()) for c in document])
    at = 0
    for i in encoding.encode_ordinary(document):
        shared = [max(0, min(byte[e], at + width[i]) - max(byte[s], at)) for _, s, e in sections]
        counts[shared.index(max(shared)) if max(shared) else op.OUTSIDE] += 1
        at += width[i]
    assert at == byte[-1]
    return counts, sections


def test_odd_documents(odd_docs, odd_rows):
    by = defaultdict(list)
    for r in op.query(odd_docs, PATH, PATTERN).collect():
        by[r["doc_id"]].append(r)
    for row in odd_rows:
        counts, sections = brute([row[2], row[3], row[1]])
        want = {(n, c[1], c[2], counts[n]) for n, c in enumerate(sections)}
        got = {(r["section"], r["start_char"], r["end_char"], r["tokens"]) for r in by[row[0]]}
        assert want <= got
    for row in (r for r in odd_rows if r[0] in (1, 10, 13)):
        assert sum(r["tokens"] for r in by[row[0]]) == by[row[0]][0]["doc_tokens"]


def test_offsets_are_the_tokenizers():
    slow = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    encoding, width = op.encoder(PATH, PATTERN)
    for text in ("plain words, and 12 more.\n\n\n  Done", "tab\tand  gap"):
        ends = np.cumsum(width[encoding.encode_ordinary(text)])
        assert ends.tolist() == [e for _, e in slow.encode(text, add_special_tokens=False).offsets]


def test_rule_for_crossing_tokens():
    ends = np.array([2, 6, 8, 9, 12])
    low, high = np.array([0, 3, 4, 4, 10]), np.array([3, 4, 4, 8, 12])
    section, many = op.attribute(ends, low, high)
    assert section.tolist() == [0, 3, 3, -1, 4] and many.tolist() == [False, True, False, False, False]
    tie, _ = op.attribute(np.array([4]), np.array([0, 2]), np.array([2, 4]))
    assert tie.tolist() == [0]


def test_empty(no_docs):
    assert op.query(no_docs, PATH, PATTERN).collect() == []
