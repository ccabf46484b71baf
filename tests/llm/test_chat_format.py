from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st

from tillsight.llm import chat_format as op

PATH, PATTERN = P.path("byte_bpe_50k.tiktoken"), P.PATTERN
TRICKY = st.text(st.sampled_from("\\<|>tend\n é日turnx"), max_size=30)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a<|text|>\\"]) | TRICKY, TRICKY | st.sampled_from(
    ["<|end|>", "\\<|end|>", "<\\|turn|>", "\\", op.PLANTED])), max_size=5))
def test_rendering_is_reversible(turns):
    formatted, spans = op.render(turns)
    assert op.parse(formatted) == turns
    raw = formatted.encode()
    assert [op.unescape(raw[a:b].decode()) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_token_spans_against_brute_force():
    encoder = op.Encoder(PATH, PATTERN)
    for texts in (["héllo there", "", "x"], ["日本" * 5, "\n\n"], [""]):
        formatted, spans = op.render([(("user", "assistant")[i % 2], t) for i, t in enumerate(["q", *texts])])
        ids, ends = encoder.encode(formatted)
        starts = np.concatenate([[0], ends[:-1]])
        for (a, b), (low, high) in zip(zip(*op.token_spans(ends, spans)), spans):
            inside = [i for i in range(len(ids)) if starts[i] < high and ends[i] > low]
            assert list(range(a, b)) == inside


def brute(rows):
    by = {}
    for c, turn, role, text in rows:
        by.setdefault(c, []).append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    out = {}
    for c, turns in by.items():
        turns = [(t[3], t[5]) for t in sorted(turns)]
        learned = "".join(t for r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned))
    return out


def test_odd_conversations(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "<|end|>\\"), (1, 1, "assistant", "<|end|>\\"), (2, None, "assistant", None),
            (2, 0, None, "x"), (3, 0, "system", ""), (None, None, None, None), (None, 4, "assistant", "z " * 40_000),
            (4, 2, "assistant", "b"), (4, 1, "assistant", "a"), (4, 1, "assistant", "ä")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    got = {r["conv_id"]: tuple(r)[1:5] for r in op.query(frame, PATH, PATTERN).collect()}
    assert got == brute([*rows, (-7, 0, "user", op.PLANTED), (-7, 1, "assistant", op.PLANTED)])


def test_empty(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert [r["conv_id"] for r in op.query(frame, PATH, PATTERN).collect()] == [-7]
