from __future__ import annotations

import random
import re

import xxhash

from tillsight.llm import unit_dedup as op

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def units(text):
    """(words in lower case, start) of each unit."""
    out, last = [], None
    for m in WORD.finditer(text):
        if last is None or "\n" in text[last.end():m.start()] or last.group()[-1] in ".,;:!?":
            out.append(([], m.start()))
        out[-1][0].append("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m.group()))
        last = m
    return [(tuple(w), s) for w, s in out]


def rank(i, t):
    """Place of a document: by id, null last, then by the signed 64-bit hash of its text."""
    h = xxhash.xxh64_intdigest((t or "").encode(), seed=42)
    return op.LAST if i is None else i, h - (1 << 64) if h >> 63 else h


def brute(rows, min_words):
    """Text and spans of each (id, text) after cutting; rows equal in both are one document."""
    first = {}
    for i, t in rows:
        for n, (w, _) in enumerate(units(t or "")):
            first[w] = min(first.get(w, (rank(i, t), n)), (rank(i, t), n))
    out = []
    for i, t in rows:
        t, spans, run = t or "", [], []
        found = units(t)
        for n, (w, s) in enumerate([*found, ((), len(t))]):
            again = n < len(found) and first[w] < (rank(i, t), n)
            if again:
                run.append((s, len(w)))
            else:
                if run and sum(k for _, k in run) >= min_words:
                    spans.append((run[0][0], s))
                run = []
        text, low = "", 0
        for a, b in spans:
            text, low = text + t[low:a], b
        out.append((i, text + t[low:], spans))
    return sorted(out, key=repr)


def found(frame, min_words):
    return sorted(((r["doc_id"], r["text"], [tuple(s) for s in r["cut_spans"]]) for r in op.dedup(frame, min_words=min_words).collect()), key=repr)


def test_odd_documents(odd_docs, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows]
    for min_words in (1, op.MIN_WORDS):
        got = op.dedup(odd_docs, min_words=min_words)
        name = [c for c in got.columns if c.endswith("cut_spans")][0]
        rows_ = sorted(((r["doc_id"], r["text"], [tuple(s) for s in r[name]]) for r in got.collect()), key=repr)
        assert rows_ == brute(rows, min_words)
        assert got.columns[:len(odd_docs.columns)] == odd_docs.columns


def test_passages_inside_lines(spark):
    r = random.Random(3)
    prose = lambda n: " ".join(r.choice("ab cd é gh ijk".split()) + str(r.randint(0, 500)) + r.choice(["", "", "", ".", ","]) for _ in range(n))
    passage = ". ".join(prose(9).capitalize() for _ in range(7)) + "."
    rows = []
    for i in range(40):
        text = prose(r.randint(5, 60)) + "\n" + prose(10)
        if i % 4 == 0:
            text = prose(20) + ". " + passage + " " + text
        rows.append((i, text))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(frame, op.MIN_WORDS)
    assert got == brute(rows, op.MIN_WORDS)
    for i, text, spans in got:
        clean = i % 4 or i == 0
        assert bool(spans) != bool(clean)
        assert not clean or text == dict(rows)[i]


def test_empty(no_docs):
    assert op.dedup(no_docs).collect() == []


def test_short_lines_and_runs_of_one_document(spark):
    short = "Share this page with a friend\n"
    clauses = [f"clause {i} has seven words in it," for i in range(8)]
    rows = [(1, short + "first text of its own"), (2, short + "second text of its own"), (3, "third text\n\n" + short),
            (10, " ".join(clauses[:4]) + " left behind"), (11, "of its own: " + " ".join(clauses[4:])),
            # Four units in a row, but from two documents: 14 words of each.
            (12, "starts: " + " ".join(clauses[2:6]) + " and ends"),
            # Units that stand in a row in one document, 28 words.
            (13, "begins: " + " ".join(clauses[:4]) + " and stops"),
            (14, "a line that holds: Share this page with a friend")]
    got = {i: text for i, text, _ in found(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), op.MIN_WORDS)}
    want = dict(rows) | {2: "second text of its own", 3: "third text\n\n", 13: "begins: and stops"}
    assert got == want


def test_windows_cover_each_long_enough_run(spark):
    """A unit goes if and only if it lies in a run of enough words that one earlier place holds."""
    r = random.Random(4)
    rows = [(i, " ".join(" ".join([r.choice("abc")] * r.randint(1, 3)) + "," for _ in range(r.randint(1, 14)))) for i in range(60)]
    need = 7
    places, want = [], {}
    for i, text in rows:
        own = [w for w, _ in units(text)]
        gone = set()
        for a in range(len(own)):
            for b in range(a + 1, len(own) + 1):
                run = own[a:b]
                if sum(map(len, run)) >= need and (any(run == e[k:k + b - a] for e in places for k in range(len(e)))
                                                  or any(run == own[k:k + b - a] for k in range(a))):
                    gone |= set(range(a, b))
        # Each document is one line, which goes whole if an earlier document is the same.
        want[i] = len(own) if own in places else len(gone)
        places.append(own)
    got = op.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), min_words=need).collect()
    assert {r["doc_id"]: r["n_repeated"] for r in got} == want and any(want.values())


def test_different_rows_of_one_id(spark):
    """Of equal lines at one place of rows with one id, or without one, one stays; other lines all stay."""
    line = "a line that stands in both rows"
    for key in (7, None):
        rows = [(key, f"{line}\nalpha only"), (key, f"{line}\nbeta only"), (key, "gamma only\ndelta only")]
        got = found(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), op.MIN_WORDS)
        first = min(rows[:2], key=lambda r: rank(*r))
        assert sorted(t for _, t, _ in got) == sorted(t if (i, t) == first else t.replace(line + "\n", "") for i, t in rows)


def test_common_lines_across_batches(spark):
    """A line in every row stays once, whatever the order in which a task meets the rows, and few copies are ranked."""
    r = random.Random(5)
    ids = r.sample(range(1000), 600)
    rows = [(i, f"the line of every row\nown words {i}") for i in ids] + [(3000, "the line of every row")] * 500
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        ranked = op.pieces(frame, "doc_id", "text").groupBy("d1", "d2").agg({"spread": "count"}).count()
        few = op.pieces(frame, "doc_id", "text").where("spread = 0").groupBy("d1", "d2").count()
        assert ranked == 601 and few.agg({"count": "max"}).first()[0] < 30
        got = {i: (t, n) for i, t, n in op.dedup(frame).select("doc_id", "text", "n_repeated").distinct().collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    least = min(ids)
    assert got == {i: (f"own words {i}", 1) for i in ids if i != least} | {
        least: (f"the line of every row\nown words {least}", 0), 3000: ("", 1)}
