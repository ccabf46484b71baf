from __future__ import annotations

import random

from pyspark.sql import functions as F

from tillsight.llm import line_dedup as op


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute(spark, rows, min_chars=op.MIN_CHARS):
    lines = {}
    places = []
    hashes = {r.text: r.h for r in spark.createDataFrame([(t,) for _, t in rows], "text string").select(
        "text", F.xxhash64("text").alias("h")).collect()}
    for i, t in sorted(set(rows), key=repr):
        for n, raw in enumerate((t or "").split("\n") if t is not None else []):
            norm = raw.strip(" \t\r").lower()
            if norm:
                place = (op.LAST if i is None else i, hashes[t], n)
                places.append((place, norm))
                lines[norm] = min(lines.get(norm, place), place)
    near = {}
    for a, pa in lines.items():
        if len(a) >= min_chars:
            before = [p for b, p in lines.items() if p < pa and len(b) >= min_chars and abs(len(a) - len(b)) < 2 and distance(a, b) < 2]
            if before:
                near[a] = min(before)
    out = []
    for place, norm in places:
        if place != lines[norm]:
            out.append((*place[::2], *lines[norm][::2], 0))
        elif norm in near:
            out.append((*place[::2], *near[norm][::2], 1))
    return sorted(out)


def found(frame):
    return sorted((*(op.LAST if r[0] is None else r[0], r[1]), *(op.LAST if r[2] is None else r[2], r[3]), r[4])
                  for r in op.repeated_lines(frame).collect())


def test_edits(spark):
    r = random.Random(6)
    base = ["a quick line of text", "aaaaaaaaaaaaaaaa", "zeile mit ümläut und é", "ababababababab", "short line", "0123456789012"]
    rows = []
    for i in range(90):
        lines = []
        for _ in range(r.randint(1, 5)):
            s = list(r.choice(base))
            for _ in range(r.choice([0, 1, 1, 2])):
                at = r.randrange(len(s))
                kind = r.random()
                if kind < 0.35:
                    s[at] = r.choice("abé0")
                elif kind < 0.7:
                    del s[at]
                else:
                    s.insert(at, r.choice("abé0"))
            lines.append(r.choice(["", " ", "\t"]) + "".join(s) + r.choice(["", " \r"]))
        rows.append((i, "\n".join([*lines, r.choice(["", "   ", "A QUICK line of text"])])))
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(spark, rows)


def test_odd_documents(spark, odd_docs, odd_rows):
    assert found(odd_docs.dropDuplicates()) == brute(spark, [(r[0], r[1]) for r in odd_rows])


def test_long_lines(spark):
    long = "".join(random.Random(1).choice("abcdefg ") for _ in range(3000)).strip() + "x"
    rows = [(1, long), (2, long[:1500] + long[1501:]), (3, long[:10] + "#" + long[11:]), (4, long + "yz")]
    assert [(r[0], r[2], r[4]) for r in sorted(op.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())] == [
        (2, 1, 1), (3, 1, 1)]


def up_to_one(a, b):
    """Whether one edit at most leads from one text to the other, as a distance; quick for long texts."""
    short, long = sorted((a, b), key=len)
    at = next((i for i, (x, y) in enumerate(zip(short, long)) if x != y), len(short))
    return 0 if a == b else 1 if long[at + 1:] == short[at + (len(short) == len(long)):] else 2


def generated_rows(frame):
    """Rows that the frame's generators made, once it has run."""
    frame.collect()

    def count(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return count(node.executedPlan())
        if "QueryStage" in name:
            return count(node.plan())
        children = node.children()
        own = node.metrics().apply("numOutputRows").value() if name == "Generate" else 0
        return own + sum(count(children.apply(i)) for i in range(children.size()))

    return count(frame._jdf.queryExecution().executedPlan())


def test_keys_for_the_places_that_differ_only(spark, monkeypatch):
    r = random.Random(5)
    head, tail = ("".join(r.choice("abcdefgh ") for _ in range(n)) for n in (300, 500))
    rows = [(i, f"x{head}{i:03d}{tail}x") for i in range(200)]
    made, neighbours = [], op.neighbours
    monkeypatch.setitem(globals(), "distance", up_to_one)
    monkeypatch.setattr(op, "neighbours", lambda texts: made.append(neighbours(texts)) or made[0])
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(frame) == brute(spark, rows)
    # Lines of 805 characters that differ in three: a few places each, not an eighth of the line.
    assert 0 < generated_rows(made[0]) < 200 * 2 * 805 / 24


def test_lengths_around_the_number_of_pieces(spark, monkeypatch):
    r = random.Random(8)
    monkeypatch.setitem(globals(), "distance", up_to_one)
    rows = []
    for n in (*range(12, 20), 31, 32, 33, 62, 63, 64, 65, 66, 127, 128, 129, 200):
        base = "".join(r.choice("abcdefgh") for _ in range(n))
        lines = [base]
        for at in sorted({0, 1, n // 2 - 1, n // 2, n // 2 + 1, n - 2, n - 1, *(r.randrange(n) for _ in range(4))}):
            lines += [base[:at] + "#" + base[at + 1:], base[:at] + base[at + 1:], base[:at] + "%" + base[at:]]
        lines += [base + "$", base[::-1]]
        r.shuffle(lines)
        rows += [(len(rows) + k, line) for k, line in enumerate(lines)]
    r.shuffle(rows)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(spark, rows)


def test_removal(spark, odd_docs, no_docs):
    rows = [(1, "keep this line here\nother"), (2, "x\nkeep this line herE \n\nend"), (3, None), (4, "keep this line hare")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r[0]: r[1] for r in op.without_repeats(frame).collect()} == {
        1: "keep this line here\nother", 2: "x\n\nend", 3: None, 4: ""}
    assert op.without_repeats(odd_docs).columns == odd_docs.columns
    assert op.repeated_lines(no_docs).collect() == [] and op.without_repeats(no_docs).collect() == []


def test_rows_with_one_id_or_none_lose_their_own_lines_only(spark):
    rows = [(7, "alpha words to stay\nbeta only row text"), (7, "first of all lines\nalpha words to stay"), (None, "delta solitary words"),
            (None, "gamma in a row\nalpha words to stay"), (None, "alpha words to stay\nomega"), (8, "x\nalpha words to stay"),
            (9, "repeated row line\nepsilon"), (9, "repeated row line\nepsilon")]
    out = op.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = sorted(r.text for r in out)
    stay = [t for t in texts if "alpha words to stay" in t]
    assert len(stay) == 1 and stay[0] in (rows[0][1], rows[1][1])
    assert len([t for t in texts if "beta only row text" in t]) == len([t for t in texts if "delta solitary" in t]) == 1
    assert sorted(x for t in texts for x in t.split("\n") if x != "alpha words to stay") == sorted(
        x for _, t in rows for x in t.split("\n") if x != "alpha words to stay")


def test_no_python_and_no_cross_join(odd_docs):
    plan = op.query(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_more_verdicts_than_are_broadcast(spark, odd_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(op, "SMALL", 2)
    assert found(odd_docs.dropDuplicates()) == brute(spark, [(r[0], r[1]) for r in odd_rows])
