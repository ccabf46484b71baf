from __future__ import annotations

import random
import re
from functools import cache
from hashlib import sha256

import pytest

from tillsight.llm import pii_boosting as op

RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


@cache
def sure(text):
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def agree(frame, rows):
    got = op.query(frame).collect()
    assert len(got) == len(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = sorted(((i, sha256(",".join(sure(t)).encode()).hexdigest(), *[sum(s.startswith(k) for s in sure(t)) for k in op.KINDS])
                   for i, t in rows), key=key)
    assert sorted(((r.doc_id, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got), key=key) == want
    for r in got:
        every = [(op.KINDS.index(k), int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        assert every == sorted(every) and len(every) >= r.n_email + r.n_ip + r.n_card + r.n_phone
    return {r.doc_id: r.spans for r in got}


EDGES = ["a@b.c", "x a@b.c@d.e", "a@b.c-x%y@d.e", "a@b..c", "a@.b", "@b.c", "a@b.c.", "a..b@c-.d-e.", "é.a@b.cé", "a@b.c%d@e.f.g%",
         "1.2.3.4", "1.2.3.4.5.6.7.8", "1.2.3", "256.1.1.1", "0001.002.03.0255", "00000000000000000000.1.2.3", "1..2.3.4",
         "4929 3483 8514 6306", "4929-3483-8514-6306", "4929  348385146306", "4929348385146306 1", "1 4929348385146306",
         "4929.3483.8514.6306", "12", "1-", "0000000000000", "00000000000000000000", "4-9-2-9-3-4-8-3-8-5-1-4-6-3-0-6",
         "+1 (017) 555-7713", "+1(", "++49 30 123456", "+1 2 3 4 5 6 7 8 9 (", "+123456789012345678", "+1-", "+1+234567890",
         "😀 +1 (017) 555-7713 😀 a@b.c", "1 2@b.c", "1\n2345678901234", "1\t2", "mail a@b.c\nc@d.e,f@g.h"]


def test_edges_of_the_rules(spark):
    rows = [(i, t) for i, t in enumerate(EDGES)] + [(90, None), (91, ""), (None, "a@b.c"), (None, None), (1, "a@b.c")]
    agree(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)


@pytest.mark.parametrize("letters", ["a.@-%", "01 -.", "+(1) .-", "a1.@ -+(é"])
def test_random_texts(spark, letters):
    r = random.Random(letters)
    rows = [(i, "".join(r.choice(letters) for _ in range(r.randint(0, 60)))) for i in range(1500)]
    agree(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_odd_documents(odd_docs, odd_rows, no_docs):
    agree(odd_docs, [(r[0], r[1]) for r in odd_rows])
    assert op.query(no_docs).collect() == []


def test_long_texts_are_neither_slow_nor_deep(spark):
    n = 12_000  # the rules as written are quadratic here
    rows = [(1, "1" * n), (2, "1 " * n), (3, "a" * n), (4, "a@" + "b." * n), (5, "1." * n), (6, "+1" + "(" * n), (7, "a." * n + "@b.c"),
            (8, "1-2 " * n), (9, "+1 234 567 890 " * 500), (10, "[dot] (at) " * 5000)]
    agree(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def corpus(n=3000):
    """Documents with sure spans, with look-alikes, and with hidden forms of the same data."""
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghiou") for _ in range(r.randint(2, 8)))
    number = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    sign = lambda: f"{word()}.{word()}"
    rows, hidden = [], {}
    for i in range(n):
        local, host = sign(), f"{word()}.example.com"
        kind = i % 10
        data = [f"{local}@{host}", f"+1 ({number(3)}) 555-{number(4)}", f"{r.randint(1, 255)}.{r.randint(0, 255)}.{r.randint(0, 255)}.{r.randint(0, 255)}",
                f"page {number(3)} of {number(4)}", f"isbn {number(9)}x", f"{number(2)}.{number(2)}.{number(4)}", word(), f"{number(6)}, {number(3)}", word(), word()][kind]
        if i % 750 == 6:
            data = f"{local} (at) {host}"
            hidden[i] = ("email", data)
        if i % 750 == 8:
            data = f"({number(3)}) 555-{number(4)}"
            hidden[i] = ("phone", data)
        rows.append((i, " ".join([word() for _ in range(5)] + [data] + [word() for _ in range(5)])))
    return rows, hidden


def test_hidden_forms_are_added_and_look_alikes_left_alone(spark):
    rows, hidden = corpus()
    spans = agree(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)
    extra = {i for i, t in rows if spans[i] != ",".join(sure(t))}
    assert extra <= set(hidden)
    assert {hidden[i][0] for i in extra} == {"email", "phone"} and len(extra) >= 0.9 * len(hidden)
    for i in extra:
        kind, data = hidden[i]
        at = rows[i][1].index(data)
        assert f"{kind}:{at}:{at + len(data)}" in spans[i].split(",")


def test_redaction(spark, odd_docs):
    rows = [(1, "é a@b.c and 1.2.3.4, +1 234 567 890"), (2, "nothing"), (3, None), (2, "a@b.c"), (None, "4929348385146306"), (4, "")]
    out = op.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, out), key=repr) == sorted([
        (1, "é [email] and [ip], [phone]"), (2, "nothing"), (3, None), (2, "[email]"), (None, "[card]"), (4, "")], key=repr)
    assert op.redact(odd_docs).columns == odd_docs.columns


def test_no_python_in_the_plan(odd_docs):
    plan = op.query(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
