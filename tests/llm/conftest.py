from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

WORDS = "ab ist the gelb nach rund très né ça über of and in to é 日本 x,".split()

# Extra columns whose names operators use inside, or that clash by case.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in (
        "tag", "digest", "Position", "size", "row", "node", "key", "lost_id", "mark_rows", "rank_key", "n_units",
        "line_dedup_key", "count", "shard", "with space")]])


def row(doc_id, text, lang="en", source="s1", n=0):
    return (doc_id, text, lang, source, n, *["x"] * (len(SCHEMA) - 5))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, copies, near copies, repeated rows and ids."""
    r = random.Random(5)

    def prose(n):
        return " ".join(r.choice(WORDS) + str(r.randint(0, 40)) for _ in range(n))

    base, other = prose(80), prose(60)
    long = "\n".join(prose(200) for _ in range(60))
    near = base.split()
    near[40] = "changed"
    out = [row(1, base), row(2, base), row(3, " ".join(near)), row(4, other, "de", "s2"), row(5, None), row(6, ""),
           row(7, "  \n\t"), row(8, "one"), row(9, "one two"), row(10, long, None, None), row(11, long + " end", None, None),
           row(None, base), row(None, "nobody has an id here at all"), row(12, other, "de", "s2"), row(12, other, "de", "s2"),
           row(12, "an other text under one id"), row(13, "Ünï\u0301code \U0001f600 text, with a — dash.", "fr", ""),
           tuple([None] * len(SCHEMA))]
    out += [row(20 + i, prose(r.randint(1, 90)), r.choice(["en", "de"]), r.choice(["s1", "s2", "s3"])) for i in range(30)]
    out += [row(60 + i, base.upper(), "en", "s1") for i in range(12)]
    return out


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
