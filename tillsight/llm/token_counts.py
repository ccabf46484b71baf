"""Token counts by field and section: encode whole documents once, then attribute tokens by their offsets.

A document is its fields joined by one space; the last field is further cut into sections, its lines. Byte-level
tokens cover known numbers of bytes, so their running sum gives every token's span, and two binary searches join
token spans with section spans.

Rule for tokens that touch several sections: the section with most of the token's bytes gets it, the earliest of
several such. A token that touches none (separators alone) goes to section -1. Counts of all sections add up to
the document's.

Defined cases: a null field is empty; an empty section counts 0; a null or empty text is one empty section; rows
with null or repeated ids are attributed like others, each row alone; an empty table gives an empty result; extra
columns are never read. A document is encoded in one piece, however long.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

OUTSIDE = -1
COUNTS = ("doc_id long, section int, field string, start_char long, end_char long, tokens long, crossing long, "
          "doc_tokens long")


@lru_cache(maxsize=2)
def encoder(ranks_path: str, pattern: str):
    """(encoding, bytes covered by each id)"""
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(k): int(v) for k, v in map(bytes.split, f)}
    width = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, i in ranks.items():
        width[i] = len(token)
    return tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), width


def lay_out(values: Sequence[str]) -> tuple[str, list[tuple[int, int, int]]]:
    """(document, sections as (field, start, end) in characters): a section per field, and per line of the last."""
    document, sections, at = " ".join(values), [], 0
    for i, value in enumerate(values[:-1]):
        sections.append((i, at, at + len(value)))
        at += len(value) + 1
    for line in values[-1].split("\n"):
        sections.append((len(values) - 1, at, at + len(line)))
        at += len(line) + 1
    return document, sections


def attribute(ends: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(section of each token, whether it touches several). Spans are half-open, sections sorted and disjoint."""
    starts = np.concatenate([[0], ends[:-1]])[:len(ends)]
    first = np.searchsorted(high, starts, side="right")
    last = np.searchsorted(low, ends, side="left") - 1
    # Empty sections touch nothing; skip those at either end of a token's range.
    section = np.where(first <= last, first, OUTSIDE)
    many = np.zeros(len(ends), bool)
    for t in np.flatnonzero(first < last):
        own = np.arange(first[t], last[t] + 1)
        shared = np.minimum(high[own], ends[t]) - np.maximum(low[own], starts[t])
        many[t] = (shared > 0).sum() > 1
        section[t] = own[shared.argmax()] if shared.max() > 0 else OUTSIDE
    return section, many


def count(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id",
          fields: Sequence[str] = ("lang", "source", "text")) -> DataFrame:
    """A row per document and section, section -1 where tokens lie in none."""
    names = list(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, width = encoder(ranks_path, pattern)
        kinds = [pa.int64(), pa.int32(), pa.string(), *[pa.int64()] * 5]
        header = ["doc_id", "section", "field", "start_char", "end_char", "tokens", "crossing", "doc_tokens"]
        for batch in slices(batches, "f" + str(len(names) - 1), 4 << 20):
            columns = [[] for _ in kinds]
            values = [batch.column(f"f{i}").to_pylist() for i in range(len(names))]
            for doc, *parts in zip(batch.column("doc_id").to_pylist(), *values):
                document, sections = lay_out([p or "" for p in parts])
                raw = document.encode()
                ids = np.array(encoding.encode_ordinary(document), np.int64)
                ends = np.cumsum(width[ids]) if len(ids) else np.zeros(0, np.int64)
                field, start, end = (np.array(x, np.int64) for x in zip(*sections))
                if len(raw) == len(document):
                    low, high = start, end
                else:  # byte at which each character begins
                    byte = np.append(np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80), len(raw))
                    low, high = byte[start], byte[end]
                section, many = attribute(ends, low, high)
                tokens = np.bincount(section + 1, minlength=len(sections) + 1)
                crossing = np.bincount(section[many] + 1, minlength=len(sections) + 1)
                first = 0 if tokens[0] else 1
                number = np.arange(first - 1, len(sections))
                n = len(number)
                for column, part in zip(columns, (
                        [doc] * n, number.tolist(), [None] * (1 - first) + [names[i] for i in field],
                        [None] * (1 - first) + start.tolist(), [None] * (1 - first) + end.tolist(),
                        tokens[first:].tolist(), crossing[first:].tolist(), [len(ids)] * n)):
                    column.extend(part)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], header)

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       *[F.col(c).cast("string").alias(f"f{i}") for i, c in enumerate(names)])
    return slim.mapInArrow(run, COUNTS)


def query(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    return count(docs, ranks_path, pattern)
