"""Substring dedup by hashing units of text.

Units are lines, cut further behind the punctuation that ends a clause or sentence, because repeated passages
often stand inside a line: a line hash alone would miss them. A unit is normalised (A-Z as a-z, words apart by
one gap whatever stood between them) and hashed to 96 bits.

Two kinds of pieces go where an earlier piece equals them: whole lines, however short (a repeated paragraph is
repeated lines), and windows, which are units in a row that together reach `min_words` words, no more of them than
that takes from their first unit on or back from their last. So a passage of that many words goes exactly if all of
it stood in a row in one earlier place; short clauses that only happen to stand in different documents stay.
The occurrence with the smallest rank (document id, then a hash of the text, then place) stays. Cut spans are in
characters of the original text.

Pieces are ranked per digest after one shuffle. What equals an earlier piece of its own task is known to be later
and is spread over the tasks, so a line that a third of all documents hold is sent to one task a few times per task
that reads documents.

Defined cases: a null or empty text has no units and comes back empty; ranks put null ids last; different texts under
one id, or without one, are documents of their own, ranked by a hash of their text; rows with equal id and text are one
document, what is cut from one is cut from each; an empty table gives an empty result; extra columns travel along
unread, and new columns get names of their own where names clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, settle, slices
from .shingles import _BACK, _BASE, Shingler, _powers, mix

MIN_WORDS = 20
CHUNK = 4 << 20
CUTS = np.zeros(256, bool)
CUTS[[ord(c) for c in ".,;:!?"]] = True
LAST = (1 << 63) - 1  # rank of a null id
COMMON = 1 << 16  # repeated digests a task remembers; more only means that more rows are ranked after the shuffle

PIECES = "d1 long, d2 int, doc long, own long, unit int, spread int"


def units_of(texts: list[bytes], shingler: Shingler) -> list[tuple[np.ndarray, ...]]:
    """(d1, d2, start byte, words, whether a line begins) of the units of each text."""
    raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    hashes, starts, ends = shingler.words_of(raw)
    limits = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(starts, limits)
    if not len(starts):
        return [tuple(np.zeros(0, k) for k in (np.int64, np.int32, np.int64, np.int64, bool)) for _ in texts]
    # A unit begins at the first word, after a line break, and after a word that ends in punctuation.
    breaks = np.concatenate([[0], np.cumsum(raw == 10)])
    line = np.ones(len(starts), bool)
    line[1:] = breaks[starts[1:]] > breaks[ends[:-1]]
    head = line.copy()
    head[1:] |= CUTS[raw[ends[:-1] - 1]]
    first = np.flatnonzero(head)
    sizes = np.diff(np.append(first, len(starts)))
    place = (np.arange(len(starts)) - np.repeat(first, sizes)).astype(np.uint64)
    d1 = np.add.reduceat(mix(hashes ^ mix(place, 31), 32), first).view(np.int64)
    d2 = (np.add.reduceat(mix(hashes + mix(place, 41), 42), first) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    out, low = [], 0
    for i, high in enumerate(np.searchsorted(first, upto)):
        base = limits[i] - len(texts[i]) - 1
        out.append((d1[low:high], d2[low:high], starts[first[low:high]] - base, sizes[low:high],
                    line[first[low:high]]))
        low = high
    return out


def pieces_of(found: tuple[np.ndarray, ...], min_words: int) -> tuple[np.ndarray, ...]:
    """(d1, d2, first unit, unit behind the last) of the lines and windows of a text's units."""
    d1, d2, _, words, line = found
    n = len(d1)
    upto = np.concatenate([[0], np.cumsum(words)])
    begin = np.flatnonzero(line)
    behind = np.append(begin[1:], n)
    short = upto[behind] - upto[begin] < min_words  # longer lines are windows
    ahead = np.searchsorted(upto, upto[:-1] + min_words)
    back = np.searchsorted(upto, upto[1:] - min_words, side="right") - 1
    last = np.flatnonzero(back >= 0)
    last = last[ahead[back[last]] != last + 1]  # the others are known from their first unit
    first = np.flatnonzero(ahead <= n)
    kind = np.repeat(np.array([1, 2], np.uint64), [int(short.sum()), len(first) + len(last)])
    a = np.concatenate([begin[short], first, back[last]])
    b = np.concatenate([behind[short], ahead[first], last + 1])
    up, down = _powers(_BASE, n), _powers(_BACK, n)
    own = d1.view(np.uint64), mix(d1.view(np.uint64) + d2.astype(np.uint64), 43)
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * up, dtype=np.uint64)]) for x in own]
    size = (b - a).astype(np.uint64) * np.uint64(4) + kind
    one, two = (mix((x[b] - x[a]) * down[a] + size, 51 + i) for i, x in enumerate(sums))
    return one.view(np.int64), (two >> np.uint64(32)).astype(np.uint32).view(np.int32), a, b


def _rank(doc_id: str):
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))


def _own(text: str):
    """Tells documents of one id apart."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def pieces(docs: DataFrame, doc_id: str, text: str, min_words: int = MIN_WORDS) -> DataFrame:
    """(d1, d2, doc, own, unit, spread) of every piece; `unit` is its first. `spread` is 0, or a positive number where
    the task knows an earlier equal."""
    names = ["d1", "d2", "doc", "own", "unit", "spread"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(1)
        common: dict[tuple[int, int], tuple[int, int, int]] = {}  # first place of digests that a batch repeats
        for batch in slices(batches, "text", CHUNK):
            found = [pieces_of(f, min_words) for f in
                     units_of([t.as_buffer().to_pybytes() for t in batch.column("text")], shingler)]
            d1, d2, unit = (np.concatenate([f[i] for f in found]) for i in range(3))
            sizes = [len(f[0]) for f in found]
            doc, own = (np.repeat(batch.column(c).to_numpy(), sizes) for c in ("doc", "own"))
            order = np.lexsort((unit, own, doc, d2, d1))
            d1, d2, doc, own, unit = d1[order], d2[order], doc[order], own[order], unit[order]
            head = np.ones(len(d1), bool)
            head[1:] = (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])
            heads = np.flatnonzero(head)
            at = heads[np.cumsum(head) - 1]
            later = (doc != doc[at]) | (own != own[at]) | (unit != unit[at])
            several = np.diff(np.append(heads, len(d1))) > 1
            held = np.isin(d1[heads], np.fromiter((k[0] for k in common), np.int64, len(common)))
            for i in heads[several | held].tolist():
                key, place = (int(d1[i]), int(d2[i])), (int(doc[i]), int(own[i]), int(unit[i]))
                first = common.get(key)
                if first is not None and first < place:
                    j = i
                    while j < len(d1) and at[j] == i and not later[j]:  # rows of the first place
                        later[j] = True
                        j += 1
                elif first is not None or len(common) < COMMON:
                    common[key] = place
            spread = np.where(later, 1 + np.arange(len(d1)) % 65_536, 0).astype(np.int32)
            columns = (d1, d2, doc, own, unit.astype(np.int32), spread)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    slim = docs.select(_rank(doc_id).alias("doc"), _own(text).alias("own"),
                       F.col(text).cast("string").cast("binary").alias("text"))
    return slim.where(F.octet_length("text") > 0).mapInArrow(run, PIECES)


def later_pieces(found: DataFrame) -> DataFrame:
    """(doc, own, unit, d1) of the pieces that an earlier one equals. Rows of one place share their rank."""
    place = Window.partitionBy("d1", "d2", "spread").orderBy("doc", "own", "unit")
    return (found.withColumn("nth", F.rank().over(place)).where("spread > 0 OR nth > 1")
            .select("doc", "own", "unit", "d1"))


def cut_spans(text: bytes, found: tuple[np.ndarray, ...], repeated: np.ndarray) -> list[tuple[int, int]]:
    """Byte spans of the runs of repeated units."""
    starts = found[2]
    edge = np.diff(np.concatenate([[0], repeated.astype(np.int8), [0]]))
    return [(int(starts[a]), int(starts[b]) if b < len(starts) else len(text))
            for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with repeated passages cut out of `text`, and columns n_units, n_repeated (units of
    repeated lines and passages), cut_spans (start_char, end_char in the original text) and cut_chars."""
    rank, own, marks = (free_name(docs.columns, c) for c in ("rank_key", "text_key", "mark_rows"))
    later = settle(later_pieces(pieces(docs, doc_id, text, min_words)))
    # A set, as rows with equal id and text bring the same marks.
    listed = later.groupBy(F.col("doc").alias(rank), F.col("own").alias(own)).agg(
        F.collect_set(F.struct("unit", "d1")).alias(marks))
    whole = docs.withColumns({rank: _rank(doc_id), own: _own(text)}).join(listed, [rank, own], "left")
    added = [free_name(docs.columns, c) for c in ("n_units", "n_repeated", "cut_spans", "cut_chars")]
    schema = T.StructType([*docs.schema.fields, T.StructField(added[0], T.LongType()), T.StructField(added[1], T.LongType()),
                           T.StructField(added[2], T.ArrayType(T.StructType([
                               T.StructField("start_char", T.LongType()), T.StructField("end_char", T.LongType())]))),
                           T.StructField(added[3], T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(1)
        for batch in slices(batches, text, CHUNK):
            names = batch.schema.names
            at = names.index(text)
            texts = [(t or "").encode() for t in batch.column(at).to_pylist()]
            out, extra = [], ([], [], [], [])
            for raw, found, listed_ in zip(texts, units_of(texts, shingler), batch.column(marks).to_pylist()):
                n = len(found[0])
                repeated = np.zeros(n, bool)
                if listed_:
                    # A line and a window may begin with one unit: the digest tells them apart.
                    d1, _, first, behind = pieces_of(found, min_words)
                    ends = dict(zip(zip(first.tolist(), d1.tolist()), behind.tolist()))
                    for m in listed_:
                        repeated[m["unit"]:ends.get((m["unit"], m["d1"]), 0)] = True
                spans = cut_spans(raw, found, repeated)
                kept, low, chars = [], 0, []
                at_char = 0
                for a, b in spans:
                    at_char += len(raw[low:a].decode())
                    width = len(raw[a:b].decode())
                    kept.append(raw[low:a])
                    chars.append({"start_char": at_char, "end_char": at_char + width})
                    at_char += width
                    low = b
                out.append(b"".join([*kept, raw[low:]]).decode())
                for column, value in zip(extra, (n, int(repeated.sum()), chars,
                                                 sum(c["end_char"] - c["start_char"] for c in chars))):
                    column.append(value)
            columns = [pa.array(out, pa.string()) if i == at else batch.column(i) for i, c in enumerate(names)
                       if c != marks]
            span = pa.list_(pa.struct([("start_char", pa.int64()), ("end_char", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(extra[0], pa.int64()), pa.array(extra[1], pa.int64()),
                                              pa.array(extra[2], span), pa.array(extra[3], pa.int64())],
                                             [*[c for c in names if c != marks], *added])

    return whole.select(*[F.col(f"`{c}`") for c in docs.columns], marks).mapInArrow(run, schema)


def query(docs: DataFrame) -> DataFrame:
    return dedup(docs.select("doc_id", "text"))
