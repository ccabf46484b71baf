"""Packing documents into fixed windows, each filled with the nearest unused documents of its seed.

Documents are encoded once and written down. Document frequencies of all tokens are counted over the whole
table; the vocabulary bounds their number. Documents are then dealt by a hash of their row into shards of about SHARD_TOKENS
tokens; each shard is an inverted index of its documents with BM25 weights. A window starts with its seed, a
BM25 query with all the seed's tokens ranks the shard's unused documents, and these fill the window in that
order. The one that does not fit is cut; its rest seeds the next window. Every window but a shard's last is
full. The last one is cut at powers of two into shorter sequences, so nothing is padded.

Where the documents come with an order, each shard takes its seeds in that order, and `sequence_id` grows over the
whole table with the place of the seed; without one, it tells sequences apart and nothing else.

Defined cases: a null or empty text is its end token alone; repeated rows are documents of their own, told
apart by `doc_no`; ties of the ranking go to the document earlier in the shard, which is ordered by id and
content; an empty table gives an empty result; extra columns are never read. Rows are dealt by a number of their own,
so repeated rows spread over the shards like any others; only a document longer than a shard makes its shard longer.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle
from .word_bpe import shared

WINDOW = 2048
SHARD_TOKENS = 1 << 18
END_ID = 1
K1, B = 1.2, 0.75
SEED_BITS = 20  # bits of a sequence's number among those of its seed; the seed's place stands above them

TOKENS = "doc_id long, n long, ids binary, row_no long"
PIECES = ("doc_id long, doc_no long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
          "offset long")


def encode_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                     end: int = END_ID, order: str | None = None) -> DataFrame:
    """(doc_id, n, ids, row_no), and with `order` also (place): compressed 16-bit ids with the end token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = shared(path), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                sizes, blobs = [], []
                for value in part.column(1):
                    ids = np.append(encoder.encode(value.as_py() or ""), np.uint16(end))
                    sizes.append(len(ids))
                    blobs.append(packer.compress(ids.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary()), *part.columns[2:]],
                    ["doc_id", "n", "ids", *part.schema.names[2:]])

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("row_no"), *([F.col(order).cast("long").alias("place")] if order else []))
    return slim.mapInArrow(run, TOKENS + (", place long" if order else ""))


@lru_cache(maxsize=1)
def _unpacker() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def _ids(blob: bytes) -> np.ndarray:
    return np.frombuffer(_unpacker().decompress(blob), np.uint16)


def document_frequencies(tokens: DataFrame) -> np.ndarray:
    """Number of documents that hold each id. A task sends a row per id at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for blob in batch.column(0):
                df[np.unique(_ids(blob.as_py()))] += 1
        ids = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int32()), "df": pa.array(df[ids], pa.int64())})

    out = np.zeros(1 << 16, np.int64)
    found = tokens.select("ids").mapInArrow(run, "id int, df long").groupBy("id").agg(F.sum("df").alias("df"))
    for row in found.toPandas().itertuples():  # at most as many rows as the vocabulary has ids
        out[row.id] = row.df
    return out


class Index:
    """Inverted index of a shard with BM25 weights from the statistics of all documents."""

    def __init__(self, docs: list[np.ndarray], df: np.ndarray, n_docs: int, mean: float):
        # Terms in more than half of all documents weigh nothing in BM25's probabilistic idf.
        idf = np.maximum(0.0, np.log((n_docs - df + 0.5) / (df + 0.5)))
        self.terms = []
        term, doc, weight = [], [], []
        for i, ids in enumerate(docs):
            t, tf = np.unique(ids, return_counts=True)
            own = idf[t] > 0
            t, tf = t[own].astype(np.int64), tf[own]
            self.terms.append(t)
            term.append(t)
            doc.append(np.full(len(t), i))
            weight.append(idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ids) / mean)))
        term = np.concatenate(term)
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = np.concatenate(doc)[order], np.concatenate(weight)[order]
        self.begin = np.searchsorted(term[order], np.arange((1 << 16) + 1))
        self.n = len(docs)

    def scores(self, seed: int) -> np.ndarray:
        t = self.terms[seed]
        low = self.begin[t]
        sizes = self.begin[t + 1] - low
        total = int(sizes.sum())
        if not total:
            return np.zeros(self.n)
        at = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)
        return np.bincount(self.doc[at], self.weight[at], self.n)


def fill(sizes: list[int], index: Index, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (document, start, length)."""
    unused = np.ones(len(sizes), bool)
    windows, next_seed = [], 0
    rest: tuple[int, int] | None = None  # document and start of what the window before left over
    while True:
        if rest is None:
            while next_seed < len(sizes) and not unused[next_seed]:
                next_seed += 1
            if next_seed == len(sizes):
                return windows
            rest = next_seed, 0
            unused[next_seed] = False
        seed, start = rest
        took = min(window, sizes[seed] - start)
        pieces, room = [(seed, start, took)], window - took
        rest = (seed, start + took) if start + took < sizes[seed] else None
        if room and unused.any():
            score = np.where(unused, index.scores(seed), -1.0)
            # An unused document has one token at least: no more than `room` of them can be needed.
            few = min(len(score), 64)
            best = np.argpartition(-score, few - 1)[:few]
            ranked = iter(best[np.lexsort((best, -score[best]))])
            while room:
                d = next(ranked, None)
                if d is None and few < len(score):
                    few, ranked = len(score), iter(np.lexsort((np.arange(len(score)), -np.where(unused, score, -1.0))))
                    continue
                if d is None or (not unused[d] and few == len(score)):
                    break
                if not unused[d]:
                    continue
                unused[d] = False
                took = min(room, sizes[d])
                pieces.append((int(d), 0, took))
                room -= took
                if took < sizes[d]:
                    rest = int(d), took
        windows.append(pieces)


def powers(n: int) -> list[int]:
    """Powers of two that add up to n, largest first."""
    return [1 << i for i in range(n.bit_length() - 1, -1, -1) if n >> i & 1]


def cut(pieces: list[tuple[int, int, int]], lengths: list[int]) -> list[list[tuple[int, int, int]]]:
    """A run of pieces cut into sequences of the given lengths."""
    out, queue = [], list(reversed(pieces))
    for n in lengths:
        own = []
        while n:
            d, start, length = queue.pop()
            took = min(n, length)
            own.append((d, start, took))
            n -= took
            if took < length:
                queue.append((d, start + took, length - took))
        out.append(own)
    return out


def pack(tokens: DataFrame, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Pieces of documents with their little-endian 32-bit ids. `tokens` is settled, as it is read three times.

    A column `place`, distinct numbers from 0 to less than 2^43, orders seeds and sequences.
    """
    ordered = "place" in tokens.columns
    n_docs, total = tokens.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = document_frequencies(tokens)
    mean = max(1.0, (total or 0) / max(1, n_docs))
    shards = max(1, -(-(total or 0) // shard_tokens))
    sent = tokens.sparkSession.sparkContext.broadcast(df)  # 64 Ki numbers whatever the input

    def run(table: pa.Table) -> pa.Table:
        places = table["place"].to_pylist() if ordered else [0] * table.num_rows
        rows = sorted(zip(table["doc_id"].to_pylist(), table["ids"].to_pylist(), places),
                      key=lambda r: (r[2], r[0] is not None, r[0] or 0, r[1]))
        shard = table["shard"][0].as_py()
        docs = [_ids(r[1]) for r in rows]
        windows = fill([len(d) for d in docs], Index(docs, sent.value, n_docs, mean), window)
        last = sum(p[2] for p in windows[-1])
        if last < window:
            windows[-1:] = cut(windows[-1], powers(last))
        out = {c: [] for c in ("doc_id", "doc_no", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")}
        seeded: Counter[int] = Counter()
        for number, pieces in enumerate(windows):
            offset, seed = 0, pieces[0][0]
            sequence = (rows[seed][2] << SEED_BITS) + seeded[seed] if ordered else (shard << 32) + number
            seeded[seed] += 1
            for d, start, length in pieces:
                values = (rows[d][0], (shard << 32) + d, start, length,
                          docs[d][start:start + length].astype("<u4").tobytes(), len(docs[d]),
                          sequence, offset)
                for column, value in zip(out.values(), values):
                    column.append(value)
                offset += length
        return pa.table({c: pa.array(v, pa.binary() if c == "ids" else pa.int64()) for c, v in out.items()})

    dealt = tokens.withColumn("shard", F.pmod(F.xxhash64("row_no"), F.lit(shards)).cast("long"))
    return dealt.select("shard", "doc_id", "ids", *(["place"] if ordered else [])).groupBy("shard").applyInArrow(run, PIECES)


def query(docs: DataFrame, path: str, order: str | None = None) -> DataFrame:
    pieces = pack(settle(encode_documents(docs, path, order=order)))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "doc_no")
