"""Nearest neighbours by blocks: int8 product tiles with error bounds, exact scores for what survives.

A vector x is kept as scale * q + e with int8 q. For two vectors the product of the stored parts is off from
the true product by at most |e_x| |y| + |x'| |e_y|, with x' = scale * q. A tile multiplies a block of queries
with a block of candidates; per query the k-th best lower bound so far, from a heap of exact scores carried
along the tiles of a task, rules out every candidate whose upper bound lies below it. What survives is scored
anew on the original vectors in double precision, summed in the order of the components. Tasks hand on at most
k rows per query, and a ranked merge over tasks ends the search. The result is exact.

Queries meet candidates block by block: each candidate block is sent to every query block, so a task holds one
query block and one candidate block at a time, whatever the table's size.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part; vectors
of different length are not compared; the query's own id is no candidate; ties go to the smaller id; rows
repeated with one id are separate candidates, but a repeated query asks once, and different vectors under one query id
are ranked each for itself; null ids take no part; an empty table gives an empty result;
extra columns are never read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

BLOCK = 2048  # vectors of a block
FEW = 1_000_000  # query blocks (two numbers each) whose list goes to every task; beyond, candidates meet it by a join
LANES = 8  # tasks among which the candidate blocks of one query block are split, at least

BLOCKS = ("dim int, block long, n int, ids binary, codes binary, scales binary, errors binary, norms binary, "
          "vectors binary")


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(id, v, dim) of the vectors that take part, in double precision."""
    v = F.col(embedding).cast("array<double>")
    fine = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return (vectors.select(F.col(vec_id).cast("long").alias("id"), v.alias("v"))
            .where(F.col("id").isNotNull() & F.col("v").isNotNull() & fine & F.exists("v", lambda x: x != 0))
            .withColumn("dim", F.size("v")))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, scales, error norms, norms of the stored parts) of the rows of x."""
    scale = np.maximum(np.abs(x).max(axis=1) / 127.0, np.finfo(np.float64).tiny)
    codes = np.clip(np.rint(x / scale[:, None]), -127, 127).astype(np.int8)
    stored = codes * scale[:, None]
    return codes, scale, np.sqrt(((x - stored) ** 2).sum(axis=1)), np.sqrt((stored ** 2).sum(axis=1))


def blocks(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """Blocks of at most `size` vectors of one length, as the scan brings them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pack(dim: int, ids: list, vs: list) -> pa.RecordBatch:
            x = np.array(vs, np.float64).reshape(len(ids), dim)
            codes, scale, error, norm = quantise(x)
            # Only spreads candidate blocks over tasks; query blocks get numbers of their own.
            name = hash((dim, len(ids), ids[0], ids[-1])) & (2**62 - 1)
            return pa.RecordBatch.from_pydict({
                "dim": pa.array([dim], pa.int32()), "block": pa.array([name], pa.int64()),
                "n": pa.array([len(ids)], pa.int32()), "ids": [np.array(ids, np.int64).tobytes()],
                "codes": [codes.tobytes()], "scales": [scale.tobytes()], "errors": [error.tobytes()],
                "norms": [norm.tobytes()], "vectors": [x.tobytes()]})

        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for i, v in zip(batch.column("id").to_pylist(), batch.column("v").to_pylist()):
                ids, vs = held.setdefault(len(v), ([], []))
                ids.append(i)
                vs.append(v)
                if len(ids) == size:
                    yield pack(len(v), *held.pop(len(v)))
        for dim, (ids, vs) in held.items():
            yield pack(dim, ids, vs)

    return rows.select("id", "v").mapInArrow(run, BLOCKS)


class Block:
    def __init__(self, row: dict):
        dim = row["dim"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.codes = np.frombuffer(row["codes"], np.int8).reshape(-1, dim).astype(np.float32)
        self.scale, self.error, self.norm = (np.frombuffer(row[c]) for c in ("scales", "errors", "norms"))
        self.x = np.frombuffer(row["vectors"]).reshape(-1, dim)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in double precision, summed from the first component to the last."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j] * b[:, j]
    return out


def search_tile(q: Block, c: Block, best: list[list], k: int) -> None:
    """Merge a tile's candidates into the heaps of (score, -id) of its queries; a heap keeps the k best."""
    # Products of int8 codes sum exactly in float32 up to 1040 components; beyond, rounding joins the bound.
    raw = (q.codes @ c.codes.T).astype(np.float64)
    dim = q.codes.shape[1]
    slack = 1e-12 if dim <= 1040 else dim * 2.0**-23
    near = raw * q.scale[:, None] * c.scale[None, :]
    size = (q.norm + q.error)[:, None] * (c.norm + c.error)[None, :]
    off = q.error[:, None] * (c.norm + c.error)[None, :] + q.norm[:, None] * c.error[None, :] + slack * size
    own = q.ids[:, None] == c.ids[None, :]
    low = np.where(own, -np.inf, near - off)
    floor = np.array([h[0][0] if len(h) == k else -np.inf for h in best])
    if low.shape[1] >= k:
        floor = np.maximum(floor, np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k])
    keep = ~own & (near + off >= floor[:, None])
    for a in range(0, len(keep), 256):  # exact scores of some queries at a time bound the memory
        qi, ci = np.nonzero(keep[a:a + 256])
        for at in range(0, len(qi), 65_536):
            i, j = qi[at:at + 65_536] + a, ci[at:at + 65_536]
            score = exact(q.x[i], c.x[j])
            order = np.lexsort((c.ids[j], -score, i))
            i, j, score = i[order], j[order], score[order]
            rank = np.arange(len(i)) - np.searchsorted(i, i)
            for n in np.flatnonzero(rank < k):
                heap, item = best[i[n]], (score[n], -c.ids[j[n]])
                if len(heap) < k:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 20, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k largest inner products; inputs as `usable` gives them."""
    # A query row that is repeated asks once.
    q = settle(blocks(queries.dropDuplicates(["id", "v"]), block).withColumn("block", F.monotonically_increasing_id()))
    c = blocks(candidates, block)
    names = BLOCKS.replace(",", "").split()[::2]
    asks = q.select([F.col(n).alias("q_" + n) for n in names])
    # A stated query set against all rows, in blocks: candidate blocks go once to each query block.
    lane = F.pmod(F.col("block"), F.lit(LANES))
    sides = asks.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))))
    targets = q.select(F.col("dim").alias("t_dim"), F.col("block").alias("t_block"))
    few = F.broadcast(targets) if q.count() <= FEW else targets
    sent = c.join(few, F.col("dim") == F.col("t_dim")).drop("t_dim").withColumn("lane", lane.cast("int"))
    pairs = sent.join(sides, (F.col("t_block") == F.col("q_block")) & (sent["lane"] == sides["lane"])).select(
        *names, *["q_" + n for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Block, list]] = {}
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1).to_pylist()[0]
                key = (row["q_dim"], row["q_block"])
                if key not in held:
                    if len(held) >= 4:  # blocks of a query come together or nearly so; hand on what is complete
                        yield from _flush(held)
                    asked = Block({n: row["q_" + n] for n in names})
                    held[key] = asked, [[] for _ in asked.ids]
                search_tile(held[key][0], Block(row), held[key][1], k)
        yield from _flush(held)

    found = pairs.mapInArrow(run, "query_id long, ask_block long, ask_row int, vec_id long, score double")
    order = Window.partitionBy("query_id", "ask_block", "ask_row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _flush(held: dict) -> Iterator[pa.RecordBatch]:
    for (_, block), (asked, best) in held.items():
        out = [(i, n, -v, s) for n, (i, heap) in enumerate(zip(asked.ids, best)) for s, v in heap]
        if out:
            a, n, b, s = zip(*out)
            yield pa.RecordBatch.from_pydict({
                "query_id": pa.array(a, pa.int64()), "ask_block": pa.array([block] * len(a), pa.int64()),
                "ask_row": pa.array(n, pa.int32()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(s, pa.float64())})
    held.clear()


def query(vectors: DataFrame) -> DataFrame:
    rows = usable(vectors)
    return nearest(rows.where(F.col("id") % 20 == 0), rows)


ORACLE = """
WITH good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""
