"""N-gram Jaccard join with several global orders of the tokens.

Two sets of sizes n that reach the similarity share a token among the first n - ceil(t n) + 1 of each, under any
order that all sets use. Three orders are used, each putting rarer shingles first. A pair is verified only if it
passes all of them: the first order makes the pairs (with the sizes and the positions of the shared token as
further conditions), the other two are intersected with them.

Texts with equal sets are one node, so copies cost nothing. In a group of nodes that share a prefix token, the
node that has it foremost is the hub, and every member is checked against it. Components of these links come
next; then only pairs of nodes in different components are made, from groups that hold several, between the
nodes outside the group's main component and all others. Pairs inside one component would change nothing, so
leaving them out loses no link between components and no group is expanded into all its pairs.

Shingle counts that the orders use come from a fixed table of 2^20 hashed counters over all documents. They
only decide how well the filters work: any order gives the same result.

Defined cases: a null text, or one without words, has an empty set and is linked with nothing; a text of fewer
words is one shingle; equal ids or rows are nodes like others; a null id has a component like others, named by
the smallest id in it that is not null; an empty table gives an empty result; extra columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, settle, slices
from .components import components
from .shingles import Shingler, mix, name_of

CHUNK = 4 << 20  # bytes of text worked on at once
COUNTERS = 1 << 20  # hashed counters of shingles
SLICES = 64  # pieces in which the counters are added up
SMALL = 4_000_000  # ids up to which the wanted documents are picked by broadcast; beyond, by a shuffle join
REMEMBERED = 200_000  # nodes of which a task knows that it sent their tokens

META = "doc_id long, n long, node long, check long, slice int, counts binary"
TOKENS = "token long, node long, n int, pos int"


def _slim(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))


def _sets(batch: pa.RecordBatch, shingler: Shingler) -> Iterator[tuple[int | None, np.ndarray]]:
    texts = [t.as_buffer().to_pybytes() for t in batch.column("text")]
    return zip(batch.column("doc_id").to_pylist(), shingler.sets(texts))


def prefix_size(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def describe(slim: DataFrame, words: int) -> DataFrame:
    """Settled: a row per document with its size and node, and rows with each task's shingle counters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts = Shingler(words), np.zeros(COUNTERS, np.uint32)
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("check", pa.int64()),
                            ("slice", pa.int32()), ("counts", pa.binary())])
        for batch in slices(batches, "text", CHUNK):
            out = []
            for doc, values in _sets(batch, shingler):
                node, check = name_of(values)
                out.append((doc, len(values), node, check, None, None))
                np.add.at(counts, (values & np.uint64(COUNTERS - 1)).astype(np.int64), np.uint32(1))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        packer, width = zstandard.ZstdCompressor(level=1), COUNTERS // SLICES
        for i in range(SLICES):
            part = counts[i * width:(i + 1) * width]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(
                    (None, None, None, None, i, packer.compress(part.tobytes())), schema)], schema=schema)

    return settle(slim.mapInArrow(run, META))


def counters(meta: DataFrame) -> np.ndarray:
    """The counters of all tasks together: 4 MB, whatever the input."""
    width = COUNTERS // SLICES

    def add(table: pa.Table) -> pa.Table:
        total, open_ = np.zeros(width, np.uint64), zstandard.ZstdDecompressor()
        for blob in table["counts"]:
            total += np.frombuffer(open_.decompress(blob.as_py()), np.uint32)
        capped = np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32)
        return pa.table({"slice": table["slice"][:1], "counts": pa.array([capped.tobytes()], pa.binary())})

    out = np.zeros(COUNTERS, np.uint32)
    rows = meta.where("slice IS NOT NULL").select("slice", "counts").groupBy("slice").applyInArrow(
        add, "slice int, counts binary").collect()
    for row in rows:
        out[row["slice"] * width:(row["slice"] + 1) * width] = np.frombuffer(row["counts"], np.uint32)
    return out


def ranked(values: np.ndarray, counts: np.ndarray, order: int) -> np.ndarray:
    """The set in the given global order. All orders put rare shingles first: the first by count, the others by
    the count's magnitude, each with its own order among equals."""
    c = counts[(values & np.uint64(COUNTERS - 1)).astype(np.int64)]
    if order == 0:
        return values[np.argsort(c, kind="stable")]  # values ascend, so equals stay in the order of their numbers
    return values[np.lexsort((mix(values, 100 + order), np.frexp(c.astype(np.float64))[1]))]


def prefix_tokens(slim: DataFrame, words: int, percent: int, shared) -> DataFrame:
    """(token, node, n, pos) of the first order's prefix of each node. A task sends a node once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts, sent = Shingler(words), shared.value, set()
        for batch in slices(batches, "text", CHUNK):
            tokens, nodes, sizes, places = [], [], [], []
            for _, values in _sets(batch, shingler):
                node, n = name_of(values)[0], len(values)
                if not n or node in sent:
                    continue
                if len(sent) >= REMEMBERED:
                    sent.clear()
                sent.add(node)
                p = prefix_size(n, percent)
                tokens.append(ranked(values, counts, 0)[:p])
                nodes.append(np.full(p, node, np.int64))
                sizes.append(np.full(p, n, np.int32))
                places.append(np.arange(p, dtype=np.int32))
            if tokens:
                whole = [np.concatenate(x) for x in (tokens, nodes, sizes, places)]
                for a in range(0, len(whole[0]), 1 << 17):
                    part = [x[a:a + (1 << 17)] for x in whole]
                    yield pa.RecordBatch.from_arrays([pa.array(part[0].view(np.int64)), *map(pa.array, part[1:])],
                                                     ["token", "node", "n", "pos"])

    return slim.mapInArrow(run, TOKENS)


def texts_of(slim: DataFrame, nodes: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, text): a compressed text of each wanted node, which is smaller than its set. nodes: (node, first)."""
    ids = settle(wanted.join(nodes, "node").select(F.col("first").alias("wanted")).distinct())
    few = ids.where("wanted IS NOT NULL")
    few = F.broadcast(few) if few.count() <= SMALL else few
    chosen = slim.join(few, F.col("doc_id") == F.col("wanted"), "left_semi")
    if not ids.where("wanted IS NULL").isEmpty():
        chosen = chosen.union(slim.where("doc_id IS NULL"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, packer = Shingler(words), zstandard.ZstdCompressor(level=3)
        for batch in slices(batches, "text", CHUNK):
            names = [name_of(values)[0] for _, values in _sets(batch, shingler)]
            texts = [packer.compress(t.as_buffer().to_pybytes()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(texts, pa.binary())], ["node", "text"])

    return chosen.mapInArrow(run, "node long, text binary").dropDuplicates(["node"])


def may_reach(nx: str, ny: str, px: str, py: str, percent: int):
    """Sizes and positions of a shared token allow the similarity, if it is the pair's first shared token."""
    x, y = F.col(nx).cast("long"), F.col(ny).cast("long")
    sizes = (100 * F.least(x, y) >= percent * F.greatest(x, y))
    rest = F.least(x - F.col(px), y - F.col(py))
    return sizes & ((100 + percent) * rest >= percent * (x + y))


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int, shared) -> DataFrame:
    """The (a, b) that pass the other orders and then the similarity itself."""
    left, right = (texts.select(F.col("node").alias(c), F.col("text").alias(c + "_text")) for c in ("a", "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts, open_ = Shingler(words), shared.value, zstandard.ZstdDecompressor()
        for batch in slices(batches, "a_text", CHUNK // 4):
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("a", "b")]
            a, b = (c.to_pylist() for c in columns)
            texts_ = {}  # a hub stands in many pairs: each text is taken up once
            for names, column in ((a, "a_text"), (b, "b_text")):
                for i, blob in zip(names, batch.column(batch.schema.get_field_index(column))):
                    if i not in texts_:
                        texts_[i] = open_.decompress(blob.as_py())
            sets = dict(zip(texts_, shingler.sets(list(texts_.values()))))
            others = {i: [np.sort(ranked(v, counts, k)[:prefix_size(len(v), percent)]) for k in (1, 2)]
                      for i, v in sets.items()}
            good = []
            for x, y in zip(a, b):
                if all(common(p, q) for p, q in zip(others[x], others[y])):
                    both = common(sets[x], sets[y])
                    if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                        good.append((x, y))
            if good:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*good)], ["a", "b"])

    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def common(x: np.ndarray, y: np.ndarray) -> int:
    """Number of shared values of two ascending arrays of distinct values."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def join(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    slim = _slim(docs, doc_id, text)
    meta = describe(slim, words)
    shared = docs.sparkSession.sparkContext.broadcast(counters(meta))
    rows = meta.where("slice IS NULL").select("doc_id", "n", "node", "check")
    nodes = settle(rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first"), F.min("check").alias("c0"),
                                                          F.max("check").alias("c1")))
    if not nodes.where("c0 <> c1").isEmpty():
        raise RuntimeError("two sets share a 64-bit name; choose another salt")

    tokens = prefix_tokens(slim, words, percent, shared)
    several = tokens.groupBy("token").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("token")
    members = settle(tokens.join(several, "token").distinct())
    hubs = members.groupBy("token").agg(F.min(F.struct("pos", "n", "node")).alias("hub"))
    stars = settle(members.join(hubs, "token").select(
        "node", "n", "pos", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.pos").alias("hub_pos"))
        .where("node <> hub").where(may_reach("n", "hub_n", "pos", "hub_pos", percent)).select(
        F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct())

    def checked(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        return settle(verified(pairs, texts_of(slim, nodes, ends, words), words, percent, shared))

    links = checked(stars)
    first = settle(components(links))
    placed = settle(members.join(first, "node", "left").select(
        "token", "node", "n", "pos", F.coalesce("root", "node").alias("root")))
    mixed = placed.groupBy("token", "root").agg(F.count(F.lit(1)).alias("k")).groupBy("token").agg(
        F.max(F.struct("k", "root")).alias("main"), F.min("root").alias("r0"), F.max("root").alias("r1")
    ).where("r0 <> r1").select("token", F.col("main.root").alias("main"))
    within = settle(placed.join(mixed, "token"))
    outer = within.where("root <> main").select("token", *[F.col(c).alias("x_" + c) for c in ("node", "n", "pos", "root")])
    cross = outer.join(within, "token").where(F.col("x_root") != F.col("root")).where(
        may_reach("x_n", "n", "x_pos", "pos", percent)).select(
        F.least("x_node", "node").alias("a"), F.greatest("x_node", "node").alias("b")).distinct()
    more = checked(settle(cross.join(stars, ["a", "b"], "left_anti")))
    grouped = components(links.union(more)) if not more.isEmpty() else first
    named = nodes.select("node", "first").join(grouped, "node", "left").select(
        "node", "first", F.coalesce("root", "node").alias("root"))
    names = named.groupBy("root").agg(F.min("first").alias("component_id"))
    known = named.join(names, "root").select("node", "component_id")
    full = rows.where("n > 0").join(known, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.union(empty)


def keep_first(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without near duplicates, with all columns: of each component the smallest id stays. Rows that
    repeat the winner's id stay with it, and rows without an id stay, as no id can name them."""
    lost = free_name(docs.columns, "lost_id")
    found = join(docs, words, percent, doc_id, text)
    out = found.where("doc_id <> component_id").select(F.col("doc_id").alias(lost)).distinct()
    return docs.join(out, F.col(doc_id).cast("long") == F.col(lost), "left_anti")


def query(docs: DataFrame) -> DataFrame:
    return join(docs, 3, 90)


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS t FROM documents
), shingled AS (
  SELECT doc_id, list_distinct(CASE WHEN len(t) >= 3 THEN list_transform(range(1, len(t) - 1), lambda i: concat_ws(' ', t[i], t[i + 1], t[i + 2]))
                                    WHEN len(t) > 0 THEN [array_to_string(t, ' ')] ELSE [] END) AS s FROM w
), tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM shingled),
rare AS (SELECT g FROM tokens GROUP BY g HAVING count(*) > 1),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS inter
  FROM tokens a JOIN rare USING (g) JOIN tokens b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (SELECT x, y FROM shared WHERE 100 * inter >= 90 * (nx + ny - inter)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM shingled UNION SELECT r.doc_id, l.y FROM reach r JOIN link l ON r.other = l.x
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.other) AS component_id
FROM shingled s JOIN reach r USING (doc_id) GROUP BY ALL
"""
