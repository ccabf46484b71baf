"""Exact duplicates through minimal perfect hash tables over the digests of the corpus seen before.

The history's distinct digests are split into shards by their leading bytes. Each shard becomes one row: a
minimal perfect hash (one displacement per small bucket) and as many slots as digests; a slot holds the full
digest, the row that won so far and the number of rows seen. Arriving texts are first aggregated by digest,
map-side, so a text repeated a billion times reaches the lookup as one row. The lookup compares all 32 bytes
of the slot; what is not a member keeps the group that the aggregation made of it.

Defined cases: a null text equals an empty one. The row with the largest document id stays; a null id loses
to any other; of repeated rows with the same id one stays. Without history all rows arrive. An empty table
gives an empty result. Extra columns are never read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, settle, tagged

SHARD_DIGESTS = 32_768  # mean size of a shard; digests are uniform, so shards are even
BUCKET = 4  # mean number of digests that share a displacement
TRIES = 64  # displacements tried at once

INDEX = "shard int, n int, displacements binary, digests binary, ids binary, has_id binary, tags binary, counts binary"
GROUPS = "digest binary, keep_id long, has_id boolean, keep_tag long, group_size long"


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, tag, digest): a settled line per row; only these go on."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)).alias("digest"))
    return settle(tagged(slim, "tag"))


def grouped(rows: DataFrame) -> DataFrame:
    """(digest, keep_id, keep_tag, group_size), one row per distinct digest."""
    return (rows.groupBy("digest").agg(F.max(F.struct("doc_id", "tag")).alias("w"), F.count(F.lit(1)).alias("group_size"))
            .select("digest", F.col("w.doc_id").alias("keep_id"), F.col("w.tag").alias("keep_tag"), "group_size"))


def _whole_ids(groups: DataFrame) -> DataFrame:
    """Null ids as zero beside a flag: a column with nulls would reach Python as floating point."""
    return groups.withColumn("has_id", F.col("keep_id").isNotNull()).withColumn("keep_id", F.coalesce("keep_id", F.lit(0)))


def _shard(shards: int):
    return (F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long") % shards).cast("int")


def _halves(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Three numbers of each digest, from bytes that the shard does not use."""
    parts = np.ascontiguousarray(keys[:, 8:32]).view("<u8")
    return parts[:, 0], parts[:, 1], parts[:, 2] | np.uint64(1)


def _slots(start: np.ndarray, step: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    mixed = start + displacement.astype(np.uint64) * step
    return ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(n)).astype(np.int64)


def perfect_hash(keys: np.ndarray) -> np.ndarray:
    """Displacements under which n distinct digests (n x 32 bytes) take n different slots."""
    n = len(keys)
    pick, start, step = _halves(keys)
    bucket = (pick % np.uint64(max(1, -(-n // BUCKET)))).astype(np.int64)
    count = np.bincount(bucket, minlength=max(1, -(-n // BUCKET)))
    order = np.argsort(bucket, kind="stable")
    begin = np.concatenate([[0], np.cumsum(count)])
    out, taken = np.zeros(len(count), np.uint32), np.zeros(n, bool)
    for b in np.argsort(-count, kind="stable"):
        if not count[b]:
            break
        own = order[begin[b]:begin[b + 1]]
        first = 0
        while True:
            trial = np.arange(first, first + TRIES)
            at = np.sort(_slots(start[own][None, :], step[own][None, :], trial[:, None], n), axis=1)
            fits = ~taken[at].any(axis=1) & (np.diff(at, axis=1) > 0).all(axis=1)
            if fits.any():
                hit = int(fits.argmax())
                out[b] = first + hit
                taken[at[hit]] = True
                break
            first += TRIES
    return out


def look_up(keys: np.ndarray, displacements: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slot, whether the slot's 32 bytes are the key's) of each key."""
    if not len(slots) or not len(keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    pick, start, step = _halves(keys)
    at = _slots(start, step, displacements[(pick % np.uint64(len(displacements))).astype(np.int64)], len(slots))
    return at, (slots[at] == keys).all(axis=1)


def _matrix(values) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(v) for v in values), np.uint8).reshape(-1, 32)


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """One row per shard from (digest, keep_id, keep_tag, group_size)."""
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        keys = _matrix(rows["digest"])
        displacements = perfect_hash(keys)
        at, _ = look_up(keys, displacements, keys)
        place = np.empty_like(at)
        place[at] = np.arange(len(at))
        return pd.DataFrame([{
            "shard": int(rows["shard"].iloc[0]), "n": len(keys), "displacements": displacements.tobytes(),
            "digests": keys[place].tobytes(), "ids": rows["keep_id"].iloc[place].to_numpy(np.int64).tobytes(),
            "has_id": rows["has_id"].iloc[place].to_numpy(np.uint8).tobytes(),
            "tags": rows["keep_tag"].iloc[place].to_numpy(np.int64).tobytes(),
            "counts": rows["group_size"].iloc[place].to_numpy(np.int64).tobytes()}])

    return _whole_ids(history).withColumn("shard", _shard(shards)).groupBy("shard").applyInPandas(build, INDEX)


def merge(index: DataFrame, arrivals: DataFrame, shards: int) -> DataFrame:
    """Groups of history and arrivals together, through lookups in the index.

    A shard holds distinct digests only, of which there are about SHARD_DIGESTS, so a task's memory is bounded.
    """
    def join(slots: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        keys = _matrix(new["digest"])
        ids, has = new["keep_id"].to_numpy(np.int64), new["has_id"].to_numpy(bool)
        tags, counts = new["keep_tag"].to_numpy(np.int64), new["group_size"].to_numpy(np.int64)
        if len(slots):
            row = slots.iloc[0]
            stored = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
            s_ids, s_tags, s_counts = (np.frombuffer(row[c], np.int64).copy() for c in ("ids", "tags", "counts"))
            s_has = np.frombuffer(row["has_id"], np.uint8).astype(bool)
            at, member = look_up(keys, np.frombuffer(row["displacements"], np.uint32), stored)
            hit, own = at[member], np.flatnonzero(member)
            s_counts[hit] += counts[own]
            better = own[(has[own] > s_has[hit]) | (has[own] == s_has[hit]) & (
                (ids[own] > s_ids[hit]) | (ids[own] == s_ids[hit]) & (tags[own] > s_tags[hit]))]
            s_ids[at[better]], s_has[at[better]], s_tags[at[better]] = ids[better], has[better], tags[better]
            rest = ~member
            keys, ids, has = np.concatenate([stored, keys[rest]]), np.concatenate([s_ids, ids[rest]]), np.concatenate(
                [s_has, has[rest]])
            tags, counts = np.concatenate([s_tags, tags[rest]]), np.concatenate([s_counts, counts[rest]])
        return pd.DataFrame({"digest": [k.tobytes() for k in keys], "keep_id": ids, "has_id": has,
                             "keep_tag": tags, "group_size": counts})

    left = index.groupBy("shard")
    right = _whole_ids(arrivals).withColumn("shard", _shard(shards)).groupBy("shard")
    return left.cogroup(right).applyInPandas(join, GROUPS).select(
        "digest", F.when(F.col("has_id"), F.col("keep_id")).alias("keep_id"), "keep_tag", "group_size")


def dedup(rows: DataFrame, is_history) -> DataFrame:
    """(doc_id, tag, digest, keep_id, group_size, kept) of every row of `digests`.

    `is_history` is a condition on doc_id: those rows are the corpus seen before, the others arrive.
    """
    known = F.coalesce(is_history, F.lit(False))
    shards = 1 << max(0, (rows.count() // SHARD_DIGESTS)).bit_length()
    index = settle(build_index(grouped(rows.where(known)), shards))
    groups = merge(index, grouped(rows.where(~known)), shards)
    return rows.join(groups, "digest").select(
        "doc_id", "tag", "digest", "keep_id", "group_size", (F.col("tag") == F.col("keep_tag")).alias("kept"))


def first_half(rows: DataFrame, doc_id: str = "doc_id"):
    """Condition for the rows up to the middle of the id range: the corpus before the last delivery."""
    low, high = rows.agg(F.min(doc_id), F.max(doc_id)).first()
    return F.lit(False) if low is None else F.col(doc_id) <= (low + high) // 2


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without their exact copies, with all columns."""
    digest, keys = free_name(docs.columns, "digest"), [free_name(docs.columns, c) for c in ("lost_id", "lost_digest")]
    rows = digests(docs, doc_id, text)
    decided = settle(dedup(rows, first_half(rows)))
    kept = decided.where("kept").select(F.col("doc_id").alias(keys[0]), F.col("digest").alias(keys[1]))
    whole = docs.withColumn(digest, F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)))
    left = whole.join(kept, (F.col(digest) == F.col(keys[1])) & F.col(doc_id).eqNullSafe(F.col(keys[0])), "left_semi")
    # Rows repeated with one id and one text both match their winner; they are equal, so either may stay.
    distinct = decided.groupBy("doc_id", "digest").count().where("count > 1").isEmpty()
    return (left if distinct else left.dropDuplicates([doc_id, digest])).drop(digest)


def query(docs: DataFrame) -> DataFrame:
    rows = digests(docs)
    return dedup(rows, first_half(rows)).select("doc_id", "keep_id", "group_size", "kept",
                                                F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
"""
