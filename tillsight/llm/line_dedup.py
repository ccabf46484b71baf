"""Line dedup within one character edit by a deletion-neighbourhood join, in DataFrame operations alone.

Lines are trimmed and lower-cased; equal lines are one distinct line, known by its digest, whose rank is its
earliest place (document id, line number). Two distinct lines are within one edit exactly if one is the other
without one character, or both lose one character at the same place and then agree. So every line emits, for
each place, a key of the line without that character (to meet whole lines) and a key of the same together with
the place (to meet lines that differ there), and one key of itself. Each member of a key meets the earliest one
only: no pairs among a key's members are made, and the earliest is all that "keep the earliest" needs. Each match
is verified by its edit distance.

Only keys that can meet another line are emitted, found by three screens that lose nothing. With one edit, the first or
the second half of the shorter length stays as it is: a line whose halves no other line has emits none. What passes is
cut into PIECES pieces: an edit inside a piece leaves what stands before and behind that piece as it is, so only
pieces count around which another line has the same text. These are cut into PIECES pieces each and held to the same
test, and a line emits keys for the places of those that pass: a group of long lines that differ within a few characters
emits keys for these, not for an eighth of each line.

A line goes when an earlier line equals it, or lies within one edit while both have `min_chars` characters at
least: below that, one edit makes another word. What is kept or not never depends on other removals.

A document is an id with a text, and its rank is the id, then a hash of the text. So different rows under one id, or
with null ids, are documents of their own, and only their own lines are cut; rows repeated with id and text are one.

Defined cases: blank lines stay and a null text has none; null ids rank last; an empty table gives an empty result;
extra columns are never read. Keys are rows of their own and never held together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, settle

MIN_CHARS = 12
LAST = (1 << 63) - 1  # rank of a null id
SMALL = 1_000_000  # lines (up to 88 MB) that are broadcast; beyond, all but the most frequent are joined
PIECES = 8  # of a line, and again of each piece that passes


def _rank(docs: DataFrame, doc_id: str, text: str) -> list[Column]:
    return [F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(F.col(f"`{text}`")).alias("part")]


def lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, part, line, norm) of every line that is not blank."""
    every = docs.select(*_rank(docs, doc_id, text), F.posexplode(F.split(F.col(f"`{text}`"), "\n", -1)).alias("line", "raw"))
    return every.select("doc", "part", "line", F.lower(F.trim(F.col("raw"), F.lit(" \t\r"))).alias("norm")).where("norm <> ''")


PLACE = ("doc", "part", "line")


def _digest(norm: str) -> Column:
    return F.unhex(F.md5(F.col(norm)))


def distinct_lines(every: DataFrame) -> DataFrame:
    """(key, short, doc, part, line, n, chars, halves): one row per distinct line with its earliest place."""
    chars = F.length("norm")

    def half(size: Column, end: str) -> Column:
        m = F.floor(size / 2).cast("int")
        part = F.left("norm", m) if end == "first" else F.right("norm", m)
        return F.xxhash64(F.lit(end), size, part)

    keyed = every.select(*PLACE, _digest("norm").alias("key"), _short("norm").alias("short"), chars.alias("chars"), *[
        half(size, end).alias(name) for name, size, end in (
            ("own_first", chars, "first"), ("own_second", chars, "second"),
            ("less_first", chars - 1, "first"), ("less_second", chars - 1, "second"))])
    names = ("short", "chars", "own_first", "own_second", "less_first", "less_second")
    grouped = keyed.groupBy("key").agg(F.min(F.struct(*PLACE)).alias("at"), F.count(F.lit(1)).alias("n"),
                                       *[F.first(c).alias(c) for c in names])
    return grouped.select("key", "at.*", "n", *names)


def _short(norm: str) -> Column:
    """A line as a number: smaller to send and quicker to make than the digest, which what it picks is compared by."""
    return F.xxhash64(F.col(norm))


NEEDS = ("own_second", "own_first", "less_second", "less_first")


def _shared(entries: DataFrame, by: str) -> DataFrame:
    """The entries that can meet: of one size with another, or of one size with those one longer."""
    counts = entries.groupBy(by).agg(
        F.count(F.when(F.col("own"), 1)).alias("size"), F.count(F.when(~F.col("own"), 1)).alias("longer")
    ).where("size > 1 OR (size = 1 AND longer > 0)")
    return entries.join(counts, by)


def candidates(distinct: DataFrame, min_chars: int) -> DataFrame:
    """(short, needs): the lines that share half a line with another, and in which half the edit can lie.

    If the first halves agree, the edit lies in the second, and the other way round. A line stands for itself (own) and
    as the longer partner of lines one shorter (less).
    """
    def entry(column: str, own: bool, edit: str) -> Column:
        return F.struct(F.col(column).alias("half"), F.lit(own).alias("own"), F.lit(edit).alias("edit"))

    halves = distinct.where(F.col("chars") >= min_chars).select("short", F.explode(F.array(
        entry("own_first", True, "second"), entry("own_second", True, "first"),
        entry("less_first", False, "second"), entry("less_second", False, "first"))).alias("e")).select("short", "e.*")
    met = _shared(halves, "half")
    return met.groupBy("short").agg(*[F.max((F.col("own") == own) & (F.col("edit") == edit)).alias(f"{name}_{edit}")
                                      for name, own in (("own", True), ("less", False)) for edit in ("second", "first")])


def _bit(j: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), j)


def refined(texts: DataFrame, pieces: int, wanted: Callable[[Column, Column], Column]) -> DataFrame:
    """(key, own_bits, less_bits, by_place, whole): the pieces, as bits, around which another line has the same text, of
    the line itself (own) and of its forms one shorter (less); those of its own in which a line of its size can differ, and
    whether a longer one can differ from it. `wanted` says of a piece, and of whether it is an own one, if it is looked at."""
    j, size = F.col("j"), F.length("norm")

    def before(n: Column, at: Column) -> Column:
        """Number of characters before a piece."""
        return F.floor(n.cast("long") * at / pieces).cast("int")

    def around(n: Column, more: int) -> Column:
        rest = F.substring("norm", before(n, j + 1) + (more + 1), size)
        return F.xxhash64(n, j, F.substring("norm", F.lit(1), before(n, j)), rest)

    def looked_at(i: Column) -> Column:
        at, own = F.pmod(i, F.lit(pieces)), i < pieces
        n = F.when(own, size).otherwise(size - 1)
        return (before(n, at) < before(n, at + 1)) & wanted(at, own)  # an empty piece holds no place

    numbers = F.filter(F.sequence(F.lit(0), F.lit(2 * pieces - 1)), looked_at)
    spread = texts.select("key", "norm", F.explode(numbers).alias("e")).select(
        "key", "norm", (F.col("e") % pieces).alias("j"), (F.col("e") < pieces).alias("own"))
    entries = spread.select("key", "own", "j", F.when(F.col("own"), around(size, 0)).otherwise(around(size - 1, 1)).alias("rest"))

    def bits(which: Column) -> Column:
        return F.bit_or(F.when(which, _bit(j)).otherwise(0))

    return _shared(entries, "rest").groupBy("key").agg(
        bits(F.col("own")).alias("own_bits"), bits(~F.col("own")).alias("less_bits"),
        bits(F.col("own") & (F.col("size") > 1)).alias("by_place"),
        F.max(F.col("own") & (F.col("longer") > 0)).alias("whole"))


def _by_half(j: Column, own: Column) -> Column:
    second = j >= PIECES // 2
    return F.when(own, F.when(second, F.col("own_second")).otherwise(F.col("own_first"))).otherwise(
        F.when(second, F.col("less_second")).otherwise(F.col("less_first")))


def _by_piece(j: Column, own: Column) -> Column:
    bits = F.when(own, F.col("own_bits")).otherwise(F.col("less_bits"))
    return bits.bitwiseAND(_bit(F.floor(j / PIECES).cast("int"))) != 0


def sifted(texts: DataFrame) -> DataFrame:
    """The lines that pass both cuts into pieces, with the bits of the second."""
    coarse = settle(texts.join(refined(texts, PIECES, _by_half), "key").drop(*NEEDS, "by_place", "whole"))
    fine = refined(coarse, PIECES * PIECES, _by_piece).withColumnRenamed("less_bits", "by_size").drop("own_bits")
    return settle(coarse.drop("own_bits", "less_bits").join(fine, "key"))


def neighbours(texts: DataFrame) -> DataFrame:
    """(key, near): for each line the earliest place before it of a line within one edit.

    The lines that share a key differ in one character at one place, or are one line and its shortened forms, so
    the alphabet and the line's length bound their number.
    """
    i, size, place = F.col("i"), F.length("norm"), F.struct(*PLACE, "short")

    def within(bits: str, n: Column, at: Column) -> Column:
        """Whether a place, from 1, lies in one of the pieces."""
        pieces = PIECES * PIECES
        piece = F.least(F.floor((at.cast("long") * pieces - 1) / n).cast("int"), F.lit(pieces - 1))
        return F.col(bits).bitwiseAND(_bit(piece)) != 0

    less = F.concat(F.substring("norm", F.lit(1), i - 1), F.substring("norm", i + 1, size))
    places = F.filter(F.sequence(F.lit(1), size), lambda at: within("by_place", size, at) | within("by_size", size - 1, at))
    spread = texts.select(*PLACE, "short", "norm", "by_place", "by_size", F.explode(places).alias("i"))
    shortened = spread.select(*PLACE, "short", "i", within("by_place", size, i).alias("to_place"),
                              within("by_size", size - 1, i).alias("to_size"), less.alias("less"))
    keys = shortened.select(*PLACE, "short", F.explode(F.array_compact(F.array(
        F.when(F.col("to_place"), F.struct(F.xxhash64(F.lit("place"), "i", "less").alias("h"), F.lit(0).alias("kind"))),
        F.when(F.col("to_size"), F.struct(F.xxhash64(F.lit("less"), "less").alias("h"), F.lit(1).alias("kind")))))).alias("e")
    ).select(*PLACE, "short", "e.h", "e.kind").union(texts.where("whole").select(
        *PLACE, "short", F.xxhash64(F.lit("less"), "norm").alias("h"), F.lit(2).alias("kind")))
    group = Window.partitionBy("h")
    best = keys.select("*", F.min(F.when(F.col("kind") < 2, place)).over(group).alias("shortened"),
                       F.min(F.when(F.col("kind") == 2, place)).over(group).alias("entire"))
    # A shortened line meets the whole line that equals it; the others meet shortened ones.
    partner = F.when(F.col("kind") == 1, F.col("entire")).otherwise(F.col("shortened"))
    pairs = best.select(place.alias("late"), partner.alias("early")).where("early < late").distinct()
    sides = texts.select(place.alias("p"), "key", "norm")
    left = sides.select(F.col("p").alias("late"), "key", F.col("norm").alias("x"))
    right = sides.select(F.col("p").alias("early"), F.col("norm").alias("y"))
    near = pairs.join(left, "late").join(right, "early").where(F.levenshtein("x", "y", 1).between(0, 1))
    return near.groupBy("key").agg(F.min(F.struct(*[f"early.{c}" for c in PLACE])).alias("near"))


def _with_verdicts(every: DataFrame, verdicts: DataFrame, total: int) -> DataFrame:
    """The lines that have a verdict. Verdicts have a row per distinct line; a frequent line meets a broadcast one."""
    def beside(few: DataFrame) -> DataFrame:
        met = every.select(*PLACE, "norm", _short("norm").alias("short")).join(F.broadcast(few), "short")
        return met.where(_digest("norm") == F.col("key")).drop("norm", "short")

    if verdicts.count() <= SMALL:
        return beside(verdicts)
    # No more than SMALL lines can have this many rows each.
    frequent = F.col("n") * SMALL >= total
    rest = every.select(*PLACE, _digest("norm").alias("key")).join(verdicts.where(~frequent).drop("short"), "key")
    return beside(verdicts.where(frequent)).unionByName(rest)


def gone_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, part, line, keep, edits) of every line that goes."""
    every = lines(docs, doc_id, text)
    distinct = settle(distinct_lines(every))
    wanted = settle(candidates(distinct, min_chars))
    few = F.broadcast(wanted) if wanted.count() <= SMALL else wanted
    first = distinct.where(F.col("chars") >= min_chars).select("key", *PLACE)
    texts = settle(every.select("norm", _short("norm").alias("short")).join(few, "short").withColumn("key", _digest("norm"))
                   .dropDuplicates(["key"]).join(first, "key"))
    verdicts = settle(distinct.select("key", "short", F.struct(*PLACE).alias("first"), "n").join(
        neighbours(sifted(texts)), "key", "left").where("n > 1 OR near IS NOT NULL"))
    total = distinct.agg(F.sum("n")).first()[0] or 0
    placed = _with_verdicts(every, verdicts, total)
    equal = F.struct(*PLACE) != F.col("first")
    return placed.where(equal | F.col("near").isNotNull()).select(
        *PLACE, F.when(equal, F.col("first")).otherwise(F.col("near")).alias("keep"),
        F.when(equal, 0).otherwise(1).alias("edits"))


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, line, keep_doc_id, keep_line, edits) of every line that goes: its place, and the earliest line that
    stands for it, equal (edits 0) if there is one before it, else one edit away."""
    def id_of(c: Column) -> Column:
        return F.when(c != LAST, c)

    return gone_lines(docs, doc_id, text, min_chars).select(
        id_of(F.col("doc")).alias("doc_id"), "line", id_of(F.col("keep.doc")).alias("keep_doc_id"),
        F.col("keep.line").alias("keep_line"), "edits")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents without the lines that go, with all columns."""
    key, part, places = (free_name(docs.columns, c) for c in ("line_dedup_key", "line_dedup_part", "line_dedup_places"))
    listed = gone_lines(docs, doc_id, text, min_chars).groupBy(F.col("doc").alias(key), F.col("part").alias(part)).agg(
        F.collect_set("line").alias(places))
    doc, own = _rank(docs, doc_id, text)
    whole = docs.withColumns({key: doc, part: own}).join(listed, [key, part], "left")
    kept = F.concat_ws("\n", F.filter(F.split(F.col(f"`{text}`"), "\n", -1),
                                      lambda x, i: ~F.array_contains(F.col(places), i)))
    out = F.when(F.col(places).isNull(), F.col(f"`{text}`")).otherwise(kept)
    return whole.select(*[out.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def query(docs: DataFrame) -> DataFrame:
    return repeated_lines(docs)


ORACLE = r"""
WITH l AS (
  SELECT doc_id, CAST(unnest(range(len(p))) AS INTEGER) AS line, unnest(p) AS raw
  FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL)
), n AS (
  SELECT doc_id, line, lower(trim(raw, ' ' || chr(9) || chr(13))) AS t FROM l WHERE trim(raw, ' ' || chr(9) || chr(13)) <> ''
), u AS (
  SELECT t, min((doc_id, line)) AS f, length(t) AS n FROM n GROUP BY t
), near AS (
  SELECT a.t, min(b.f) AS g FROM u a JOIN u b ON b.n BETWEEN a.n - 1 AND a.n + 1 AND b.f < a.f
  WHERE a.n >= 12 AND b.n >= 12
    AND (left(a.t, CAST(least(a.n, b.n) // 2 AS BIGINT)) = left(b.t, CAST(least(a.n, b.n) // 2 AS BIGINT))
         OR right(a.t, CAST(least(a.n, b.n) // 2 AS BIGINT)) = right(b.t, CAST(least(a.n, b.n) // 2 AS BIGINT)))
    AND levenshtein(a.t, b.t) <= 1
  GROUP BY a.t
)
SELECT n.doc_id, n.line, CASE WHEN (n.doc_id, n.line) <> u.f THEN u.f[1] ELSE g[1] END AS keep_doc_id,
       CASE WHEN (n.doc_id, n.line) <> u.f THEN u.f[2] ELSE g[2] END AS keep_line,
       CASE WHEN (n.doc_id, n.line) <> u.f THEN 0 ELSE 1 END AS edits
FROM n JOIN u USING (t) LEFT JOIN near USING (t)
WHERE (n.doc_id, n.line) <> u.f OR g IS NOT NULL
"""
