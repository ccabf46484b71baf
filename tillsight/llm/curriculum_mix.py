"""Mixing sources to target weights along a curriculum whose weights change over training time.

Each source has a weight schedule over training time 0..1, linear between knots. Its integral is the source's
share. Shares are filled up to a cap per source and the excess is shared anew by weight. A source's demand for
words up to time t is then its target times the integral up to t; inverting it gives every document, at its
place in the source's own random order, a training position. Range-sorting by position gives the mixture.

The running totals inside a source never gather the source in one task: documents fall into about sqrt(rows)
hash buckets, totals are taken per bucket, then over buckets, then inside each bucket.

Defined cases: a null or empty text has size 0 and is never taken; a null source is a source of its own, last
in order; repeated rows are separate documents; with no words at all every target is 0; an empty table gives
an empty result; extra columns travel along. The order depends on the seed and the rows alone, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, settle, words

WEIGHTS = (5.0, 2.0, 1.0)  # repeating over the sources in order
TOTAL = 1.5  # words the mixture asks for, as a multiple of all words
CAP = 2.0  # most that one source gives, as a multiple of its words
# Shapes of mean 1 over training time as (time, factor) knots, repeating: early, even and late sources.
SHAPES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))

Knots = Sequence[tuple[float, float]]


def integral(knots: Knots) -> float:
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))


def schedules(weights: Sequence[float] = WEIGHTS, shapes: Sequence[Knots] = SHAPES) -> list[list[tuple[float, float]]]:
    """Schedules that repeat over the sources; each integrates to its weight."""
    return [[(t, w * y / integral(shape)) for t, y in shape]
            for w, shape in zip(weights, (shapes[i % len(shapes)] for i in range(len(weights))))]


def source_key(source: str) -> Column:
    """Null-safe text key of a source."""
    return F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source).cast("string")))


def targets(sizes: DataFrame, plans: Sequence[Knots], total: float = TOTAL, cap: float = CAP) -> DataFrame:
    """(key, source_size, target, plan) from (key, ..., source_size) with one row per source.

    Sources reach their cap in the order of cap per weight. Counting how many do gives in one step what sharing
    the excess again and again ends at. One row per source goes through one window task.
    """
    areas = [integral(p) for p in plans]
    order = Window.orderBy(F.col("name").isNull(), "name")
    ranked = (sizes.withColumn("plan", ((F.row_number().over(order) - 1) % len(plans)).cast("int"))
              .withColumn("w", F.element_at(F.array(*[F.lit(float(a)) for a in areas]), F.col("plan") + 1)))
    by_cap = Window.orderBy(cap * F.col("source_size") / F.col("w"), "key")
    everything = Window.partitionBy(F.lit(0))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    filled = ranked.select(
        "*", (F.sum("source_size").over(everything) * F.lit(total)).alias("ask"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("full_size"),
        F.sum("w").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("w_left"))
    level = (F.col("ask") - cap * F.col("full_size")) / F.col("w_left")
    own_cap = cap * F.col("source_size")
    # The level at the first source that stays below its cap holds for all that follow.
    held = filled.select("*", F.when(level * F.col("w") < own_cap, level).alias("level"))
    final = F.first("level", ignorenulls=True).over(
        by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return held.select("key", F.col("source_size").cast("long").alias("source_size"), "plan",
                       F.when(final.isNull(), own_cap).otherwise(F.least(own_cap, final * F.col("w")))
                       .cast("double").alias("target"))


def invert(plan: Column, share: Column, plans: Sequence[Knots]) -> Column:
    """Time at which a schedule's integral reaches `share` of its whole."""
    def one(knots: Knots) -> Column:
        whole, done, out = integral(knots), 0.0, F.lit(1.0)
        pieces = []
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            area, slope = (t1 - t0) * (w0 + w1) / 2, (w1 - w0) / (t1 - t0)
            y = share * whole - F.lit(done)
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * y, F.lit(0.0)))
            at = F.lit(t0) + F.when(y <= 0, F.lit(0.0)).otherwise(2 * y / (F.lit(w0) + root))
            pieces.append((done + area, at))
            done += area
        for end, at in reversed(pieces):
            out = F.when(share * whole <= F.lit(end), at).otherwise(out)
        return out

    chosen = F.lit(None).cast("double")
    for i, knots in enumerate(plans):
        chosen = F.when(plan == i, one(knots)).otherwise(chosen)
    return chosen


def assign(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
           plans: Sequence[Knots] | None = None, total: float = TOTAL, cap: float = CAP, seed: int = 17,
           carry: bool = False) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, passes, and with `carry` its whole row.

    `passes` lists (taken, position) of every pass that takes words of the document; the pass in which the
    source reaches its target takes the leading words of its last document.
    """
    plans = list(plans or schedules())
    sized = docs.select(F.col(doc_id).cast("long").alias("doc_id"), source_key(source).alias("key"),
                        F.col(source).cast("string").alias("name"), words(F.col(text)).alias("size"),
                        F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)), 4).alias("at"),
                        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []))
    slim = sized if carry else settle(sized)
    totals = settle(slim.groupBy("key", "name").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")))
    rows = totals.agg(F.sum("n")).first()[0] or 0
    width = (1 << 60) // max(1, int(rows ** 0.5)) + 1
    placed = slim.drop("name").withColumn("bucket", F.expr(f"at div {width}L"))
    buckets = placed.groupBy("key", "bucket").agg(F.sum("size").alias("held"))
    offsets = buckets.select("key", "bucket", F.coalesce(F.sum("held").over(
        Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    goals = offsets.join(targets(totals.drop("n"), plans, total, cap), "key")
    inside = Window.partitionBy("key", "bucket").orderBy("at", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    running = placed.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = running.join(goals, ["key", "bucket"])
    begin, goal = F.col("start") + F.col("before"), F.round("target").cast("long")

    def piece(p: int) -> Column:
        low = begin + p * F.col("source_size")
        took = F.greatest(F.lit(0), F.least(F.col("size"), goal - low))
        share = (low + took / 2) / F.col("target")
        return F.when(took > 0, F.struct(took.cast("long").alias("taken"),
                                         invert(F.col("plan"), share, plans).alias("position")))

    passes = F.filter(F.array(*[piece(p) for p in range(-int(-cap // 1))]), lambda x: x.isNotNull())
    return joined.withColumn("passes", passes).select(
        "doc_id", "size", "source_size", "target",
        F.aggregate("passes", F.lit(0).cast("long"), lambda a, x: a + x["taken"]).alias("taken"), "passes",
        *(["row"] if carry else []))


def mixture(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The documents in training order with their own columns, repeated as often as the mixture takes them.

    A document is repeated whole in each pass that takes more than half of its words, so that a source's
    words stay near its target and no text is cut.
    """
    whole = F.filter("passes", lambda x: 2 * x["taken"] > F.col("size"))
    position = free_name(docs.columns, "position")
    taken = (assign(docs, doc_id, text, source, carry=True, **how).select("row", F.explode(whole).alias("pass"))
             .select("row.*", F.col("pass.position").alias(position)))
    return taken.repartitionByRange(position).sortWithinPartitions(position).drop(position)


def query(docs: DataFrame) -> DataFrame:
    """Digest of the mixture, in training order; documents that are not taken come last."""
    rows = assign(docs)
    out = rows.select("doc_id", "size", "source_size", "target", "taken", F.size("passes").alias("passes"),
                      F.get("passes", F.lit(0))["position"].alias("position"))
    order = [F.col("position").asc_nulls_last(), F.col("doc_id").asc()]  # the many without a position spread by id
    return out.repartitionByRange(*order).sortWithinPartitions(*order)
