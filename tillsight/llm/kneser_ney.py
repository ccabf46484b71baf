"""Quality classifier: an interpolated modified Kneser-Ney model of byte n-grams, trained on trusted text.

One pass over all documents counts the n-grams of each language: how often trusted training text has them,
and, with count 0, which others the corpus holds. The orders below take continuation counts, each from the
distinct n-grams of the order above. Discounts, context totals and probabilities come from grouped counts and
joins keyed by n-gram, so every shard of the key space is worked on alone. That gives the surprise of each
n-gram of the corpus, 2-log, by language.

Documents are then dealt into blocks, compressed, by one shuffle. Each block asks the shards for its distinct
n-grams once, gets their surprises back, and adds them up per document. A document's score is its mean surprise
in bits per byte; a few bytes at the language's mean are added, so that short texts are not judged on noise.
Trusted documents kept out of training give a low and a high quantile per language; scores outside are rejected. A
language with few trusted texts takes its quantiles from all of them, each scored by a model that has not seen it. A
language with hardly any is judged by a pooled model of all trusted texts and by its quantiles.

Trusted are documents that the labels call good and none calls toxic (all their rows, if several). The folds, of
which the first is kept out of training, follow a hash of the id.

Defined cases: a null or empty text has no bytes, the score of its language's mean, and stays; a null language
is a language of its own; without any trusted text nothing is rejected; repeated rows are scored alike;
null ids have no label; empty tables give empty results; extra columns of both tables are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, settle, slices

ORDER = 4  # bytes of the longest n-gram; 7 at most
LOW, HIGH = 0.0, 0.995  # quantiles of the calibration texts between which a score passes; 0: no lower bound
PRIOR_BYTES = 64  # bytes at the language's mean that are added to each text
CALIBRATE = 5  # folds of the trusted documents; the first is kept for the quantiles
FEW = 1000  # a model with fewer trusted texts takes its quantiles from all folds, not from the first alone
OWN = 20  # a language with fewer trusted texts is judged by the pooled model
POOL = "p"  # key of the pooled model; no language has it
BLOCK_BYTES = 16 << 20  # text of a block
SHARDS = 64  # shards per 64 blocks or fewer
SMALL_LABELS = 2_000_000  # up to so many trusted ids (32 MB) are broadcast; beyond, labels and texts are joined
CHUNK = 4 << 20  # bytes a task works on at once

ASKS = "shard int, block int, lang string, grams binary"
ANSWERS = "block int, lang string, grams binary, bits binary"
SCORES = "doc_id long, mark long, lang string, n_bytes long, total double"


def language_key(lang: str) -> Column:
    """Null-safe text key of a language."""
    return F.when(F.col(lang).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(lang).cast("string")))


def mark_of(lang: str, text: str) -> Column:
    return F.xxhash64(language_key(lang), F.coalesce(F.col(text).cast("string"), F.lit("")))


def grams_of(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams as numbers, bytes of each text): one n-gram ends at every byte; zero bytes stand before a text."""
    pad = bytes(order - 1)
    sizes = np.array([len(t) for t in texts], np.int64)
    raw = np.frombuffer(pad + pad.join(texts) + pad, np.uint8)
    kind = np.uint32 if order <= 4 else np.uint64
    out = np.zeros(max(0, len(raw) - order + 1), kind)
    for i in range(order):
        out = (out << kind(8)) | raw[i:i + len(out)]
    begin = np.cumsum(sizes + order - 1) - (sizes + order - 1)
    keep = np.ones(len(out), bool)
    for gap in range(order - 1):  # n-grams that would reach from one text into the next
        at = begin + sizes + gap
        keep[at[at < len(out)]] = False
    return out[keep], sizes


class Counter:
    """Counts of n-grams of one language; merges what it was given once that is much."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, grams: np.ndarray, weight: int) -> None:
        found, n = np.unique(grams, return_counts=True)
        self.parts.append((found, n * weight))
        self.held += len(found)
        if self.held > 2_000_000 and len(self.parts) > 1:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.parts) > 1:
            grams, n = (np.concatenate(x) for x in zip(*self.parts))
            order = np.argsort(grams, kind="stable")
            grams, n = grams[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
            self.parts = [(grams[first], np.add.reduceat(n, first))]
            self.held = len(first)
        return self.parts[0]


def count_grams(flagged: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, c) from (lang, text, train): c counts training text; other text gives 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, counter in held.items():
                grams, n = counter.merge()
                for a in range(0, len(grams), 1 << 16):
                    part = grams[a:a + (1 << 16)].astype(np.int64)
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.array([lang] * len(part), pa.string()), "gram": pa.array(part),
                        "c": pa.array(n[a:a + (1 << 16)].astype(np.int64))})
            held.clear()

        for batch in slices(batches, "text", CHUNK):
            kinds: dict[tuple[str, bool], list[bytes]] = {}
            for lang, text, train in zip(batch.column("lang").to_pylist(), batch.column("text"),
                                         batch.column("train").to_pylist()):
                kinds.setdefault((lang, train), []).append(text.as_buffer().to_pybytes())
            for (lang, train), texts in kinds.items():
                grams, _ = grams_of(texts, order)
                if len(grams):
                    held.setdefault(lang, Counter()).add(grams, int(train))
            if sum(c.held for c in held.values()) > 8_000_000:  # bounds the memory; the groups sum up again
                yield from out()
        yield from out()

    return (flagged.select("lang", "text", "train").mapInArrow(run, "lang string, gram long, c long")
            .groupBy("lang", "gram").agg(F.sum("c").alias("c")))


def _discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3): modified Kneser-Ney discounts from how many n-grams occur once to four times."""
    n = [F.count(F.when(F.col("c") == i, 1)).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)]
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def d(i: int, fallback: float) -> Column:
        value = F.lit(float(i)) - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}")
        fine = (F.col(f"n{i}") > 0) & (F.col("n1") > 0) & (F.col(f"n{i + 1}") > 0)
        return F.when(fine, F.greatest(F.lit(0.05), F.least(value, F.lit(float(i))))).otherwise(F.lit(fallback))

    # Small or saturated corpora lack some of the counts; then usual values stand in.
    return counts.groupBy("lang").agg(*n).select("lang", d(1, 0.5).alias("d1"), d(2, 0.75).alias("d2"),
                                                 d(3, 0.9).alias("d3"))


def surprises(table: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, bits) of every n-gram in (lang, gram, c)."""
    seen = {order: table.where("c > 0")}
    for k in range(order - 1, 0, -1):
        mask = (1 << (8 * k)) - 1
        seen[k] = settle(seen[k + 1].groupBy("lang", F.col("gram").bitwiseAND(F.lit(mask)).alias("gram"))
                         .agg(F.count(F.lit(1)).alias("c")))
    wanted = {order: table.select("lang", "gram")}
    for k in range(order - 1, 0, -1):
        mask = (1 << (8 * k)) - 1
        wanted[k] = wanted[k + 1].select("lang", F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).distinct()
    lower = None  # (lang, gram, p) of the order below, for every n-gram that is asked for
    for k in range(1, order + 1):
        c, d = seen[k], _discounts(seen[k])
        contexts = c.groupBy("lang", F.shiftright("gram", 8).alias("context")).agg(
            F.sum("c").alias("total"), *[F.count(F.when(F.col("c") == i, 1)).alias(f"k{i}") for i in (1, 2)],
            F.count(F.when(F.col("c") > 2, 1)).alias("k3"))
        weight = (F.col("d1") * F.col("k1") + F.col("d2") * F.col("k2") + F.col("d3") * F.col("k3")) / F.col("total")
        contexts = contexts.join(d, "lang").select("lang", "context", "total", "d1", "d2", "d3", weight.alias("rest"))
        discount = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        asked = wanted[k].join(c, ["lang", "gram"], "left").withColumn("context", F.shiftright("gram", 8))
        known = asked.join(contexts, ["lang", "context"], "left")
        if lower is None:
            below = known.withColumn("below", F.lit(1 / 256))
        else:
            mask = (1 << (8 * (k - 1))) - 1
            below = (known.withColumn("tail", F.col("gram").bitwiseAND(F.lit(mask)))
                     .join(lower.select("lang", F.col("gram").alias("tail"), F.col("p").alias("below")), ["lang", "tail"]))
        own = F.greatest(F.col("c") - discount, F.lit(0.0)) / F.col("total")
        p = F.when(F.col("total").isNull(), F.col("below")).otherwise(
            F.coalesce(own, F.lit(0.0)) + F.col("rest") * F.col("below"))
        lower = settle(below.select("lang", "gram", p.alias("p")))
    return lower.select("lang", "gram", (-F.log2("p")).cast("float").alias("bits"))


def shard_of(gram, shards: int):
    """Shard of an n-gram, the same for a column and for an array."""
    if isinstance(gram, Column):
        return F.pmod(F.shiftright((gram.bitwiseAND(F.lit(0xFFFFFFFF)) * F.lit(40503)), 9), F.lit(shards)).cast("int")
    low = gram.astype(np.uint64) & np.uint64(0xFFFFFFFF)
    return ((low * np.uint64(40503)) >> np.uint64(9)) % np.uint64(shards)


def score(rows: DataFrame, bits: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, mark, lang, n_bytes, total): bits of each document. rows: (doc_id, mark, lang, text)."""
    whole = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-whole // block_bytes))
    shards = SHARDS * max(1, blocks // SHARDS)
    kind = np.uint32 if order <= 4 else np.uint64

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in slices(batches, "text", CHUNK):
            texts = [packer.compress(t.as_buffer().to_pybytes()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("block", "doc_id", "mark", "lang")), pa.array(texts, pa.binary())],
                ["block", "doc_id", "mark", "lang", "text"])

    packed = (rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
              .select("block", "doc_id", "mark", "lang", "text")
              .mapInArrow(squeeze, "block int, doc_id long, mark long, lang string, text binary"))

    def parts(table: pa.Table) -> Iterator[tuple[str, list[int], list[bytes]]]:
        """Texts of one language, some at a time."""
        open_, langs = zstandard.ZstdDecompressor(), table["lang"].to_pylist()
        texts = table["text"].combine_chunks() if table.num_rows else []
        for lang in sorted(set(langs)):
            own, held, size = [], [], 0
            for i in (i for i, x in enumerate(langs) if x == lang):
                own.append(i)
                held.append(open_.decompress(texts[i].as_py()) if texts[i].as_py() else b"")
                size += len(held[-1])
                if size > CHUNK:
                    yield lang, own, held
                    own, held, size = [], [], 0
            if own:
                yield lang, own, held

    def ask(table: pa.Table) -> pa.Table:
        distinct: dict[str, Counter] = {}
        for lang, _, texts in parts(table):
            grams, _ = grams_of(texts, order)
            if len(grams):
                distinct.setdefault(lang, Counter()).add(grams, 1)
        out = {"shard": [], "block": [], "lang": [], "grams": []}
        for lang, counter in distinct.items():
            grams = counter.merge()[0]
            at = shard_of(grams, shards)
            by = np.argsort(at, kind="stable")
            for own in np.split(by, np.flatnonzero(np.diff(at[by])) + 1):
                values = (int(at[own[0]]), table["block"][0].as_py(), lang, grams[own].astype(kind).tobytes())
                for column, value in zip(out.values(), values):
                    column.append(value)
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), (
            pa.int32(), pa.int32(), pa.string(), pa.binary()))})

    def answer(asks: pa.Table, known: pa.Table) -> pa.Table:
        tables = {}
        langs = np.array(known["lang"].to_pylist(), object)
        grams, values = known["gram"].to_numpy(), known["bits"].to_numpy()
        for lang in set(langs):
            own = np.flatnonzero(langs == lang)
            own = own[np.argsort(grams[own])]
            tables[lang] = grams[own].astype(kind), values[own].astype(np.float32)
        out = []
        for lang, wanted in zip(asks["lang"].to_pylist(), asks["grams"].to_pylist()):
            keys, bits_ = tables[lang]
            out.append(bits_[np.searchsorted(keys, np.frombuffer(wanted, kind))].tobytes())
        return pa.table([asks["block"], asks["lang"], asks["grams"], pa.array(out, pa.binary())],
                        names=["block", "lang", "grams", "bits"])

    def total(table: pa.Table, answers: pa.Table) -> pa.Table:
        found: dict[str, list] = {}
        for lang, g, b in zip(*(answers[c].to_pylist() for c in ("lang", "grams", "bits"))):
            found.setdefault(lang, []).append((np.frombuffer(g, kind), np.frombuffer(b, np.float32)))
        tables = {}
        for lang, arrays in found.items():
            g, b = (np.concatenate(x) for x in zip(*arrays))
            by = np.argsort(g)
            tables[lang] = g[by], b[by].astype(np.float64)
        n, sums = np.zeros(table.num_rows, np.int64), np.zeros(table.num_rows)
        for lang, own, texts in parts(table):
            grams, sizes = grams_of(texts, order)
            n[own] = sizes
            if len(grams):
                keys, bits_ = tables[lang]
                run = np.concatenate([[0.0], np.cumsum(bits_[np.searchsorted(keys, grams)])])
                ends = np.cumsum(sizes)
                sums[own] = run[ends] - run[ends - sizes]
        return pa.table([table["doc_id"], table["mark"], table["lang"], pa.array(n), pa.array(sums)],
                        names=["doc_id", "mark", "lang", "n_bytes", "total"])

    asks = packed.groupBy("block").applyInArrow(ask, ASKS)
    known = bits.withColumn("shard", shard_of(F.col("gram"), shards))
    answers = asks.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(answer, ANSWERS)
    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(total, SCORES)


def trusted_ids(labels: DataFrame, doc_id: str = "doc_id", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """(doc_id, fold, train): ids that every label calls good and none toxic; all folds but the first train."""
    harm = F.coalesce(F.col(toxic).cast("int"), F.lit(0)) if toxic in labels.columns else F.lit(0)
    rows = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(quality).alias("q"), harm.alias("harm"))
    good = (rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("q").alias("q"), F.max("harm").alias("harm"))
            .where("q = 1 AND harm = 0"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATE)).cast("int")
    return good.select("doc_id", fold.alias("fold"), (fold != 0).alias("train"))


def apart(known: DataFrame, own: DataFrame, sizes: list[tuple[str, int]]) -> DataFrame | None:
    """(doc_id, mark, lang, text, train, held) of trusted rows under the keys of further models, or None.

    The pooled model needs the trusted rows of languages that have their own; a model with few trusted texts needs
    one more model per further fold, under a key of its own. `held` rows give scores for the quantiles.
    known: rows with `fold` and, in `lang`, the key of the model that judges them; sizes: trusted texts per key.
    """
    counts = dict(sizes)
    pooled = POOL in counts
    parts, columns = [], ("doc_id", "mark", "lang", "text", "train", "held")
    trusted = known.where(F.col("fold").isNotNull() & (F.octet_length("text") > 0))
    everything = trusted.withColumn("lang", F.lit(POOL))
    if pooled:
        parts.append(everything.where(known["lang"] != POOL).withColumn("train", F.col("fold") != 0)
                     .withColumn("held", F.col("fold") == 0).select(*columns))
    folds = F.explode(F.sequence(F.lit(1), F.lit(CALIBRATE - 1)))

    def crossed(rows: DataFrame) -> DataFrame:
        return (rows.withColumn("out", folds).withColumn("train", F.col("fold") != F.col("out"))
                .withColumn("held", F.col("fold") == F.col("out"))
                .withColumn("lang", F.concat(F.col("out").cast("string"), F.lit(":"), "lang")).select(*columns))

    if any(0 < n < FEW for key, n in sizes if key != POOL):
        parts.append(crossed(trusted.join(F.broadcast(own.where(F.col("trusted") < FEW).select("lang")), "lang")))
    if pooled and 0 < sum(counts.values()) < FEW:
        parts.append(crossed(everything))
    if not parts:
        return None
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             order: int = ORDER, low: float = LOW, high: float = HIGH) -> DataFrame:
    """(doc_id, mark, n_bytes, bits, low, high, kept) of each document; `mark` hashes its language and text."""
    trusted = settle(trusted_ids(labels))
    few = trusted.select("doc_id", "fold")
    few = F.broadcast(few) if few.count() <= SMALL_LABELS else few
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), mark_of(lang, text).alias("mark"),
                       language_key(lang).alias("lang"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    own = settle(rows.select("doc_id", "lang", F.octet_length("text").alias("n")).join(few, "doc_id", "left")
                 .groupBy("lang").agg(F.count(F.when(F.col("fold").isNotNull() & (F.col("n") > 0), 1)).alias("trusted")))
    # Per model: the trusted texts of a language, or under POOL those of all languages that have too few.
    key = F.when(F.col("trusted") >= OWN, F.col("lang")).otherwise(F.lit(POOL))
    sizes = [tuple(r) for r in own.groupBy(key.alias("key")).agg(F.sum("trusted")).collect()]
    own = own.where(F.col("trusted") >= OWN)
    rows = (rows.join(F.broadcast(own.select("lang", F.col("lang").alias("key"))), "lang", "left")
            .select("doc_id", "mark", F.coalesce("key", F.lit(POOL)).alias("lang"), "text"))
    known = rows.join(few, "doc_id", "left")
    further = apart(known, own, sizes)
    flagged = known.withColumn("train", F.coalesce(F.col("fold") != 0, F.lit(False))).select("lang", "text", "train")
    if further is not None:
        further = settle(further)
        flagged = flagged.unionByName(further.select("lang", "text", "train"))
    bits = settle(surprises(settle(count_grams(flagged, order)), order))
    keys = F.col("lang").rlike("^[0-9]:") | (F.col("lang") == POOL)
    scored = settle(score(rows, bits, order))
    calibration = scored.join(trusted.where("NOT train"), "doc_id", "left_semi").where("n_bytes > 0")
    if further is not None:
        held = further.where("held").select("doc_id", "mark", "lang", "text")
        calibration = settle(calibration.unionByName(score(held, bits.where(keys), order).withColumn(
            "lang", F.regexp_replace("lang", "^[0-9]:", ""))))
    means = calibration.groupBy("lang").agg((F.sum("total") / F.sum("n_bytes")).alias("mean"))
    smooth = (F.col("total") + PRIOR_BYTES * F.coalesce(F.col("mean"), F.lit(0.0))) / F.greatest(
        F.lit(1), F.col("n_bytes") + F.when(F.col("mean").isNull(), 0).otherwise(PRIOR_BYTES))
    # Scores in steps of 1/1024 bit: few distinct values, whose running counts give exact quantiles of them.
    step = F.floor(smooth * 1024)
    steps = calibration.join(means, "lang").groupBy("lang", step.alias("step")).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("step"))
    every = F.sum("n").over(Window.partitionBy("lang"))
    bounds = steps.select("lang", "step", upto.alias("upto"), every.alias("every")).groupBy("lang").agg(
        F.min(F.when(F.col("upto") >= low * F.col("every"), F.col("step"))).alias("low"),
        F.min(F.when(F.col("upto") >= high * F.col("every"), F.col("step"))).alias("high"))
    # One row per language, met in one join instead of two.
    known = means.join(bounds, "lang")
    judged = scored.join(known, "lang", "left").withColumn("step", step)
    above = F.lit(True) if low <= 0 else F.col("step") >= F.col("low")
    kept = F.col("high").isNull() | (above & (F.col("step") <= F.col("high")))
    return judged.select("doc_id", "mark", "n_bytes", smooth.alias("bits"), (F.col("low") / 1024).alias("low"),
                         ((F.col("high") + 1) / 1024).alias("high"), kept.alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
              **how) -> DataFrame:
    """The documents that pass, with their own columns. Rejected rows are found again by id and a hash of
    language and text; rows equal in these are judged alike."""
    lost_id, lost = free_name(docs.columns, "lost_id"), free_name(docs.columns, "lost_mark")
    bad = classify(docs, labels, doc_id, text, lang, **how).where("NOT kept").select(
        F.col("doc_id").alias(lost_id), F.col("mark").alias(lost))
    same = F.col(doc_id).cast("long").eqNullSafe(F.col(lost_id)) & (mark_of(lang, text) == F.col(lost))
    return docs.join(bad, same, "left_anti")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return classify(docs, labels).select("doc_id", "n_bytes", F.round("bits", 6).alias("bits_per_byte"),
                                         F.round(F.pow(F.lit(2.0), "bits"), 6).alias("perplexity"), "low", "high", "kept")
