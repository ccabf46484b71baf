"""Personal data: candidate spans scored by gradient-boosted trees, in DataFrame functions alone.

Sure spans come from four fixed rules (email, ip, card, phone) and always stay. Beside them generators of high recall
propose spans that may overlap: addresses with `(at)` and `[dot]`, digit groups with any usual separators, defanged
internet addresses. Each candidate becomes a row of small integers about its format (digits, longest run, separators,
checksum, brackets) and its context (neighbouring characters, cue words before it), none of which is the sure rule
itself. A candidate that overlaps a sure span of its kind is a positive example, any other a negative one. Since the
features are coarse, all examples of a corpus fit a table of distinct feature rows with two counts; boosting runs
on that table, each tree level being one grouped sum of gradients and hessians, of which the driver sees a row per node,
feature and value. A tree is a nested CASE, so scoring is part of the plan's generated code.

Scores are log odds; per kind they are shifted so that their mean probability is the share of positives among the
candidates held out from training, and a candidate is accepted from `PRECISION` on. A kind with fewer than `LEAST`
held-out positives adds nothing. Accepted candidates that overlap no sure span are added. Everything is fitted on all
candidates of the whole table. Texts never leave their task: what a text holds is written down as the matches and the
distances between them, and places are running sums of these, so a text with very many matches costs no more for each.

The sure rules are run so that no text is slow or deep: separators are first replaced, one for one, by characters that
make each rule a run of one character class, and rules start only where a run starts (or a match ended).

Defined cases: a null text is empty; rows are documents of their own whatever their ids, null ids too; places are code
points; an empty table gives an empty result, extra columns are never read.
"""

from __future__ import annotations

from functools import reduce
from math import exp, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

KINDS = ("email", "ip", "card", "phone")
# Stand-ins of one code point: a separator between digits, a dot before a label. Where texts hold them, they become `?`.
JOIN, DOT = "\ue000", "\ue002"

LOCAL, LABEL = rf"A-Za-z0-9._%+{DOT}\-", r"A-Za-z0-9\-"
SURE = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[{LABEL}]++{DOT}[{LABEL}{DOT}]*+",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": rf"[0-9][0-9{JOIN}]{{12,}}+",
    "phone": r"\+[0-9][ ().0-9\-]+[0-9]",
}
_AT, _DOT = r"(?:@|[ ]?[(\[{][ ]?[aA][tT][ ]?[)\]}][ ]?)", r"(?:\.|[ ]?[(\[{][ ]?[dD][oO][tT][ ]?[)\]}][ ]?)"
LOOSE = {
    "email": rf"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]{{1,64}}{_AT}[{LABEL}]{{1,63}}(?:{_DOT}[{LABEL}]{{1,63}}){{1,6}}",
    "ip": r"(?<![0-9])[0-9]{1,3}(?:(?:\.|\[\.\]|\(\.\)|[ ]\.[ ])[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ .\-]{0,2}[0-9]){12,18}(?![0-9])",
    "phone": r"(?:\+[ ]?)?\(?(?<![0-9])[0-9](?:[ ()./\-]{0,3}[0-9]){8,14}(?![0-9])",
}
# Words before a span that speak for a kind, and words that speak against any.
CUES = {1: r"(?i)(tel|phone|call|mobile|cell|fax|whatsapp)\W*(no|nr|number)?\W*$",
        2: r"(?i)(card|visa|credit|debit|mastercard|amex)\W*(no|nr|number)?\W*$",
        3: r"(?i)(ip|host|server|addr|address)\W*$",
        4: r"(?i)(mail|e-mail|contact|write to)\W*$",
        5: r"(?i)(isbn|issn|doi|order|invoice|version|id|sku|part|page|total|figure)\W*(no|nr|number)?\W*$"}
FEATURES = ("kind", "digits", "run", "marks", "luhn", "lead", "free", "cue", "shape", "hidden", "even")

TREES, DEPTH, RATE, SMOOTH = 12, 2, 0.5, 1.0
FOLDS = 5  # one of them is held out to set the thresholds
STEPS = 8  # parts of a unit of the score that the held-out candidates are counted by
PRECISION, LEAST = 0.95, 30


def only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the checksum of a digit text holds."""
    def doubled(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    total = F.aggregate(F.transform(F.split(F.reverse(digits), ""), doubled), F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0)))
    return total % 10 == 0


def _sure_enough(kind: str, hit: Column) -> Column:
    """What a rule asks beyond its pattern."""
    digits = only_digits(hit)
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3)
                        & (F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _pieces(rule: str, text: Column, pattern: str, wanted: Column) -> list[Column]:
    """What lies between the matches of a pattern, and the matches."""
    none = F.array().cast("array<string>")
    return [F.when(wanted, F.split(text, pattern, -1)).otherwise(none).alias(f"{rule}_gaps"),
            F.when(wanted, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none).alias(f"{rule}_hits")]


def _matches(number: int, gaps: Column, hits: Column) -> Column:
    """Matches in their order, each with the distance to the one before and some text around it."""
    parts = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), F.slice(gaps, 2, F.greatest(F.size(gaps), F.lit(1))).alias("next"))
    # The last piece has no match behind it.
    return F.transform(F.filter(parts, lambda p: p["hit"].isNotNull()), lambda p: F.struct(
        F.lit(number).alias("rule"), F.length(p["gap"]).alias("gap"), F.length(p["hit"]).alias("size"), p["hit"].alias("hit"),
        F.right(p["gap"], F.lit(24)).alias("before"), F.left(p["next"], F.lit(1)).alias("after")))


def _steps(value: Column, *bounds: int) -> Column:
    """How many of the bounds a number reaches: a small integer in its order."""
    return reduce(lambda a, b: a + b, [(value >= b).cast("int") for b in bounds])


def features(s) -> dict[str, Column]:
    """A candidate's format and context as small integers."""
    hit, digits = s["hit"], only_digits(s["hit"])
    longest = F.array_max(F.transform(F.split(hit, "[^0-9]+"), lambda p: F.length(p)))
    marks = F.size(F.array_distinct(F.split(F.regexp_replace(hit, "[A-Za-z0-9]", ""), "(?!^)")))
    word = r"[\p{L}\p{N}_]"
    cue = F.lit(0)
    for number, pattern in CUES.items():
        cue = F.when(s["before"].rlike(pattern), number).otherwise(cue)
    parts = F.split(hit, r"[^0-9]+")
    quad = F.size(parts) == 4
    small = F.forall(parts, lambda p: F.coalesce(p.try_cast("int"), F.lit(999)) <= 255)
    named = hit.rlike(r"[A-Za-z]{2,}$")
    return {
        "kind": s["kind"], "digits": _steps(F.length(digits), 1, 9, 10, 11, 12, 13, 16, 17, 20),
        "run": _steps(longest, 1, 3, 4, 5, 9, 13, 16), "marks": F.least(marks, F.lit(5)),
        "luhn": F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False).cast("int"),
        "lead": hit.rlike(r"^[+(]").cast("int"),
        "free": (~F.right(s["before"], F.lit(1)).rlike(word)).cast("int") + (~s["after"].rlike(word)).cast("int"),
        "cue": cue, "shape": F.when(s["kind"] == 0, named).otherwise(quad & small).cast("int"),
        "hidden": hit.rlike(r"[(\[{]").cast("int"),
        "even": (F.size(F.array_distinct(F.split(digits, "(?!^)"))) <= 2).cast("int")}


def matched(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """(doc_no, id_of_doc, matches), and the `whole` row where asked: what rules and generators match. Settle it."""
    kept = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")] if whole else []
    plain = docs.select(*kept, F.monotonically_increasing_id().alias("doc_no"), F.col(f"`{doc_id}`").cast("long").alias("id_of_doc"),
                        F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), JOIN + DOT, "??").alias("plain_text"))
    t = F.col("plain_text")
    digit, at = t.rlike("[0-9]"), t.contains("@")
    ready = plain.select("*", digit.alias("has_digit"), at.alias("has_at"),
                         F.when(digit, F.regexp_replace(t, "(?<=[0-9])[ \\-](?=[0-9])", JOIN)).otherwise("").alias("joined_text"),
                         F.when(at, F.regexp_replace(t, f"\\.(?=[{LABEL}])", DOT)).otherwise("").alias("dotted_text"))
    source = {"email": F.col("dotted_text"), "ip": t, "card": F.col("joined_text"), "phone": t}
    dots = F.col("has_digit") & t.contains(".")
    wanted = {"email": F.col("has_at"), "ip": dots, "card": F.col("has_digit"), "phone": F.col("has_digit") & t.contains("+")}
    loosely = wanted | {"email": F.col("has_at") | t.rlike(r"[(\[{] ?[aA][tT] ?[)\]}]"), "phone": F.col("has_digit")}
    carried = ["whole"] if whole else []
    cut = ready.select(*carried, "doc_no", "id_of_doc", *[c for k in KINDS for c in [
        *_pieces(k, source[k], SURE[k], wanted[k]), *_pieces(f"loose_{k}", t, LOOSE[k], loosely[k])]])
    rules = [*KINDS, *[f"loose_{k}" for k in KINDS]]
    every = F.concat(*[_matches(n, F.col(f"{r}_gaps"), F.col(f"{r}_hits")) for n, r in enumerate(rules)])
    return cut.select(*carried, "doc_no", "id_of_doc", every.alias("matches"))


def spans(found: DataFrame) -> DataFrame:
    """(doc_no, kind, sure, start, end, features, label) of every sure span and every candidate."""
    rows = found.select("doc_no", "id_of_doc", F.posexplode("matches").alias("pos", "m")).select("doc_no", "id_of_doc", "pos", "m.*")
    far = Window.partitionBy("doc_no", "rule").orderBy("pos")
    end = F.sum(F.col("gap") + F.col("size")).over(far).cast("int")
    placed = rows.withColumn("end", end).select(
        "doc_no", "id_of_doc", (F.col("rule") % len(KINDS)).alias("kind"), (F.col("rule") < len(KINDS)).alias("sure"),
        (F.col("end") - F.col("size")).alias("start"), "end", "hit", "before", "after")
    case = F.lit(False)
    for n, k in enumerate(KINDS):
        case = F.when(F.col("kind") == n, _sure_enough(k, F.col("hit"))).otherwise(case)
    held = placed.where(~F.col("sure") | case)
    # Sure spans of a kind do not overlap: only the last one that starts before, or the next one, can meet a candidate.
    known, begun = F.when(F.col("sure"), F.col("end")), F.when(F.col("sure"), F.col("start"))
    before = Window.orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # Backwards from the end: a frame that grows is summed as it goes, one that shrinks would be summed anew per row.
    after = Window.orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, Window.currentRow)

    def meets(*by: str) -> Column:
        last, following = F.max(known).over(before.partitionBy(*by)), F.min(begun).over(after.partitionBy(*by))
        return F.coalesce(last > F.col("start"), F.lit(False)) | F.coalesce(following < F.col("end"), F.lit(False))

    # The rules of email, ip and phone insist on marks that these candidates have in another form.
    other = ((F.col("kind") == 0) & ~F.col("hit").contains("@")) | ((F.col("kind") == 1) & F.col("hit").rlike("[^0-9.]")) | (
        (F.col("kind") == 3) & ~F.col("hit").startswith("+") & (F.col("hit").startswith("(") | F.col("before").rlike(CUES[1])))
    own = meets("doc_no", "kind")
    marked = held.withColumn("label", F.when(own | ~other, own)).withColumn("covered", meets("doc_no"))
    fold = F.pmod(F.xxhash64(F.lit("fold"), "id_of_doc"), F.lit(FOLDS)).cast("int").alias("fold")
    return marked.select("doc_no", fold, "kind", "sure", "start", "end", "label", "covered", *[
        F.when(~F.col("sure"), v).alias(f"f_{f}") for f, v in features({c: F.col(c) for c in ("kind", "hit", "before", "after")}).items()])


# --- boosting --------------------------------------------------------------------------------

Tree = tuple  # (feature, bound, tree where the value is at most the bound, tree where it is more), or (leaf value,)


def tree_value(tree: Tree, value) -> Column:
    """A tree as nested conditions; `value` gives a feature's column."""
    if len(tree) == 1:
        return F.lit(tree[0])
    feature, bound, low, high = tree
    return F.when(value(feature) <= bound, tree_value(low, value)).otherwise(tree_value(high, value))


def score(trees: list[Tree], start: float, value) -> Column:
    return reduce(lambda a, b: a + b, [tree_value(t, value) for t in trees], F.lit(start))


def table(rows: DataFrame) -> DataFrame:
    """Distinct feature rows of all examples, by fold, with the number of examples and of positive ones."""
    seen = rows.where("NOT sure AND label IS NOT NULL").select("fold", *[F.col(f"f_{f}").alias(f) for f in FEATURES], "label")
    return seen.groupBy("fold", *FEATURES).agg(F.count(F.lit(1)).alias("n"), F.count_if("label").alias("pos"))


def grow_tree(cells: DataFrame, margin: Column) -> Tree:
    """One regression tree on the log loss, level by level."""
    p = 1 / (1 + F.exp(-margin))
    graded = cells.select(*FEATURES, (F.col("pos") - F.col("n") * p).alias("g"), (F.col("n") * p * (1 - p)).alias("h"))
    leaves: dict[int, list[tuple[str, int, bool]]] = {0: []}  # node to the conditions that lead to it
    splits: dict[int, tuple[str, int]] = {}
    totals: dict[int, tuple[float, float]] = {}
    for _ in range(DEPTH):
        node = F.lit(None).cast("int")
        for n, way in leaves.items():
            here = reduce(lambda a, b: a & b, [(F.col(f) <= b) if low else (F.col(f) > b) for f, b, low in way], F.lit(True))
            node = F.when(here, n).otherwise(node)
        values = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("v")) for f in FEATURES]))
        # A row per node, feature and value: some hundred, whatever the corpus.
        sums = graded.select(node.alias("node"), "g", "h", values.alias("c")).where("node IS NOT NULL").groupBy(
            "node", "c.f", "c.v").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
        ways, leaves = leaves, {}
        for n, way in ways.items():
            own = [r for r in sums if r["node"] == n]
            g, h = totals[n] = tuple(sum(r[c] for r in own if r["f"] == FEATURES[0]) for c in ("g", "h"))
            best = (1e-6,)
            for f in FEATURES:
                low_g = low_h = 0.0
                for r in sorted((r for r in own if r["f"] == f), key=lambda r: r["v"])[:-1]:
                    low_g, low_h = low_g + r["g"], low_h + r["h"]
                    gain = sum(a * a / (b + SMOOTH) for a, b in ((low_g, low_h), (g - low_g, h - low_h))) - g * g / (h + SMOOTH)
                    if gain > best[0]:
                        best = gain, (f, r["v"]), (low_g, low_h), (g - low_g, h - low_h)
            if len(best) > 1:
                f, b = splits[n] = best[1]
                leaves |= {2 * n + 1: [*way, (f, b, True)], 2 * n + 2: [*way, (f, b, False)]}
                totals |= {2 * n + 1: best[2], 2 * n + 2: best[3]}
        if not leaves:
            break

    def build(n: int) -> Tree:
        if n in splits:
            return (*splits[n], build(2 * n + 1), build(2 * n + 2))
        g, h = totals[n]
        return (RATE * g / (h + SMOOTH),)

    return build(0)


def fit(cells: DataFrame) -> tuple[list[Tree], float, dict[int, float]]:
    """(trees, start, lowest accepted score by kind) from the settled table of `table`."""
    training = cells.where(F.col("fold") > 0)
    n, pos = training.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("pos"), F.lit(0))).first()
    start = 0.0
    trees: list[Tree] = []
    if 0 < pos < n:
        for _ in range(TREES):
            trees.append(grow_tree(training, score(trees, start, F.col)))
    # A row per kind and step of the score.
    held = cells.where("fold = 0").select("kind", F.round(score(trees, start, F.col) * STEPS).cast("long").alias("at"), "n", "pos").groupBy(
        "kind", "at").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).collect()
    bounds = {}
    for kind in range(len(KINDS)):
        own = [(r["at"] / STEPS, r["n"], r["pos"]) for r in held if r["kind"] == kind]
        n, pos = sum(r[1] for r in own), sum(r[2] for r in own)
        if pos >= LEAST:
            bounds[kind] = log(PRECISION / (1 - PRECISION)) - shift(own, n * (pos + 1) / (n + 2))
    return trees, start, bounds


def shift(scores: list[tuple[float, int, int]], want: float) -> float:
    """What to add to all scores so that their probabilities add up to the positives wanted."""
    low, high = -50.0, 50.0
    for _ in range(60):
        middle = (low + high) / 2
        if sum(n / (1 + exp(-s - middle)) for s, n, _ in scores) < want:
            low = middle
        else:
            high = middle
    return low


def selected(rows: DataFrame) -> DataFrame:
    """(doc_no, kind, start, end, sure) of the sure spans and the accepted candidates. `rows` is settled."""
    trees, start, bounds = fit(settle(table(rows)))
    bound = F.lit(None).cast("double")
    for kind, least in bounds.items():
        bound = F.when(F.col("kind") == kind, F.lit(least)).otherwise(bound)
    accepted = F.coalesce(score(trees, start, lambda f: F.col(f"f_{f}")) >= bound, F.lit(False))
    return rows.where(F.col("sure") | (accepted & ~F.col("covered"))).select("doc_no", "kind", "start", "end", "sure")


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Every row as (doc_no, id_of_doc), and its spans as (doc_no, kind, start, end, sure)."""
    found = settle(matched(docs, doc_id, text))
    return found.select("doc_no", "id_of_doc"), selected(settle(spans(found)))


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, each span, or each group of overlapping ones, replaced by its first kind in brackets."""
    found = settle(matched(docs, doc_id, text, whole=True))
    rows = selected(settle(spans(found.select("doc_no", "id_of_doc", "matches"))))
    order = Window.partitionBy("doc_no").orderBy("start", F.desc("end"), "kind")
    fresh = F.col("start") >= F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = rows.withColumn("fresh", fresh.cast("int")).withColumn("number", F.sum("fresh").over(order))
    merged = groups.groupBy("doc_no", "number").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by(
        "kind", F.struct("start", "kind")).alias("kind"))
    listed = merged.groupBy("doc_no").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("masks"))
    names, t, masks = F.array(*[F.lit(f"[{k}]") for k in KINDS]), F.col(f"whole.`{text}`"), F.col("masks")

    def part(s: Column, i: Column) -> Column:
        from_ = F.when(i > 0, F.get(masks, i - 1)["end"]).otherwise(0)
        return F.concat(F.substring(t, from_ + 1, s["start"] - from_), F.get(names, s["kind"]))

    tail = F.substring(t, F.get(masks, F.size(masks) - 1)["end"] + 1, F.length(t))
    out = F.when(masks.isNull(), t).otherwise(F.concat(F.array_join(F.transform(masks, part), ""), tail))
    return found.join(listed, "doc_no", "left").select(
        *[out.alias(c) if c == text else F.col(f"whole.`{c}`").alias(c) for c in docs.columns])


def query(docs: DataFrame) -> DataFrame:
    """Counts and digest of the sure spans, and all spans, of every document."""
    rows, found = find(docs)
    name = F.get(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    span = F.concat_ws(":", name, F.col("start").cast("string"), F.col("end").cast("string"))
    listed = found.groupBy("doc_no").agg(
        *[F.count_if(F.col("sure") & (F.col("kind") == n)).alias(f"n_{k}") for n, k in enumerate(KINDS)],
        F.array_sort(F.collect_list(F.struct("kind", "start", "end", "sure", span.alias("span")))).alias("every"))
    every = F.coalesce("every", F.array().cast("array<struct<kind: int, start: int, end: int, sure: boolean, span: string>>"))
    sure = F.array_join(F.filter(every, lambda s: s["sure"])["span"], ",")
    return rows.join(listed, "doc_no", "left").select(
        F.col("id_of_doc").alias("doc_id"), *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(sure.cast("binary"), 256).alias("base_sha256"), F.array_join(every["span"], ",").alias("spans"))
