"""A Merkle tree over every document of a dataset, with a proof per document.

Every row is a leaf. Leaves of a source stand in the order of their ids; consecutive nodes form runs of `arity`, and
a run's digest is a node of the next level, until one node is left: the source's subroot. The subroots, in the order
of the sources, are the leaves of the tree above, whose root stands for the dataset.

Levels are self-joins by sibling index. The node in slot 0 of a run computes the indices of its siblings (its own plus
0 to arity - 1), an equijoin fetches their digests, and the row of slot 0 emits the parent. Paths go the other way:
the members of a run share everything above it, so what lies above is handed down run by run, and a document meets it
in one join with its run. No level holds rows that a document does not need, and the levels shrink by `arity`.

Positions come from one range shuffle by source and id, the number of rows in the parts before, and the row's place
in its part. A source of any size spreads over as many parts as it fills; no window numbers it in one task.

Defined cases: a null value counts as `-` and an empty one as `0:`; a null source is the first source, a null id the
first of its source and never tampered with; rows of one source and id stand in the order of their leaves, so equal
rows are leaves of their own; a source of one document has its leaf as subroot; a dataset of one source has the
subroot as root; an empty table gives an empty result; extra columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PART_BITS = 33  # monotonically_increasing_id holds the part above these bits and the place in it below
SMALL = 1_000_000  # parts and sources (some 60 MB) up to which their table is broadcast; beyond, it is joined
CAPITALS, SMALLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def as_text(digests: Column) -> Column:
    """Digests of an array as one lowercase hex text."""
    return F.lower(F.array_join(F.transform(digests, F.hex), ""))


def leaf(values: list[Column]) -> Column:
    """Digest of a row: each value with its size in bytes before it, so that no two rows read alike."""
    texts = [v.cast("string") for v in values]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]))


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The rows with (tree, i, size): where their group starts in the whole order, their place in it, its rows.

    Groups are in ascending order too, null first, so `tree` is the group's name and its rank at once.
    """
    keys = [F.col(c).asc_nulls_first() for c in [group, *order]]
    dealt = settle(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                   .withColumn("at", F.monotonically_increasing_id()))
    part, place = F.shiftright("at", PART_BITS).alias("part"), F.col("at").bitwiseAND((1 << PART_BITS) - 1)
    heads = dealt.groupBy(part, F.col(group).alias("own")).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    # One row per part of the shuffle: their sizes before them add up in one small task.
    before = heads.groupBy("part").agg(F.sum("n").alias("rows")).select(
        "part", F.expr("sum(rows) OVER (ORDER BY part) - rows").alias("before"))
    starts = heads.join(before, "part").select(
        "part", "own", "before", F.expr("min(before + first) OVER (PARTITION BY own)").alias("tree"),
        F.expr("sum(n) OVER (PARTITION BY own)").alias("size"))
    starts = settle(starts)
    few = F.broadcast(starts) if starts.count() <= SMALL else starts
    there = (F.shiftright("at", PART_BITS) == F.col("part")) & F.col(group).eqNullSafe(F.col("own"))
    return dealt.join(few, there).select(*rows.columns, "tree", (F.col("before") + place - F.col("tree")).alias("i"), "size")


def _run(index: str, arity: int) -> Column:
    return F.expr(f"{index} div {arity}")


def gather(nodes: DataFrame, arity: int) -> DataFrame:
    """(tree, run, size, members): the digests of each run, asked for by its node in slot 0."""
    zero = nodes.where(F.col("i") % arity == 0)
    asked = zero.select("tree", "size", F.col("i").alias("zero"), F.explode(F.sequence(F.lit(0), F.lit(arity - 1))).alias("slot"))
    asked = asked.where(F.col("zero") + F.col("slot") < F.col("size")).withColumn("sibling", F.col("zero") + F.col("slot"))
    met = asked.join(nodes.select("tree", F.col("i").alias("sibling"), "digest"), ["tree", "sibling"])
    runs = met.groupBy("tree", "zero", "size").agg(F.sort_array(F.collect_list(F.struct("slot", "digest"))).alias("m"))
    return runs.select("tree", _run("zero", arity).alias("run"), "size", F.col("m.digest").alias("members"))


def grow(nodes: DataFrame, arity: int = ARITY) -> tuple[list[DataFrame], DataFrame]:
    """Runs of every level, lowest first, and (tree, digest) of the last node of each tree."""
    levels, done = [], []
    while True:
        done.append(nodes.where("size = 1").select("tree", "digest"))
        largest = nodes.agg(F.max("size")).first()[0]
        if largest is None or largest <= 1:
            break
        levels.append(settle(gather(nodes.where("size > 1"), arity)))
        nodes = levels[-1].select("tree", F.col("run").alias("i"), F.expr(f"(size + {arity - 1}) div {arity}").alias("size"),
                                  digest(as_text(F.col("members"))).alias("digest"))
    roots = done[0]
    for d in done[1:]:
        roots = roots.unionByName(d)
    return levels, settle(roots)


def around(slot: Column) -> Column:
    """The members of a run before and after one of them."""
    count = F.size("members")
    return F.struct(F.slice("members", F.lit(1), slot.cast("int")).alias("before"),
                    F.slice("members", slot.cast("int") + 2, count).alias("after"))


def hand_down(levels: list[DataFrame], above: DataFrame, arity: int = ARITY) -> DataFrame | None:
    """The lowest level's (tree, run, members, up): `up` lists the siblings on the way from the run to the very top.

    `above` holds (tree, up) of each tree's last node.
    """
    lower = None
    for runs in reversed(levels):
        last = runs.where(F.col("size") <= arity).join(above, "tree").select("tree", "run", "members", "up")
        if lower is not None:
            parent = lower.select("tree", F.col("run").alias("higher"), F.col("members").alias("m"), F.col("up").alias("u"))
            inner = runs.where(F.col("size") > arity).withColumn("higher", _run("run", arity))
            met = inner.join(parent, ["tree", "higher"]).select("tree", "run", F.col("members").alias("own"), F.col("m").alias("members"), "u")
            last = last.unionByName(met.select("tree", "run", F.col("own").alias("members"), F.concat(
                F.array(around(F.col("run") % arity)), "u").alias("up")))
        lower = settle(last)
    return lower


STEP = "array<struct<before: array<binary>, after: array<binary>>>"


def fold(start: Column, up: Column) -> Column:
    """The root that a leaf leads to beside the given siblings."""
    return F.aggregate(up, start, lambda node, s: digest(F.concat(as_text(s["before"]), F.lower(F.hex(node)), as_text(s["after"]))))


def siblings(up: Column) -> Column:
    """All siblings on the way, in order, as one text."""
    return F.array_join(F.transform(up, lambda s: F.concat(as_text(s["before"]), as_text(s["after"]))), "")


def with_paths(nodes: DataFrame, levels: list[DataFrame], above: DataFrame, arity: int) -> DataFrame:
    """The leaves with `up`, their way to the top."""
    single = nodes.where("size = 1").join(above, "tree")
    lowest = hand_down(levels, above, arity)
    if lowest is None:
        return single
    many = nodes.where("size > 1").withColumn("run", _run("i", arity)).join(lowest, ["tree", "run"])
    return single.unionByName(many.select(*nodes.columns, F.concat(F.array(around(F.col("i") % arity)), "up").alias("up")))


def manifest(leaves: DataFrame, group: str, order: list[str], arity: int = ARITY) -> DataFrame:
    """The leaves (a column `digest` among them) with `subroot`, `root` and `up`, each leaf's proof."""
    nodes = placed(leaves, group, [*order, "digest"])
    levels, subroots = grow(nodes, arity)
    tops = placed(subroots.select(F.lit(0).alias("all"), F.col("tree").alias("below"), "digest"), "all", ["below"])
    top_levels, roots = grow(tops, arity)
    root = F.lit(None).cast("binary") if (found := roots.first()) is None else F.lit(bytes(found["digest"]))
    none = tops.select("tree").distinct().select("tree", F.array().cast(STEP).alias("up"))
    above = settle(with_paths(tops, top_levels, none, arity).select(
        F.col("below").alias("tree"), F.col("digest").alias("subroot"), "up"))
    out = with_paths(nodes, levels, above.select("tree", "up"), arity)
    few = F.broadcast(above) if above.count() <= SMALL else above
    return out.join(few.select("tree", "subroot"), "tree").withColumn("root", root)


def query(docs: DataFrame) -> DataFrame:
    """Every document's digests and proof, and whether its (for some rows altered) text still leads to the root."""
    values = [F.col(c) for c in FIELDS]
    altered = [*values[:-1], F.translate(values[-1], CAPITALS, SMALLS)]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaves = docs.select("doc_id", "source", leaf(values).alias("digest"), F.when(tampered, leaf(altered)).alias("other"))
    proved = manifest(leaves, "source", ["doc_id"])
    root = F.lower(F.hex("root"))
    folded = F.lower(F.hex(fold(F.coalesce("other", "digest"), F.col("up"))))
    out = proved.select("doc_id", F.lower(F.hex("digest")).alias("leaf"), F.lower(F.hex("subroot")).alias("subroot"),
                        root.alias("root"), F.sha2(siblings(F.col("up")).cast("binary"), 256).alias("proof_sha256"),
                        folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _oracle(levels: int, top_levels: int) -> str:
    """The same by window functions, for so many levels of 16 at most."""
    def level(name: str, n: int) -> str:
        # A tree of one node stays as it is; otherwise its runs of 16 become nodes.
        return f"""{name}{n + 1} AS (
  SELECT t, i // 16 AS i, max(c) AS c0, CASE WHEN max(c) = 1 THEN 1 ELSE (max(c) + 15) // 16 END AS c,
         list(h ORDER BY i) AS m, CASE WHEN max(c) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h
  FROM {name}{n} GROUP BY t, i // 16)"""

    def climb(name: str, n: int, i: str, alias: str) -> tuple[str, str, str]:
        joins, before, after = [], [], []
        for k in range(n):
            a = f"{alias}{k}"
            joins.append(f"JOIN {name}{k + 1} {a} ON {a}.t = {i.split('.')[0]}.t AND {a}.i = {i} // {16 ** (k + 1)}")
            slot = f"({i} // {16 ** k}) % 16"
            before.append(f"CASE WHEN {a}.c0 = 1 THEN '' ELSE array_to_string({a}.m[1:{slot}], '') END")
            after.append(f"CASE WHEN {a}.c0 = 1 THEN '' ELSE array_to_string({a}.m[{slot} + 2:], '') END")
        return "\n".join(joins), before, after

    low_joins, low_before, low_after = climb("n", levels, "l.i", "a")
    top_joins, top_before, top_after = climb("s", top_levels, "r.i", "b")
    steps = [*zip(low_before, low_after, [f"a{k}.c0" for k in range(levels)]),
             *zip(top_before, top_after, [f"b{k}.c0" for k in range(top_levels)])]
    cols = ", ".join(f"{b} AS b{k}, {a} AS e{k}, {c} AS z{k}" for k, (b, a, c) in enumerate(steps))
    folds, last = [], "path"
    for k in range(len(steps)):
        folds.append(f"f{k} AS (SELECT * REPLACE (CASE WHEN z{k} = 1 THEN x ELSE sha256(b{k} || x || e{k}) END AS x) FROM {last})")
        last = f"f{k}"
    value = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    row = " || ".join(value(c) for c in FIELDS[:-1])
    low = f"translate(text, '{CAPITALS}', '{SMALLS}')"
    crc = ("xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           "lambda d: ascii(d)::BIGINT)), lambda c, d: list_reduce(list_prepend(xor(c, d), range(8)), "
           "lambda x, k: xor(x >> 1, 3988292384::BIGINT * (x & 1)))))")
    return f"""
WITH leaves AS MATERIALIZED (
  SELECT doc_id, source, sha256({row} || {value('text')}) AS h,
         CASE WHEN {crc} % 5 = 0 THEN sha256({row} || {value(low)}) END AS other FROM documents
), l AS MATERIALIZED (
  SELECT doc_id, other, h, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS t,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS i,
         count(*) OVER (PARTITION BY source) AS c FROM leaves
), n0 AS (SELECT t, i, c, h FROM l),
{','.join(level('n', k) for k in range(levels))},
r AS MATERIALIZED (SELECT 0 AS t, t AS below, t AS i, count(*) OVER () AS c, h FROM n{levels}),
s0 AS (SELECT t, i, c, h FROM r),
{','.join(level('s', k) for k in range(top_levels))},
path AS (
  SELECT l.doc_id, l.h AS leaf, r.h AS subroot, top.h AS root, coalesce(l.other, l.h) AS x, {cols}
  FROM l JOIN r ON r.below = l.t CROSS JOIN s{top_levels} top
  {low_joins}
  {top_joins}
), {', '.join(folds)}
SELECT doc_id, leaf, subroot, root, sha256({' || '.join(f'b{k} || e{k}' for k in range(len(steps)))}) AS proof_sha256,
       x AS folded_root, x = root AS verified FROM {last}
"""


ORACLE = _oracle(5, 3)
