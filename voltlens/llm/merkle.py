"""Merkle manifest of a table and its verification by a recursive query.

Build: every row is a leaf, the SHA-256 of its fields. Per ``lang`` the leaves ascend by id; every
``fanout`` consecutive nodes become the hash of their digests (hexadecimal text) until one is left,
the subroot. The subroots, ordered by lang, become the root in the same way. Every level is written,
and each node that has children is a row: its number, its children's digests, its parent's number and
its place among its parent's children.

Climb: ``WITH RECURSIVE`` starts one row per leaf with the digest to be proven. Each step joins the row
with its parent's node row, appends the siblings found there and folds the digest between
them, until a node has no parent. The last digest must equal the root. The proof is the siblings of
all steps.

Scale: places come from range-partitioned ranks, so a language that holds all rows is no single task.
The number of a node is the first leaf below it and its height, which is exact. All leaves meet in
few node rows near the root: a node row above height ``SPREAD`` is stored once for every
``fanout ** SPREAD`` leaves below it (a few rows in all), and a climbing row picks its copy by its leaf number, so
no join key has more than that many rows. The climb carries 32-byte digests, and a step's
siblings stay in that step's row. The driver sees the number of levels and the root.

Cases: a null field is hashed as ``-``. Null ids come first in their lang, rows of equal id are
ordered by their leaf; fully repeated rows are leaves of their own with equal digests. A null lang is a
tree of its own, the first. One leaf is its own subroot, one subroot is the root, with an empty
proof. An empty table has no root and no rows. Extra columns are not hashed, also those that clash in name
or case. A text of any length is hashed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from voltlens.llm.common import materialize, pick
from voltlens.operators.prefix import row_rank, running_sum

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Heights above which a node row is stored more than once, and the most copies of one.
SPREAD, MOST_COPIES = 4, 1 << 10
#: The heights of the tree over the subroots count from here; a number holds the height in its low 6 bits.
TOP = 32


def digest(fields: list[Column]) -> Column:
    """SHA-256 (hexadecimal) of the fields, each as its byte length and value, null as ``-``."""
    shown = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")),
                        F.lit("-")) for f in fields]
    return F.sha2(F.concat(*shown), 256)


def node_number(first_leaf: Column, height: Column) -> Column:
    return F.shiftleft(first_leaf, 6) + height


def parents(level: DataFrame, fanout: int) -> DataFrame:
    """The next level of all trees that are not done: ``tree, idx, size, hash, kids``."""
    runs = level.where("size > 1").groupBy("tree", F.expr(f"idx div {fanout}").alias("up"), "size").agg(
        F.sort_array(F.collect_list(F.struct("idx", "hash"))).alias("kids"))
    text = F.array_join(F.transform("kids", lambda k: k["hash"]), "")
    return runs.select("tree", F.col("up").alias("idx"), F.expr(f"(size + {fanout - 1}) div {fanout}").alias("size"),
                       F.sha2(text, 256).alias("hash"), F.unhex(text).alias("kids"))


def levels_of(leaves: DataFrame, fanout: int, name: str) -> list[DataFrame]:
    """The levels above ``leaves`` (``tree, idx, size, hash``), each a written table."""
    biggest, out, level = leaves.agg(F.max("size").alias("n")).first().n or 0, [], leaves
    while biggest > 1:
        level = materialize(parents(level, fanout), name)
        out.append(level)
        biggest = -(-biggest // fanout)
    return out


def node_rows(levels: list[DataFrame], fanout: int, base: int, links: DataFrame | None) -> DataFrame | None:
    """Node rows of a forest: ``node, kids, parent, place, spread`` (copies of the parent). ``links``: tree and its
    place among the subroots, for the parent of a tree's last node; null: it has none."""
    out = None
    for h, level in enumerate(levels, start=1):
        up = node_number(F.col("tree") + F.expr(f"idx div {fanout}") * fanout ** (h + 1), F.lit(base + h + 1))
        rows = level.withColumn("node", node_number(F.col("tree") + F.col("idx") * fanout ** h, F.lit(base + h)))
        rows = rows.withColumn("height", F.lit(h))
        inner = rows.where("size > 1").select("node", "kids", up.alias("parent"), F.expr(f"idx % {fanout}").alias("place"),
                                              F.lit(h + 1).alias("above"))
        last = rows.where("size = 1")
        if links is None:
            last = last.select("node", "kids", F.lit(None).cast("long").alias("parent"), F.lit(None).cast("long").alias("place"),
                               F.lit(0).alias("above"))
        else:
            last = last.join(links, "tree").select("node", "kids", "parent", "place", F.lit(TOP).alias("above"))
        both = inner.union(last).withColumn("height", F.lit(base + h))
        out = both if out is None else out.union(both)
    return out


def copies(height: Column, fanout: int) -> Column:
    """How many times a node row of this height is stored (heights from ``TOP`` on: the most)."""
    spread = F.pow(F.lit(float(fanout)), F.least(height, F.lit(TOP)).cast("double") - SPREAD)
    return F.least(F.greatest(spread, F.lit(1.0)), F.lit(float(MOST_COPIES))).cast("int")


def manifest(df: DataFrame, fanout: int = 8, columns: dict[str, str] | None = None,
             tampered: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame, str | None]:
    """``(leaves, nodes, subroots, root)``. ``columns``: input column of every field (default: its own name);
    ``tampered``: condition on the fields under which a row's ``held`` digest is that of its
    text with small letters A-Z, else it equals ``leaf``."""
    rows = pick(df, {f: (columns or {}).get(f, f) for f in FIELDS})
    fields = [F.col(f) for f in FIELDS]
    leaf, altered = digest(fields), digest([*fields[:-1], F.translate("text", UPPER, LOWER)])
    changed = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    rows = rows.select("doc_id", "lang", leaf.alias("leaf"), F.when(changed, altered).otherwise(leaf).alias("held"))
    rows = rows.withColumn("some_id", F.col("doc_id").isNotNull())
    ranked = materialize(row_rank(rows, ["some_id", "doc_id", "leaf"], by=["lang"], name="at", size_name="size"), "leaves")
    # trees lie one after the other, in the order of their lang's bytes, null first
    sizes = ranked.groupBy("lang").agg(F.count("*").alias("rows")).withColumn(
        "key", F.coalesce(F.concat(F.lit("1"), "lang"), F.lit("")))
    trees = row_rank(running_sum(sizes, ["key"], ["rows"]), ["key"], name="nth", size_name="trees")
    trees = materialize(trees.select(F.col("lang").alias("of"), (F.col("rows_cum") - F.col("rows")).alias("tree"),
                                     (F.col("nth") - 1).alias("nth"), "trees"), "trees")
    leaves = materialize(ranked.join(trees, F.col("lang").eqNullSafe(F.col("of"))).select(
        "doc_id", "leaf", "held", "tree", (F.col("at") - 1).alias("idx"), "size"), "placed")
    low = levels_of(leaves.select("tree", "idx", "size", F.col("leaf").alias("hash")), fanout, "level")
    ends = leaves.where("size = 1").select("tree", F.col("leaf").alias("hash"))
    for level in low:
        ends = ends.union(level.where("size = 1").select("tree", "hash"))
    subroots = materialize(ends.join(trees, "tree").select("tree", "nth", "trees", "hash"), "subroots")
    top_leaves = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("nth").alias("idx"), F.col("trees").alias("size"), "hash")
    top = levels_of(top_leaves, fanout, "top")
    last = (top[-1] if top else top_leaves).select("hash").first()
    up = node_number(F.expr(f"nth div {fanout}") * fanout, F.lit(TOP + 1))
    links = subroots.select("tree", F.when(F.col("trees") > 1, up).alias("parent"),
                            F.expr(f"nth % {fanout}").alias("place"))
    parts = [n for n in (node_rows(low, fanout, 0, links), node_rows(top, fanout, TOP, None)) if n is not None]
    first_up = node_number(F.col("tree") + F.expr(f"idx div {fanout}") * fanout, F.lit(1))
    start = leaves.withColumn("number", F.col("tree") + F.col("idx")).join(
        links.withColumnRenamed("place", "top_place"), "tree").select(
        "number", "doc_id", "leaf", "held", "tree",
        F.when(F.col("size") > 1, first_up).otherwise(F.col("parent")).alias("parent"),
        F.when(F.col("size") > 1, F.expr(f"idx % {fanout}")).otherwise(F.col("top_place")).alias("place"),
        F.when(F.col("size") > 1, copies(F.lit(1), fanout)).otherwise(copies(F.lit(TOP), fanout)).alias("spread"))
    start = materialize(start, "start")
    if parts:
        nodes = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
        # under TOP the height says how many leaves lie below, above it there may be many
        each = copies(F.col("height"), fanout)
        nodes = nodes.select("node", "kids", "parent", "place", copies(F.col("above"), fanout).alias("spread"),
                             F.explode(F.sequence(F.lit(0), each - 1)).alias("copy"))
    else:
        nodes = start.sparkSession.createDataFrame([], "node long, kids binary, parent long, place long, spread int, copy int")
    return start, materialize(nodes, "nodes"), subroots, last.hash if last else None


CLIMB = """
    WITH RECURSIVE climb AS (
        SELECT number, parent, place, spread, unhex(held) AS folded, CAST(NULL AS BINARY) AS siblings, 0L AS node
        FROM {leaves}
        UNION ALL
        SELECT c.number, n.parent, n.place, n.spread,
               unhex(sha2(lower(hex(concat(substring(n.kids, 1, int(32 * c.place)), c.folded,
                                           substring(n.kids, int(32 * c.place + 33))))), 256)),
               concat(substring(n.kids, 1, int(32 * c.place)), substring(n.kids, int(32 * c.place + 33))),
               n.node
        FROM climb c JOIN {nodes} n ON n.node = c.parent AND n.copy = pmod(c.number div {stride}, c.spread)
    )
    SELECT number, node, siblings, CASE WHEN parent IS NULL THEN folded END AS top FROM climb"""


def climb(leaves: DataFrame, nodes: DataFrame, fanout: int = 8) -> DataFrame:
    """``number, proof_sha256, folded_root`` of every leaf, from its ``held`` digest."""
    spark = leaves.sparkSession
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")  # the rows are bounded by leaves times levels
    try:
        steps = spark.sql(CLIMB.format(leaves="{leaves}", nodes="{nodes}", stride=fanout ** SPREAD), leaves=leaves, nodes=nodes)
        # neighbours have most siblings in common: side by side they take little room in files and shuffles
        steps = materialize(steps.sortWithinPartitions("node", "number"), "climb")
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)
    # a step's height is in the low bits of its node's number
    step = F.struct(F.col("node").bitwiseAND(F.lit(63)).alias("height"), "siblings")
    near = steps.withColumn("block", F.expr(f"number div {fanout ** SPREAD}")).repartition("block")
    found = near.groupBy("block", "number").agg(F.collect_list(F.when(F.col("node") > 0, step)).alias("steps"),
                                        F.max("top").alias("top"))
    proof = F.array_join(F.transform(F.sort_array("steps"), lambda s: F.hex(s["siblings"])), "")
    return found.select("number", F.sha2(F.lower(proof), 256).alias("proof_sha256"), F.lower(F.hex("top")).alias("folded_root"))


def verify(df: DataFrame, fanout: int = 8, columns: dict[str, str] | None = None, tampered: Column | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row."""
    leaves, nodes, subroots, root = manifest(df, fanout, columns, tampered)
    proofs = climb(leaves, nodes, fanout)
    out = leaves.select("number", "doc_id", "leaf", "tree").join(
        subroots.select("tree", F.col("hash").alias("subroot")), "tree").join(proofs, "number")
    root_col = F.lit(root).cast("string")
    return out.select("doc_id", "leaf", "subroot", root_col.alias("root"), "proof_sha256", "folded_root",
                      (F.col("folded_root") == root_col).alias("verified"))
