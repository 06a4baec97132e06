"""Merkle manifest of a dataset, from levels kept as concatenated strings.

1. A row's leaf is the SHA-256 of its columns, each as ``bytes:value`` (``-`` for
   null). Leaves ascend by id within a group; every two consecutive nodes become
   the hash of their concatenated hex digests (a last single one too) until one node, the
   group's subroot, is left. Subroots, ordered by group (null first, by bytes),
   become the root in the same way.
2. An aligned block of 1,024 nodes keeps a level as one hex string. Fixed-width
   substrings of 128 digits are hashed to the level above it, up to ten levels in
   a block; the blocks' top nodes are the leaves of the next pass, so 10**9 rows take
   three passes.
3. The sibling of a node is the flanking 64 digits of its level's string. The segments
   of a block are followed by those of the block's own top node, taken from the pass
   above: passes are read back from the root to the leaves, and only blocks
   are joined, never leaves.

Ranks come from range-sorted tables, so a group may hold all rows. A block is 1,024
rows, whatever the group.

Defined results: ids and groups may be null (first in order); rows that repeat are
leaves of their own, side by side; equal ids are ordered by leaf; a lone leaf is its
group's subroot, a lone subroot the root, and its proof is empty; an empty table gives no
rows. Texts are hashed whole. Columns that are not named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ranked, stored

LEVELS = 10
#: Hex digits of a digest.
DIGITS = 64


def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def _height(size: Column) -> Column:
    """Levels above the leaves of a tree of ``size`` leaves."""
    return F.when(size > 1, F.length(F.bin(size - 1))).otherwise(0)


def _parents(line: Column) -> Column:
    """The level above a level: every 128 digits (the last may be 64) hashed."""
    last = F.floor((F.octet_length(line) - 1) / (2 * DIGITS)).cast("int")
    hashed = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.sha2(F.substring(line, i * 2 * DIGITS + 1, F.lit(2 * DIGITS)), 256)
    )
    return F.array_join(hashed, "").cast("binary")


def _blocks(nodes: DataFrame, payload: Sequence[str]) -> DataFrame:
    """Blocks of nodes (``tree``, ``rank``, ``size`` of the tree, ``node``): ``members`` in
    order and ``levels``, one hex string each from the block's nodes to its top."""
    block = F.call_function("shiftright", F.col("rank"), F.lit(LEVELS))
    grouped = nodes.groupBy("tree", block.alias("block")).agg(
        F.first("size").alias("size"), F.sort_array(F.collect_list(F.struct("rank", "node", *payload))).alias("members")
    )
    first = F.array_join(F.transform("members", lambda m: m["node"]), "").cast("binary")
    steps = F.least(F.lit(LEVELS), _height(F.col("size")))
    levels = F.aggregate(
        F.sequence(F.lit(1), F.lit(LEVELS)),
        F.array(F.col("line")),
        lambda done, level: F.when(level > steps, done).otherwise(F.concat(done, F.array(_parents(F.element_at(done, -1))))),
    )
    members = F.transform("members", lambda m: F.struct(*[m[c].alias(c) for c in ("node", *payload)]))
    lined = grouped.withColumn("line", first)
    return stored(lined.select("tree", "block", "size", members.alias("members"), levels.alias("levels")), "merkle_blocks")


def climb(nodes: DataFrame, tallest: int, payload: Sequence[str] = ()) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every pass, lowest first, and ``tree``, ``node`` of the tops.
    ``tallest``: leaves of the largest tree."""
    passes = [_blocks(nodes, payload)]
    while True:
        blocks = passes[-1]
        size = F.ceil(F.col("size") / (1 << LEVELS)).cast("long")
        tops = blocks.select("tree", F.col("block").alias("rank"), size.alias("size"), F.element_at("levels", -1).cast("string").alias("node"))
        tallest = -(-tallest // (1 << LEVELS))
        if tallest <= 1:
            return passes, tops.select("tree", "node")
        passes.append(_blocks(tops, ()))


def _with_siblings(fields: Sequence[str]) -> Column:
    """A block's members with their place in it and their siblings within it."""

    def siblings(place: Column) -> Column:
        def step(line: Column, level: Column) -> Column:
            number = F.call_function("shiftright", place, level)
            sibling = F.substring(line, number.bitwiseXOR(F.lit(1)) * DIGITS + 1, F.lit(DIGITS))
            return F.struct(sibling.cast("string").alias("sibling"), (number.bitwiseAND(F.lit(1)) == 1).alias("left"))

        return F.transform(F.slice("levels", 1, F.size("levels") - 1), step)

    def opened(member: Column, place: Column) -> Column:
        return F.struct(*[member[c].alias(c) for c in fields], place.cast("long").alias("place"), siblings(place).alias("own"))

    return F.transform("members", opened)


def descend(passes: list[DataFrame], above: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """Each leaf's ``path`` from itself to the root: siblings ('' where there is none)
    and whether they stand on the left. ``above``: ``tree``, ``path`` of the trees' tops
    and columns that all leaves of a tree get."""
    keep = [c for c in above.columns if c not in ("tree", "path")]
    above = above.withColumn("block", F.lit(0).cast("long"))
    for blocks in reversed(passes):
        fields = ["node", *(payload if blocks is passes[0] else ())]
        members = _with_siblings(fields)
        opened = blocks.join(above, ["tree", "block"]).select("tree", "block", "path", *keep, F.inline(members))
        rank = F.col("block") * (1 << LEVELS) + F.col("place")
        above = opened.select("tree", rank.alias("block"), *fields, F.concat("own", "path").alias("path"), *keep)
    return above.drop("block")


def merkle_manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group_col: str = "lang",
    id_col: str = "doc_id",
    claimed: Column | None = None,
) -> DataFrame:
    """``id``, ``group``, ``leaf``, ``claimed``, ``subroot``, ``root``, ``path`` of every row.
    ``claimed``: a leaf that somebody holds the row to be (null: its own)."""
    claimed = F.lit(None).cast("string") if claimed is None else claimed
    group = F.col(group_col).cast("string")
    tree = F.coalesce(F.concat(F.lit("="), group), F.lit(""))  # never null, in the order of the groups
    leaves = stored(
        docs.select(tree.alias("tree"), F.col(id_col).alias("id"), leaf_digest(*[F.col(c) for c in columns]).alias("node"), claimed.alias("claimed")),
        "merkle_leaves",
    )
    rows = ranked(leaves, "tree", "id", "node")
    trees = stored(rows.groupBy("tree").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("size")), "merkle_trees")
    count, tallest = trees.agg(F.count(F.lit(1)), F.max("size")).first()
    nodes = rows.join(trees, "tree").withColumn("rank", F.col("rank") - F.col("first"))
    passes, tops = climb(nodes, tallest or 0, ("id", "claimed"))

    root_nodes = ranked(stored(tops.withColumnRenamed("tree", "group"), "merkle_subroots"), "group")
    root_nodes = root_nodes.withColumns({"tree": F.lit(""), "size": F.lit(count).cast("long")})
    root_passes, root = climb(root_nodes, count, ("group",))
    start = root.select("tree", F.col("node").alias("root"), F.expr("array()").cast("array<struct<sibling:string,left:boolean>>").alias("path"))
    subroots = descend(root_passes, start, ("group",))
    above = subroots.select(F.col("group").alias("tree"), F.col("node").alias("subroot"), "root", "path")
    out = descend(passes, above, ("id", "claimed"))
    own_group = F.when(F.col("tree") != "", F.substring("tree", 2, 2147483647))
    return out.select("id", own_group.alias("group"), F.col("node").alias("leaf"), "claimed", "subroot", "root", "path")


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings, from the leaf's level to the root's."""
    return F.sha2(F.array_join(F.transform(path, lambda p: p["sibling"]), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    both = lambda node, p: F.when(p["left"], F.concat(p["sibling"], node)).otherwise(F.concat(node, p["sibling"]))
    return F.aggregate(path, leaf, lambda node, p: F.sha2(both(node, p), 256))


def verify(manifest: DataFrame) -> DataFrame:
    """The manifest with ``proof_sha256``, ``folded_root`` (from the claimed leaf, else the
    own one) and ``verified`` (whether that is the root)."""
    folded = manifest.withColumns(
        {"proof_sha256": proof_digest(F.col("path")), "folded_root": fold(F.coalesce("claimed", "leaf"), F.col("path"))}
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
