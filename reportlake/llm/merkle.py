"""Merkle manifest of a dataset: a tree per group of rows and one tree over the groups.

A leaf is the hash of a row's fields.  In each group the leaves stand in order of their
id; runs of ``FAN`` consecutive nodes are hashed to their parent until one node, the
subroot, is left; the subroots, in order of their group, make the root likewise.

The tree is built by blocks.  A block holds ``FAN ** DEPTH`` consecutive nodes of a
group, at an aligned place, so that all levels above it up to its own root lie within it.
Each level is one string of hex digests.  A parent is the hash of a substring of
``FAN`` digests; the siblings of a node are the two substrings that flank it in its run.
Roots of the blocks are the nodes of the next round, so the number of rounds is the
logarithm of the largest group to the base of the block, and no task holds more than a
block.  Places come from a range partitioning and counts for each of its parts, so a
group with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportlake.session import stage

#: Children of a node.
FAN = 3

#: Levels within a block: blocks have FAN ** DEPTH nodes (243: strings of 15 kB).
DEPTH = 5
BLOCK = FAN ** DEPTH

#: Hex digits of a digest.
HEX = 64

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(fields: Sequence[Column]) -> Column:
    """The leaf of a row with these fields."""
    return F.sha2(F.concat(*[encoded(f) for f in fields]), 256)


def _placed(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Staged ``rows`` with ``pos`` (from 0, by ``order`` within ``g``) and ``n``, the rows of ``g``."""
    ranged = rows.repartitionByRange("g", *order).withColumn("part", F.spark_partition_id())
    ranged = stage(ranged, name)
    counts = ranged.groupBy("g", "part").agg(F.count(F.lit(1)).alias("k"))
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("g", "part", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("start"),
                           F.sum("k").over(Window.partitionBy("g")).alias("n"))
    within = Window.partitionBy("g", "part").orderBy(*order)
    numbered = ranged.withColumn("nth", F.row_number().over(within) - 1)
    return numbered.join(starts, ["g", "part"]).withColumn("pos", F.col("start") + F.col("nth")).drop("part", "start", "nth")


def _level_strings(nodes: Column, whole_group: Column) -> Column:
    """All levels of a block, from its nodes to its root.

    A block that is all its group ends with one node; any other one has ``DEPTH`` levels
    above its nodes, also where its last run is a single node.
    """
    def parents(level: Column) -> Column:
        runs = F.sequence(F.lit(0), F.ceil(F.length(level) / (FAN * HEX)).cast("int") - 1)
        return F.array_join(F.transform(runs, lambda i: F.sha2(F.substring(level, i * FAN * HEX + 1, F.lit(FAN * HEX)), 256)), "")

    def one_up(levels: Column, _: Column) -> Column:
        last = F.element_at(levels, -1)
        return F.when(whole_group & (F.length(last) <= HEX), levels).otherwise(F.array_append(levels, parents(last)))

    return F.aggregate(F.sequence(F.lit(1), F.lit(DEPTH)), F.array(nodes), one_up)


def siblings(levels: Column, place: Column) -> Column:
    """(left, right) on every level: the digests beside the node above ``place`` in its run."""
    def beside(level: Column, j: Column) -> Column:
        at = F.floor(place / F.pow(F.lit(FAN), j)).cast("int")
        first = at - at % FAN
        return F.struct(F.substring(level, first * HEX + 1, (at - first) * HEX).alias("left"),
                        F.substring(level, (at + 1) * HEX + 1, (first + FAN - 1 - at) * HEX).alias("right"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), beside)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of its path."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def path_hash(path: Column) -> Column:
    """Hash of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _blocks(nodes: DataFrame, payload: Sequence[str], name: str) -> DataFrame:
    """Staged (g, block, n, levels, members) of rows (g, pos, n, node, payload); n: nodes of the group."""
    found = nodes.groupBy("g", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "node", *payload))).alias("members"))
    joined = F.array_join(F.transform("members", lambda m: m["node"]), "")
    members = F.transform("members", lambda m: F.struct(m["pos"], *[m[p] for p in payload]))
    return stage(found.select("g", "block", "n", _level_strings(joined, F.col("n") <= BLOCK).alias("levels"),
                              members.alias("members")), name)


def _grown(nodes: DataFrame, payload: Sequence[str], name: str) -> list[DataFrame]:
    """Tables of blocks: of the nodes, of their blocks' roots, and so on until every group is one block."""
    rounds = [_blocks(nodes, payload, f"{name}-0")]
    while True:
        roots = rounds[-1].where(F.col("n") > BLOCK)
        if roots.isEmpty():
            return rounds
        roots = roots.select("g", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).cast("long").alias("n"),
                             F.element_at("levels", -1).alias("node"))
        rounds.append(_blocks(roots, [], f"{name}-{len(rounds)}"))


def _paths(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """One row per node of the first table: g, its payload, path to the top, and the columns of ``tops``.

    ``tops`` has one row per group: g, ``above`` (the path from its root on) and more columns.
    """
    more = [c for c in tops.columns if c not in ("g", "above")]
    over = None
    for table in reversed(rounds):
        # The one block of a group has the group's path above it, others that of their parent block's members.
        with_top = table.where(F.col("n") <= BLOCK).join(tops, "g")
        if over is not None:
            parents = over.select("g", F.col("member.pos").alias("block"), F.col("path").alias("above"), *more)
            with_top = with_top.unionByName(table.where(F.col("n") > BLOCK).join(parents, ["g", "block"]))
        each = with_top.select("g", "levels", "above", *more, F.explode("members").alias("member"))
        place = (F.col("member.pos") % BLOCK).cast("int")
        over = each.select("g", "member", F.concat(siblings(F.col("levels"), place), "above").alias("path"), *more)
    return over


_PATH = "array<struct<left:string,right:string>>"


def merkle_manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: Sequence[str] = FIELDS,
                    carry: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: id, group, leaf, subroot, root, path, and the columns of ``carry``.

    ``path`` lists the siblings (left, right) from the leaf's level up to the root:
    ``folded(leaf, path)`` is the root.  ``carry`` are expressions over ``docs`` that come
    along, as hashes of a changed row to be tested.

    Groups stand in order of their name, bytewise, a null group first (it is a group like
    the others).  Leaves of a group stand by id, null ids first, and rows of one id by
    their hash; equal rows are interchangeable, each has its leaf.  A lone leaf is its
    subroot, and a lone subroot the root, with an empty path.  Fields may be null or
    empty; other columns are ignored; an empty table gives no rows.
    """
    carry = dict(carry or {})
    kept = [f"c{i}" for i in range(len(carry))]
    leaves = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{group_col}`").alias("group"), leaf_hash([F.col(f"`{f}`") for f in fields]).alias("node"),
        *[c.alias(k) for k, c in zip(kept, carry.values())])
    # "0" for null, else "1" and the name: in order, and never null.
    leaves = leaves.withColumn("g", F.coalesce(F.concat(F.lit("1"), F.col("group").cast("string")), F.lit("0")))
    leaves = leaves.withColumn("uid", F.monotonically_increasing_id())  # tells equal rows apart
    placed = _placed(stage(leaves, "merkle-leaves"), ["id", "node", "uid"], "merkle-ranged").withColumn("leaf", F.col("node"))
    own = _grown(placed, ["id", "group", "leaf", *kept], "merkle-rows")

    subroots = None
    for table in own:
        whole = table.where(F.col("n") <= BLOCK).select("g", F.element_at("levels", -1).alias("node"))
        subroots = whole if subroots is None else subroots.unionByName(whole)
    subroots = subroots.select(F.lit("").alias("g"), F.col("g").alias("name"), "node")
    upper = _grown(_placed(subroots, ["name"], "merkle-subroots").withColumn("subroot", F.col("node")), ["name", "subroot"], "merkle-groups")
    top = upper[-1].where(F.col("n") <= BLOCK).select("g", F.expr(f"CAST(array() AS {_PATH})").alias("above"), F.element_at("levels", -1).alias("root"))
    tops = stage(_paths(upper, top).select(F.col("member.name").alias("g"), F.col("path").alias("above"), F.col("member.subroot").alias("subroot"), "root"),
                 "merkle-tops")
    return _paths(own, tops).select(
        F.col("member.id").alias(id_col), F.col("member.group").alias(group_col), F.col("member.leaf").alias("leaf"), "subroot", "root", "path",
        *[F.col(f"member.{k}").alias(c) for k, c in zip(kept, carry)])
