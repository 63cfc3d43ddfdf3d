"""Merkle manifest of a table: a tree per group of rows, and one tree over the groups' roots.

Rows of a group ascend by key. Every ``FANOUT`` consecutive nodes have one parent. A parent's
children are spread into columns by conditional aggregates, one per slot (slot pivot): the columns
joined are what the parent's digest is taken of; with a child's own column left out they are its
siblings. Digests are lower-case hex SHA-256.

Trees are climbed ``LEVELS`` levels at a time. Nodes are shuffled once by group and block, a block
being all nodes below one node ``LEVELS`` levels up, sorted once, and every level groups by a prefix
of that order, so it needs neither a shuffle nor a sort of its own. A group with most of all rows is
many blocks. Places within a group come from ranges of the key: each range counts its rows of each
group, and a row's place is the rows of the ranges before plus its place in the range.

Proofs go the other way: the path of a block's root is joined to the block's nodes, so each row's
siblings are in one row only where its proof is computed, and only rows of leaf size are shuffled.

Defined results: a null field counts as ``-``; null keys come first, rows that repeat a key ascend
by their leaf; a null group is a group of its own, before all others; a group of one row has that
row's leaf as its root; one group's root is the root of all; a row without any sibling has the digest
of an empty text as proof; a table without rows gives none. Other columns of the table, whatever
their names, stay out of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmurio.session import materialize

FANOUT = 3
LEVELS = 6  # levels climbed after one shuffle; a block has FANOUT ** LEVELS nodes


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf: its length in bytes, a colon and the value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    return digest(*[field(c) for c in columns])


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with pos (place within tree by ``order``, from 0) and n (rows of the tree).

    ``order`` must tell all rows of a tree apart.
    """
    keys = ["tree", *order]
    ranged = materialize(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("part", F.spark_partition_id())
        .withColumn("row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "ranges")
    # a row for each tree in each range
    runs = ranged.groupBy("part", "tree").agg(F.count("*").alias("rows"), F.min("row").alias("first"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))).withColumn(
        "n", F.sum("rows").over(Window.partitionBy("tree")))
    runs = runs.select(F.col("part").alias("part2"), F.col("tree").alias("tree2"), "n",
                       (F.col("before") - F.col("first")).alias("shift"))
    return (ranged.join(runs, (F.col("part") == F.col("part2")) & (F.col("tree") == F.col("tree2")))
            .withColumn("pos", F.col("row") + F.col("shift"))
            .drop("part", "part2", "tree2", "row", "shift"))


def _blocked(nodes: DataFrame) -> tuple[DataFrame, list[list[str]]]:
    """Nodes by blocks with their ancestors' places, and the keys that hold a parent of each level together."""
    for level in range(1, LEVELS + 1):
        nodes = nodes.withColumn(f"p{level}", F.floor(F.col("pos") / F.lit(FANOUT ** level)).cast("long"))
    ancestors = [f"p{level}" for level in range(LEVELS, 0, -1)]
    nodes = nodes.repartition("tree", ancestors[0]).sortWithinPartitions("tree", *ancestors, "pos")
    return nodes, [["tree", *ancestors[:LEVELS + 1 - level]] for level in range(1, LEVELS + 1)]


def _slot(level: int) -> Column:
    """A node's slot below its parent of this level."""
    return F.pmod(F.col(f"p{level - 1}" if level > 1 else "pos"), F.lit(FANOUT))


def _hashed(tier: int, level: int) -> Column:
    """Whether the tree has this level: it has one as long as several nodes remain below it."""
    return F.col("n") > F.lit(FANOUT ** (tier * LEVELS + level - 1))


def _spread(level: int, h: Column) -> list[Column]:
    """Conditional aggregates: the digest of the child in each slot, empty where there is none."""
    return [F.coalesce(F.max(F.when(_slot(level) == s, h)), F.lit("")) for s in range(FANOUT)]


def climb(nodes: DataFrame, tier: int) -> DataFrame:
    """(tree, pos, h, n) of the blocks' roots."""
    nodes, keys = _blocked(nodes.select("tree", "pos", "h", "n"))
    for level in range(1, LEVELS + 1):
        children = [c.alias(f"c{s}") for s, c in enumerate(_spread(level, F.col("h")))]
        nodes = nodes.groupBy(*keys[level - 1]).agg(*children, F.max("n").alias("n"))
        columns = [F.col(f"c{s}") for s in range(FANOUT)]
        nodes = nodes.withColumn("h", F.when(_hashed(tier, level), digest(*columns)).otherwise(columns[0]))
    return nodes.select("tree", F.col(f"p{LEVELS}").alias("pos"), "h", "n")


def siblings(nodes: DataFrame, tier: int) -> DataFrame:
    """``nodes`` with block and steps: for each level up to the block's root what stands left and right."""
    nodes, keys = _blocked(nodes)
    own, steps = nodes.columns[:-LEVELS], []
    nodes = nodes.withColumn("_h", F.col("h"))
    for level in range(1, LEVELS + 1):
        parent = Window.partitionBy(*keys[level - 1])
        spread = [F.coalesce(F.max(F.when(_slot(level) == s, F.col("_h"))).over(parent), F.lit(""))
                  for s in range(FANOUT)]
        nodes = nodes.select("*", *[c.alias(f"c{level}_{s}") for s, c in enumerate(spread)])
        columns = [F.col(f"c{level}_{s}") for s in range(FANOUT)]

        def side(take, columns=columns, level=level):
            kept = [F.when(take(F.lit(s), _slot(level)), c).otherwise(F.lit("")) for s, c in enumerate(columns)]
            return F.concat(*kept)

        steps.append(F.when(_hashed(tier, level), F.struct(
            side(lambda s, slot: s < slot).alias("left"), side(lambda s, slot: s > slot).alias("right"))))
        nodes = nodes.withColumn("_h", F.when(_hashed(tier, level), digest(*columns)).otherwise(F.col("_h")))
    return nodes.select(*own, F.col(f"p{LEVELS}").alias("block"),
                        F.filter(F.array(*steps), lambda x: x.isNotNull()).alias("steps"))


def grow(nodes: DataFrame) -> list[DataFrame]:
    """The nodes at the bottom of every tier, each a written table; the last are the trees' roots."""
    tiers = [nodes]
    largest = nodes.agg(F.max("n")).first()[0] or 0
    while largest > 1:
        tiers.append(materialize(climb(tiers[-1], len(tiers) - 1), "tier"))
        largest = -(-largest // FANOUT ** LEVELS)
    return tiers


def descend(tiers: list[DataFrame], top: DataFrame) -> DataFrame:
    """The lowest nodes with path (all steps up to the root) and what ``top`` has more of each tree.

    ``top`` has (tree, path) and more for each tree: the steps above its root.
    """
    more = [c for c in top.columns if c not in ("tree", "path")]
    if len(tiers) == 1:
        return tiers[0].join(top, "tree")
    up = top.withColumn("pos", F.lit(0).cast("long"))
    for tier in range(len(tiers) - 2, -1, -1):
        above = up.select(F.col("tree").alias("_tree"), F.col("pos").alias("_pos"), F.col("path").alias("_path"), *more)
        nodes = siblings(tiers[tier], tier)
        nodes = nodes.join(above, (F.col("tree") == F.col("_tree")) & (F.col("block") == F.col("_pos")))
        up = nodes.withColumn("path", F.concat("steps", "_path")).drop("_tree", "_pos", "_path", "steps", "block")
    return up


def manifest(df: DataFrame, columns: list[str], *, key: str = "doc_id", group: str = "source",
             tampered: dict[str, Column] | None = None) -> DataFrame:
    """Per row key, leaf, subroot, root, proof_sha256, folded_root and verified.

    The leaf is taken of ``columns``. ``tampered`` gives values that replace some of them when the root
    is folded anew from the row and its proof; ``verified`` says whether the root comes out again.
    """
    own = leaf([F.col(c) for c in columns])
    bent = leaf([(tampered or {}).get(c, F.col(c)) for c in columns])
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")),
                                                         F.lit("0")).alias("tree"),
                     own.alias("h"), bent.alias("bent"))
    # texts are read once; where nothing is tampered with, the second digest is not kept
    rows = rows.withColumn("bent", F.when(F.col("bent") != F.col("h"), F.col("bent")))
    rows = materialize(rows.withColumn("tie", F.monotonically_increasing_id()), "leaves")
    trees = grow(materialize(placed(rows, "key", "h", "tie").drop("tie"), "placed"))

    roots = trees[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "h")
    forest = grow(materialize(placed(roots, "name"), "subroots"))
    crown = forest[-1].select("tree", F.col("h").alias("root"),
                              F.expr("array() :: array<struct<left: string, right: string>>").alias("path"))
    top = descend(forest, crown).select(F.col("name").alias("tree"), F.col("h").alias("subroot"), "root", "path")

    found = descend(trees, top)
    proof = F.array_join(F.transform("path", lambda x: F.concat(x["left"], x["right"])), "")
    fold = F.aggregate("path", F.coalesce("bent", "h"), lambda h, x: digest(x["left"], h, x["right"]))
    found = found.withColumn("folded_root", fold)
    return found.select(F.col("key").alias(key), F.col("h").alias("leaf"), "subroot", "root",
                        F.sha2(proof, 256).alias("proof_sha256"), "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))


def without_newlines(key: str = "doc_id", text: str = "text") -> Column:
    """The text without line ends where 2 divides the CRC-32 of the key's decimal form."""
    even = F.crc32(F.col(key).cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(F.col(text), F.lit("\n"), F.lit(""))).otherwise(F.col(text))
