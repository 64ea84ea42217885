"""Trees: closure, roll-up of distinct records, inheritance, order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treille.plans.lineage import cut


def closure(edges: DataFrame, node: str = "node", parent: str = "parent", depth: int = 64) -> DataFrame:
    """(ancestor, node, depth) with each node its own ancestor at 0; a secondary parent counts like the first.

    Each level is written once and only pairs not found before go on, so a cycle ends as
    soon as it brings nothing new; ``depth`` is the longest path that is followed.
    """
    pairs = edges.select(F.col(node).alias("node"), F.col(parent).alias("parent")).distinct()
    nodes = pairs.select("node").union(pairs.select("parent").where("parent is not null")).where("node is not null").distinct()
    up = cut(pairs.where("node is not null and parent is not null"), "edges").select(F.col("node").alias("child"), F.col("parent").alias("ancestor"))
    found = cut(nodes.select(F.col("node").alias("ancestor"), "node", F.lit(0).alias("depth")), "level")
    level = found
    for d in range(1, depth + 1):
        reached = level.select(F.col("ancestor").alias("child"), "node").join(up, "child").select("ancestor", "node").distinct()
        level = cut(reached.join(found, ["ancestor", "node"], "left_anti").withColumn("depth", F.lit(d)), "level")
        if level.isEmpty():
            break
        found = found.unionByName(level)
    return found


def roots_of(tree: DataFrame, edges: DataFrame, node: str = "node", parent: str = "parent") -> DataFrame:
    """(node, root): the roots a node hangs under, all of them; ``tree`` is the closure of ``edges``."""
    child = edges.where(F.col(parent).isNotNull()).select(F.col(node).alias("ancestor")).distinct()
    return tree.join(child, "ancestor", "left_anti").select("node", F.col("ancestor").alias("root"))


def buckets(values: DataFrame, key: str, value: str, roots: DataFrame, other: str = "other") -> DataFrame:
    """(key, root): the root buckets of the values of each key; a value the tree doesn't know falls into ``other``."""
    joined = values.select(key, F.col(value).alias("node")).join(roots, "node", "left")
    return joined.select(key, F.coalesce("root", F.lit(other)).alias("root")).distinct()


def depth_first(edges: DataFrame, node: str = "node", parent: str = "parent", hidden: str | None = None, depth: int = 64) -> DataFrame:
    """(node, parent, depth, path) of a tree by first parents; sorting by ``path`` gives the depth-first order, siblings by name.

    Nodes for which ``hidden`` holds are left out with all below them. Nodes in a cycle have no path and no row.
    """
    flag = F.coalesce(F.col(hidden), F.lit(False)) if hidden else F.lit(False)
    rows = edges.select(F.col(node).alias("node"), F.col(parent).alias("parent"), flag.alias("_h")).groupBy("node").agg(F.min("parent").alias("parent"), F.max("_h").alias("_h"))
    rows = cut(rows.where("not _h").select("node", "parent"), "tree")
    level = cut(rows.where("parent is null").select("node", "parent", F.lit(0).alias("depth"), F.array("node").alias("path")), "level")
    found = level
    for d in range(1, depth + 1):
        above = level.select(F.col("node").alias("parent"), F.col("path").alias("_path"))
        level = cut(rows.join(above, "parent").select("node", "parent", F.lit(d).alias("depth"), F.concat("_path", F.array("node")).alias("path")), "level")
        if level.isEmpty():
            break
        found = found.unionByName(level)
    return found


def children(edges: DataFrame, node: str = "node", parent: str = "parent") -> DataFrame:
    """(parent, children): the children of each parent by name, capitals aside."""
    rows = edges.where(F.col(parent).isNotNull()).select(F.col(parent).alias("parent"), F.struct(F.lower(F.col(node)).alias("k"), F.col(node).alias("n")).alias("c")).distinct()
    return rows.groupBy("parent").agg(F.transform(F.array_sort(F.collect_list("c")), lambda x: x["n"]).alias("children"))


def roll_up(records: DataFrame, key: str, node: str, tree: DataFrame) -> DataFrame:
    """(ancestor, records): records that carry the node or any below it, each counted once."""
    return records.select(key, F.col(node).alias("node")).join(tree, "node").groupBy("ancestor").agg(F.countDistinct(key).alias("records"))


def inherit(rows: DataFrame, key: str, parent: str, columns: list[str]) -> DataFrame:
    """Columns that are null are taken from the parent row; ``inherited`` tells whether any was."""
    up = rows.groupBy(F.col(key).alias("_pk")).agg(*[F.first(c, ignorenulls=True).alias(f"_p_{c}") for c in columns])
    joined = rows.join(up, F.col(parent) == F.col("_pk"), "left")
    took = [F.col(c).isNull() & F.col(f"_p_{c}").isNotNull() for c in columns]
    flag = took[0]
    for t in took[1:]:
        flag = flag | t
    return joined.select(*[c for c in rows.columns if c not in columns], *[F.coalesce(c, f"_p_{c}").alias(c) for c in columns], flag.alias("inherited"))
