"""Connected components of a link table, by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _relabel(df: DataFrame, names: list[str], parents: DataFrame) -> DataFrame:
    for name in names:
        p = parents.select(F.col("node").alias("p_node"), F.col("parent").alias("p_parent"))
        df = df.join(p, df[name] == p["p_node"], "left").withColumn(name, F.coalesce("p_parent", name)).drop("p_node", "p_parent")
    return df


def components(links: DataFrame) -> DataFrame | None:
    """Labels (node, label) of all nodes in links (a, b); the label is the least node of a component.

    Each pass hooks every node to its least neighbour if that is smaller, shortens the chains and
    contracts the links, so the links shrink geometrically and no component meets in one task.
    Self links and repeated links are harmless. None if there is no link between two nodes.
    """
    left = cut(links.where("a <> b").select("a", "b").distinct())
    labels = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("parent"))
        for _ in range(2):
            parents = _relabel(parents, ["parent"], parents)
        parents = cut(parents)
        labels = parents.withColumnRenamed("parent", "label") if labels is None else _relabel(labels, ["label"], parents)
        left = cut(_relabel(left, ["a", "b"], parents).where("a <> b").distinct())
    return None if labels is None else cut(labels)


def compose(labels: DataFrame | None, more: DataFrame | None) -> DataFrame | None:
    """Labels of nodes after the labels themselves were grouped further."""
    if labels is None or more is None:
        return labels if more is None else more
    moved = _relabel(labels, ["label"], more.withColumnRenamed("label", "parent"))
    return cut(moved.unionByName(more.join(labels.select("node"), "node", "left_anti")))
