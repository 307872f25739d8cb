"""Connected components of a graph held as a table: distributed union-find by alternating stars.

Every node repeatedly hangs its larger neighbours, then all its neighbours,
onto its smallest one, until each component is a star around its smallest id.
Each round is groupings with map-side minimum and joins that adaptive execution
can split, so neither a component nor a node's links meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.tables import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Edges may repeat here; what follows takes the minimum per child and leaves repeats out."""
    both = edges.select(F.col("child").alias("node"), F.col("parent").alias("other")).unionByName(
        edges.select(F.col("parent").alias("node"), F.col("child").alias("other"))
    )
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    return (
        both.filter("other > node")
        .join(least, "node")
        .select(F.col("other").alias("child"), F.col("least").alias("parent"))
        .filter("child <> parent")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges may repeat."""
    least = edges.groupBy("child").agg(F.min("parent").alias("least"))
    moved = edges.join(least, "child").select(F.col("parent").alias("child"), F.col("least").alias("parent"))
    return moved.unionByName(least.select("child", F.col("least").alias("parent"))).filter("child <> parent")


def _is_star_forest(edges: DataFrame) -> bool:
    roles = edges.select(F.col("child").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("parent").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    mixed = roles.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return mixed.filter("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def _downward(links: DataFrame, first: str, second: str) -> DataFrame:
    """(child, parent) of links with two ends, which are not the same; links may repeat."""
    whole = links.filter(F.col(first).isNotNull() & F.col(second).isNotNull())
    edges = whole.select(F.greatest(first, second).alias("child"), F.least(first, second).alias("parent"))
    return edges.filter("child <> parent")


def first_groups(links: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """(node, component) after one round, of the nodes that then hang on a smaller one.

    ``component`` is an id reachable over links, most often the smallest: nodes
    with the same one are connected, and a component may still be in several parts.
    Nodes that are not named count as their own. That is enough to leave out work
    between nodes known to be connected, and takes no test whether to go on.
    """
    moved = _small_star(_large_star(_downward(links, first, second)))
    hung = moved.groupBy(F.col("child").alias("node")).agg(F.min("parent").alias("component"))
    hung = written(hung, "hung")
    above = hung.select(F.col("node").alias("component"), F.col("component").alias("above"))
    return hung.join(above, "component", "left").select("node", F.coalesce("above", "component").alias("component"))


def components(links: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """(node, component) of every node that has a link to another node.

    ``component`` is the smallest id reachable. Links with a null end, loops
    and repeated links change nothing; without links the result is empty.
    """
    edges = written(_downward(links, first, second).distinct(), "links")
    while not _is_star_forest(edges):
        edges = written(_small_star(_large_star(edges)).distinct(), "stars")
    roots = edges.select(F.col("parent").alias("node")).distinct()
    return edges.select(F.col("child").alias("node"), F.col("parent").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
