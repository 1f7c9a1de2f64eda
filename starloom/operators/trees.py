"""Hierarchies and graphs by level-wise joins.

Each level is one join of the frontier with the children, written to the shared folder, so the plan does not
grow with depth and there is no cap on rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import materialize


def hierarchy(nodes: DataFrame, node_id: str, parent_id: str, name: str, keep: list[str] = ()) -> DataFrame:
    """Every node reachable from a root (null parent) with depth and its path of names joined by " > ".

    Any depth. A node has one parent, which is checked; so no node of a cycle is reachable and the levels end.
    """
    columns = [node_id, parent_id, name, *keep]
    nodes = materialize(nodes.select(columns), "tree")
    if not nodes.groupBy(node_id).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).isEmpty():
        raise ValueError(f"a {node_id} has more than one parent")
    level = materialize(nodes.where(F.col(parent_id).isNull()).select(
        *columns, F.col(name).cast("string").alias("path"), F.lit(0).alias("depth")), "tree")
    children = nodes.where(F.col(parent_id).isNotNull())
    levels = []
    while not level.isEmpty():
        levels.append(level)
        parents = level.select(F.col(node_id).alias("_parent"), F.col("path").alias("_path"), F.col("depth").alias("_depth"))
        found = children.join(parents, F.col(parent_id) == F.col("_parent"))
        level = materialize(found.select(
            *columns, F.concat("_path", F.lit(" > "), F.col(name)).alias("path"),
            (F.col("_depth") + 1).alias("depth")), "tree")
    return reduce(DataFrame.unionByName, levels or [level])


def downstream(edges: DataFrame, start: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Nodes reachable over (src, dst) edges with the least number of steps; start nodes excluded.

    start has one column, node. All that is reachable, or only max_depth steps of it. The edges are stored once and a
    node is expanded once, so neither levels nor dense layers multiply the work.
    """
    edges = materialize(edges.select("src", "dst").distinct(), "graph")
    frontier = materialize(start.select("node").distinct().withColumn("depth", F.lit(0)), "graph")
    visited, depth = [frontier], 0
    while max_depth is None or depth < max_depth:
        depth += 1
        known = reduce(DataFrame.unionByName, visited).select("node")
        reached = edges.join(frontier.select("node"), F.col("src") == F.col("node"), "left_semi").select(
            F.col("dst").alias("node")).distinct()
        frontier = materialize(reached.join(known, "node", "left_anti").withColumn("depth", F.lit(depth)), "graph")
        if frontier.isEmpty():
            break
        visited.append(frontier)
    return reduce(DataFrame.unionByName, visited).where(F.col("depth") > 0)
