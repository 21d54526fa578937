"""Connected components of a graph given by its edges, by contraction: hook every node to its smallest neighbour, merge, repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changeflow.llm.common import saved

MAX_ROUNDS = 60


def components(edges: DataFrame, folder: str, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Each round hooks every node to the smallest of its neighbours that is smaller, follows these hooks to their ends, and goes on with
    the edges between different ends. A round joins only the edges that the rounds before have left, and two rounds at least halve the nodes: an end
    that nothing is hooked to is hooked itself in the next round, as all its edges lead to smaller ends. Messages meet in map-side minimums, so a node with
    very many edges gets a row per task. Each step is a written table: lost executors repeat one step at most. Repeated
    edges and loops change nothing; no edges give no rows."""
    left = saved(_ordered(edges), folder, f"{name}-edges-0")
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        if len(rounds) == MAX_ROUNDS:
            raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
        k = len(rounds) + 1
        hooked = saved(left.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("to")), folder, f"{name}-hooks-{k}")
        rounds.append(_to_ends(hooked, folder, f"{name}-ends-{k}"))
        left = saved(_ordered(_renamed(_renamed(left, "a", rounds[-1]), "b", rounds[-1])), folder, f"{name}-edges-{k}")
    if not rounds:
        return edges.sparkSession.createDataFrame([], "node long, component long")
    # A node is hooked in one round only; later rounds tell where its end went.
    placed = rounds.pop()
    for k in range(len(rounds), 0, -1):
        placed = saved(_renamed(rounds[k - 1], "to", placed).union(placed), folder, f"{name}-placed-{k}")
    placed = placed.withColumnRenamed("to", "component")
    return saved(placed.union(placed.select(F.col("component").alias("node"), "component").distinct()), folder, name)


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges between different nodes, the smaller node first."""
    return edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _renamed(rows: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    """``rows`` with the nodes of a column followed along ``hooks`` (node, to), where they have one."""
    told = hooks.select(F.col("node").alias("_node"), F.col("to").alias("_to"))
    return rows.join(told, rows[column] == told["_node"], "left").select(
        *(F.coalesce("_to", c).alias(c) if c == column else F.col(c) for c in rows.columns))


def _to_ends(hooked: DataFrame, folder: str, name: str) -> DataFrame:
    """Hooks (node, to) followed until ``to`` has none itself; each step doubles the way."""
    for k in range(1, MAX_ROUNDS):
        if hooked.join(hooked.select(F.col("node").alias("to")), "to", "left_semi").isEmpty():
            return hooked
        hooked = saved(_renamed(hooked, "to", hooked), folder, f"{name}-{k}")
    raise RuntimeError(f"hooks did not end in {MAX_ROUNDS} steps")
