"""Connected components of a graph whose edges are a DataFrame.

Contraction: in each round every node that still has an edge hooks to the one
of least hash among itself and its neighbours (another hash each round, so a
chain in id order shrinks as fast as any), edges are rewritten to what their
ends hooked to, and loops and repeats go. Rounds grow with the logarithm of
the graph. Each round's table is written to the shared folder; nothing but a
count reaches the driver. Once at most ``LOCAL_EDGES`` edges are left, one task
joins their ends: rounds over so few cost more in tasks than in work.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import stage


#: Edges that one task joins: some tens of MB in it at most.
LOCAL_EDGES = 200_000


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Over all edges: every end and the smallest node it reaches."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x
    for pdf in batches:
        for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist()):
            root.setdefault(a, a)
            root.setdefault(b, b)
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    yield pd.DataFrame({"node": list(root), "to": [find(x) for x in root]}, dtype="int64")


def connected_components(edges: DataFrame, seed: int = 23, local_edges: int | None = None) -> DataFrame:
    """(node, component) for every end of ``edges`` (a, b: long); component is
    the smallest node reachable. Loops are ignored; no edges give no rows."""
    most = LOCAL_EDGES if local_edges is None else local_edges
    edges = stage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")),
                  "component-edges")
    nodes = None
    turn = 0
    while (left := edges.count()) > most:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = F.struct(F.xxhash64(F.col("b"), F.lit(seed + turn)).alias("h"), F.col("b").alias("id"))
        own = F.struct(F.xxhash64(F.col("a"), F.lit(seed + turn)).alias("h"), F.col("a").alias("id"))
        hooks = stage(both.groupBy("a").agg(F.min(rank).alias("least"))
                      .select(F.col("a").alias("node"), F.least("least", own)["id"].alias("to")), "component-hooks")
        nodes = hooks if nodes is None else stage(_follow(nodes, hooks, "node", "to"), "component-nodes")
        edges = _renamed(_renamed(edges, hooks, "a"), hooks, "b")
        edges = stage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                      .distinct(), "component-edges")
        turn += 1
    if left or nodes is None:
        hooks = stage(edges.coalesce(1).mapInPandas(_joined, "node long, to long"), "component-hooks")
        if nodes is None:
            return hooks.withColumnRenamed("to", "component")
        nodes = stage(_follow(nodes, hooks, "node", "to"), "component-nodes")
    least = stage(nodes.groupBy("to").agg(F.min(F.least("node", "to")).alias("component")), "component-least")
    return nodes.join(least.withColumnRenamed("to", "__to"), F.col("to") == F.col("__to")).select("node", "component")


def _follow(table: DataFrame, hooks: DataFrame, node: str, to: str) -> DataFrame:
    """``to`` replaced by what it hooked to, where it did."""
    nxt = hooks.select(F.col("node").alias("__node"), F.col("to").alias("__to"))
    return table.join(nxt, F.col(to) == F.col("__node"), "left").select(
        node, F.coalesce("__to", to).alias(to))


def _renamed(edges: DataFrame, hooks: DataFrame, end: str) -> DataFrame:
    other = "b" if end == "a" else "a"
    nxt = hooks.select(F.col("node").alias("__node"), F.col("to").alias("__to"))
    return edges.join(nxt, F.col(end) == F.col("__node")).select(F.col("__to").alias(end), other)
