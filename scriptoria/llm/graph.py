"""Connected components of a graph that is a DataFrame of links."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptoria.llm.common import cut_lineage

#: Distinct links up to which one task follows them; more are joined over the cluster, to the same result.
ONE_TASK_LINKS = 100_000


def components(links: DataFrame, one_task_links: int = ONE_TASK_LINKS) -> DataFrame:
    """(node, root) of all nodes in `links` (a, b); root is the least node that can be reached."""
    both = links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    edges = cut_lineage(both)
    if edges.count() <= one_task_links:
        kind = links.schema["a"].dataType.simpleString()
        return edges.repartition(1).mapInPandas(_followed, f"node {kind}, root {kind}")
    return _stars(edges)


def _followed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find; the least node of each component is its root."""
    root: dict[int | bytes, int | bytes] = {}

    def find(x: int | bytes) -> int | bytes:
        top = x
        while root.setdefault(top, top) != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for frame in frames:
        for hi, lo in zip(frame["hi"].tolist(), frame["lo"].tolist(), strict=True):
            a, b = find(hi), find(lo)
            root[max(a, b)] = min(a, b)
    nodes = list(root)
    yield pd.DataFrame({"node": nodes, "root": [find(x) for x in nodes]}, dtype=None if nodes and isinstance(nodes[0], bytes) else "int64" if nodes else object)


def _stars(edges: DataFrame) -> DataFrame:
    """Large-star and small-star steps by turns: each node tells its larger (smaller) neighbours of the least of them all, until no link changes.

    Hubs are summed up in the tasks first, and the joins back are of a kind that Spark splits where a key is
    hot. Each step is written to the shared folder, as Spark splits joins of plain inputs only.
    """
    seen = None
    while True:
        # large star: every node's larger neighbours go to its least neighbour (or itself)
        out = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = cut_lineage(out.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")))
        large = cut_lineage(out.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct())
        # small star: every node and its smaller neighbours go to the least of these
        down = cut_lineage(large.groupBy("hi").agg(F.min("lo").alias("m")))
        small = large.join(down, "hi").select(F.col("lo").alias("u"), F.col("m").alias("v")).union(down.select(F.col("hi").alias("u"), F.col("m").alias("v")))
        edges = cut_lineage(small.where("u <> v").select(F.col("u").alias("hi"), F.col("v").alias("lo")).distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    roots = edges.groupBy("hi").agg(F.min("lo").alias("root"))
    return roots.select(F.col("hi").alias("node"), "root").union(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
