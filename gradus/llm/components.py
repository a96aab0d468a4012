"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradus.llm.staging import Stage


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one partition: each node with its smallest one."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    nodes = [(x, find(x)) for x in list(parent)]
    nodes = [(x, root) for x, root in nodes if x != root]
    yield pa.RecordBatch.from_arrays(
        [pa.array([p[i] for p in nodes], pa.int64()) for i in (0, 1)], names=["u", "v"]
    )


def components(links: DataFrame, stage: Stage) -> DataFrame:
    """(node, component): every linked node with the smallest node it can reach.

    ``links`` are pairs of longs in its first two columns. Union-find first contracts the
    links of each partition to a forest; the forests are then joined by alternating star
    contraction (every node's neighbours are hung on the smallest of them), a table in
    the shared folder after each step, until nothing changes. Links to one hub are
    minimised before they are shuffled, and joins on a hub are left to AQE's skew split.
    """
    a, b = links.columns[:2]
    edges = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    edges = stage.write(edges.where("u <> v").mapInArrow(_forest, "u long, v long").distinct())
    before = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m"))
        smallest = smallest.select("u", F.least("u", "m").alias("m"))
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        roots = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(roots, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = stage.write(small.union(roots.select("u", F.col("m").alias("v"))).distinct())
        after = new.agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")
        ).first()
        stage.drop(edges)
        edges = new
        if after == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = after
