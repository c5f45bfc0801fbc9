"""Connected components of an edge table, in Spark.

Every task first contracts the edges it holds to stars (union-find over its
partition).  Then alternating large-star and small-star steps hang every node's
larger neighbours, then its smaller ones, on the least node it sees, until the
edges are stars over the whole table.  Each step is one aggregation and one join
on the node; rows are two ids, and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlsieve.llm.common import stored


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of one partition as stars (node, least node)."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    ends = [(x, find(x)) for x in list(root)]
    ends = [(x, r) for x, r in ends if x != r]
    for i in range(0, len(ends), 50_000):
        u, v = zip(*ends[i:i + 50_000])
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _stars(edges: DataFrame) -> DataFrame:
    return stored(edges.select("u", "v").mapInArrow(_contract, "u long, v long"), "edges")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from the larger to the smaller end."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _are_stars(edges: DataFrame) -> bool:
    """No end is also a centre, and no end has two centres."""
    ends = edges.select(F.col("u").alias("x"), "v").unionByName(edges.select(F.col("v").alias("x"), F.lit(None).cast("long").alias("v")))
    bad = ends.groupBy("x").agg(F.min("v").alias("a"), F.max("v").alias("b"), F.count_if(F.col("v").isNull()).alias("centre"))
    return bad.where("a is not null and (a <> b or centre > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of `edges` (columns u, v) that differs from
    another one; the component is its least node.  Loops and repeated edges are
    allowed."""
    now = _stars(edges)
    while not _are_stars(now):
        now = _stars(_small_star(_large_star(now)))
    ends = now.groupBy("u").agg(F.min("v").alias("v"))
    return (ends.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()))
