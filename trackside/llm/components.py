"""Connected components of links, by alternating stars."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackside.session import forget, landed

#: Links that one task joins by itself; the memory for them is bounded, however many there are in all.
SLICE = 100_000


def _joined(links: DataFrame, slices: int) -> DataFrame:
    """The links of each slice as stars: its nodes and the smallest node that the slice's links lead to."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict = {}

        def top(node):
            while up.setdefault(node, node) != node:
                up[node] = node = up[up[node]]
            return node

        kind = None
        for batch in batches:
            kind = batch.schema
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                a, b = top(a), top(b)
                up[max(a, b)] = min(a, b)
        nodes = list(up)
        for at in range(0, len(nodes), 10_000):
            part = nodes[at : at + 10_000]
            ends = [top(node) for node in part]
            yield pa.RecordBatch.from_arrays([pa.array(part, kind.field("a").type), pa.array(ends, kind.field("b").type)], names=["a", "b"])

    return links.repartition(slices).mapInArrow(rows, links.schema).filter("a <> b")


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest one in the node's neighbourhood."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return both.join(least, F.col("a") == F.col("u")).filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them. Links run from larger to smaller."""
    least = links.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
    moved = links.join(least, F.col("a") == F.col("u")).filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of undirected links (a, b); the component is its smallest node.

    Links are dealt out in slices of bounded size and each is joined by a task first. If there are several
    slices, rounds of stars join what they leave. There minima are taken per task first and joined back, so a
    node with very many links is no single group. Each round is written to the shared folder, which cuts its
    lineage.
    """
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    now, state = landed(now, "links"), None
    slices = max(1, math.ceil(now.count() / SLICE))
    before, now = now, landed(_joined(now, slices), "links")
    forget(before)
    while slices > 1:
        before, now = now, landed(_small_star(_large_star(now)), "links")
        forget(before)
        told = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if told == state:
            break
        state = told
    found = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = found.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
    found._landed = now._landed  # for whoever has written the result
    return found
