"""Connected components of a link table: parts contracted in tasks, then alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import skew_join, written

PART_LINKS = 1 << 20             # links that a task holds at once


def _contract(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """The links' forest of stars: every node but the smallest of its component, linked to that one."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    low = root != np.arange(len(nodes))
    return pa.RecordBatch.from_arrays([pa.array(nodes[low]), pa.array(nodes[root[low]])], names=["a", "b"])


def _contract_parts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Contract at most ``most`` links (and one batch) at a time."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= most:
            yield _contract(*(np.concatenate([h.column(i).to_numpy() for h in held]) for i in range(2)))
            held, n = [], 0
    if n:
        yield _contract(*(np.concatenate([h.column(i).to_numpy() for h in held]) for i in range(2)))


def _is_star_forest(edges: DataFrame) -> bool:
    """Every node has one link down, and what it links to has none."""
    n = edges.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("a").alias("d")).first()
    if n["n"] != n["d"]:
        return False
    return not edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").take(1)


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = (both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
             .select("a", F.least("a", "m").alias("m"), "n"))
    up = both.filter(F.col("b") > F.col("a"))
    return (skew_join(up, least, ["a"], "n", 2 * total)
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct())


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
    joined = skew_join(edges, least, ["a"], "n", total)
    return (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(joined.select("a", F.col("m").alias("b"))).filter("a > b").distinct())


def _contracted(edges: DataFrame, part_links: int) -> tuple[DataFrame, bool]:
    """The written links with every part of ``part_links`` contracted, and whether one part held them all."""
    parts = -(-edges.count() // part_links)
    table = edges.coalesce(max(1, parts)).mapInArrow(lambda it: _contract_parts(it, 2 * part_links), "a long, b long")
    return written(table if parts <= 1 else table.distinct(), "links"), parts <= 1


def components(edges: DataFrame, part_links: int = PART_LINKS) -> DataFrame:
    """(node, component) for every node of the links ``(a, b)``, longs; a component is its smallest node.

    Links live in written tables of the shared folder; only counts reach the
    driver.  Before the first and after each pair of star steps, tasks contract
    parts of about ``part_links`` links (twice that and one batch at most are
    held) to stars, which shortens paths; links of one part are done then.
    Rounds grow with the logarithm of the longest path.
    """
    edges = written(edges.select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b"))
                    .filter("a > b").distinct(), "links")
    edges, whole = _contracted(edges, part_links)
    while not whole and not _is_star_forest(edges):
        edges = written(_large_star(edges, max(1, edges.count())), "links")
        edges = written(_small_star(edges, max(1, edges.count())), "links")
        edges, whole = _contracted(edges, part_links)
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
