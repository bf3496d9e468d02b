"""Helpers shared by the operators: words, stored tables, numbering, connected components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle, settle_from

#: A word is a run of anything but ASCII white space; the same set that ``bytes.split()`` uses.
WORD = r"[^\x20\x09-\x0D]+"

__all__ = ["WORD", "components", "free_name", "group_roots", "numbered", "runs", "settle", "settle_from", "word_count"]


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of name_1, name_2, ... that is no column of ``df`` (in any case)."""
    taken, n, found = {c.lower() for c in df.columns}, 0, name
    while found.lower() in taken:
        n += 1
        found = f"{name}_{n}"
    return found


def numbered(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Rows with ``name``, their 0-based place in the total order, without one global sort task.

    Rows are dealt by range, numbered inside each range, and shifted by the
    counts of the earlier ranges (one row for each range).  The ordered rows are
    stored, so that numbers and counts come from the same division.
    """
    dealt = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    inside = settle(dealt.withColumn(name, F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1), name)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = inside.groupBy("_range").count().select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    return inside.join(starts, "_range").withColumn(name, (F.col(name) + F.col("_start")).cast("long")).drop("_range", "_start")


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of equal neighbours in a one-dimensional array."""
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cut = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return np.concatenate([[0], cut]), np.concatenate([cut, [len(keys)]])


def group_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 with links a-b: the smallest node of each node's component."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        low = np.minimum(ra, rb)
        np.minimum.at(root, ra, low)
        np.minimum.at(root, rb, low)
        while True:
            deeper = root[root]
            if np.array_equal(deeper, root):
                break
            root = deeper
        left = root[a] != root[b]
        a, b = a[left], b[left]
    return root


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b): root is the smallest node of its component.

    Alternating star contraction: each round links a node's larger neighbours,
    then its smaller ones, to its least neighbour.  Every round is two shuffles
    with a map-side minimum; the links are stored between rounds, which cuts the
    lineage, and the loop ends when a round changes nothing.  Nothing but one
    count and one checksum a round reaches the driver.
    """
    def both(e: DataFrame) -> DataFrame:
        return e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(e.select(F.col("b").alias("u"), F.col("a").alias("v")))

    def mark(e: DataFrame):
        row = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        return tuple(row)

    edges = settle(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = mark(edges)
    for _ in range(most_rounds):
        if not seen[0]:
            break
        wide = both(edges)
        least = wide.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = wide.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(small, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = settle(linked.unionAll(small.select("a", F.col("m").alias("b"))).where("a != b").distinct(), "links")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    tops = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(tops)
