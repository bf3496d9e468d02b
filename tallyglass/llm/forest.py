"""Near-duplicate embeddings by a forest of random-projection trees.

Trees are fitted on a bounded sample (``sample`` vectors by the order of a hash of
their content), every vector is indexed.  A node draws random directions and takes the cut with the
fewest vectors near it; vectors within the spill margin go to both sides.  A
node stays a leaf when it is small, when most of its pairs are already within
the threshold, or when no cut divides it.  Leaves are compared whole, in blocks,
in double precision.  A pair that meets in several leaves counts in the first of
them only, which both vectors can tell from their lists of leaves; so counts add
up without any pair being stored, and a leaf yields one row per vector.

Leaves that the sample leaves too full (more than twice ``leaf`` vectors) are split
again in rounds, each by a tree fitted on about ``SPLIT`` of its own vectors, until
they are small or no cut divides them; so the comparisons grow with the table, not
with its square.  The vectors of such a leaf pass its tree in slices.

Exact copies are one class first.  A leaf with more than ``most`` classes is
dealt out as pairs of blocks, so no task holds more than two blocks.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing, as do rows with a null id (component null, not
kept); vectors of different lengths never link; rows that repeat an id are
vectors of their own with that id; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, group_roots, settle

TREES, LEAF, SAMPLE = 5, 512, 50_000
#: Sample of a full leaf that is split again, and vectors that pass its tree together.
SPLIT, SLICE = 4096, 20_000


def grow(x: np.ndarray, threshold: float, leaf: int, rng: np.random.Generator) -> tuple | None:
    """A tree over unit vectors: (direction, cut, margin, left, right), None for a leaf."""
    n, width = x.shape
    if n <= leaf:
        return None
    reach = math.sqrt(max(2 * (1 - threshold), 1e-12))  # distance of vectors at the threshold
    if 2 * np.maximum(x.var(axis=0), 0).sum() <= reach**2:  # mean squared distance of two members
        return None
    margin = 0.5 * reach / math.sqrt(width)
    best = None
    for _ in range(8):
        direction = rng.standard_normal(width)
        direction /= np.linalg.norm(direction)
        at = np.sort(x @ direction)
        for q in np.linspace(0.2, 0.8, 7):
            cut = at[int(q * (n - 1))]
            near = np.searchsorted(at, cut + margin) - np.searchsorted(at, cut - margin)
            score = near / n + 0.2 * abs(q - 0.5)
            if best is None or score < best[0]:
                best = (score, near, direction, cut)
    _, near, direction, cut = best
    side = x @ direction
    left, right = x[side < cut + margin], x[side >= cut - margin]
    if near > 0.5 * n or max(len(left), len(right)) > 0.95 * n:
        return None
    return direction, float(cut), margin, grow(left, threshold, leaf, rng), grow(right, threshold, leaf, rng)


def leaves(tree: tuple | None, x: np.ndarray) -> list[np.ndarray]:
    """Rows of ``x`` in each leaf, leaves in the tree's order."""

    def walk(node, rows):
        if node is None:
            yield rows
            return
        side = x[rows] @ node[0]
        yield from walk(node[3], rows[side < node[1] + node[2]])
        yield from walk(node[4], rows[side >= node[1] - node[2]])

    return list(walk(tree, np.arange(len(x))))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of one length as unit rows in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)  # keeps squares of huge components finite
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def compare(x: np.ndarray, weight: np.ndarray, lists: list, cell: int, threshold: float, side: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """For each member: linked vectors first met in this leaf, and the first member of its connected part.

    ``lists`` holds each member's leaves; ``side`` limits pairs to those across two blocks.
    """
    n = len(x)
    earlier = sorted({c for own in lists for c in own if c < cell})
    place = {c: i for i, c in enumerate(earlier)}
    member = np.zeros((n, max(1, len(earlier))), np.float32)
    for i, own in enumerate(lists):
        for c in own:
            if c < cell:
                member[i, place[c]] = 1
    counts, a, b = np.zeros(n, np.int64), [], []
    root = np.arange(n)
    for i in range(0, n, 512):
        near = x[i : i + 512] @ x.T >= threshold
        near[np.arange(len(near)), np.arange(i, i + len(near))] = False
        if side is not None:
            near &= side[i : i + 512, None] != side[None, :]
        p, q = np.nonzero(near)
        if not len(p):
            continue
        a, b = root[p + i], root[q]
        root = group_roots(n, np.concatenate([np.arange(n), a]), np.concatenate([root, b]))
        new = near & (member[i : i + 512] @ member.T == 0)
        counts[i : i + 512] = new @ weight
    return counts, root


def near_duplicates(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", threshold: float = 0.9, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE, most: int = 8192, seed: int = 7) -> DataFrame:
    """key, n_links, component_id, kept for each row."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).alias("key"), F.col(column).cast("array<double>").alias("v"))
    sound = F.col("key").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    usable = rows.withColumn("ok", F.coalesce(sound, F.lit(False)))
    classes = settle(
        usable.where("ok").groupBy("v").agg(F.count("*").alias("weight"), F.min("key").alias("first")).withColumn("cid", F.monotonically_increasing_id()), "classes"
    )
    total, widths = classes.count(), [r[0] for r in classes.select(F.size("v")).distinct().collect()]
    links = counts = None
    base = 0  # leaves are numbered through all trees and lengths
    for width in widths:  # nearly always one
        own = classes.where(F.size("v") == width)
        drawn = own.orderBy(F.xxhash64("v", F.lit(seed)), "v").limit(sample).select("v").toArrow()
        x = _matrix(drawn.column("v").combine_chunks(), width)
        enough = max(32, min(leaf, leaf * len(x) // max(1, total)))
        forest = [grow(x, threshold, enough, np.random.default_rng([seed, t])) for t in range(trees)]
        met = spark.sparkContext.broadcast((forest, base, [_stuck(t, x, enough) for t in forest]))
        base += sum(len(leaves(t, x[:1])) for t in forest)
        placed = _divide(settle(_place(own, met, width), "leaves"), width, threshold, leaf, seed)
        sizes = placed.groupBy("cell").count()
        blocks = settle(sizes.select("cell", F.ceil(F.col("count") / most).cast("int").alias("blocks")).where("blocks > 1"), "blocks")
        dealt = _deal(placed, blocks)
        found = settle(dealt.groupBy("cell", "bi", "bj").applyInPandas(_leaf_task(width, threshold), "cid long, root long, n long"), "met")
        links = found.select(F.col("cid").alias("a"), F.col("root").alias("b")) if links is None else links.unionAll(found.select("cid", "root"))
        more = found.groupBy("cid").agg(F.sum("n").alias("n"))
        counts = more if counts is None else counts.unionAll(more)
    if links is None:
        return rows.select(F.col("key").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"), F.col("key").isNotNull().alias("kept"))
    roots = components(links).select(F.col("node").alias("cid"), "root")
    named = classes.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid")).join(counts, "cid", "left")
    least = named.groupBy("root").agg(F.min("first").alias("component"))
    named = named.join(least, "root").select(F.col("v").alias("_v"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component")
    out = usable.join(named, F.col("ok") & (F.col("v") == F.col("_v")), "left")
    component = F.coalesce("component", "key")
    return out.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"),
    )


def _stuck(tree: tuple | None, x: np.ndarray, enough: int) -> list[bool]:
    """For each leaf, whether it is large because no cut divides it."""
    return [len(rows) > enough for rows in leaves(tree, x)]


def _place(own: DataFrame, met, width: int) -> DataFrame:
    """A row for each class and leaf it falls in, with the list of all its leaves; done if the leaf can't be split."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, base, stuck = met.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(2), width)
            lists, at, pairs = [[] for _ in range(len(x))], base, []
            for tree, large in zip(forest, stuck):
                for rows, done in zip(leaves(tree, x), large):
                    for i in rows.tolist():
                        lists[i].append(at)
                    pairs.append((at, rows, done))
                    at += 1
            size = [len(r) for _, r, _ in pairs]
            cell, done = np.repeat([c for c, _, _ in pairs], size), np.repeat([d for _, _, d in pairs], size)
            order = np.concatenate([r for _, r, _ in pairs])
            take = batch.take(pa.array(order))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell.astype(np.int64)), *take.columns, pa.array([lists[i] for i in order.tolist()], pa.list_(pa.int64())), pa.array(done)],
                ["cell", "cid", "weight", "v", "lists", "done"],
            )

    return own.select("cid", "weight", "v").mapInArrow(task, "cell long, cid long, weight long, v array<double>, lists array<long>, done boolean")


def _divide(placed: DataFrame, width: int, threshold: float, leaf: int, seed: int, most_rounds: int = 40) -> DataFrame:
    """``placed`` with its full leaves split; what is still full after all rounds is compared whole, in blocks."""

    def full(rows: DataFrame) -> DataFrame:
        return settle(rows.where("NOT done").groupBy("cell").count().where(F.col("count") > 2 * leaf), "full")

    crowded = full(placed)
    if crowded.isEmpty():
        return placed.drop("done")
    active, small = placed.drop("lists"), []
    for turn in range(most_rounds):
        small.append(active.join(crowded.select("cell"), "cell", "left_anti"))
        active = settle(_split(active, crowded, width, threshold, leaf, [seed, turn]), "leaves")
        crowded = full(active)
        if crowded.isEmpty():
            break
    for part in small:
        active = active.unionByName(part)
    lists = active.groupBy("cid").agg(F.collect_list("cell").alias("lists"))
    return settle(active.drop("done").join(lists, "cid"), "leaves").select("cell", "cid", "weight", "v", "lists")


def _split(rows: DataFrame, crowded: DataFrame, width: int, threshold: float, leaf: int, seed: list[int]) -> DataFrame:
    """cell, cid, weight, v, done of the vectors of full leaves (``crowded``: cell, count) in the leaves of each one's own tree.

    New leaves are named by a hash; two that shared a name would be compared as one, which is right as well.
    """

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        cell, count = int(group["cell"].iloc[0]), int(group["count"].iloc[0])
        x = _unit(group["v"], width)
        enough = max(32, min(leaf, leaf * len(x) // count))
        tree = grow(x, threshold, enough, np.random.default_rng([*seed, cell % 2**64]))
        return pd.DataFrame({"cell": [cell], "tree": [pickle.dumps((tree, _stuck(tree, x, enough)))]})

    def deal(members: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        if not len(members) or not len(trees):  # no vector was drawn: the leaf stays
            return members[["cell", "cid", "weight", "v"]].assign(done=True)
        tree, stuck = pickle.loads(trees["tree"].iloc[0])
        parts, cell = [], int(members["cell"].iloc[0])
        for i, (own, done) in enumerate(zip(leaves(tree, _unit(members["v"], width)), stuck)):
            name = np.uint64(xxhash.xxh64_intdigest(f"{cell}/{i}")).astype(np.int64)
            parts.append(members.iloc[own][["cell", "cid", "weight", "v"]].assign(cell=name, done=done))
        return pd.concat(parts)

    rows = rows.select("cell", "cid", "weight", "v").join(crowded, "cell")
    part = F.pmod(F.xxhash64("v", *map(F.lit, seed)), F.lit(2**31)) < F.lit(SPLIT * 2.0**31) / F.col("count")
    trees = settle(rows.where(part).select("cell", "count", "v").groupBy("cell").applyInPandas(fit, "cell long, tree binary"), "trees")
    slices = F.ceil(F.col("count") / SLICE)
    sliced = rows.select("cell", "cid", "weight", "v", F.pmod(F.xxhash64("cid"), slices).alias("slice"))
    spread = crowded.join(trees, "cell").select(F.col("cell").alias("full"), "tree", F.explode(F.sequence(F.lit(0).cast("long"), slices - 1)).alias("share"))
    both = sliced.groupBy("cell", "slice").cogroup(spread.groupBy("full", "share"))
    return both.applyInPandas(deal, "cell long, cid long, weight long, v array<double>, done boolean")


def _deal(placed: DataFrame, blocks: DataFrame) -> DataFrame:
    """Leaf rows keyed by (cell, bi, bj): small leaves once, large ones for every pair of blocks."""
    wide = placed.join(blocks, "cell", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("cid", F.lit("block")), F.col("blocks")).cast("int")
    spread = wide.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return spread.select("cell", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"), "block", "cid", "weight", "v", "lists")


def _unit(vectors: pd.Series, width: int) -> np.ndarray:
    """Vectors of one length as unit rows."""
    x = np.array(vectors.tolist(), np.float64).reshape(-1, width)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _leaf_task(width: int, threshold: float):
    def task(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("cid")
        x = _unit(group["v"], width)
        cell, across = int(group["cell"].iloc[0]), group["bi"].iloc[0] != group["bj"].iloc[0]
        cid = group["cid"].to_numpy()
        n, root = compare(x, group["weight"].to_numpy(), [list(c) for c in group["lists"]], cell, threshold, group["block"].to_numpy() if across else None)
        out = pd.DataFrame({"cid": cid, "root": cid[root], "n": n})
        return out[(out["n"] > 0) | (out["cid"] != out["root"])]

    return task
