"""Ranked lexical search: documents grouped by the mask of matched terms, masks evaluated from the best bound down.

Terms are runs of ASCII letters and digits and of anything beyond ASCII; only
A-Z are lower-cased.  A term's weight and a document's length factor are the
integers of the contract (:func:`search`).

1. Statistics.  One pass counts the documents with a term, all their terms, and
   the documents that hold each term of the items.
2. Masks.  A second pass cuts each task's documents into blocks.  In a block
   every term of the items is a bitmap over the documents.  An item's bitmaps,
   stacked, give each document its mask of matched terms; equal masks are one
   group, whose bound is the sum of its terms' greatest contributions in the
   block.  Masks are evaluated exactly, by descending bound, until the bound is
   below the score of the item's last place, which is carried from block to
   block; a bound equal to it is still evaluated, for ties go by id.
3. Each task's best rows of an item meet in two steps, first in about the square
   root of the tasks' number of groups, then in one for each item.

Items are taken in blocks of at most ``ITEM_BYTES`` bytes of terms (one item at
least), which the tasks receive whole; each block is one pass of both kinds.

Edge cases: null texts have no term, an item without terms or matches has no
row; rows of ``items`` that share an id are one item with the terms of all; null
item ids are one item; documents with a null id rank after all others of their
score; repeated documents all rank, in an arbitrary but unobservable order;
empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

TOP = 50
ITEM_BYTES = 4 << 20
#: Documents and matched terms held at a time; neither changes a result.
BLOCK_DOCS, BLOCK_MATCHES, CHUNK = 1 << 15, 1 << 21, 256

_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
_KEEP = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_FOLD = bytes((c + 32 if 0x41 <= c <= 0x5A else c) if c in _KEEP else 0x20 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """All terms of a text in order, repeats included."""
    return text.encode().translate(_FOLD).split() if text else []


def weight(docs: int, holding: int) -> int:
    """floor(1000 ln((2 N + 2) / (2 df + 1)))."""
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * holding + 1)))


# --- statistics ---------------------------------------------------------------------------------


def _item_blocks(items: DataFrame, key: str) -> Iterator[list[tuple[object, list[bytes]]]]:
    """Lists of (item, its distinct terms in order), of bounded size; read from the stored items one partition at a time."""
    block, held = [], 0
    for row in items.groupBy(key).agg(F.collect_set("text").alias("texts")).orderBy(key).toLocalIterator():
        own = sorted({t for text in row["texts"] for t in terms(text)})
        size = sum(map(len, own))
        if block and held + size > ITEM_BYTES:
            yield block
            block, held = [], 0
        if own:
            block.append((row[key], own))
            held += size
    if block:
        yield block


def statistics(docs: DataFrame, vocabulary: list[bytes]) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the number of documents that hold each term of the vocabulary."""
    number = {t: k for k, t in enumerate(vocabulary)}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, holding = 0, 0, np.zeros(len(number), np.int64)
        for batch in batches:
            for text in batch.column(0):
                if own := terms(text.as_py()):
                    count, total = count + 1, total + len(own)
                    for k in {number[t] for t in set(own) & number.keys()}:
                        holding[k] += 1
        some = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([pa.array(np.append([-2, -1], some)), pa.array(np.append([count, total], holding[some]))], ["k", "c"])

    sums = dict(docs.select("text").mapInArrow(task, "k long, c long").groupBy("k").agg(F.sum("c").cast("long")).collect())
    holding = np.zeros(len(number), np.int64)
    for k, c in sums.items():
        if k >= 0:
            holding[k] = c
    return sums.get(-2, 0), sums.get(-1, 0), holding


# --- one block of documents ---------------------------------------------------------------------


class Block:
    """The matches of a block of documents, term by term: documents in ascending order and their contributions."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray, weights: np.ndarray):
        order = np.lexsort((doc, term))
        self.doc, term, tf = doc[order], term[order], tf[order]
        self.gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[self.doc]))
        self.start = np.searchsorted(term, np.arange(len(weights) + 1))
        self.size = len(m)
        #: Greatest contribution of each term in this block.
        self.best = np.zeros(len(weights), np.int64)
        np.maximum.at(self.best, term, self.gain)

    def masks(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bound of each distinct mask over the terms ``own``, and the group of each document; the empty mask has bound 0."""
        own = own[self.start[own + 1] > self.start[own]]  # a term that is not in the block divides nothing
        group, bound = np.zeros(self.size, np.int64), np.zeros(1, np.int64)
        for c in range(0, len(own), 64):
            part = own[c : c + 64]
            bits = np.zeros((64, self.size), bool)
            for row, t in enumerate(part.tolist()):
                bits[row, self.doc[self.start[t] : self.start[t + 1]]] = True
            word = np.ascontiguousarray(np.packbits(bits, axis=0).T).view(np.uint64).ravel()
            values, one, name = np.unique(word, return_index=True, return_inverse=True)
            gain = bits[: len(part), one].T @ self.best[part]
            if not c:
                group, bound = name, gain
                continue
            _, one, refined = np.unique(group * len(values) + name, return_index=True, return_inverse=True)
            bound, group = bound[group[one]] + gain[name[one]], refined
        return bound, group

    def scores(self, own: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Exact scores of some documents (ascending)."""
        out = np.zeros(len(docs), np.int64)
        for t in own.tolist():
            a, b = self.start[t], self.start[t + 1]
            held = self.doc[a:b]
            at = np.minimum(np.searchsorted(held, docs), max(0, len(held) - 1))
            if len(held):
                out += np.where(held[at] == docs, self.gain[a:b][at], 0)
        return out


def _better(score: np.ndarray, rank: np.ndarray, top: int) -> np.ndarray:
    return np.lexsort((rank, -score))[:top]


def best_of(block: Block, own: np.ndarray, floor: int, rank: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The best documents of a block (highest score, then lowest ``rank``) with a score of at least ``floor`` and above 0."""
    bound, group = block.masks(own)
    groups = np.flatnonzero(bound >= max(1, floor))
    groups = groups[np.argsort(-bound[groups], kind="stable")]
    place = np.full(len(bound), len(groups))
    place[groups] = np.arange(len(groups))
    turn = place[group]
    order = np.argsort(turn, kind="stable")[: np.count_nonzero(turn < len(groups))]
    turn = turn[order]
    docs, score = np.empty(0, np.int64), np.empty(0, np.int64)
    at = 0
    while at < len(order) and bound[group[order[at]]] >= floor:
        end = int(np.searchsorted(turn, turn[min(at + CHUNK, len(order)) - 1], "right"))  # whole masks
        chunk = np.sort(order[at:end])
        docs, score = np.concatenate([docs, chunk]), np.concatenate([score, block.scores(own, chunk)])
        keep = _better(score, rank[docs], top)
        docs, score = docs[keep], score[keep]
        if len(docs) == top:
            floor = max(floor, int(score[-1]))
        at = end
    good = (score > 0) & (score >= floor)
    return docs[good], score[good]


# --- the whole table ----------------------------------------------------------------------------


def _candidates(docs: DataFrame, key: str, block: list[tuple[object, list[bytes]]], top: int) -> DataFrame:
    """item (its place in the block), key, score: each task's best documents."""
    vocabulary = sorted({t for _, own in block for t in own})
    count, total, holding = statistics(docs, vocabulary)
    weights = np.array([weight(count, int(h)) for h in holding], np.int64)
    number = {t: k for k, t in enumerate(vocabulary)}
    queries = [np.array([number[t] for t in own]) for _, own in block]
    rows = docs.select(F.col(key).alias("key"), "text")
    kind = rows.schema["key"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[list, np.ndarray]] = [([], np.empty(0, np.int64)) for _ in queries]
        keys: list = []
        lengths: list[int] = []
        doc, term, tf = [], [], []

        def close() -> None:
            m = 50 + (50 * np.array(lengths, np.int64) * count) // total
            flat = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (doc, term, tf)]
            held = Block(*flat, m, weights)
            order = sorted(range(len(keys)), key=lambda i: (keys[i] is None, keys[i] if keys[i] is not None else 0))
            rank = np.empty(len(keys), np.int64)
            rank[order] = np.arange(len(keys))
            for q, own in enumerate(queries):
                ids, scores = best[q]
                floor = int(scores[-1]) if len(ids) == top else 1
                found, score = best_of(held, own, floor, rank, top)
                if len(found):
                    both = sorted(zip([*ids, *(keys[i] for i in found.tolist())], [*scores.tolist(), *score.tolist()]), key=lambda x: (-x[1], x[0] is None, x[0] if x[0] is not None else 0))[:top]
                    best[q] = [b[0] for b in both], np.array([b[1] for b in both], np.int64)
            for x in (keys, lengths, doc, term, tf):
                x.clear()

        matches = 0
        for batch in batches:
            for own_key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = terms(text.as_py())
                if not own:
                    continue
                known = np.array([k for k in map(number.get, own) if k is not None], np.int64)
                held, times = np.unique(known, return_counts=True)
                doc.append(np.full(len(held), len(keys), np.int64))
                term.append(held)
                tf.append(times)
                keys.append(own_key)
                lengths.append(len(own))
                matches += len(held)
                if len(keys) >= BLOCK_DOCS or matches >= BLOCK_MATCHES:
                    close()
                    matches = 0
        if keys:
            close()
        out = [(q, k, s) for q, (ids, scores) in enumerate(best) for k, s in zip(ids, scores.tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], _ARROW[kind]), pa.array([o[2] for o in out], pa.int64())], ["item", "key", "score"]
        )

    return rows.mapInArrow(task, f"item int, key {kind}, score long")


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", item_key: str = "item_id", top: int = TOP) -> DataFrame:
    """item_key, rank, key, score: each item's ``top`` documents with a score above 0, equal scores by ascending key.

    A score sums, over the item's distinct terms, weight * ((10**9 tf) div
    (1000 tf + 20 m)) with m = 50 + (50 n N) div L: n terms in the document, L in
    all N documents that have one.
    """
    kinds = {f.name: f.dataType.simpleString() for f in (docs.schema[key], items.schema[item_key])}
    if kinds[key] not in _ARROW:
        raise TypeError(f"{key} must be one of {', '.join(_ARROW)}, not {kinds[key]}")
    spark, found = docs.sparkSession, None
    for block in _item_blocks(items, item_key):
        own = settle(_candidates(docs, key, block, top).withColumn("part", F.spark_partition_id()), "candidates")
        parts = own.agg(F.coalesce(F.max("part"), F.lit(0))).first()[0] + 1
        order = [F.col("score").desc(), F.col("key").asc_nulls_last()]
        first = Window.partitionBy("item", "salt").orderBy(*order)
        best = own.withColumn("salt", F.col("part") % max(1, math.isqrt(parts))).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
        names = spark.createDataFrame([(q, name) for q, (name, _) in enumerate(block)], f"item int, name {kinds[item_key]}")
        ranked = best.join(names, "item").select(F.col("name").alias(item_key), "rank", F.col("key").alias(key), "score")
        found = ranked if found is None else found.unionAll(ranked)
    if found is None:
        found = spark.createDataFrame([], f"{item_key} {kinds[item_key]}, rank int, {key} {kinds[key]}, score long")
    return found
