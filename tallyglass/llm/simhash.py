"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: A-Z lower-cased, words joined to 3-word shingles, XXH64 (seed 42)
of each shingle; a bit is 1 if it is set in over half of the hashes.

Candidates: the 64 bits are cut into partitions, correlated bits together, and
partition i gets a threshold t_i with sum(t_i) = limit - partitions + 1; two
fingerprints within ``limit`` bits then differ by at most t_i in some partition
i.  The number of partitions and the thresholds come from a dynamic program over
estimated candidate counts (bit frequencies of all fingerprints, scaled by the
exact number of collisions of each partition).  A key is the partition's bits;
a fingerprint is probed with all keys within t_i bits of its own.

Keys shared by more than ``most`` fingerprints are divided again: the bits
outside the key fall into limit + 1 blocks, one of which must agree, so each
member moves to limit + 1 longer keys.  Fingerprints are distinct, so this ends;
no group exceeds ``most`` and nothing is dropped.  Each group is verified in
blocks and yields links to the least member of each of its parts, not all pairs.

Edge cases: null and empty texts have fingerprint 0 and link like any other;
texts with fewer than three words are one shingle; rows that repeat text share a
fingerprint; null ids take part, and a group's id is its smallest non-null id;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, group_roots, runs, settle, settle_from

BITS = 64
#: Candidate comparisons that cost as much as one more stored probe row.
PROBE_COST = 20
_BYTE_BITS = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def shingle_hashes(text: bytes | None, width: int = 3) -> np.ndarray:
    """Hash of each shingle of ``width`` words; a shorter text is one shingle."""
    words = text.lower().split() if text else []
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    if n < width:
        shingles = [line]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
        starts = np.concatenate([[0], ends[:-width]])
        shingles = [line[a:b] for a, b in zip(starts.tolist(), (ends[width - 1 :] - 1).tolist())]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, 42) for s in shingles), np.uint64, len(shingles))


def fingerprint(text: bytes | None) -> int:
    hashes = shingle_hashes(text)
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 14):  # bounded memory for long texts
        part = hashes[i : i + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, text_hash, fp (the 64 bits as a long) of each whole text; one pass, nothing shuffled."""
    rows = docs.select(F.col(key).alias("key"), F.xxhash64("text").alias("text_hash"), "text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t) for t in batch.column(2).cast(pa.binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(fps.view(np.int64))], ["key", "text_hash", "fp"])

    return rows.mapInArrow(task, f"key {rows.schema['key'].dataType.simpleString()}, text_hash long, fp long")


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of differing bits, element by element."""
    x = np.ascontiguousarray(np.bitwise_xor(a, b))
    return _BYTE_BITS[x.view(np.uint8)].reshape(*x.shape, 8).sum(axis=-1, dtype=np.uint8)


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how often each pair of bits is set together: 64 x 64 numbers, summed by Spark."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            own = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False))
            bits = np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
            total += bits.T @ bits
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS)), pa.array(total.ravel().astype(np.int64))], ["cell", "n"])

    cells = fps.select("fp").mapInArrow(task, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    together = np.zeros(BITS * BITS)
    for cell, n in cells.collect():  # 4096 rows, whatever the input
        together[cell] = n
    return fps.count(), together.reshape(BITS, BITS)


def partition_bits(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` sets of nearly equal size; each set is grown by the bit most correlated with it."""
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    tie = np.abs(together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    left, out = list(range(BITS)), []
    for i in range(parts):
        width = BITS // parts + (i < BITS % parts)
        own = [max(left, key=lambda b: (tie[b, left].sum(), -b))]
        left.remove(own[0])
        while len(own) < width:
            own.append(max(left, key=lambda b: (tie[b, own].sum(), -b)))
            left.remove(own[-1])
        out.append(sorted(own))
    return out


def within(n: int, together: np.ndarray, bits: list[int], limit: int) -> list[float]:
    """Estimated share of pairs that differ by at most 0, 1, .. ``limit`` of these bits, from the bits' frequencies."""
    p = np.diag(together)[bits] / max(n, 1)
    chance = [1.0] + [0.0] * limit
    for d in 2 * p * (1 - p):
        chance = [chance[e] * (1 - d) + (chance[e - 1] * d if e else 0.0) for e in range(limit + 1)]
    return list(itertools.accumulate(chance))


def allocate(cost: list[list[float]], limit: int) -> tuple[float, list[int]]:
    """Thresholds, -1 or more, with sum limit - partitions + 1 and the least total cost; cost[i][e] is for threshold e >= 0."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        best_next: dict[int, tuple[float, list[int]]] = {}
        for used, (total, chosen) in best.items():
            for e in range(-1, limit + 1):
                now = (total + (row[e] if e >= 0 else 0.0), [*chosen, e])
                if used + e not in best_next or now < best_next[used + e]:
                    best_next[used + e] = now
        best = best_next
    return best[limit - len(cost) + 1]


def costs(n: int, shares: list[list[float]], widths: list[int], scale: list[float]) -> list[list[float]]:
    """Candidates plus weighted probe rows of each partition and threshold."""
    pairs = n * n / 2
    balls = lambda w, e: sum(math.comb(w, i) for i in range(e + 1))
    return [[pairs * s * f + PROBE_COST * n * balls(w, e) for e, s in enumerate(row)] for row, w, f in zip(shares, widths, scale)]


def _mask(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >= 1 << 63 else value


def plan(fps: DataFrame, limit: int) -> list[tuple[list[int], int]]:
    """The chosen partitions, as bit lists, with their thresholds."""
    n, together = bit_statistics(fps)
    options = {}
    for parts in range(1, limit + 3):
        sets = partition_bits(n, together, parts)
        shares = [within(n, together, s, limit) for s in sets]
        options[parts] = (allocate(costs(n, shares, [len(s) for s in sets], [1.0] * parts), limit)[0], sets, shares)
    _, sets, shares = min(options.values(), key=lambda x: x[0])
    # The exact number of colliding pairs of each partition corrects for what single frequencies miss.
    values = fps.select(F.explode(F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_mask(s))).alias("value")) for i, s in enumerate(sets)])).alias("x"))
    tally = values.groupBy("x.part", "x.value").count().groupBy("part").agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2).alias("pairs"))
    met = dict(tally.collect())
    pairs = max(n * n / 2, 1)
    scale = [max(met.get(i, 0.0), 1e-9) / max(pairs * s[0], 1e-9) for i, s in enumerate(shares)]
    _, thresholds = allocate(costs(n, shares, [len(s) for s in sets], scale), limit)
    return list(zip(sets, thresholds))


def probes(fps: DataFrame, chosen: list[tuple[list[int], int]]) -> DataFrame:
    """mask, value, fp, own: each fingerprint under its own keys (own) and under those within the thresholds."""
    keys = []
    for bits, t in chosen:
        if t < 0:
            continue
        mask = _mask(bits)
        for e in range(t + 1):
            for flipped in itertools.combinations(bits, e):
                value = F.col("fp").bitwiseXOR(F.lit(_mask(list(flipped)))).bitwiseAND(F.lit(mask))
                keys.append(F.struct(F.lit(mask).alias("mask"), value.alias("value"), F.lit(not e).alias("own")))
    return fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.mask", "k.value", "k.own", "fp")


def _blocks(mask: int, count: int) -> list[int]:
    """The key's bits with each of ``count`` blocks of the other bits added."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    return [_mask([b for b in range(BITS) if mask >> b & 1] + free[i::count]) for i in range(count)]


def bounded_groups(rows: DataFrame, limit: int, most: int) -> DataFrame:
    """The probe rows, with every key shared by more than ``most`` of them divided into longer keys."""
    done = None
    while True:
        counts = rows.groupBy("mask", "value").count()
        hot = settle(counts.where(F.col("count") > most).select("mask", "value"), "hot")
        if hot.isEmpty():
            return rows if done is None else done.unionAll(rows)
        cold = rows.join(hot, ["mask", "value"], "left_anti")
        done = cold if done is None else done.unionAll(cold)
        masks = [r[0] for r in hot.select("mask").distinct().collect()]  # at most limit + 1 times as many as before
        longer = F.create_map(*[x for m in masks for x in (F.lit(m).cast("long"), F.array(*[F.lit(b).cast("long") for b in _blocks(m, limit + 1) if b != m]))])
        split = rows.join(hot, ["mask", "value"]).withColumn("_next", F.explode(F.element_at(longer, F.col("mask"))))
        # Outside the key the fingerprint's own bits count; inside, the probed ones.
        value = F.col("value").bitwiseOR(F.col("fp").bitwiseAND(F.col("_next")).bitwiseAND(F.bitwise_not(F.col("mask"))))
        rows = settle(split.select(F.col("_next").alias("mask"), value.alias("value"), "own", "fp"), "probes")


def link_group(fp: np.ndarray, own: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one group: every member of a connected part to that part's first member."""
    a, b = [], []
    mine = np.flatnonzero(own)
    for i in range(0, len(fp), 256):
        x, y = np.nonzero(differing(fp[i : i + 256, None], fp[None, mine]) <= limit)
        a.append(x + i)
        b.append(mine[y])
    root = group_roots(len(fp), np.concatenate(a), np.concatenate(b))
    moved = np.flatnonzero(root != np.arange(len(fp)))
    return fp[moved], fp[root[moved]]


def verified_links(rows: DataFrame, limit: int) -> DataFrame:
    """a, b: fingerprints within ``limit`` bits, enough of them to connect each group's parts."""
    dealt = rows.repartition("mask", "value").sortWithinPartitions("mask", "value")

    def small(key: np.ndarray, fp: np.ndarray, own: np.ndarray, longest: int):
        for k in range(1, longest):  # neighbours k apart, all groups at once
            hit = np.all(key[k:] == key[:-k], axis=1) & (own[k:] | own[:-k])
            at = np.flatnonzero(hit)
            at = at[differing(fp[at + k], fp[at]) <= limit]
            yield fp[at], fp[at + k]

    def solve(key, fp, own):
        first, last = runs_of(key)
        size = last - first
        few = np.repeat(size <= 16, size)
        yield from small(key[few], fp[few], own[few], int(min(16, size.max(initial=1))))
        for s, e in zip(first[size > 16], last[size > 16]):
            yield link_group(fp[s:e], own[s:e], limit)

    def runs_of(key):
        if not len(key):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        change = np.concatenate([[0], np.cumsum(np.any(key[1:] != key[:-1], axis=1))])
        return runs(change)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None and batch.num_rows:
                cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
                now = (np.stack(cols[:2], axis=1), cols[3].astype(np.int64), cols[2].astype(bool))
                kept = now if kept is None else tuple(np.concatenate(x) for x in zip(kept, now))
            if kept is None or batch is not None and not batch.num_rows:
                continue
            if batch is None:
                cut = len(kept[0])
            else:  # the last group may go on
                cut = int(runs_of(kept[0])[0][-1])
            for a, b in solve(*(x[:cut] for x in kept)):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
            kept = tuple(x[cut:] for x in kept)

    return dealt.select("mask", "value", "own", "fp").mapInArrow(task, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", limit: int = 2, most: int = 4096, linked: bool = False) -> DataFrame:
    """key, text_hash, fp, root (a fingerprint that names the group) and component (smallest key reachable) for each row.

    ``linked`` adds the smaller fingerprints that the search linked to the row's own, ascending; null if there are none.
    """
    prints = settle(fingerprints(docs, key), "fingerprints")
    distinct = settle(prints.groupBy("fp").agg(F.min("key").alias("first")), "distinct")
    rows = probes(distinct.select("fp"), plan(distinct.select("fp"), limit))
    links = verified_links(bounded_groups(rows, limit, most), limit)
    if linked:
        links = settle(links, "met")  # read twice: for the groups and as they are
    roots = components(links).withColumnRenamed("node", "fp")
    classes = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = classes.groupBy("root").agg(F.min("first").alias("component"))
    named = classes.join(least, "root").select("fp", "root", "component")
    if linked:
        met = links.where("a != b").groupBy(F.greatest("a", "b").alias("fp")).agg(F.sort_array(F.collect_set(F.least("a", "b"))).alias("linked"))
        named = named.join(met, "fp", "left")
    return prints.join(named, "fp").select(F.col("key").alias(key), "text_hash", *named.columns)


def star_links(found: DataFrame) -> DataFrame:
    """a, b: every link of :func:`near_duplicates` (with ``linked``) between different texts, by their hashes, b < a.

    Texts of one fingerprint are linked to the least of them, and the least texts of two fingerprints that the
    search linked to each other.
    """
    texts = settle(found.select("fp", "linked", F.col("text_hash").alias("a")).distinct(), "group-texts")
    least = texts.groupBy("fp").agg(F.min("a").alias("b"), F.max("a").alias("_most"), F.first("linked").alias("linked"))
    same = texts.join(least.where("b < _most").select("fp", "b"), "fp").where("a != b").select("a", "b")
    met = least.where("linked IS NOT NULL").select(F.col("b").alias("x"), F.explode("linked").alias("fp")).join(least.select("fp", F.col("b").alias("y")), "fp")
    return same.unionAll(met.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))).distinct()


def hex_digits(fp: Column) -> Column:
    """The 64 bits as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, key: str = "doc_id", find=near_duplicates, **how) -> DataFrame:
    """One row of each group that ``find`` names: the smallest non-null key, then the smallest text hash; equal rows count as one."""
    # Work tables and shuffles of the search go once the groups are stored.
    found = settle_from(docs.sparkSession, "groups", lambda: find(docs, key, **how))
    best = F.min(F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("_key"), F.col("text_hash").alias("_hash"))).alias("best")
    winners = found.groupBy("root").agg(best).select("best._key", "best._hash")
    often = found.groupBy(F.col(key).alias("_key"), F.col("text_hash").alias("_hash")).agg((F.count("*") > 1).alias("_repeated"))
    same = lambda a, b: a["_key"].eqNullSafe(b["_key"]) & (a["_hash"] == b["_hash"])
    single = settle(winners.join(often.where("_repeated"), same(winners, often), "left_anti"), "single")
    several = settle(winners.join(often.where("_repeated"), same(winners, often), "left_semi"), "several")
    mine = lambda w: docs[key].eqNullSafe(w["_key"]) & (F.xxhash64(docs["text"]) == w["_hash"])
    kept = docs.join(single, mine(single), "left_semi")
    if several.isEmpty():
        return kept
    return kept.unionAll(docs.join(several, mine(several), "left_semi").dropDuplicates([key, "text"]))
