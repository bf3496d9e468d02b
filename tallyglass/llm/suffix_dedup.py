"""Removal of long repeated byte strings, with suffix arrays built by Lyndon groups in linear time.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else goes.  Only regions that can hold such a string reach a suffix array:

1. Anchors.  In each window of ``WINDOW`` starting positions the least hash of
   the next 8 bytes is an anchor, so two equal strings have the same anchor at
   the same distance from their start, and ``length - WINDOW + 1`` equal bytes
   (the core) right of it.  Anchors whose core occurs once are settled.
2. Contexts.  An anchor's context is all that strings with that anchor can
   cover.  Anchors with equal contexts are one class; a class with two members
   or more is repeated wherever it can be, and one member stands for it.
3. Suffix arrays.  The contexts that share a core become strings over 40-byte
   blocks, the core being one symbol.  :func:`suffix_array` sorts all their
   suffixes; a suffix's longest match is with a neighbour in that order.  Where
   it is long enough to hold a repeated string that starts in the block before
   it, and only there, the strings that start in that block are looked up by
   their hashes, and the outermost ones compared byte by byte.

A core shared by more than ``MOST`` different contexts is not brought into one
task.  Its strings are divided by their distance from the anchor, 40, 8 and at
last one distance together, which makes the bytes they must share longer, up to
the string itself; what is left of a context is again a context, equal ones are
again one class, and the suffix arrays go on as before.

Edge cases: null and empty texts, and texts shorter than ``length``, lose
nothing; exact copies of longer texts lose everything, as do rows that repeat;
null ids are carried; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle

LENGTH, WINDOW, BLOCK, MOST = 400, 200, 40, 20_000
#: Distances that stay together each time a crowded core is divided.
STEPS = (40, 8, 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_VALUES = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)


# --- the suffix array ---------------------------------------------------------------------------


def suffix_array(symbols: list[int]) -> list[int]:
    """Suffixes of ``symbols`` in ascending order; the last symbol must be the only 0.

    Phase 1 refines groups of suffixes, from the highest group to the lowest,
    until each holds the suffixes with one common Lyndon prefix: a group's
    previous-smaller positions move behind the rest of their own groups, those
    with more members in the group behind those with fewer.  Phase 2 places the
    suffixes: each placed one fixes its predecessor and that one's chain of
    previous-smaller positions at the front of their groups.
    """
    n = len(symbols)
    order = np.argsort(np.asarray(symbols), kind="stable")
    sorted_symbols = np.asarray(symbols)[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_symbols[1:] != sorted_symbols[:-1]]))
    sizes = np.diff(np.concatenate([first, [n]]))
    starts = np.empty(n, np.int64)
    starts[order] = np.repeat(first, sizes)
    at = np.empty(n, np.int64)
    at[order] = np.arange(n)
    sa, group, place = order.tolist(), starts.tolist(), at.tolist()
    size = dict(zip(first.tolist(), sizes.tolist()))
    prev = [-1] * n
    end = n - 1
    while end >= 0:
        start = group[sa[end]]
        if start == end:
            i = sa[end]
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = prev[j]
            prev[i] = j
            levels = [[j]] if j >= 0 else []
        else:
            count: dict[int, int] = {}
            for i in sorted(sa[start : end + 1]):
                j = i - 1
                while j >= 0 and group[j] >= start:
                    j = prev[j]
                prev[i] = j
                if j >= 0:
                    count[j] = count.get(j, 0) + 1
            by_count: dict[int, list[int]] = {}
            for j, c in count.items():
                by_count.setdefault(c, []).append(j)
            levels = [by_count[c] for c in sorted(by_count, reverse=True)]
        for level in levels:
            moved: dict[int, int] = {}  # old group: how many have moved to its end
            for j in level:
                g = group[j]
                if size[g] == 1:
                    continue
                m = moved.get(g, 0) + 1
                moved[g] = m
                target, own = g + size[g] - m, place[j]
                other = sa[target]
                sa[target], sa[own] = j, other
                place[j], place[other] = target, own
            for g, m in moved.items():
                if m < size[g]:
                    size[g] -= m
                    new = g + size[g]
                    size[new] = m
                    for j in sa[new : new + m]:
                        group[j] = new
        end = start - 1
    out, placed, front = [0] * n, [False] * n, {}
    out[0], placed[n - 1] = n - 1, True
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            f = front.get(g, g)
            out[f], placed[j], front[g] = j, True, f + 1
            j = prev[j]
    return out


# --- anchors ------------------------------------------------------------------------------------


def anchors(data: np.ndarray, first: int, last: int) -> np.ndarray:
    """Positions that are the least, leftmost on ties, of some window of starts in first..last."""
    count = last - first + WINDOW
    grams = np.ndarray((count,), "<u8", data.data, first, (1,)) * _MIX
    grams ^= grams >> np.uint64(29)
    grams *= _MIX
    coded = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(count, dtype=np.uint64)
    blocks = -(-count // WINDOW)
    padded = np.full(blocks * WINDOW, np.iinfo(np.uint64).max)
    padded[:count] = coded
    padded = padded.reshape(blocks, WINDOW)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = last - first + 1
    least = np.minimum(behind[:windows], ahead[WINDOW - 1 : WINDOW - 1 + windows]) & np.uint64(0xFFFFFFFF)
    keep = np.concatenate([[True], least[1:] != least[:-1]])
    return least[keep].astype(np.int64) + first


def anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    """core, context (hashes), ref and n (hash and bytes of the text), pos: one row for each anchor."""
    rows = docs.select(F.xxhash64("text").alias("ref"), F.octet_length("text").cast("int").alias("n"), "text").where(F.col("n") >= length)
    core = length - WINDOW + 1

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[], [], [], [], []]
            hashed = xxhash.xxh3_64_intdigest
            for ref, n, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist()):
                # Starts of strings run to n - length; in pieces, so that a very long text needs no more memory.
                places: list[int] = []
                data = np.frombuffer(text, np.uint8)
                for a in range(0, n - length + 1, 1 << 20):
                    places += anchors(data, a, min(a + (1 << 20) - 1, n - length)).tolist()
                places = sorted(set(places))
                found[0] += [hashed(text[p : p + core]) for p in places]
                found[1] += [hashed(text[max(0, p - WINDOW + 1) : p + length], min(p, WINDOW - 1)) for p in places]
                found[2] += [ref] * len(places)
                found[3] += [n] * len(places)
                found[4] += places
            unsigned = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in found[:2]]
            yield pa.RecordBatch.from_arrays([*unsigned, pa.array(found[2], pa.int64()), pa.array(found[3], pa.int32()), pa.array(found[4], pa.int32())], ["core", "context", "ref", "n", "pos"])

    return rows.mapInArrow(task, "core long, context long, ref long, n int, pos int")


@lru_cache
def _weights(n: int) -> np.ndarray:
    return np.random.default_rng(12).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# --- one group of contexts ----------------------------------------------------------------------


def symbols_of(members: list[tuple[int, bytes, int]], core: int) -> tuple[list[int], np.ndarray, np.ndarray, list]:
    """Symbols of all contexts, the member and the distance (-1: right of the anchor) of each, and the block behind each symbol."""
    pieces, owner, distance = [], [], []
    for m, (key, text, left) in enumerate(members):
        blocks = left // BLOCK
        for j in range(blocks, 0, -1):
            pieces.append(text[left - j * BLOCK : left - (j - 1) * BLOCK])
            distance.append(j * BLOCK)
        pieces.append((key, text[left : left + core]))
        distance.append(0)
        right = range(left + core, len(text), BLOCK)
        pieces += [text[i : i + BLOCK] for i in right]
        pieces.append(None)
        distance += [-1] * (len(right) + 1)
        owner += [m] * (blocks + 2 + len(right))
    blocks = {b: i + 2 for i, b in enumerate(sorted({p for p in pieces if type(p) is bytes}))}
    cores = {c: i + 2 + len(blocks) for i, c in enumerate(dict.fromkeys(p for p in pieces if type(p) is tuple))}
    symbols = [1 if p is None else blocks[p] if type(p) is bytes else cores[p] for p in pieces]
    return [*symbols, 0], np.array([*owner, -1]), np.array([*distance, -1]), [*pieces, None]


def neighbour_matches(symbols: list[int], distance: np.ndarray, pieces: list, core: int) -> np.ndarray:
    """For each suffix that starts at or left of an anchor: bytes it shares with the closer of its neighbours in the suffix array."""
    sa = np.array(suffix_array(symbols))
    s = np.array(symbols)
    width = np.array([0 if p is None else core if type(p) is tuple else len(p) for p in pieces])
    a, b = sa[:-1], sa[1:]
    wanted = (distance[a] >= 0) | (distance[b] >= 0)
    a, b = a[wanted], b[wanted]
    shared, i, j, live = np.zeros(len(a), np.int64), a.copy(), b.copy(), np.arange(len(a))
    stop_i, stop_j = a.copy(), b.copy()
    while len(live):
        same = (s[i] == s[j]) & (s[i] > 1)
        stop_i[live[~same]], stop_j[live[~same]] = i[~same], j[~same]
        shared[live[same]] += width[i[same]]
        live, i, j = live[same], i[same] + 1, j[same] + 1
    for k in np.flatnonzero(shared >= core).tolist():  # the rest of the first blocks that differ
        x, y = pieces[stop_i[k]], pieces[stop_j[k]]
        if type(x) is bytes and type(y) is bytes:
            n = min(len(x), len(y))
            shared[k] += n - ((int.from_bytes(x[:n]) ^ int.from_bytes(y[:n])).bit_length() + 7) // 8
    best = np.zeros(len(symbols), np.int64)
    np.maximum.at(best, a, shared)
    np.maximum.at(best, b, shared)
    return best


def repeated_starts(members: list[tuple[int, bytes, int]], wanted: list[bool], length: int = LENGTH, window: int = WINDOW) -> list[tuple[int, int] | None]:
    """For each wanted member: least and greatest distance from a repeated string's start to the anchor, or None.

    A member is (group, context, bytes left of the anchor); members of a group
    share the core, the ``length - window + 1`` bytes from the anchor on.
    """
    core = length - window + 1
    symbols, owner, distance, pieces = symbols_of(members, core)
    best = neighbour_matches(symbols, distance, pieces, core)
    n, out = len(members), [None] * len(members)
    hopeful = np.zeros((n, -(-window // BLOCK)), bool)
    at = np.flatnonzero((distance >= 0) & (best > length - BLOCK))
    hopeful[owner[at], distance[at] // BLOCK] = True
    hopeful &= np.array(wanted)[:, None]
    if not hopeful.any():
        return out
    # Hashes of all strings around an anchor, as differences of running sums; strings at one distance line up.
    span = window - 1
    group = np.unique(np.array([m[0] for m in members]), return_inverse=True)[1].astype(np.uint64) * _MIX
    left = np.array([m[2] for m in members])
    right = np.array([len(m[1]) - m[2] for m in members])
    rows = np.frombuffer(b"".join((bytes(span - k) + t).ljust(span + length, b"\0") for _, t, k in members), np.uint8).reshape(n, span + length)
    sums = np.zeros((n, span + length + 1), np.uint64)
    np.cumsum(_VALUES[rows] * _weights(span + length), axis=1, out=sums[:, 1:])
    low, high, low_with, high_with = (np.full(n, -1) for _ in range(4))
    for d in range(window):
        hope = hopeful[:, d // BLOCK]
        whole = np.flatnonzero((left >= d) & (right + d >= length))
        if len(whole) < 2 or not hope[whole].any():
            continue
        keys = (sums[whole, span - d + length] - sums[whole, span - d]) ^ group[whole]
        order = np.argsort(keys, kind="stable")
        keys, who = keys[order], whole[order]
        same = np.flatnonzero(keys[1:] == keys[:-1])
        x, y = np.concatenate([who[same], who[same + 1]]), np.concatenate([who[same + 1], who[same]])
        x, y = x[hope[x]], y[hope[x]]
        high[x], high_with[x] = d, y
        new = low[x] < 0
        low[x[new]], low_with[x[new]] = d, y[new]

    def string(m: int, d: int) -> bytes:
        return members[m][1][members[m][2] - d : members[m][2] - d + length]

    for m in np.flatnonzero(low >= 0).tolist():
        ends = [(int(low[m]), int(low_with[m])), (int(high[m]), int(high_with[m]))]
        if all(members[m][0] == members[o][0] and string(m, d) == string(o, d) for d, o in ends):
            out[m] = ends[0][0], ends[1][0]
        else:  # two strings with one hash: all others of the group, byte by byte
            others = [o for o in range(n) if o != m and members[o][0] == members[m][0]]
            real = [d for d in range(min(window, left[m] + 1)) if hopeful[m, d // BLOCK] and right[m] + d >= length and any(left[o] >= d and string(o, d) == string(m, d) for o in others)]
            out[m] = (real[0], real[-1]) if real else None
    return out


# --- the whole table ----------------------------------------------------------------------------

PLACE = "ref long, n int, pos int"


def _contexts(docs: DataFrame, wanted: DataFrame, length: int, key: str) -> DataFrame:
    """core, alone, left, text for each wanted anchor, read from one document of each text."""
    firsts = docs.select(F.xxhash64("text").alias("ref"), F.octet_length("text").cast("int").alias("n"), F.col(key).alias("id")).where(F.col("n") >= length)
    firsts = firsts.groupBy("ref", "n").agg(F.min("id").alias("id"))
    lists = wanted.groupBy("ref", "n").agg(F.collect_set(F.struct("pos", "core", "alone", "hot")).alias("places")).join(firsts, ["ref", "n"])
    texts = docs.select(F.xxhash64("text").alias("ref"), F.octet_length("text").cast("int").alias("n"), F.col(key).alias("own"), "text")
    held = texts.join(lists, ["ref", "n"]).where(F.col("own").eqNullSafe(F.col("id"))).select("ref", "n", "places", "text")
    kind = "core long, alone boolean, hot boolean, left int, text binary, " + PLACE

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ref, n, places, text in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3).cast(pa.binary()).to_pylist()):
                for x in places:
                    p = x["pos"]
                    left = min(p, WINDOW - 1)
                    out.append((x["core"], x["alone"], x["hot"], left, text[p - left : p + length], ref, n, p))
            types = [pa.int64(), pa.bool_(), pa.bool_(), pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.int32()]
            names = ["core", "alone", "hot", "left", "text", "ref", "n", "pos"]
            for i in range(0, len(out), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i : i + 20_000]), types)], names)

    return held.mapInArrow(task, kind).dropDuplicates(["ref", "n", "pos"])


def _by_suffix_arrays(contexts: DataFrame, length: int, window: int) -> DataFrame:
    """ref, n, s, e: from the first to the last repeated string in each lone context that holds one."""
    dealt = contexts.repartition("core").sortWithinPartitions("core", "ref", "n", "pos").select("core", "alone", "left", "text", "ref", "n", "pos")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def solve(rows: list[tuple]) -> pa.RecordBatch:
            found = repeated_starts([(r[0], r[3], r[2]) for r in rows], [r[1] for r in rows], length, window)
            hit = [(r[4], r[5], r[6], *f) for r, f in zip(rows, found) if f]
            return pa.RecordBatch.from_arrays([pa.array([h[i] for h in hit], t) for i, t in enumerate([pa.int64(), *[pa.int32()] * 4])], ["ref", "n", "pos", "low", "high"])

        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                held += zip(*(c.to_pylist() for c in batch.slice(i, 2000).columns))
                if len(held) >= 2000:  # whole groups only
                    cut = next((k for k in range(len(held) - 1, 0, -1) if held[k][0] != held[k - 1][0]), 0)
                    if cut:
                        yield solve(held[:cut])
                        held = held[cut:]
        if held:
            yield solve(held)

    found = dealt.mapInArrow(task, PLACE + ", low int, high int")
    return found.select("ref", "n", (F.col("pos") - F.col("high")).alias("s"), (F.col("pos") - F.col("low") + length).alias("e"))


def _divide(contexts: DataFrame, length: int, window: int, width: int) -> DataFrame:
    """Each context in parts of ``width`` distances: core, hi and lo (hash of the part), alone, left, text, ref, n, pos."""
    core = length - width + 1

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                for nearest in range(0, min(window, r["left"] + 1), width):
                    at = r["left"] - nearest
                    left = min(at, width - 1)
                    text = r["text"][at - left : at + length]
                    if len(text) < length or len(text) - left < core:
                        continue
                    whole = xxhash.xxh3_128_intdigest(text, left)
                    # The distance is part of the key: one place may be reached from two anchors.
                    shared = xxhash.xxh3_64_intdigest(text[left : left + core], (r["core"] + nearest) % 2**64)
                    signed = [int.from_bytes(x.to_bytes(8), signed=True) for x in (shared, whole >> 64, whole & 0xFFFFFFFFFFFFFFFF)]
                    out.append((*signed, r["alone"], left, text, r["ref"], r["n"], r["pos"] - nearest))
            types = [pa.int64()] * 3 + [pa.bool_(), pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.int32()]
            names = ["core", "hi", "lo", "alone", "left", "text", "ref", "n", "pos"]
            for i in range(0, len(out), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i : i + 20_000]), types)], names)

    return contexts.mapInArrow(task, "core long, hi long, lo long, alone boolean, left int, text binary, " + PLACE)


def _whole(known: DataFrame, length: int, window: int) -> DataFrame:
    """ref, n, s, e: all that strings with an anchor can cover, for anchors whose context occurs elsewhere too."""
    left, low = F.least(F.col("pos"), F.lit(window - 1)), F.greatest(F.lit(0), length - F.col("n") + F.col("pos"))
    return known.select("ref", "n", (F.col("pos") - left).alias("s"), (F.col("pos") - low + length).alias("e"))


def _crowded(contexts: DataFrame, length: int, window: int, most: int, steps: tuple[int, ...]) -> DataFrame:
    """ref, n, s, e for the contexts of crowded cores, divided as often as ``steps`` says."""
    parts = settle(_divide(contexts, length, window, steps[0]), "divided")
    classes = parts.groupBy("core", "hi", "lo").agg(F.count("*").alias("members"), F.min(F.struct("ref", "n", "pos")).alias("one"))
    groups = classes.groupBy("core").agg(F.count("*").alias("classes")).where("classes > 1").withColumn("hot", F.col("classes") > most)
    known = settle(parts.join(classes, ["core", "hi", "lo"]), "classes")
    found = _whole(known.where("members > 1 AND alone"), length, steps[0])
    some = known.where(F.expr("members = 1 OR struct(ref, n, pos) = one")).join(groups, "core")
    rest = settle(some.select("core", (F.col("alone") & (F.col("members") == 1)).alias("alone"), "hot", "left", "text", "ref", "n", "pos"), "parts")
    found = found.unionAll(_by_suffix_arrays(rest.where("NOT hot"), length, steps[0]))
    # Single strings are one class a core, so the last division leaves nothing crowded.
    if rest.where("hot").isEmpty():
        return found
    return found.unionAll(_crowded(rest.where("hot"), length, steps[0], most, steps[1:]))


def removed_spans(docs: DataFrame, key: str = "doc_id", length: int = LENGTH, most: int = MOST) -> DataFrame:
    """ref, n, spans: the maximal removed runs (start, end) of each text that loses bytes."""
    rows = settle(anchor_rows(docs, length), "anchors")
    twice = rows.groupBy("core").count().where("count > 1").select("core")
    rows = settle(rows.join(twice, "core"), "candidates")
    classes = rows.groupBy("core", "context").agg(F.count("*").alias("members"), F.min(F.struct("ref", "n", "pos")).alias("one"))
    groups = classes.groupBy("core").agg(F.count("*").alias("classes")).where("classes > 1").withColumn("hot", F.col("classes") > most)
    known = settle(rows.join(classes, ["core", "context"]).select("core", "ref", "n", "pos", "members", (F.struct("ref", "n", "pos") == F.col("one")).alias("chosen")), "classes")
    # Members of a repeated class: every string they can hold is repeated.
    full = _whole(known.where("members > 1"), length, WINDOW)
    wanted = known.where("members = 1 OR chosen").join(groups, "core").select("core", "ref", "n", "pos", (F.col("members") == 1).alias("alone"), "hot")
    contexts = _contexts(docs, wanted, length, key)
    if settle(groups.where("hot"), "hot").isEmpty():
        part = _by_suffix_arrays(contexts, length, WINDOW)
    else:
        contexts = settle(contexts, "contexts")
        part = _by_suffix_arrays(contexts.where("NOT hot"), length, WINDOW).unionAll(_crowded(contexts.where("hot"), length, WINDOW, most, STEPS))
    spans = full.unionAll(part).groupBy("ref", "n").agg(F.sort_array(F.collect_set(F.struct("s", "e"))).alias("spans"))

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            merged = []
            for own in batch.column(2).to_pylist():
                out: list[dict] = []
                for x in own:
                    if out and x["s"] <= out[-1]["e"]:
                        out[-1]["e"] = max(out[-1]["e"], x["e"])
                    else:
                        out.append(x)
                merged.append(out)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(merged, batch.column(2).type)], ["ref", "n", "spans"])

    return spans.mapInArrow(join_up, "ref long, n int, spans array<struct<s:int,e:int>>")


def remove_repeats(docs: DataFrame, key: str = "doc_id", length: int = LENGTH, most: int = MOST) -> DataFrame:
    """key, n_bytes, spans (removed runs, possibly none) and kept (the remaining bytes) for each row."""
    spans = settle(removed_spans(docs, key, length, most), "spans").withColumnRenamed("ref", "_ref").withColumnRenamed("n", "_n")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(key).alias(key), F.xxhash64("text").alias("ref"), F.octet_length(text).cast("int").alias("n_bytes"), F.encode(text, "UTF-8").alias("bytes"))
    joined = rows.join(spans, (F.col("ref") == F.col("_ref")) & (F.col("n_bytes") == F.col("_n")), "left")
    # Kept pieces lie between the end of one run and the start of the next.
    starts = F.concat(F.array(F.lit(0)), F.col("spans.e"))
    ends = F.concat(F.col("spans.s"), F.array(F.col("n_bytes")))
    piece = lambda a, x: F.concat(a, F.substring(F.col("bytes"), x["0"] + 1, x["1"] - x["0"]))
    cut = F.aggregate(F.arrays_zip(starts.alias("0"), ends.alias("1")), F.lit(b"").cast("binary"), piece)
    none = F.array().cast("array<struct<s:int,e:int>>")
    return joined.select(key, F.col("n_bytes").cast("long").alias("n_bytes"), F.coalesce("spans", none).alias("spans"), F.when(F.col("spans").isNull(), F.col("bytes")).otherwise(cut).alias("kept"))
