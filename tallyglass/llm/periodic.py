"""Periodic runs of words, by recompression: a run-length grammar answers how far two places agree.

A run is a stretch of words with smallest period q, of at least ``least`` words
and ``times`` * q, that cannot be extended with that period.

1. Grammar.  The words of many texts, with a symbol of its own between any two,
   are compressed in turns: blocks of one symbol become (symbol, count), then
   the alphabet is split in two at random and every pair left-right becomes one
   symbol.  Both steps look at neighbours only, so equal stretches are parsed
   alike but for one symbol at each end.
2. Common extensions.  From two places the longest common extension climbs the
   levels while both stand at the start of a symbol, with one step inside a
   level at most, and descends again from the level where the symbols differ.
   The mirrored levels answer the extensions to the left.
3. Candidates.  For period p the places i that are multiples of
   ``(times - 1) * p`` (of ``least - p`` if that is more) meet every run of
   period p.  Where the words at i and i + p agree, the two extensions give the
   maximal stretch itself.  That is a harmonic sum of places for each text.

A stretch found with several periods keeps the smallest, which divides the rest.

Edge cases: null, empty and short texts have no run and keep their words; rows
are solved one by one, so repeated rows and null ids get the same result each;
a text is solved whole, and memory grows with the longest text only; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD

LEAST, TIMES = 24, 3
#: Words that share one grammar, and places looked at together; neither changes a result.
BATCH_WORDS, SLAB = 200_000, 1 << 20


class Level(NamedTuple):
    """One level of the grammar and its step to the next."""

    symbols: np.ndarray
    block: bool  # the step to the next level joins equal symbols
    parent: np.ndarray  # place in the next level
    opens: np.ndarray  # stands first in its parent
    first: np.ndarray  # first place below each symbol of the next level, and one more


# --- the grammar --------------------------------------------------------------------------------


def _step(symbols: np.ndarray, first: np.ndarray, block: bool) -> Level:
    opens = np.zeros(len(symbols), bool)
    opens[first] = True
    return Level(symbols, block, np.cumsum(opens) - 1, opens, np.append(first, len(symbols)))


def _named(keys: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
    """New symbols for equal keys, and the next unused one."""
    values, name = np.unique(keys, return_inverse=True)
    return fresh + name, fresh + len(values)


def grammar(symbols: np.ndarray) -> list[Level]:
    """Levels over ``symbols``; negative ones are fences, each occurs once and stays alone.  The last level has no step."""
    draw, fresh, levels = np.random.default_rng(23), int(symbols.max(initial=0)) + 1, []
    while True:
        real = symbols >= 0
        if not np.any(real[1:] & real[:-1]):
            levels.append(_step(symbols, np.arange(len(symbols)), False))
            return levels
        first = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
        if len(first) < len(symbols):
            levels.append(_step(symbols, first, True))
            count = np.diff(levels[-1].first)
            joined = symbols[first]
            many = count > 1
            joined[many], fresh = _named(joined[many] * (int(count.max()) + 1) + count[many], fresh)
            symbols = joined
            continue
        factor = draw.integers(0, 2**63, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        side = (symbols.astype(np.uint64) * factor) >> np.uint64(63) == 1
        left, right = side & real, ~side & real
        if np.count_nonzero(left[:-1] & right[1:]) < np.count_nonzero(right[:-1] & left[1:]):
            left, right = right, left
        pair = np.flatnonzero(left[:-1] & right[1:])
        if not len(pair):
            continue
        lone = np.ones(len(symbols), bool)
        lone[pair + 1] = False
        first = np.flatnonzero(lone)
        levels.append(_step(symbols, first, False))
        joined = symbols.copy()
        joined[pair], fresh = _named(symbols[pair] * fresh + symbols[pair + 1], fresh)
        symbols = joined[first]


def mirrored(levels: list[Level]) -> list[Level]:
    """The same grammar read from right to left."""
    out = []
    for symbols, block, parent, opens, first in levels:
        above, here = len(first) - 1, len(symbols)
        out.append(Level(symbols[::-1], block, above - 1 - parent[::-1], np.append(opens[1:], True)[::-1], here - first[::-1]))
    return out


def _left_in_block(level: Level, at: np.ndarray) -> np.ndarray | int:
    return level.first[level.parent[at] + 1] - at if level.block else 1


def common_extensions(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Symbols that agree from i and from j on, for different i and j of one text; a fence ends each text."""
    stop_i, stop_j, stop_level = i.copy(), j.copy(), np.zeros(len(i), np.int64)
    live, a, b = np.arange(len(i)), i, j
    for k, level in enumerate(levels):
        same = level.symbols[a] == level.symbols[b]
        aside = np.flatnonzero(same & ~(level.opens[a] & level.opens[b]))
        if len(aside):  # one step brings both to the start of a symbol above, or to a difference
            x, y = a[aside], b[aside]
            step = np.minimum(_left_in_block(level, x), _left_in_block(level, y))
            a, b = a.copy(), b.copy()
            a[aside], b[aside] = x + step, y + step
            same[aside] = level.opens[a[aside]] & level.opens[b[aside]]
        done = live[~same]
        stop_i[done], stop_j[done], stop_level[done] = a[~same], b[~same], k
        live, a, b = live[same], level.parent[a[same]], level.parent[b[same]]
        if not len(live):
            break
    for k in range(int(stop_level.max(initial=0)), 0, -1):
        down = np.flatnonzero(stop_level >= k)
        below = levels[k - 1]
        a, b = below.first[stop_i[down]], below.first[stop_j[down]]
        same = below.symbols[a] == below.symbols[b]
        step = np.where(same, np.minimum(_left_in_block(below, a), _left_in_block(below, b)), 0)
        stop_i[down], stop_j[down] = a + step, b + step
    return stop_i - i


# --- runs ---------------------------------------------------------------------------------------


def _places(n: np.ndarray, start: np.ndarray, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of the harmonic grids of texts with ``n`` words that begin at ``start``."""
    most = np.where(n >= least, n // times, 0)
    for lo in range(0, int(most.max(initial=0)), SLAB):
        width = np.clip(most - lo, 0, SLAB)
        text = np.repeat(np.arange(len(n)), width)
        p = np.arange(len(text)) - np.repeat(np.cumsum(width) - width, width) + lo + 1
        grid = np.maximum((times - 1) * p, least - p)
        count = (n[text] - p - 1) // grid + 1
        before = np.cumsum(count)
        cuts = np.searchsorted(before, np.arange(SLAB, int(before[-1]) + SLAB, SLAB), "left") + 1 if len(before) else []
        at = 0
        for cut in np.minimum(cuts, len(p)):
            c = count[at:cut]
            if len(c):
                nth = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
                yield np.repeat(start[text[at:cut]], c) + nth * np.repeat(grid[at:cut], c), np.repeat(p[at:cut], c)
            at = int(cut)


def find_runs(texts: list[np.ndarray], least: int = LEAST, times: int = TIMES) -> list[np.ndarray]:
    """For each array of word numbers: its runs as rows (start, length, period), ordered by start, then period."""
    n = np.array([len(t) for t in texts], np.int64)
    start = np.cumsum(n + 1) - n
    symbols = np.full(int((n + 1).sum()) + 1, -1, np.int64)
    fences = np.append(0, start + n)
    symbols[fences] = -1 - np.arange(len(fences))
    for t, s in zip(texts, start.tolist()):
        symbols[s : s + len(t)] = t
    hits = [(i[w], p[w]) for i, p in _places(n, start, least, times) for w in [np.flatnonzero(symbols[i] == symbols[i + p])] if len(w)]
    if not hits:
        return [np.empty((0, 3), np.int64)] * len(texts)
    i, p = (np.concatenate(x) for x in zip(*hits))
    levels = grammar(symbols)
    ahead = common_extensions(levels, i, i + p)
    far = len(symbols) - 1
    behind = common_extensions(mirrored(levels), far - (i - 1), far - (i + p - 1))
    s, length = i - behind, ahead + behind + p
    good = length >= np.maximum(least, times * p)
    s, length, p = s[good], length[good], p[good]
    order = np.lexsort((p, length, s))
    s, length, p = s[order], length[order], p[order]
    new = np.concatenate([[True], (s[1:] != s[:-1]) | (length[1:] != length[:-1])])[: len(s)]
    s, length, p = s[new], length[new], p[new]
    order = np.lexsort((p, s))
    found = np.stack([s, length, p], axis=1)[order]
    bounds = np.searchsorted(found[:, 0], start), np.searchsorted(found[:, 0], start + n)
    return [found[a:b] - [o, 0, 0] for a, b, o in zip(*bounds, start)]


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run drops: all of a run but its first period goes."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, key: str = "doc_id", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """key, n_words, runs (start, length, period in words, ordered) and collapsed: the text with one period left of each run."""
    rows = docs.select(F.col(key).alias("key"), "text")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def solve(texts: list[list[bytes]]) -> list[np.ndarray]:
        numbers: dict[bytes, int] = {}
        flat = np.array([numbers.setdefault(w, len(numbers)) for w in chain.from_iterable(texts)], np.int64)
        return find_runs(np.split(flat, np.cumsum([len(t) for t in texts])[:-1]), least, times)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts, held, end = [], 0, at
                while end < batch.num_rows and (held < BATCH_WORDS or end == at):
                    texts.append((batch.column(1)[end].as_py() or "").encode().split())
                    held += len(texts[-1])
                    end += 1
                found = solve(texts)
                flat = np.concatenate([np.empty((0, 3), np.int64), *found])
                items = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(kind.value_type))
                offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at), pa.array([len(t) for t in texts], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items),
                     pa.array([_collapsed(t, f).decode() for t, f in zip(texts, found)], pa.string())],
                    ["key", "n_words", "runs", "collapsed"],
                )
                at = end

    schema = "key " + rows.schema["key"].dataType.simpleString() + ", n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return rows.mapInArrow(task, schema).withColumnRenamed("key", key)


def planted(doc_id: Column, text: Column) -> Column:
    """The text of the contract: one in ten, by the id's CRC-32, repeats a stretch of its words from some place on."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("int")
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    n = F.size(words)
    a = g % n
    p = F.floor((n - a) / (3 + g % 8)).cast("int") + 1
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    whole = F.slice(F.concat(F.slice(words, F.lit(1), a), again), F.lit(1), n)
    return F.when((h % 10 == 0) & (n > 0), F.array_join(whole, " ")).otherwise(text)


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts, the run with the greatest exponent (exact; ties: first start, then period), and hashes of all runs and of the words kept."""
    first = F.element_at("runs", 1)
    better = lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best)
    best = F.when(F.size("runs") > 0, F.aggregate("runs", first, better))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.withColumn("best", best).select(
        key, F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
