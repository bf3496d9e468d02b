"""Removal of word windows that documents with smaller ids hold: an FM-index per shard, matching statistics by backward search.

Every word covered by ``WINDOW`` words that also start in a document with a
smaller id goes; windows are judged on the input.

1. Routing.  In each stretch of ``SPREAD`` window starts the word with the least
   hash of its next 16 bytes is an anchor, so equal windows have their anchor at
   the same distance, and ``WINDOW - SPREAD + 1`` equal words (the core) right
   of it.  The windows of one anchor overlap to one segment of words.  Segments
   are brought together by their cores; equal segments are one class, with the
   smallest and the largest id that holds it.  Cores of one id are settled, and
   their segments go before the others meet.
2. Shards.  A shard is the classes of some cores, whole cores only.  Its index
   holds their words once each: the Burrows-Wheeler transform in a wavelet
   matrix of bit vectors with counts, and for each row of it the smallest id.
3. Matching statistics.  Each class streams through the index from its last word
   to its first, by backward search.  A match counts as long as its rows hold a
   smaller id than the class's largest; where a word can't extend it, it is
   shortened to its parent interval.  At ``WINDOW`` words and more the interval
   of the first ``WINDOW`` reports the smallest id that holds the window.
4. Each member of a class loses the windows whose smallest id is below its own.

A core with more than ``MOST`` classes is divided: its windows by their distance
from the anchor, five distances at first and then one, which makes the words
they must share longer, up to the window itself, where only one class is left.

Edge cases: null, empty and short texts lose nothing; a null id is the smallest;
rows that repeat an id are no smaller than each other, whatever their texts;
an empty table gives an empty result; other columns are ignored.  Ids must be
whole numbers.  Equal segments are recognised by 128-bit hashes; words are
compared as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, settle_from

WINDOW, SPREAD, MOST, SHARD_WORDS = 50, 30, 4000, 300_000
#: Distances that stay together when a crowded core is divided, once and twice.
STEPS = (5, 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_NONE = -(2**63)


# --- anchors and segments -----------------------------------------------------------------------


def word_places(text: bytes) -> tuple[bytes, np.ndarray]:
    """The words joined by one space, and where each starts, with one more entry behind the last."""
    plain = b" ".join(text.split())
    spaces = np.flatnonzero(np.frombuffer(plain, np.uint8) == 0x20)
    return plain, np.concatenate([[0], spaces + 1, [len(plain) + 1]]) if plain else np.zeros(1, np.int64)


def segments(plain: bytes, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last window of each segment of a text with ``WINDOW`` words or more."""
    windows = len(start) - 1 - WINDOW + 1
    count = windows + SPREAD - 1
    data = np.frombuffer(plain + bytes(16), np.uint8)
    eight = np.ndarray((len(data) - 7,), "<u8", data.data, 0, (1,))
    code = (eight[start[:count]] * _MIX) ^ (eight[start[:count] + 8] * (_MIX + np.uint64(2)))
    code ^= code >> np.uint64(29)
    code = ((code * _MIX) & np.uint64(0xFFFFFFFF00000000)) | np.arange(count, dtype=np.uint64)
    padded = np.full(-(-count // SPREAD) * SPREAD, np.iinfo(np.uint64).max)
    padded[:count] = code
    blocks = padded.reshape(-1, SPREAD)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = (np.minimum(behind[:windows], ahead[SPREAD - 1 : SPREAD - 1 + windows]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    return least[first], first, np.append(first[1:], windows) - 1


def _rows(docs: DataFrame, key: str) -> DataFrame:
    """id (a null one below all others), ref and n (hash and bytes of the text) and text."""
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_NONE)).alias("id"), F.xxhash64("text").alias("ref"), F.octet_length("text").cast("int").alias("n"), "text")


def anchor_rows(docs: DataFrame, key: str) -> DataFrame:
    """core, hi and lo (hash of the segment), id, ref, n, at (first word), lead (words before the anchor), span (windows): one row for each segment."""
    core = WINDOW - SPREAD + 1

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes: list[list[int]] = [[], [], []]
            places: list[list[np.ndarray]] = [[], [], []]
            repeats = []
            for text in batch.column(3).cast(pa.binary()).to_pylist():
                plain, start = word_places(text)
                if len(start) <= WINDOW:
                    repeats.append(0)
                    continue
                anchor, first, last = segments(plain, start)
                ends = start - 1
                hashes[0] += [xxhash.xxh3_64_intdigest(plain[a:b]) for a, b in zip(start[anchor].tolist(), ends[anchor + core].tolist())]
                for a, b in zip(start[first].tolist(), ends[last + WINDOW].tolist()):
                    both = xxhash.xxh3_128_intdigest(plain[a:b])
                    hashes[1].append(both >> 64)
                    hashes[2].append(both & 0xFFFFFFFFFFFFFFFF)
                for kept, new in zip(places, (first, anchor - first, last - first + 1)):
                    kept.append(new)
                repeats.append(len(anchor))
            signed = [pa.array(np.array(h, np.uint64).view(np.int64)) for h in hashes]
            own = np.repeat(np.arange(batch.num_rows), repeats)
            whole = [pa.array(np.concatenate([np.empty(0, np.int64), *p]), pa.int64()).cast(pa.int32()) for p in places]
            yield pa.RecordBatch.from_arrays([*signed, *(batch.column(c).take(pa.array(own)) for c in range(3)), *whole], ["core", "hi", "lo", "id", "ref", "n", "at", "lead", "span"])

    long_enough = _rows(docs, key).where(F.col("n") >= 2 * WINDOW - 1)
    return long_enough.mapInArrow(task, "core long, hi long, lo long, id long, ref long, n int, at int, lead int, span int")


# --- the index of a shard -----------------------------------------------------------------------


class BitVector:
    """Bits in 64-bit words, with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))[:-1]]).astype(np.int64)
        self.zeros = len(bits) - int(np.count_nonzero(bits))

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class Wavelet:
    """Wavelet matrix of a sequence of symbols below ``size``."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels = []
        for shift in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            bits = (symbols >> shift & 1).astype(bool)
            self.levels.append((shift, BitVector(bits)))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])
        self.origin = np.zeros(size, np.int64)
        self.origin = self._down(np.arange(size), np.zeros(size, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits in self.levels:
            ones = bits.ones(at)
            at = np.where(symbol >> shift & 1, bits.zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        return self._down(symbol, at) - self.origin[symbol]


class Smallest:
    """The least of any stretch of an array, by the leasts of stretches of powers of two."""

    def __init__(self, values: np.ndarray):
        self.table = [values]
        while 2 << (len(self.table) - 1) <= len(values):
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.append(np.minimum(last[:-half], last[half:]), last[len(last) - half :]))
        self.table = np.stack(self.table)

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Least of the places lo to hi - 1, for hi > lo."""
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        return np.minimum(self.table[level, lo], self.table[level, hi - (1 << level)])


class ShardIndex:
    """FM-index over the words of a shard's classes, with parent intervals up to ``WINDOW`` words."""

    def __init__(self, symbols: np.ndarray, size: int, ids: np.ndarray):
        """``symbols``: words from 1 on, with a 0 behind each class; ``ids``: the smallest id of the class at each place."""
        n = self.n = len(symbols)
        ranks = [symbols]
        while 1 << (len(ranks) - 1) < WINDOW:  # order by the next 2, 4, 8, ... symbols
            rank, width = ranks[-1], 1 << (len(ranks) - 1)
            after = np.zeros(n, np.int64)
            after[: max(0, n - width)] = rank[width:] + 1
            ranks.append(np.unique(rank * (n + size + 1) + after, return_inverse=True)[1])
        order = np.argsort(ranks[-1], kind="stable")
        a, b = order[:-1], order[1:]
        shared = np.zeros(max(0, n - 1), np.int64)
        for k in range(len(ranks) - 1, -1, -1):
            x, y = a + shared, b + shared
            fit = np.flatnonzero((x < n) & (y < n) & (shared < WINDOW))
            fit = fit[ranks[k][x[fit]] == ranks[k][y[fit]]]
            shared[fit] += 1 << k
        #: Words shared with the row before, at most WINDOW; -1 at both ends.
        self.shared = np.concatenate([[-1], np.minimum(shared, WINDOW), [-1]])
        self.before, self.behind = np.zeros(n + 1, np.int64), np.full(n + 1, n, np.int64)
        rows = np.arange(n + 1)
        for value in range(WINDOW + 1):  # the closest row on either side that shares less
            own = np.flatnonzero(self.shared == value)
            if len(own):
                less = self.shared < value
                self.before[own] = np.maximum.accumulate(np.where(less, rows, 0))[own]
                self.behind[own] = np.minimum.accumulate(np.where(less, rows, n)[::-1])[::-1][own]
        self.wavelet = Wavelet(symbols[order - 1], size)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=size))[:-1]])
        self.least = Smallest(ids[order])

    def extend(self, word: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that begin with the word, then with what the rows lo to hi - 1 share."""
        at = self.smaller[np.concatenate([word, word])] + self.wavelet.rank(np.concatenate([word, word]), np.concatenate([lo, hi]))
        return at[: len(word)], at[len(word) :]

    def parent(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The next wider interval of rows and how many words it shares."""
        left, right = self.shared[lo], self.shared[hi]
        return np.where(left >= right, self.before[lo], lo), np.where(right >= left, self.behind[hi], hi), np.maximum(left, right)


def smallest_ids(index: ShardIndex, symbols: np.ndarray, start: np.ndarray, length: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matching statistics of streams of words against ids smaller than ``below``.

    Returns stream, first word and smallest id of each window found.  All streams
    advance together, each by one step of its own: one word more, or the parent.
    """
    live = np.flatnonzero(length >= WINDOW)
    at = start[live] + length[live] - 1
    lo, hi, held = np.zeros(len(live), np.int64), np.full(len(live), index.n), np.zeros(len(live), np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(live):
        a, b = index.extend(symbols[at], lo, hi)
        good = b > a
        least = np.where(good, index.least.of(a, np.maximum(b, a + 1)), 0)
        good &= least < below[live]
        grown = np.flatnonzero(good)
        a, b, words = a[grown], b[grown], held[grown] + 1
        long = np.flatnonzero(words >= WINDOW)
        if len(long):
            over = long[words[long] > WINDOW]  # the rows that share the first WINDOW words
            full = index.shared[a[over]] == WINDOW
            a[over] = np.where(full, index.before[a[over]], a[over])
            full = index.shared[b[over]] == WINDOW
            b[over] = np.where(full, index.behind[b[over]], b[over])
            words[over] = WINDOW
            who = grown[long]
            found.append((live[who], at[who] - start[live[who]], index.least.of(a[long], b[long])))
        short = np.flatnonzero(~good)
        up, down, depth = index.parent(lo[short], hi[short])
        rootless = held[short] > 0
        lo[short] = np.where(rootless, up, 0)
        hi[short] = np.where(rootless, down, index.n)
        at[short[~rootless]] -= 1  # no match at this word at all
        held[short] = np.where(rootless, depth, 0)
        lo[grown], hi[grown], held[grown] = a, b, words
        at[grown] -= 1
        # A stream ends at its first word, or where what is left can't make a window.
        on = (at >= start[live]) & (at - start[live] + 1 + held >= WINDOW)
        live, at, lo, hi, held = live[on], at[on], lo[on], hi[on], held[on]
    if not found:
        return (np.empty(0, np.int64),) * 3
    who, place, least = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((place, who))
    return who[order], place[order], least[order]


def solve_shard(texts: list[bytes], first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """class, first and last window, smallest id: stretches of windows of one smallest id below the class's largest."""
    numbers: dict[bytes, int] = {}
    split = [t.split() for t in texts]
    length = np.array([len(w) for w in split], np.int64)
    start = np.cumsum(length + 1) - length - 1
    symbols = np.zeros(int((length + 1).sum()), np.int64)
    for words, s in zip(split, start.tolist()):
        symbols[s : s + len(words)] = [numbers.setdefault(w, len(numbers) + 1) for w in words]
    index = ShardIndex(symbols, len(numbers) + 1, np.repeat(first, length + 1))
    who, place, least = smallest_ids(index, symbols, start, length, last)
    if not len(who):
        return who, place, place, least
    new = np.concatenate([[True], (who[1:] != who[:-1]) | (place[1:] != place[:-1] + 1) | (least[1:] != least[:-1])])
    begin = np.flatnonzero(new)
    return who[begin], place[begin], place[np.append(begin[1:], len(who)) - 1], least[begin]


# --- the whole table ----------------------------------------------------------------------------

CLASS = "core long, hi long, lo long, lead int, span int, first long, last long, text binary, crowded boolean"
FOUND = "hi long, lo long, a int, b int, least long"


def _with_text(docs: DataFrame, classes: DataFrame, key: str) -> DataFrame:
    """The columns of CLASS for each class, its words read from the row that stands for it."""
    places = F.collect_list(F.struct("core", "hi", "lo", "at", "lead", "span", "last", "crowded")).alias("places")
    lists = classes.groupBy(F.col("first").alias("id"), "ref", "n").agg(places)
    held = _rows(docs, key).join(lists, ["id", "ref", "n"]).select("id", "places", "text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in CLASS.split(", ")]
        types = [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.int64()] * 2 + [pa.binary(), pa.bool_()]
        for batch in batches:
            out = []
            for own, places, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist()):
                plain, start = word_places(text)
                for x in places:
                    a, b = start[x["at"]], start[x["at"] + x["span"] - 1 + WINDOW] - 1
                    out.append((x["core"], x["hi"], x["lo"], x["lead"], x["span"], own, x["last"], plain[a:b], x["crowded"]))
            for i in range(0, len(out), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i : i + 20_000]), types)], names)

    return held.mapInArrow(task, CLASS)


def _search(classes: DataFrame) -> DataFrame:
    """FOUND for classes whose cores are not crowded: shards of whole cores, one index each."""
    dealt = classes.repartition("core").sortWithinPartitions("core", "hi", "lo").select("core", "hi", "lo", "first", "last", "text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def solve(rows: list[tuple]) -> pa.RecordBatch:
            rows = [r for k, r in enumerate(rows) if not k or r[1:3] != rows[k - 1][1:3]]  # rows that repeat an id and a text
            who, a, b, least = solve_shard([r[5] for r in rows], np.array([r[3] for r in rows], np.int64), np.array([r[4] for r in rows], np.int64))
            hi, lo = (np.array([r[c] for r in rows], np.int64)[who] for c in (1, 2))
            return pa.RecordBatch.from_arrays([pa.array(hi), pa.array(lo), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(least)], ["hi", "lo", "a", "b", "least"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= SHARD_WORDS and row[0] != held[-1][0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += row[5].count(b" ") + 1
        if held:
            yield solve(held)

    return dealt.mapInArrow(task, FOUND)


def _divide(classes: DataFrame, width: int) -> DataFrame:
    """whole_hi, whole_lo, off and a CLASS row for each stretch of ``width`` distances of a class's windows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["whole_hi", "whole_lo", "off", *(c.split()[0] for c in CLASS.split(", "))]
        types = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 3, *[pa.int32()] * 2, *[pa.int64()] * 2, pa.binary(), pa.bool_()]
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                words = r["text"].split()
                for nearest in range(0, SPREAD, width):  # windows that start nearest to nearest + width - 1 words before the anchor
                    a, b = max(0, r["lead"] - nearest - width + 1), min(r["span"] - 1, r["lead"] - nearest)
                    if a > b:
                        continue
                    text = b" ".join(words[a : b + WINDOW])
                    common = b" ".join(words[r["lead"] - nearest : r["lead"] - nearest - width + 1 + WINDOW])
                    both = xxhash.xxh3_128_intdigest(text)
                    signed = [int.from_bytes(x.to_bytes(8), signed=True) for x in (xxhash.xxh3_64_intdigest(common, width), both >> 64, both & 0xFFFFFFFFFFFFFFFF)]
                    # The next division counts distances from the last start that all of these windows reach.
                    out.append((r["hi"], r["lo"], a, *signed, r["lead"] - nearest - a, b - a + 1, r["first"], r["last"], text, False))
            for i in range(0, len(out), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i : i + 20_000]), types)], names)

    return classes.mapInArrow(task, "whole_hi long, whole_lo long, off int, " + CLASS)


def _found(classes: DataFrame, most: int, steps: tuple[int, ...]) -> DataFrame:
    """FOUND for all classes; those of crowded cores are divided as often as ``steps`` says, which ends with single windows."""
    simple = _search(classes.where("NOT crowded"))
    crowded = classes.where("crowded")
    if not steps or crowded.isEmpty():
        return simple
    parts = settle(_divide(crowded, steps[0]), "divided")
    cores = parts.groupBy("core").agg(F.min("first").alias("one"), F.max("last").alias("other"), F.count_distinct("hi", "lo").alias("k")).where("one < other")
    some = [F.any_value(c).alias(c) for c in ("lead", "span", "text")]
    own = parts.groupBy("core", "hi", "lo").agg(F.min("first").alias("first"), F.max("last").alias("last"), *some).join(cores, "core")
    own = own.withColumn("crowded", F.col("k") > F.lit(most if len(steps) > 1 else 2**31 - 1)).select(*[c.split()[0] for c in CLASS.split(", ")])
    inner = settle(_found(settle(own, "parts"), most, steps[1:]), "found")
    uses = parts.select("whole_hi", "whole_lo", "off", "hi", "lo", F.col("last").alias("own")).distinct()
    back = uses.join(inner, ["hi", "lo"]).where("least < own")
    return simple.unionAll(back.select(F.col("whole_hi").alias("hi"), F.col("whole_lo").alias("lo"), (F.col("a") + F.col("off")).alias("a"), (F.col("b") + F.col("off")).alias("b"), "least"))


def _shared(docs: DataFrame, key: str) -> DataFrame:
    """The segments whose core several ids hold.  Cores are counted by themselves, so most segments never meet in a class."""
    rows = settle(anchor_rows(docs, key), "segments")
    cores = rows.groupBy("core").agg(F.min("id").alias("least"), F.max("id").alias("greatest")).where("least < greatest").select("core")
    return rows.join(settle(cores, "cores"), "core", "left_semi")


def _live(rows: DataFrame, most: int) -> DataFrame:
    """One row for each class, and whether its core is crowded."""
    one = F.min(F.struct("id", "ref", "n", "at", "lead", "span")).alias("one")
    classes = settle(rows.groupBy("core", "hi", "lo").agg(one, F.max("id").alias("last")), "classes")
    return classes.join(classes.groupBy("core").agg(F.count("*").alias("k")), "core").select(
        "core", "hi", "lo", F.col("one.id").alias("first"), "one.ref", "one.n", "one.at", "one.lead", "one.span", "last", (F.col("k") > most).alias("crowded")
    )


def removed_words(docs: DataFrame, key: str = "doc_id", most: int = MOST) -> DataFrame:
    """id, ref, n, spans: word numbers (start, end, exclusive) of the windows that each text loses, overlapping as they are found."""
    spark = docs.sparkSession
    rows = settle_from(spark, "shared", lambda: _shared(docs, key))

    def found() -> DataFrame:
        live = settle_from(spark, "live", lambda: _live(rows, most))
        return _found(settle(_with_text(docs, live, key), "texts"), most, STEPS)

    spans = F.struct((F.col("at") + F.col("a")).alias("s"), (F.col("at") + F.col("b") + WINDOW).alias("e"))
    lost = rows.select("hi", "lo", "id", "ref", "n", "at").join(settle_from(spark, "found", found), ["hi", "lo"]).where("least < id")
    return lost.groupBy("id", "ref", "n").agg(F.collect_set(spans).alias("spans"))


def remove_windows(docs: DataFrame, key: str = "doc_id", most: int = MOST) -> DataFrame:
    """key, n_words, spans (maximal runs of removed words) and kept: the other words, joined by one space."""
    spans = settle_from(docs.sparkSession, "spans", lambda: removed_words(docs, key, most))
    kind = docs.schema[key].dataType.simpleString()
    rows = _rows(docs, key).withColumn("key", F.when(F.col("id") != _NONE, F.col("id")).cast(kind))
    joined = rows.join(spans, ["id", "ref", "n"], "left").select("key", "text", "spans")
    item = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, runs, texts = [], [], []
            for text, spans in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                words = (text or b"").split()
                counts.append(len(words))
                own: list[list[int]] = []
                for s, e in sorted((x["s"], x["e"]) for x in spans or ()):
                    if own and s <= own[-1][1]:
                        own[-1][1] = max(own[-1][1], e)
                    else:
                        own.append([s, e])
                for s, e in reversed(own):
                    del words[s:e]
                runs.append([{"s": s, "e": e} for s, e in own])
                texts.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(runs, item), pa.array(texts, pa.string())], ["key", "n_words", "spans", "kept"])

    found = joined.mapInArrow(task, f"key {kind}, n_words long, spans array<struct<s:int,e:int>>, kept string")
    return found.withColumnRenamed("key", key)
