"""Packing token sequences by minimum bin slack.

Each document is its token ids and one separator id.  Whole windows of long
documents fill sequences by themselves.  What remains of each document is an
item; a sequence starts with the longest item left, and a bitset of reachable
sums over the counts of the other lengths finds the multiset that comes closest
to the room that is left; the counts are traced back through the bitsets.  If
even that leaves slack, one more item is cut to fill it.  Only the very last
items of a task can leave a sequence part empty; it is cut at powers of two,
which need no padding.

A task packs its own partition, holding about ``hold`` ids at a time, so nothing
is shuffled, no task depends on another, and a task that is run again gives the
same sequences.

Edge cases: a null or empty text is the separator alone; rows that repeat are
packed again; null ids are carried; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY, SEPARATOR, HOLD = 2048, 1, 2_000_000

# Fixed value: the pre-tokenizer's pattern of this vocabulary family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def plain_bytes() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: itself where it prints, else the next free code from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Token ids of whole texts, as little-endian 32-bit bytes, for a byte-level vocabulary in JSON.

    The pieces of such a vocabulary merge in the order of their ids, so its own
    file serves tiktoken as ranks, which gives the same ids as the tokenizers
    library in a fifth of the time.  With ``special``, an added token of the file
    that stands in a text is its own id, as in the library by default; without,
    it is ordinary text.
    """

    def __init__(self, vocabulary: str, special: bool = False):
        import tiktoken

        loaded, byte = json.loads(vocabulary), plain_bytes()
        added = {t["content"]: t["id"] for t in loaded.get("added_tokens") or ()}
        ranks = {bytes(byte[c] for c in piece): i for piece, i in loaded["model"]["vocab"].items() if piece not in added}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
        self.allowed = set(added) if special else set()

    def __call__(self, text: str) -> bytes:
        return self.encoding.encode_to_numpy(text, allowed_special=self.allowed, disallowed_special=()).astype("<u4", copy=False).tobytes() if text else b""


def closest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths, within their counts, whose sum is the largest not above ``room``."""
    reach, steps, full = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left > 0:  # copies in powers of two reach every count
            take = min(take, left)
            steps.append((reach, length, take))
            reach |= (reach << (length * take)) & full
            left, take = left - take, take * 2
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, []
    for before, length, take in reversed(steps):
        if not before >> total & 1:
            chosen += [length] * take
            total -= length * take
    return chosen


def fill(lengths: list[int], capacity: int = CAPACITY, last: bool = True, spare: int = 0) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length), and the items left over for later.

    Unless ``last``, packing stops when at most ``spare`` ids are left.
    """
    full: list[list[tuple[int, int, int]]] = []
    items: dict[int, list[tuple[int, int]]] = defaultdict(list)  # length: (document, start)
    for d, n in enumerate(lengths):
        full += [[(d, s, capacity)] for s in range(0, n - n % capacity, capacity)]
        if n % capacity:
            items[n % capacity].append((d, n - n % capacity))
    left = sum(k * len(v) for k, v in items.items())

    def take(length: int) -> tuple[int, int, int]:
        d, s = items[length].pop()
        if not items[length]:
            del items[length]
        return d, s, length

    while left > (0 if last else max(spare, capacity)):
        pieces = [take(max(items))]
        room = capacity - pieces[0][2]
        pieces += [take(x) for x in closest({k: len(v) for k, v in items.items() if k <= room}, room)]
        room -= sum(p[2] for p in pieces[1:])
        while room and items:
            d, s, n = take(max(items))
            cut = min(room, n)
            pieces.append((d, s, cut))
            if n > cut:
                items[n - cut].append((d, s + cut))
            room -= cut
        left -= capacity - room
        full += [pieces] if not room else powers(pieces)
    return full, [(d, s, k) for k, v in items.items() for d, s in v]


def powers(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The pieces of a part-filled sequence, cut into sequences whose lengths are powers of two."""
    total, out = sum(p[2] for p in pieces), []
    rest = list(reversed(pieces))
    while total:
        size = 1 << (total.bit_length() - 1)
        total, own = total - size, []
        while size:
            d, s, n = rest.pop()
            cut = min(n, size)
            own.append((d, s, cut))
            if n > cut:
                rest.append((d, s + cut, n - cut))
            size -= cut
        out.append(own)
    return out


NAMES = ("key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack(docs: DataFrame, vocabulary_path: str, key: str = "doc_id", capacity: int = CAPACITY, separator: int = SEPARATOR, hold: int = HOLD) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    The vocabulary file (of fixed size) is read by the driver and broadcast.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    schema = f"key {rows.schema['key'].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in NAMES[1:])
    end = np.array([separator], "<u4").tobytes()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, place = Encoder(vocabulary.value, special=True), TaskContext.get().partitionId() << 32
        # Held documents: key, all ids' length, ids of the part that is still to be placed, and where that part starts.
        held: list[tuple] = []
        kind, number = None, 0

        def packed(last: bool) -> pa.RecordBatch:
            nonlocal held, number
            sequences, rest = fill([len(h[2]) // 4 for h in held], capacity, last, 32 * capacity)
            out = []
            for pieces in sequences:
                at = 0
                for d, s, n in pieces:
                    name, total, ids, base = held[d]
                    out.append((name, base + s, n, zlib.crc32(ids[4 * s : 4 * (s + n)]), total, place + number, at))
                    at += n
                number += 1
            held = [(held[d][0], held[d][1], held[d][2][4 * s : 4 * (s + n)], held[d][3] + s) for d, s, n in rest]
            return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kind if not i else pa.int64()) for i in range(7)], list(NAMES))

        size = 0
        for batch in batches:
            kind = batch.column(0).type
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py()) + end
                held.append((name, len(ids) // 4, ids, 0))
                size += len(ids) // 4
                if size >= hold:
                    yield packed(False)
                    size = sum(len(h[2]) // 4 for h in held)
        if held:
            yield packed(True)

    return rows.mapInArrow(task, schema).withColumnRenamed("key", key)
