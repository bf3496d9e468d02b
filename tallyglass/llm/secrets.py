"""Secret scan: keyword automaton first, anchored patterns only at its hits, then checksums inside the token.

Kinds.  ``assign``, ``access`` and ``hex`` are the base kinds, found leftmost
and without overlap.  ``github`` and ``npm`` are tokens that carry a checksum in
their last six characters, and ``jwt`` signed tokens whose header must decode to
JSON with an algorithm; what fails that test is dropped.

Edge cases: a null or empty text has no spans; rows are scanned one by one, so
repeats change nothing; an empty table gives an empty result; other columns are
ignored.  Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "github", "npm", "jwt")

# Keywords, and the published token formats.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "api_key", "apikey"),
    "access": ("AKIA",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "jwt": ("eyJ",),
}
PATTERNS = {
    "assign": re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "hex": re.compile(rb"[0-9a-f]{32,}"),
    "github": re.compile(rb"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"),
    "npm": re.compile(rb"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"),
    "jwt": re.compile(rb"(eyJ[0-9A-Za-z_-]+)\.([0-9A-Za-z_-]+)\.[0-9A-Za-z_-]+"),
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62_crc(body: bytes) -> bytes:
    """The CRC-32 of the token's body as six base-62 digits."""
    n, digits = zlib.crc32(body), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        digits = BASE62[r] + digits
    return digits.encode()


def _json_header(part: bytes) -> bool:
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(part + b"=" * (-len(part) % 4)))
    except (ValueError, binascii.Error, TypeError, RecursionError):
        return False


#: What a match must pass to count.
VALID = {
    "assign": lambda m: len(m[2]) >= 8,
    "access": lambda m: len(m[0]) >= 16,
    "github": lambda m: base62_crc(m[1]) == m[2],
    "npm": lambda m: base62_crc(m[1]) == m[2],
    "jwt": lambda m: _json_header(m[1]),
}


def automaton() -> ahocorasick.Automaton:
    """Every keyword, lower-cased, with the kinds it starts."""
    kinds: dict[str, list[tuple[str, bytes]]] = {}
    for kind, words in KEYWORDS.items():
        for w in words:
            kinds.setdefault(w.lower(), []).append((kind, w.encode()))
    found = ahocorasick.Automaton()
    for w, k in kinds.items():
        found.add_word(w, (len(w), k))
    found.make_automaton()
    return found


def find(text: bytes, words: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, end, kind number) in bytes, ordered by start, then kind.

    A pattern begins with its keyword, so trying it at the keyword's hits from
    left to right, skipping hits inside the last match, gives exactly the
    leftmost matches without overlap.  Hits come ordered by their end; the
    starts are put in order first.
    """
    out = [(m.start(), m.end(), 2) for m in PATTERNS["hex"].finditer(text)]
    # One character a byte: offsets stay bytes, and only A-Z change case.
    hits = sorted((end + 1 - n, kind, word) for end, (n, kinds) in words.iter(text.lower().decode("latin-1")) for kind, word in kinds)
    last = dict.fromkeys(KEYWORDS, 0)
    for start, kind, word in hits:
        if start < last[kind] or kind != "assign" and not text.startswith(word, start):
            continue
        if m := PATTERNS[kind].match(text, start):
            last[kind] = m.end()
            if VALID[kind](m):
                out.append((m.start(), m.end(), KINDS.index(kind)))
    return sorted(out, key=lambda x: (x[0], x[2]))


def spans(text: bytes, words: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points."""
    found = find(text, words)
    if not found:
        return []
    at, places, chars = 0, {}, 0
    for p in sorted({x for f in found for x in f[:2]}):
        chars += len(text[at:p].decode("utf-8", "replace"))
        at, places[p] = p, chars
    return [(KINDS[k], places[a], places[b]) for a, b, k in found]


def scan(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key and spans (kind, start, end) of each whole text; one pass, nothing shuffled."""
    rows = docs.select(F.col(key).alias("key"), "text")
    schema = "key " + rows.schema["key"].dataType.simpleString() + ", spans array<struct<kind:string,start:bigint,end:bigint>>"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton()
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end"), s)) for s in spans(t, words)] if t else [] for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["key", "spans"])

    return rows.mapInArrow(task, schema).withColumnRenamed("key", key)


def digest(spans: list[tuple[str, int, int]]) -> str:
    """sha256 of kind:start:end, comma-joined; what the query derives in SQL."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
