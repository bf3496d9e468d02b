"""Accent folding without Python in the tasks.

Compatibility decomposition works letter by letter, and dropping everything
that is not ASCII afterwards makes the order of combining marks irrelevant.
So the fold is a fixed replacement per code point, read off the Unicode tables
once: letters that keep one ASCII character go through ``translate``, the few
that become several go through a map, all others are dropped.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col, let, strip_all

_ASCII = r"^[\x00-\x7f]*$"
#: Different letters beyond ASCII that are replaced one by one.
_FEW = 64


@cache
def _replacements() -> tuple[str, str, dict[str, str]]:
    old, new, several = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        if not unicodedata.decomposition(char):
            continue
        ascii_part = (
            unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode("ascii")
        )
        if len(ascii_part) == 1:
            old.append(char)
            new.append(ascii_part)
        elif ascii_part:
            several[char] = ascii_part
    return "".join(old), "".join(new), several


def literal_map(pairs: dict[str, str]) -> Column:
    """A constant map as one literal; the optimizer evaluates it once."""
    return F.from_json(F.lit(json.dumps(pairs)), "map<string,string>")


def _by_letter(s: Column) -> Column:
    """The fold of every letter of a text, in passes over the whole of it."""
    old, new, several = _replacements()
    wide = "[" + "".join(rf"\x{{{ord(x):x}}}" for x in several) + "]"
    table = literal_map(several)
    letters = F.regexp_extract_all(s, F.lit(r"(?s)(.)"), F.lit(1))
    spelled = F.array_join(
        F.transform(letters, lambda x: F.coalesce(F.try_element_at(table, x), x)), ""
    )
    opened = F.when(s.rlike(wide), spelled).otherwise(s)
    return F.regexp_replace(F.translate(opened, old, new), r"[^\x00-\x7f]", "")


def ascii_fold(c: Column | str) -> Column:
    """Nearest ASCII text, trimmed; letters keep their case, NULL becomes ''.

    A long text has few different letters beyond ASCII.  Only those are looked
    up, and each is replaced by one search for its bytes.
    """
    s = F.coalesce(as_col(c), F.lit(""))

    def folded(letters: Column) -> Column:
        few = F.aggregate(letters, s, lambda text, x: F.replace(text, x, _by_letter(x)))
        return F.when(F.size(letters) <= _FEW, few).otherwise(_by_letter(s))

    beyond = F.array_distinct(F.split(F.regexp_replace(s, r"[\x00-\x7f]+", ""), ""))
    return strip_all(F.when(s.rlike(_ASCII), s).otherwise(let(beyond, folded)))


def fold_accents(c: Column | str) -> Column:
    """:func:`ascii_fold` in lower case."""
    return F.lower(ascii_fold(c))
