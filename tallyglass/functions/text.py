"""Text cleaning expressions.  All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# What str.strip() removes, as a character class Java and RE2 both read.
STRIP_CLASS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}]"
)
# The same class for Java alone, which tests the sides of && in turn: printable ASCII is told by one comparison.
_STRIP_FAST = f"[[^!-~]&&{STRIP_CLASS}]"
# The same characters for btrim, which needs no regular expression.
STRIP_CHARS = "".join(
    chr(c)
    for lo, hi in [
        (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
        (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
        (0x3000, 0x3000),
    ]
    for c in range(lo, hi + 1)
)


# Control characters that extraction leaves in text; tab and line feed stay.
_CONTROLS = "".join(chr(c) for c in [*range(0x00, 0x09), *range(0x0B, 0x20)])


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Name an intermediate value inside one expression.

    A plain column alias is written out again at every use when Spark merges
    projections or pushes filters down, which doubles the expression at each
    step of a chain.  A lambda variable is computed once and never copied.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip_all(c: Column | str) -> Column:
    """Trim every kind of Unicode white space from both ends."""
    return F.btrim(as_col(c), F.lit(STRIP_CHARS))


def trim_spaces(c: Column | str) -> Column:
    """Trim plain spaces only, as SQL ``TRIM`` does."""
    return F.trim(as_col(c))


def is_blank(c: Column | str) -> Column:
    c = as_col(c)
    return c.isNull() | (F.trim(c) == "")


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(as_col(c)), F.lit(""))


def clean(c: Column | str, drop_del: bool = False) -> Column:
    """NULL to '', control characters dropped (tab and LF stay), then trimmed."""
    junk = _CONTROLS + "\x7f" if drop_del else _CONTROLS
    return strip_all(F.translate(F.coalesce(as_col(c), F.lit("")), junk, ""))


def collapse_spaces(c: Column | str, at_least: int = 1) -> Column:
    pattern = _STRIP_FAST + ("+" if at_least == 1 else f"{{{at_least},}}")
    return F.regexp_replace(as_col(c), pattern, " ")


def clean_asset(c: Column | str) -> Column:
    """Drop everything through the last arrow, then leading list dashes."""
    s = strip_all(F.regexp_replace(as_col(c), r"^.*⇒\s*", ""))
    return strip_all(F.regexp_replace(s, r"^[-–—]+\s*", ""))


def strip_labels(c: Column | str) -> Column:
    """Drop the filing-section label at the end and the schedule label in front."""
    c = as_col(c)
    s = strip_all(F.regexp_replace(c, r"\s*F\s+S\s*:.*$", ""))
    labelled = strip_all(F.regexp_replace(s, r"^S\s+O\s*:\s*", ""))
    # Both labels have a colon, which few texts have.
    return F.when(F.contains(c, F.lit(":")), labelled).otherwise(strip_all(c))


def is_label_row(c: Column | str) -> Column:
    return as_col(c).rlike(r"(?i)^F\s+S\s*:")


def strip_class_marker(c: Column | str) -> Column:
    return strip_all(F.regexp_replace(strip_all(c), r"\s*\([A-Z]\)\s*$", ""))


def ticker(c: Column | str) -> Column:
    c = as_col(c)
    return F.coalesce(
        F.nullif(F.regexp_extract(c, r"\(([A-Z]{1,5})\)", 1), F.lit("")),
        F.regexp_extract(c, r"\[([A-Z]{1,5})\]", 1),
        F.lit(""),
    )


def strip_tags(c: Column | str) -> Column:
    return strip_all(F.regexp_replace(as_col(c), r"<[^>]+>", ""))


def report_uuid(c: Column | str, kinds: str = "annual|ptr") -> Column:
    """Report id inside a search-result link, '' when the link has none."""
    return F.regexp_extract(
        F.coalesce(as_col(c), F.lit("")), rf"/search/view/(?:{kinds})/([0-9a-f-]+)/", 1
    )


def last_path_segment(c: Column | str) -> Column:
    return F.element_at(F.split(F.regexp_replace(as_col(c), r"/+$", ""), "/"), -1)


def contains_any(c: Column | str, phrases: list[str]) -> Column:
    """True when any phrase occurs: plain byte searches, no regular expression."""
    c = as_col(c)
    return reduce(or_, [F.contains(c, F.lit(p)) for p in phrases])


def like_pattern(text: str) -> str:
    """Wrap user text for a substring match; its own % and _ stay wildcards."""
    return "%" + text.replace("\\", "\\\\") + "%"


def matches(c: Column | str, text: str) -> Column:
    return as_col(c).ilike(like_pattern(text))
