"""Person-name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fv
from .fold import ascii_fold, fold_accents, literal_map  # noqa: F401
from .text import STRIP_CLASS, as_col, clean, strip_all


def strip_hon_anywhere(c: Column | str) -> Column:
    return strip_all(
        F.regexp_replace(as_col(c), rf"(?i)\b(?:the{STRIP_CLASS}+honorable|hon\.\.?){STRIP_CLASS}*", "")
    )


def strip_hon_prefix(c: Column | str) -> Column:
    return strip_all(F.regexp_replace(strip_all(c), rf"(?i)^hon\.\.?{STRIP_CLASS}+", ""))


def strip_hon_first_word(c: Column | str) -> Column:
    """Drop the first word when the text starts with 'hon.'."""
    c = as_col(c)
    return F.when(
        F.lower(F.substring(c, 1, 4)) == "hon.",
        F.trim(F.substr(c, F.instr(c, " ") + F.lit(1))),
    ).otherwise(c)


def strip_credentials(c: Column | str) -> Column:
    """Drop leading and trailing credential tokens, but never all of the name."""
    c = as_col(c)
    tokens = F.transform(
        F.filter(F.split(c, rf"(?:,|{STRIP_CLASS})+"), lambda t: t != ""),
        lambda t: F.regexp_replace(t, r"\.+$", ""),
    )
    words = F.array_join(tokens, " ")
    cred = "|".join(fv.CREDENTIALS)
    kept = F.regexp_replace(words, rf"(?i)^(?:(?:{cred})(?: |$))+", "")
    kept = F.regexp_replace(kept, rf"(?i)(?:(?:^| )(?:{cred}))+$", "")
    return F.when(kept == "", c).otherwise(kept)


def split_name(c: Column | str) -> Column:
    """'Last, First' or 'First Middle Last' to STRUCT<last, first>."""
    full = strip_hon_anywhere(c)
    words = F.array_join(F.filter(F.split(full, STRIP_CLASS + "+"), lambda t: t != ""), " ")
    has_comma = F.contains(full, F.lit(","))
    last = F.when(has_comma, F.substring_index(full, ",", 1)).otherwise(
        F.substring_index(words, " ", -1)
    )
    first = F.when(has_comma, F.regexp_extract(full, r"(?s)^[^,]*,(.*)$", 1)).otherwise(
        F.regexp_extract(words, r"^(.*) [^ ]+$", 1)
    )
    return F.struct(
        clean(last, drop_del=True).alias("last"), clean(first, drop_del=True).alias("first")
    )


def first_word(c: Column | str) -> Column:
    return F.substring_index(strip_all(F.regexp_replace(as_col(c), STRIP_CLASS + "+", " ")), " ", 1)


def last_word(c: Column | str) -> Column:
    return F.substring_index(strip_all(F.regexp_replace(as_col(c), STRIP_CLASS + "+", " ")), " ", -1)


def strip_suffix(c: Column | str) -> Column:
    """Heading text to a plain name: honorific, generation suffix, office note."""
    s = strip_all(F.regexp_replace(as_col(c), r"(?i)the\s+honorable\s*", ""))
    s = strip_all(F.regexp_replace(s, r"(?i)\s+(jr|sr|ii|iii|iv)\.?$", ""))
    return strip_all(
        F.regexp_replace(
            s,
            r"(?i)\s*\((?:Former\s+)?(?:Senator|Representative|Congressman|Member)\s*\).*$",
            "",
        )
    )


def parenthesised_name(c: Column | str) -> Column:
    """The 'Last, First' inside parentheses, '' when there is none."""
    return F.regexp_extract(
        as_col(c), r"\(([A-Za-z][^,)]{1,30},\s*[A-Za-z][^)]{1,30})\)", 1
    )


def _lookup(mapping: dict[str, str], key: Column) -> Column:
    return F.try_element_at(literal_map(mapping), key)


def nickname(c: Column | str) -> Column:
    """Other form of a lower-case first name, NULL when none is known."""
    return _lookup(fv.NICKNAMES, as_col(c))


def alias_nickname(c: Column | str) -> Column:
    known = {k: v for k, v in fv.NICKNAMES.items() if k not in fv.NICKNAMES_NOT_FOR_ALIASES}
    return _lookup(known, as_col(c))


def justice_party(last: Column | str) -> Column:
    return _lookup(fv.JUSTICE_PARTY, F.lower(as_col(last)))


def display_first(first: Column, nick: Column, official: Column) -> Column:
    """Nickname, else the official first word when it differs, else the legal first."""
    official_first = F.coalesce(first_word(official), F.lit(""))
    return F.when(F.coalesce(nick, F.lit("")) != "", nick).otherwise(
        F.when(
            (official_first != "")
            & (F.lower(official_first) != F.lower(F.coalesce(first, F.lit("")))),
            official_first,
        ).otherwise(F.coalesce(first, F.lit("")))
    )


def name_candidates(c: Column | str) -> Column:
    """Distinct lower-case tries in order: last word, first word, whole name."""
    s = strip_hon_prefix(c)
    tries = F.array(F.lower(last_word(s)), F.lower(first_word(s)), F.lower(s))
    return F.when(s.isNull() | (s == ""), F.array().cast("array<string>")).otherwise(
        F.array_distinct(tries)
    )


def alias_keys(c: Column | str) -> Column:
    """Every alias that would cover this lower-case name.

    An alias covers a name when it equals it, or is the part before one of its
    spaces, or the part after one.  Listing those parts turns the text match
    into an equality join.
    """
    words = F.split(as_col(c), " ")
    cuts = F.when(F.size(words) > 1, F.sequence(F.lit(1), F.size(words) - 1)).otherwise(
        F.array().cast("array<int>")
    )
    heads = F.transform(cuts, lambda i: F.array_join(F.slice(words, F.lit(1), i), " "))
    tails = F.transform(
        cuts, lambda i: F.array_join(F.slice(words, i + 1, F.size(words)), " ")
    )
    return F.array_distinct(F.concat(F.array(as_col(c)), heads, tails))


def sort_form(last: Column | str, first: Column | str) -> Column:
    """Roster rendering of a name."""
    return F.concat(as_col(last), F.lit(", Hon.. "), as_col(first))
