"""Date, money, code and transaction-type expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fv
from .names import _lookup
from .text import as_col, clean, collapse_spaces, let, strip_all


def has_money(c: Column | str) -> Column:
    return as_col(c).rlike(fv.MONEY)


def normalize_date(c: Column | str, cleaned: bool = False) -> Column:
    """First m/d/y or m-d-y as ISO text; ISO input and text without a date pass through.

    No calendar check is made here; use :func:`to_date` for a typed column.
    ``cleaned``: the text is never null and went through ``clean`` already.
    """
    def iso(hit: Column) -> Column:
        month, day, year = (F.split_part(hit, F.lit("-"), F.lit(i)) for i in (1, 2, 3))
        century = F.when(F.length(year) == 2, F.when(year < "50", "20").otherwise("19"))
        return F.concat(
            F.coalesce(century, F.lit("")), year, F.lit("-"), F.lpad(month, 2, "0"),
            F.lit("-"), F.lpad(day, 2, "0"),
        )

    def read(s: Column) -> Column:
        hit = F.translate(F.regexp_extract(s, fv.ANY_DATE, 0), "/", "-")
        return let(
            hit,
            lambda h: F.when((h == "") | s.rlike(r"^\d{4}-\d{2}-\d{2}$"), s).otherwise(iso(h)),
        )

    return let(as_col(c) if cleaned else clean(c, drop_del=True), read)


def to_date(c: Column | str) -> Column:
    return F.try_to_timestamp(as_col(c), F.lit("yyyy-MM-dd")).cast("date")


def submission_window(year: Column | str) -> Column:
    """Filings for a year are handed in during the next one."""
    nxt = (as_col(year) + 1).cast("string")
    return F.struct(
        F.concat(F.lit("01/01/"), nxt, F.lit(" 00:00:00")).alias("start"),
        F.concat(F.lit("12/31/"), nxt, F.lit(" 23:59:59")).alias("end"),
    )


def value_range(c: Column | str) -> Column:
    """Value code to its range; unknown codes pass through."""
    c = as_col(c)
    return F.coalesce(_lookup(fv.VALUE_RANGES, F.upper(c)), c)


def range_bounds(c: Column | str) -> Column:
    """Range text to STRUCT<lo, hi>; ``hi`` is NULL for 'Over' alone.

    'None' and 'less than' start at 0 and end at the stated amount; one amount
    by itself is both ends.
    """
    text = as_col(c)
    below = text.rlike(r"(?i)\bnone\b|less\s+than|<\s*\$")
    above = text.rlike(r"(?i)\bover\b")
    amounts = F.regexp_extract_all(as_col(c), F.lit(r"\$([\d,]+)"), F.lit(1))

    def amount(i: int) -> Column:
        digits = F.regexp_replace(F.get(amounts, F.lit(i)), ",", "")
        return digits.try_cast("decimal(18,2)")

    zero = F.lit(0).cast("decimal(18,2)")
    lo = F.when(below & amount(0).isNotNull(), zero).otherwise(amount(0))
    hi = F.when(below, amount(0)).when(above, amount(1)).otherwise(F.coalesce(amount(1), amount(0)))
    return F.struct(lo.alias("lo"), hi.alias("hi"))


def _contains(c: Column, word: str) -> Column:
    return F.contains(c, F.lit(word))


def tx_type(c: Column | str) -> Column:
    """Canonical transaction type of a table cell; other text is left as typed."""
    c = as_col(c)
    words = F.lower(
        F.regexp_extract(
            c, fv.TX_TYPE_WORDS, 1
        )
    )
    return let(
        words,
        lambda hit: F.when(hit == "", c)
        .when(_contains(hit, "purchase"), "Purchase")
        .when(_contains(hit, "partial"), "Sale (Partial)")
        .when(_contains(hit, "full"), "Sale (Full)")
        .when(_contains(hit, "exchange"), "Exchange")
        .otherwise("Received"),
    )


def title_case(c: Column | str) -> Column:
    """Each run of letters with one capital in front; what is between the runs stays."""
    runs = F.regexp_extract_all(as_col(c), F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def tx_type_judicial(c: Column | str) -> Column:
    low = F.lower(as_col(c))
    return (
        F.when(low.rlike("buy|purchase"), "Purchase")
        .when(low.rlike("sell|sold|redeem"), "Sale (Full)")
        .when(_contains(low, "exchange"), "Exchange")
        .otherwise(title_case(c))
    )


def owner_label(c: Column | str) -> Column:
    """Owner code to words; a blank means the filer."""
    c = F.upper(F.trim(as_col(c)))
    return (
        F.when(c == "SP", "spouse")
        .when(c == "JT", "joint")
        .when(c == "DC", "dependent child")
        .when(c.isNull() | (c == ""), "self")
        .otherwise(F.lower(c))
    )


def split_owner(c: Column | str) -> Column:
    """Leading owner code of a merged row and the rest; no code means DC."""
    c = as_col(c)
    code = F.regexp_extract(c, fv.OWNER_HEAD, 1)
    return F.struct(
        F.when(code == "", "DC").otherwise(F.upper(code)).alias("owner"),
        strip_all(F.regexp_replace(c, fv.OWNER_HEAD, "")).alias("rest"),
    )


# -- executive form ----------------------------------------------------------


def parse_values(c: Column | str) -> Column:
    """Value, income type and income out of the value columns of one line."""
    c = as_col(c)
    amounts = F.regexp_extract_all(c, F.lit(fv.EXECUTIVE_MONEY), F.lit(1))

    def amount(i: int) -> Column:
        raw = F.get(amounts, F.lit(i))
        return F.when(raw.isNull(), "").when(
            F.lower(raw).startswith("none"), "None / <$1,001"
        ).otherwise(F.regexp_replace(strip_all(raw), r"\s+", " "))

    word = F.regexp_extract(c, fv.EXECUTIVE_INCOME, 1)
    return F.struct(
        amount(0).alias("value"),
        F.initcap(word).alias("income_type"),
        amount(1).alias("income"),
    )


def eif_split(c: Column | str) -> Column:
    """Text before the first Yes/No/N/A token and the text from there on."""
    c = as_col(c)
    hit = c.rlike(fv.EIF_INSIDE)
    return F.struct(
        F.when(hit, strip_all(F.regexp_extract(c, fv.EIF_INSIDE, 1))).otherwise(c).alias("description"),
        F.when(hit, F.regexp_extract(c, fv.EIF_INSIDE, 2)).otherwise("").alias("values_text"),
    )


# -- judiciary form ----------------------------------------------------------

def _alt(codes: list[str]) -> str:
    return "|".join(codes)


_TX_TAIL = (
    rf"(?i)^(?:(.*?) )??({_alt(fv.JUDICIAL_TX_WORDS)}) (\d{{2}}/\d{{2}}/\d{{2,4}}\b[^ ]*)(?: (.*))?$"
)
_TX_CODES = (
    rf"(?i)^({_alt(fv.VALUE_CODES)})?(?:(?:^| )({_alt(fv.INCOME_CODES)}))?(?: |$)"
)


def parse_codes(c: Column | str) -> Column:
    """Peel the code columns off the end of a judiciary line.

    From the right: method, value, income type and income code.  A transaction
    word followed by a date cuts the line there; value and gain code may follow.
    """
    # Not split: that would compile the pattern anew for every line.
    words = F.trim(collapse_spaces(c))

    def codes(s: Column) -> Column:
        # Few lines carry a date, so the long pattern runs only where a '/' is.
        is_tx = F.contains(s, F.lit("/")) & s.rlike(_TX_TAIL)
        return let(is_tx, lambda tx: let(
            F.when(tx, F.regexp_extract(s, _TX_TAIL, 1)).otherwise(s),
            lambda head: _peel_all(head, _PEEL, {}, s, tx),
        ))

    return let(words, codes)


_PEEL = [
    ("method_code", fv.METHOD_CODES),
    ("value_code", fv.VALUE_CODES),
    ("income_type", fv.JUDICIAL_INCOME_WORDS),
    ("income_code", fv.INCOME_CODES),
]


def _peel_all(rest: Column, todo: list, found: dict[str, Column], s: Column, tx: Column) -> Column:
    if todo:
        (name, codes), *more = todo
        pattern = rf"(?i)(?:^| )({_alt(codes)})$"
        code = F.regexp_extract(rest, pattern, 1)
        return let(
            F.regexp_replace(rest, pattern, ""),
            lambda shorter: _peel_all(shorter, more, {**found, name: code}, s, tx),
        )

    def part(i: int) -> Column:
        return F.when(tx, F.regexp_extract(s, _TX_TAIL, i)).otherwise("")

    def after(i: int) -> Column:
        return F.when(tx, F.upper(F.regexp_extract(part(4), _TX_CODES, i))).otherwise("")

    return F.struct(
        rest.alias("text"),
        F.upper(found["income_code"]).alias("income_code"),
        found["income_type"].alias("income_type"),
        F.upper(found["value_code"]).alias("value_code"),
        F.upper(found["method_code"]).alias("method_code"),
        part(2).alias("tx_type"),
        part(3).alias("tx_date"),
        after(1).alias("tx_value"),
        after(2).alias("tx_gain"),
    )


def sector(c: Column | str) -> Column:
    """Names of the sectors whose companies the text mentions, comma separated."""
    c = as_col(c)
    return F.concat_ws(
        ",",
        *[
            F.when(c.rlike("(?i)(?:" + "|".join(words) + ")"), F.lit(name))
            for name, words in fv.SECTORS.items()
        ],
    )


def mentions(c: Column | str, words: list[str]) -> Column:
    import re

    return as_col(c).rlike("(?i)(?:" + "|".join(re.escape(w) for w in words) + ")")
