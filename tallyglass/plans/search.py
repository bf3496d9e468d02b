"""Faceted search, member browsing, exports and read-only SQL."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import names as nm
from ..functions import text as tx
from ..operators.joins import lookup
from ..operators.paging import SortKey, after, deep_page

NONE_FACET = "__none__"
#: Up to this offset a page is a top-k; beyond it the row before the page is found by range counts.
SHALLOW = 10_000
_MEMBER = {
    "party": "mi_party",
    "state": "mi_state",
    "last_name": "mi_last",
    "display_first": "mi_display",
}


@dataclass
class Page:
    """A page of results and the (lazy) count of all of them."""

    total: DataFrame
    rows: DataFrame
    message: str | None = None


# -- predicates --------------------------------------------------------------


def not_legend(asset: str = "asset") -> Column:
    """Footnote rows read as holdings: one digit 1-9, a dot and a space in front."""
    return ~F.col(asset).rlike(r"^[1-9]\. ")


def member_is(text: str, canonical: bool) -> Column:
    last, first = F.col("last_name"), F.col("first_name")
    forms = [last, first, F.concat(last, F.lit(", "), first)]
    if canonical:
        forms.append(
            F.concat(F.coalesce("mi_last", last), F.lit(", "), F.coalesce("mi_display", first))
        )
    return reduce(or_, [tx.matches(f, text) for f in forms])


def any_column_has(text: str, *columns: str) -> Column:
    return reduce(or_, [tx.matches(c, text) for c in columns])


def facet(column: str, choices: str) -> Column | None:
    """'a|b|__none__': any part as a substring, or blank; no part means no filter."""
    parts = [p.strip() for p in choices.split("|") if p.strip()]
    tests = [tx.matches(column, p) for p in parts if p != NONE_FACET]
    if NONE_FACET in parts:
        tests.append(tx.is_blank(column))
    return reduce(or_, tests) if tests else None


def party_is(text: str, justices: bool = True) -> Column:
    test = tx.matches("mi_party", text)
    if justices:
        test = test | (
            (F.col("chamber") == "SCOTUS") & tx.matches(nm.justice_party("last_name"), text)
        )
    return test


def state_is(state: str) -> Column:
    """The row's own state as written, else the member's where the row has none."""
    return (F.col("state") == state) | (tx.is_blank("state") & (F.col("mi_state") == state))


def effective_state() -> Column:
    return F.coalesce(tx.blank_to_null("state"), F.col("mi_state"))


def _where(df: DataFrame, tests: list[Column | None]) -> DataFrame:
    kept = [t for t in tests if t is not None]
    return df.where(reduce(and_, kept)) if kept else df


# -- shared pieces -----------------------------------------------------------


def with_member(facts: DataFrame, members: DataFrame) -> DataFrame:
    return lookup(facts, members, "bioguide", _MEMBER, spread_by=F.xxhash64("id"))


def sort_order(column: str, direction: str, allowed: list[str], default: list[SortKey]) -> list[SortKey]:
    """Whitelisted sort column, else the default; the id makes the order total."""
    chosen = [SortKey(column, direction == "desc")] if column in allowed else default
    return [*chosen, SortKey("id")]


def page(
    df: DataFrame, order: list[SortKey], limit: int, offset: int, most: int | None = None, after_id: int | None = None
) -> DataFrame:
    """Sort with limit and offset: each task keeps its best rows, no full sort.

    ``most`` is a cap of the caller's own; a request above it, or a negative
    number, is an error and not another page.  ``after_id`` starts the page
    behind the row with that id, whatever rows came or went before it.
    """
    if limit < 0 or offset < 0 or (most is not None and limit > most):
        raise ValueError(f"limit {limit} and offset {offset} must not be negative, limit at most {most}")
    if after_id is not None:
        last = df.where(F.col("id") == after_id).select(*[k.column for k in order]).first()
        if last is None:
            raise ValueError(f"no row with id {after_id} among the rows found")
        df = after(df, order, tuple(last))
    if offset > SHALLOW:
        return deep_page(df, order, limit, offset)
    return df.orderBy(*[k.order for k in order]).offset(offset).limit(limit)


def _page_of(
    base: DataFrame, members: DataFrame, joined: list, order: list[SortKey], limit: int, offset: int, most: int | None, after_id: int | None
) -> DataFrame:
    """One page with its member columns; without member filters only the page's rows meet the member table."""
    kept = [j for j in joined if j is not None]
    if kept:
        return page(_where(with_member(base, members), kept), order, limit, offset, most, after_id)
    return with_member(page(base, order, limit, offset, most, after_id), members).orderBy(*[k.order for k in order])


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"))


# -- queries -----------------------------------------------------------------


def stats(holdings: DataFrame) -> dict[str, DataFrame]:
    return {
        "total": _count(holdings),
        "members": holdings.agg(
            F.countDistinct(F.concat("last_name", "first_name")).alias("members")
        ),
        "chambers": holdings.groupBy("chamber")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "chamber"),
    }


def search_holdings(
    holdings: DataFrame, members: DataFrame, *, member: str = "", asset: str = "",
    chamber: str = "", asset_type: str = "", party: str = "", state: str = "",
    sort_col: str = "", sort_dir: str = "asc", limit: int = 500, offset: int = 0, most: int | None = None,
    after_id: int | None = None,
) -> Page:
    own = [
        not_legend(),
        any_column_has(asset, "asset", "asset_type") if asset else None,
        F.col("chamber") == chamber if chamber else None,
        facet("asset_type", asset_type),
    ]
    joined = [
        member_is(member, canonical=True) if member else None,
        party_is(party) if party else None,
        state_is(state) if state else None,
    ]
    base = _where(holdings, own)  # reaches the scan, below the join
    found = _where(with_member(base, members), joined)
    # One member row per key: without member filters the join cannot change the count.
    total = _count(found if any(j is not None for j in joined) else base)
    order = sort_order(
        sort_col, sort_dir, fv.HOLDING_SORT_COLUMNS,
        [SortKey(c) for c in ("chamber", "last_name", "first_name")],
    )
    top = _page_of(base, members, joined, order, limit, offset, most, after_id)
    return Page(total, top.select(*_HOLDING_OUT, *_member_out()))


# The columns of a result, as its readers know them.
_HOLDING_OUT = [
    "id", "chamber", "last_name", "first_name", "asset", "asset_type", "owner", "value",
    "income_type", "income",
]
_TX_OUT = [
    "id", "chamber", "last_name", "first_name", "transaction_date", "disclosure_date", "asset",
    "asset_type", "transaction_type", "amount", "ticker", "comment",
]


def _member_out() -> list[Column]:
    return [
        effective_state().alias("state"),
        F.col("mi_party").alias("party"),
        F.coalesce("mi_display", "first_name").alias("display_first"),
    ]


def search_transactions(
    transactions: DataFrame | None, members: DataFrame, *, member: str = "", asset: str = "",
    asset_type: str = "", chamber: str = "", tx_type: str = "", date_from: str = "",
    date_to: str = "", party: str = "", state: str = "", sort_col: str = "",
    sort_dir: str = "desc", limit: int = 500, offset: int = 0, most: int | None = None,
    after_id: int | None = None,
) -> Page:
    if transactions is None:
        spark = members.sparkSession
        return Page(
            spark.createDataFrame([(0,)], "total bigint"),
            spark.createDataFrame(
                [], ", ".join(f"{c} string" for c in [*_TX_OUT, "state", "party", "display_first"])
            ),
            "No transactions table has been loaded yet",
        )
    own = [
        member_is(member, canonical=False) if member else None,
        any_column_has(asset, "asset", "ticker") if asset else None,
        facet("asset_type", asset_type),
        F.col("chamber") == chamber if chamber else None,
        tx.matches("transaction_type", tx_type) if tx_type else None,
        F.col("transaction_date") >= date_from if date_from else None,
        F.col("transaction_date") <= date_to if date_to else None,
    ]
    joined = [
        party_is(party) if party else None,
        effective_state() == state if state else None,
    ]
    base = _where(transactions, own)
    found = _where(with_member(base, members), joined)
    total = _count(found if any(j is not None for j in joined) else base)
    order = sort_order(
        sort_col, sort_dir, fv.TRANSACTION_SORT_COLUMNS,
        [SortKey("transaction_date", descending=True), SortKey("last_name")],
    )
    top = _page_of(base, members, joined, order, limit, offset, most, after_id)
    return Page(total, top.select(*_TX_OUT, *_member_out()))


def export_holdings(
    holdings: DataFrame, *, member: str = "", asset: str = "", chamber: str = "",
    asset_type: str = "", state: str = "",
) -> DataFrame:
    """All matching rows, ten columns, no join; sort when writing."""
    tests = [
        not_legend(),
        member_is(member, canonical=False) if member else None,
        any_column_has(asset, "asset", "asset_type") if asset else None,
        F.col("chamber") == chamber if chamber else None,
        facet("asset_type", asset_type),
        F.col("state") == state if state else None,
    ]
    return (
        _where(holdings, tests)
        .orderBy("chamber", "last_name", "first_name")
        .select(
            "chamber", "last_name", "first_name", "state", "asset", "asset_type", "owner",
            "value", "income_type", "income",
        )
    )


def browse_members(
    holdings: DataFrame, members: DataFrame, *, q: str = "", chamber: str = "", state: str = "",
    party: str = "", limit: int | None = None,
) -> DataFrame:
    """Distinct canonical names, ordered by the least raw last name behind each."""
    base = _where(
        holdings,
        [
            any_column_has(q, "last_name", "first_name") if q else None,
            F.col("chamber") == chamber if chamber else None,
        ],
    )
    # Rows shrink to distinct filer facts before they meet the member table.
    base = base.groupBy("bioguide", "chamber", "last_name", "first_name", "state").agg(
        F.min("id").alias("id")
    )
    found = _where(
        with_member(base, members),
        [state_is(state) if state else None, party_is(party, justices=False) if party else None],
    )
    names = (
        found.select(
            F.coalesce("mi_last", "last_name").alias("last_name"),
            F.coalesce("mi_display", "first_name").alias("first_name"),
            "chamber",
            effective_state().alias("state"),
            F.col("mi_party").alias("party"),
            F.col("last_name").alias("raw_last"),
        )
        .groupBy("last_name", "first_name", "chamber", "state", "party")
        .agg(F.min("raw_last").alias("raw_last"))
    )
    names = names.orderBy(
        F.asc_nulls_first("raw_last"),
        *[F.asc_nulls_first(c) for c in ("last_name", "first_name", "chamber", "state", "party")],
    )
    return (names if limit is None else names.limit(limit)).drop("raw_last")


def asset_types(holdings: DataFrame) -> DataFrame:
    return (
        holdings.where(F.col("asset_type") != "").select("asset_type").distinct().orderBy("asset_type")
    )


# -- read-only SQL -----------------------------------------------------------

# Spark's functions that reach any public JVM method.
_CALLS_OUT = re.compile(r"\b(?:java_method|reflect|try_reflect)\s*\(", re.I)


class NotASelect(ValueError):
    """The statement would do more than read."""


def run_select(spark: SparkSession, sql: str, args: dict | None = None) -> DataFrame:
    """Run one SELECT over the registered views.

    Spark's own grammar decides what a query is, so a WITH in front of an
    INSERT is refused although its text starts like a read.  Files cannot be
    named as tables, and functions that call into the JVM are refused wherever
    they stand in the analysed plan, subqueries included.  Columns that share a
    name get a numbered suffix.
    """
    text = sql.strip().lstrip(";").strip().rstrip(";").strip()
    parser = spark._jsparkSession.sessionState().sqlParser()
    try:
        as_query = parser.parseQuery(text).getClass().getName()
        as_statement = parser.parsePlan(text).getClass().getName()
    except Exception as e:
        raise NotASelect("only SELECT statements are allowed") from e
    if as_query != as_statement:
        raise NotASelect("only SELECT statements are allowed")
    before = spark.conf.get("spark.sql.runSQLOnFiles")
    spark.conf.set("spark.sql.runSQLOnFiles", "false")
    try:
        df = spark.sql(text, args=args) if args else spark.sql(text)
    finally:
        spark.conf.set("spark.sql.runSQLOnFiles", before)
    if _CALLS_OUT.search(df._jdf.queryExecution().analyzed().toString()) or _CALLS_OUT.search(text):
        raise NotASelect("functions that call into the JVM are not allowed")
    names = [c.lower() for c in df.columns]
    if len(set(names)) < len(names):
        df = df.toDF(*_distinct_names(df.columns))
    return df


def _distinct_names(columns: list[str]) -> list[str]:
    seen: dict[str, int] = {}
    out = []
    for c in columns:
        n = seen.get(c.lower(), 0)
        seen[c.lower()] = n + 1
        out.append(c if n == 0 else f"{c}_{n + 1}")
    return out
