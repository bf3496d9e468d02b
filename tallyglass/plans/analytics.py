"""The example questions as named queries, with their parts as parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import text as tx
from ..functions import values as vl
from .search import not_legend


def with_bounds(df: DataFrame, column: str) -> DataFrame:
    b = vl.range_bounds(column)
    return df.withColumns({"lo": b["lo"], "hi": b["hi"]})


def mentioning(
    holdings: DataFrame, words: list[str], chamber: str | None = None, columns: tuple[str, ...] = ("asset",)
) -> DataFrame:
    """Holdings whose asset mentions one of the words."""
    df = holdings.where(not_legend())
    if chamber:
        df = df.where(F.col("chamber") == chamber)
    hit = vl.mentions(columns[0], words)
    for c in columns[1:]:
        hit = hit | vl.mentions(c, words)
    return df.where(hit)


def sector_holdings(holdings: DataFrame, sector: str, chamber: str | None = None) -> DataFrame:
    return mentioning(holdings, fv.SECTORS[sector], chamber)


def top_filers(holdings: DataFrame, chamber: str, kind: str, n: int = 20) -> DataFrame:
    """Filers with the most holdings of a kind."""
    return (
        holdings.where(not_legend() & (F.col("chamber") == chamber) & tx.matches("asset_type", kind))
        .groupBy("last_name", "first_name")
        .agg(F.count(F.lit(1)).alias("n_holdings"))
        .orderBy(F.desc("n_holdings"), F.asc_nulls_first("last_name"), F.asc_nulls_first("first_name"))
        .limit(n)
    )


def _seats(assignments: DataFrame, committees: DataFrame, name: str, full_only: bool) -> DataFrame:
    wanted = committees.where(tx.matches("name", name))
    if full_only:
        wanted = wanted.where(F.col("parent_id").isNull())
    return assignments.join(wanted.select("thomas_id"), "thomas_id")


def committee_holdings(
    holdings: DataFrame, assignments: DataFrame, committees: DataFrame, name: str, full_only: bool = True
) -> DataFrame:
    """Holdings of members of the committees matching ``name``, by member key.

    Seats are counted per member first, so each holding comes out once with
    the number of matching seats, however many a member has.
    """
    seats = (
        _seats(assignments, committees, name, full_only)
        .groupBy("bioguide")
        .agg(F.count(F.lit(1)).alias("seats"))
    )
    return holdings.join(seats, "bioguide")


def committee_holdings_by_name(
    holdings: DataFrame, assignments: DataFrame, committees: DataFrame, name: str, full_only: bool = True
) -> DataFrame:
    """The same through names, for rows without a key; ``seats`` as above."""
    seats = (
        _seats(assignments, committees, name, full_only)
        .groupBy(F.lower("last_name").alias("__l"), F.lower("first_name").alias("__f"))
        .agg(F.count(F.lit(1)).alias("seats"))
    )
    return holdings.join(
        seats, (F.lower("last_name") == F.col("__l")) & (F.lower("first_name") == F.col("__f"))
    ).drop("__l", "__f")


def trades_of(transactions: DataFrame, issuer: str, date_from: str, date_to: str) -> DataFrame:
    return transactions.where(
        (tx.matches("asset", issuer) | tx.matches("ticker", issuer))
        & F.col("transaction_date").between(date_from, date_to)
    )


def holdings_of(holdings: DataFrame, last_name: str) -> DataFrame:
    return holdings.where(not_legend() & (F.lower("last_name") == last_name.lower()))


def largest(holdings: DataFrame, chamber: str, n: int = 50) -> DataFrame:
    """Holdings with the highest lower bound of their value range."""
    df = with_bounds(holdings.where(not_legend() & (F.col("chamber") == chamber)), "value")
    return df.where(F.col("lo").isNotNull()).orderBy(F.desc("lo"), "id").limit(n)


def traders_in(transactions: DataFrame, words: list[str], year: int) -> DataFrame:
    """Members who traded matching assets in a year, with their number of trades."""
    return (
        transactions.where((F.col("filing_year") == year) & vl.mentions("asset", words))
        .groupBy("last_name", "first_name", "chamber")
        .agg(F.count(F.lit(1)).alias("n_trades"), F.min("transaction_date").alias("first_trade"))
    )


def whole_chamber(holdings: DataFrame, chamber: str) -> DataFrame:
    return holdings.where(not_legend() & (F.col("chamber") == chamber))
