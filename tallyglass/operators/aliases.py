"""Learning filing-name aliases and repairing missing member keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import names as nm
from ..session import settle

ALIAS_COLUMNS = ["bioguide", "last_name", "first_name"]


def seed_aliases(members: DataFrame) -> DataFrame:
    """Legal first names and display names that differ from them."""
    legal = members.where(F.col("first_name") != "").select(*ALIAS_COLUMNS)
    shown = members.where(
        (F.col("display_first") != "")
        & (F.lower("display_first") != F.lower("first_name"))
    ).select("bioguide", "last_name", F.col("display_first").alias("first_name"))
    return legal.unionByName(shown).distinct()


def seed_when_empty(existing: DataFrame, members: DataFrame) -> DataFrame:
    """The alias table as it is, or the seeds if it has no row yet."""
    return seed_aliases(members) if existing.isEmpty() else existing


def unique_last_names(members: DataFrame) -> DataFrame:
    """Last names only one member bears, with that member."""
    return (
        members.groupBy(F.lower("last_name").alias("last_lc"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("bioguide").alias("bioguide"))
        .where(F.col("n") == 1)
        .drop("n")
    )


def learn_aliases(facts: DataFrame, members: DataFrame, aliases: DataFrame) -> DataFrame:
    """Names on filings that point to one member and that no alias covers yet.

    Names are made distinct before any join.  The uniqueness guard leaves one
    member per last name, so the join cannot multiply rows, and "covered by an
    alias" is an equality join on the parts of the name an alias could be.
    """
    names = (
        facts.where(
            (F.col("first_name") != "") & F.lower("chamber").isin("senate", "house")
        )
        .select("last_name", nm.strip_hon_first_word("first_name").alias("first_name"))
        .distinct()
    )
    found = names.withColumn("last_lc", F.lower("last_name")).join(
        unique_last_names(members), "last_lc"
    )
    parts = found.select(
        "bioguide", "last_name", "first_name", F.explode(nm.alias_keys(F.lower("first_name"))).alias("part")
    )
    known = aliases.select("bioguide", F.lower("first_name").alias("part"))
    covered = parts.join(known, ["bioguide", "part"], "left_semi").select(*ALIAS_COLUMNS).distinct()
    return found.select(*ALIAS_COLUMNS).join(covered, ALIAS_COLUMNS, "left_anti")


def fix_null_keys(facts: DataFrame, aliases: DataFrame) -> DataFrame:
    """Fill missing keys of House and Senate rows from the alias table.

    Tries the last word of the first name, then its first word, then all of
    it.  Several members under one alias: the least key.
    """
    open_rows = F.col("bioguide").isNull() & F.col("chamber").isin("House", "Senate")
    names = facts.where(open_rows).select("last_name", "first_name").distinct()
    tries = names.select(
        "last_name",
        "first_name",
        F.lower("last_name").alias("last_lc"),
        F.posexplode(nm.name_candidates("first_name")).alias("pos", "first_lc"),
    )
    known = aliases.groupBy(
        F.lower("last_name").alias("last_lc"), F.lower("first_name").alias("first_lc")
    ).agg(F.min("bioguide").alias("found"))
    hits = (
        tries.join(known, ["last_lc", "first_lc"])
        .groupBy("last_name", "first_name")
        .agg(F.min_by("found", "pos").alias("__found"))
        .select(F.col("last_name").alias("__l"), F.col("first_name").alias("__f"), "__found")
    )
    # Rows that need no repair cannot match; keep them from piling up on one key.
    probe = F.when(open_rows, F.col("last_name")).otherwise(
        F.concat(F.lit("\x00"), F.pmod(F.xxhash64("id"), F.lit(1024)).cast("string"))
    )
    return (
        facts.withColumn("__p", probe)
        .join(hits, (F.col("__p") == F.col("__l")) & (F.col("first_name") == F.col("__f")), "left")
        .withColumn("bioguide", F.coalesce("bioguide", "__found"))
        .select(*facts.columns)
    )


def repair(
    holdings: DataFrame, transactions: DataFrame, members: DataFrame, aliases: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Learn from holdings, fix holdings, learn from transactions, fix those.

    Later steps see the aliases of earlier ones.  Returns the repaired
    holdings and transactions and the grown alias table.
    """
    # Each alias table feeds several later branches, so it is stored once.
    known = settle(
        aliases.select(*ALIAS_COLUMNS)
        .unionByName(learn_aliases(holdings, members, aliases))
        .distinct(),
        "aliases",
    )
    fixed_holdings = fix_null_keys(holdings, known)
    grown = settle(
        known.unionByName(learn_aliases(transactions, members, known)).distinct(), "aliases"
    )
    return fixed_holdings, fix_null_keys(transactions, grown), grown


def first_covering_alias(names: DataFrame, aliases: DataFrame, members: DataFrame) -> DataFrame:
    """For each (last, first) the member whose alias covers it, least key first.

    Ordinary or covered names alike; adds ``matched_party`` and
    ``matched_display_first``.
    """
    parts = names.select(
        "last_name", "first_name",
        F.lower("last_name").alias("last_lc"),
        F.explode(nm.alias_keys(F.lower(nm.strip_hon_first_word("first_name")))).alias("part"),
    )
    known = aliases.groupBy(
        F.lower("last_name").alias("last_lc"), F.lower("first_name").alias("part")
    ).agg(F.min("bioguide").alias("bioguide"))
    hit = (
        parts.join(known, ["last_lc", "part"])
        .groupBy("last_name", "first_name")
        .agg(F.min("bioguide").alias("bioguide"))
    )
    info = members.select(
        "bioguide",
        F.col("party").alias("matched_party"),
        F.coalesce("display_first", "first_name").alias("matched_display_first"),
    )
    return names.join(hit, ["last_name", "first_name"], "left").join(info, "bioguide", "left")


def suspect_names(
    holdings: DataFrame, aliases: DataFrame, members: DataFrame, suspects: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Filing names and aliases that start with (contain) a suspect last name; without a list, one of the names that are known to stay unmatched."""
    suspects = fv.SUSPECT_LAST_NAMES if suspects is None else suspects

    def any_of(c: str, prefix: str):
        out = F.lit(False)
        for s in suspects:
            out = out | F.lower(c).like(prefix + s.lower().replace("'", "%") + "%")
        return out

    filed = (
        holdings.where((F.col("chamber") == "House") & any_of("last_name", ""))
        .select("last_name", "first_name", "chamber")
        .distinct()
    )
    info = members.select("bioguide", "display_first", "state", "party")
    listed = (
        aliases.where(any_of("last_name", "%"))
        .join(info, "bioguide")
        .select("last_name", "first_name", "display_first", "state", "party")
    )
    return filed, listed
