"""Member, committee and alias tables from nested roster documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import names as nm
from .joins import best_row


def latest_term(roster: DataFrame) -> DataFrame:
    """One row per member with the attributes of the last listed term.

    A member on both rosters keeps the current one (``is_historical`` false).
    """
    rows = roster.select(
        F.col("id.bioguide").alias("bioguide"),
        F.coalesce("name.last", F.lit("")).alias("last_name"),
        F.coalesce("name.first", F.lit("")).alias("first_name"),
        F.coalesce("name.nickname", F.lit("")).alias("nickname"),
        F.coalesce("name.official_full", F.lit("")).alias("official_full"),
        F.try_element_at("terms", F.lit(-1)).alias("t"),
        "is_historical",
    ).where(F.col("bioguide").isNotNull())
    rows = rows.select(
        "*",
        *[
            F.coalesce(F.col("t")[c], F.lit("")).alias(c)
            for c in ("state", "district", "party")
        ],
    ).drop("t")
    return best_row(rows, ["bioguide"], F.col("is_historical").cast("int"))


def member_info(roster: DataFrame) -> DataFrame:
    """The member table, principals included."""
    current = (
        roster.where(~F.col("is_historical"))
        .select(F.col("id.bioguide").alias("bioguide"))
        .distinct()
        .withColumn("__now", F.lit(1))
    )
    rows = latest_term(roster).join(current, "bioguide", "left").select(
        "bioguide", "last_name", "first_name",
        nm.display_first(
            F.col("first_name"), F.col("nickname"), F.col("official_full")
        ).alias("display_first"),
        "state", "party",
        F.coalesce("__now", F.lit(0)).alias("is_current"),
    )
    people = roster.sparkSession.createDataFrame(
        [(k, last, firsts[0], shown, "", party, now)
         for k, last, firsts, shown, party, now in fv.PRINCIPALS],
        "bioguide string, last_name string, first_name string, display_first string, "
        "state string, party string, is_current int",
    )
    missing = people.join(rows.select("bioguide"), "bioguide", "left_anti")
    return rows.unionByName(missing)


def name_aliases(roster: DataFrame) -> DataFrame:
    """Every first name a member may file under, in the form it is stored.

    A form that one of the roster names has is stored as written there; an
    expansion that none has is capitalised.
    """
    m = latest_term(roster)
    official_first = nm.first_word("official_full")
    shown = nm.display_first(F.col("first_name"), F.col("nickname"), F.col("official_full"))
    forms = m.select(
        "bioguide",
        nm.ascii_fold("last_name").alias("last_name"),
        F.posexplode(
            F.array("first_name", shown, "nickname", official_first)
        ).alias("pos", "form"),
    ).withColumn("form", nm.ascii_fold("form"))
    forms = forms.where(F.col("form") != "").withColumn("key", F.lower("form"))
    written = forms.groupBy("bioguide", "last_name", "key").agg(
        F.min_by("form", "pos").alias("first_name")
    )
    expanded = (
        written.select("bioguide", "last_name", nm.alias_nickname("key").alias("key"))
        .where(F.col("key").isNotNull())
        .distinct()
        .join(written.select("bioguide", "key"), ["bioguide", "key"], "left_anti")
        .select(
            "bioguide", "last_name",
            F.concat(F.upper(F.substring("key", 1, 1)), F.expr("substring(key, 2)")).alias("first_name"),
        )
    )
    base = written.select("bioguide", "last_name", "first_name").unionByName(expanded)
    return base.unionByName(_manual_aliases(m, base)).unionByName(_principal_aliases(m)).distinct()


def _manual_aliases(members: DataFrame, aliases: DataFrame) -> DataFrame:
    """Copies of a member's aliases under the manual last name."""
    spark = members.sparkSession
    manual = spark.createDataFrame(
        [(a, last.lower(), first.lower()) for a, last, first in fv.MANUAL_MEMBER_ALIASES],
        "filed_last string, l string, f string",
    )
    who = (
        members.select(
            "bioguide", nm.fold_accents("last_name").alias("l"), nm.fold_accents("first_name").alias("f")
        )
        .join(F.broadcast(manual), ["l", "f"])  # fixed list of three
        .groupBy("filed_last")
        .agg(F.min("bioguide").alias("bioguide"))
    )
    return aliases.join(who, "bioguide").select(
        "bioguide", F.col("filed_last").alias("last_name"), "first_name"
    )


def _principal_aliases(members: DataFrame) -> DataFrame:
    people = members.sparkSession.createDataFrame(
        [(k, last, f) for k, last, firsts, *_ in fv.PRINCIPALS for f in firsts],
        "bioguide string, last_name string, first_name string",
    )
    return people.join(members.select("bioguide"), "bioguide", "left_anti")


def committees(docs: DataFrame) -> DataFrame:
    """Committees and their subcommittees in one table; blank ids skipped."""
    kept = docs.where(F.coalesce("thomas_id", F.lit("")) != "")
    full = kept.select(
        "thomas_id", "name", F.col("type").alias("chamber"), F.lit(None).cast("string").alias("parent_id")
    )
    subs = kept.select(
        F.col("thomas_id").alias("parent_id"), F.col("type").alias("chamber"), F.explode("subcommittees").alias("s")
    ).select(
        F.concat("parent_id", "s.thomas_id").alias("thomas_id"), F.col("s.name").alias("name"),
        "chamber", "parent_id",
    )
    return full.unionByName(subs)


def committee_members(membership: DataFrame, members: DataFrame) -> DataFrame:
    """Membership documents (``assignments`` MAP) to rows, names from the roster.

    An unknown key falls back to the written name, split at its last space.
    Keys whose value is not a list arrive as NULL and yield no rows.
    """
    rows = membership.select(F.explode("assignments").alias("thomas_id", "people")).select(
        "thomas_id", F.explode("people").alias("m")
    ).select(
        "thomas_id",
        F.coalesce("m.bioguide", F.lit("")).alias("bioguide"),
        F.coalesce("m.name", F.lit("")).alias("__name"),
        F.coalesce("m.party", F.lit("")).alias("party"),
        F.coalesce("m.rank", F.lit(0)).alias("rank"),
        F.coalesce("m.title", F.lit("")).alias("title"),
    )
    who = members.select(
        "bioguide", F.col("last_name").alias("__l"), F.col("first_name").alias("__f"),
        F.col("state").alias("__s"), F.col("district").alias("__d"),
    )
    return rows.join(who, "bioguide", "left").select(
        "thomas_id", "bioguide",
        F.coalesce("__l", F.substring_index("__name", " ", -1)).alias("last_name"),
        F.coalesce("__f", F.regexp_extract("__name", r"^(.*) [^ ]*$", 1)).alias("first_name"),
        F.coalesce("__s", F.lit("")).alias("state"),
        F.coalesce("__d", F.lit("")).alias("district"),
        "party", "rank", "title",
    )
