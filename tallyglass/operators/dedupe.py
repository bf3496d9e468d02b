"""Keep-one rules for repeated filings and keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import names as nm
from ..sources import rosters as rs
from .joins import best_row


def keep_first_filing(index: DataFrame, last: str = "last", first: str = "first", ordinal: str = "ordinal") -> DataFrame:
    """First filing per (last name, first three letters of the first name)."""
    keyed = index.withColumns(
        {"__l": F.lower(last), "__f": F.substring(F.lower(first), 1, 3)}
    )
    return best_row(keyed, ["__l", "__f"], F.col(ordinal)).drop("__l", "__f")


def prefer_original(
    records: DataFrame, keys: list[str], is_amendment: Column, ordinal: str = "ordinal"
) -> DataFrame:
    """Last original filing per key; the first amendment only where there is none."""
    amended = is_amendment.cast("int")
    rank = F.when(amended == 0, -F.col(ordinal)).otherwise(F.col(ordinal))
    names = [f"__k{i}" for i in range(len(keys))]
    keyed = records.withColumns({n: F.lower(k) for n, k in zip(names, keys)})
    return best_row(keyed, names, amended, rank).drop(*names)


def keep_last(rows: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Upsert semantics: the row with the highest load sequence wins."""
    return best_row(rows, keys, -F.col(seq))


def apply_corrections(roster: DataFrame, corrections: DataFrame) -> DataFrame:
    """Replace document ids, only where both the id and the member agree.

    ``roster`` has (last, doc_id); ``corrections`` has (last, doc_id, new_doc_id),
    one row per pair.
    """
    fixes = corrections.select(
        F.lower("last").alias("__l"), F.col("doc_id"), F.col("new_doc_id")
    )
    return (
        roster.withColumn("__l", F.lower("last"))
        .join(fixes, ["__l", "doc_id"], "left")
        .withColumn("doc_id", F.coalesce("new_doc_id", "doc_id"))
        .drop("__l", "new_doc_id")
        .select(*roster.columns)
    )


def known_cases(spark: SparkSession) -> DataFrame:
    """The members known to be listed under a wrong document id: last, first, office, doc_id."""
    return spark.createDataFrame(fv.WRONG_DOC_IDS, "last string, first string, office string, doc_id string")


def find_corrections(index: DataFrame, cases: DataFrame) -> DataFrame:
    """(last, doc_id, new_doc_id) for each case whose annual filing the bulk index holds under another id.

    ``index`` has doc_id, filing_type, last, first and office; ``cases`` is
    :func:`known_cases` or the like.  A filing fits if the last names and the
    first words of the first names agree; one of the case's office goes before
    others, then the least id.  Each side is joined on the name, and a case keeps
    one filing by a map-side minimum, however many the index has.
    """
    name = [F.lower(F.trim("last")).alias("__l"), F.lower(nm.first_word("first")).alias("__f")]
    filed = index.where(rs.is_annual("filing_type") & (F.col("doc_id") != "")).select(*name, F.col("doc_id").alias("__new"), F.upper("office").alias("__office"))
    asked = cases.select(*name, "last", "doc_id", F.upper("office").alias("__own"))
    best = F.min(F.struct((F.col("__office") != F.col("__own")).alias("far"), F.col("__new").alias("id")))
    found = asked.join(filed, ["__l", "__f"]).where("__new != doc_id").groupBy("last", "doc_id").agg(best["id"].alias("new_doc_id"))
    return found


def new_rows(candidates: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    return candidates.join(existing.select(key), key, "left_anti")


def is_current(members: DataFrame, current: DataFrame, key: str = "bioguide") -> DataFrame:
    flags = current.select(key).distinct().withColumn("__now", F.lit(1))
    return (
        members.join(flags, key, "left")
        .withColumn("is_current", F.coalesce("__now", F.lit(0)))
        .drop("__now")
    )
