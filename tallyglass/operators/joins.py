"""Lookups that stay balanced when a key, or its absence, is very common."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPREAD = 1024


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    columns: dict[str, str],
    spread_by: Column | None = None,
) -> DataFrame:
    """Left join to a table with one row per key.

    No broadcast hint: Spark broadcasts the small side only when its own size
    check passes, else sorts and merges, with AQE splitting hot key ranges.
    Rows without a key would all hash to one task, so they get a key that can
    match nothing but differs from row to row.
    """
    spread = spread_by if spread_by is not None else F.xxhash64(*[F.col(c) for c in facts.columns[:4]])
    probe = F.coalesce(
        F.col(key), F.concat(F.lit("\x00"), F.pmod(spread, F.lit(SPREAD)).cast("string"))
    )
    side = dim.select(F.col(key).alias("__key"), *[F.col(s).alias(n) for s, n in columns.items()])
    return (
        facts.withColumn("__probe", probe)
        .join(side, F.col("__probe") == F.col("__key"), "left")
        .drop("__probe", "__key")
    )


def best_row(df: DataFrame, keys: list[str], *rank: Column) -> DataFrame:
    """The row with the least rank in each key group.

    An aggregate instead of row_number: it combines map-side, so a key with a
    third of all rows reaches its task as one row per map task.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = df.select(
        *keys,
        F.struct(
            *[r.alias(f"r{i}") for i, r in enumerate(rank)],
            *[F.col(c) for c in rest],
        ).alias("__best"),
    )
    best = ranked.groupBy(*keys).agg(F.min("__best").alias("__best"))
    return best.select(*keys, *[F.col("__best")[c].alias(c) for c in rest]).select(*df.columns)
