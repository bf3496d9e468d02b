"""Data-quality accounting as DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def summarise(flags: DataFrame, position: list[str]) -> DataFrame:
    """Rows per category and the sample that came first."""
    return flags.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct(*[F.col(c) for c in position], F.col("sample"))).alias("s"),
    ).select("category", "n", F.col("s.sample").alias("sample"))


def value_counts(df: DataFrame, column: str, alarm_below: int = 50) -> DataFrame:
    """Rows per value, with an alarm where there are suspiciously few."""
    return (
        df.groupBy(F.trim(F.coalesce(column, F.lit(""))).alias(column))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("too_few", F.col("n") < alarm_below)
    )


def table_counts(tables: dict[str, DataFrame | None]) -> DataFrame:
    """Rows per table; a table that does not exist counts 0."""
    parts = []
    for name, df in tables.items():
        if df is None:
            continue
        parts.append(df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n"))
    spark = next(df for df in tables.values() if df is not None).sparkSession
    absent = [(name, 0) for name, df in tables.items() if df is None]
    if absent:
        parts.append(spark.createDataFrame(absent, "table_name string, n bigint"))
    return reduce(DataFrame.unionByName, parts)


def catalog_counts(spark, names: list[str]) -> DataFrame:
    return table_counts(
        {n: spark.table(n) if spark.catalog.tableExists(n) else None for n in names}
    )


def unresolved(facts: DataFrame, show: int = 10) -> DataFrame:
    """Per chamber: how many distinct names have no key, and the first few of them.

    The names shown are the feature's own limit; the count is over all names.
    """
    label = F.concat_ws(", ", F.col("last_name"), F.col("first_name"))
    names = (
        facts.where(F.col("bioguide").isNull()).select("chamber", label.alias("name")).distinct()
    )
    totals = names.groupBy("chamber").agg(F.count(F.lit(1)).alias("n_names"))
    # rank limit is pushed into the map side (window group limit)
    w = Window.partitionBy("chamber").orderBy("name")
    shown = (
        names.withColumn("rn", F.row_number().over(w))
        .where(F.col("rn") <= show)
        .groupBy("chamber")
        .agg(F.array_join(F.array_sort(F.collect_list("name")), "; ").alias("shown"))
    )
    return totals.join(shown, "chamber").select(
        "chamber", "n_names", "shown",
        F.greatest(F.col("n_names") - show, F.lit(0)).alias("n_more"),
    )


def name_mismatches(filings: DataFrame, roster: DataFrame) -> DataFrame:
    """Document ids that the roster gives to somebody else."""
    owner = roster.select("doc_id", F.col("last").alias("roster_last"))
    return filings.join(owner, "doc_id").where(F.lower("last") != F.lower("roster_last"))
