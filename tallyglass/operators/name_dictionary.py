"""Resolved names kept from run to run, so that a run resolves only names it has not met.

The dictionary is a bucketed Parquet table for each version of the member index,
below a shared folder: (name_key, bioguide, tier), name_key being the asked last
name, first name and year as one text.  The version is a fingerprint of the whole
index, so a change of any entry starts a new table and no old answer is used.

Joins go by name_key alone, whose buckets the table keeps: the dictionary is not
shuffled.  Each answer stands for itself, so a run that is killed while it
appends leaves a dictionary that is right, and the next run adds what is missing.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle
from .resolve import resolve_names


def name_key(last: Column, first: Column, year: Column) -> Column:
    """One text that tells any two askings apart, nulls and blanks included; year 0 means none."""
    asked = F.struct(last.alias("l"), first.alias("f"), F.nullif(year.cast("int"), F.lit(0)).alias("y"))
    return F.to_json(asked, {"ignoreNullFields": "false"})


def index_version(index: DataFrame) -> str:
    """A fingerprint of the index's rows in any order; one row reaches the driver."""
    columns = sorted(index.columns)
    row = index.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64(*columns)), F.sum(F.xxhash64(F.lit("again"), *columns).cast("decimal(38,0)"))
    ).first()
    return hashlib.md5(repr((columns, *map(str, row))).encode()).hexdigest()


class NameDictionary:
    """``path`` is a folder that all executors share; ``buckets`` should not be below the number of shuffle partitions."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 200):
        self.spark, self.path, self.buckets = spark, path, buckets

    def table(self, version: str) -> str:
        """The table of one version, registered in this session's catalogue."""
        name = f"names_{hashlib.md5(self.path.encode()).hexdigest()[:8]}_{version}"
        at = f"{self.path}/{version}".replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (name_key STRING, bioguide STRING, tier INT) USING parquet "
            f"CLUSTERED BY (name_key) INTO {self.buckets} BUCKETS LOCATION '{at}'"
        )
        self.spark.catalog.refreshTable(name)  # files of another session
        return name

    def learn(self, names: DataFrame, index: DataFrame, last: str, first: str, year: str | None) -> tuple[str, int]:
        """Resolves the names that the dictionary lacks; the table and how many they were."""
        table = self.table(index_version(index))
        y = F.col(year) if year else F.lit(None)
        asked = names.select(
            F.col(last).alias("last_name"), F.col(first).alias("first_name"), y.cast("int").alias("year"),
            name_key(F.col(last), F.col(first), y).alias("name_key"),
        ).dropDuplicates(["name_key"])
        unseen = settle(asked.join(self.spark.table(table).select("name_key"), "name_key", "left_anti"), "unseen")
        n = unseen.count()
        if n:
            found = resolve_names(unseen, index).select("name_key", "bioguide", F.col("tier").cast("int").alias("tier"))
            # One file a bucket: rows are dealt the way the buckets are.
            found.repartition(self.buckets, "name_key").write.insertInto(table)
            self.spark.catalog.refreshTable(table)
        return table, n

    def resolve(
        self, names: DataFrame, index: DataFrame, last: str = "last_name", first: str = "first_name",
        year: str | None = "year", out: str = "bioguide",
    ) -> DataFrame:
        """What :func:`resolve_names` gives: the member key and its tier for each row of ``names``."""
        table, _ = self.learn(names, index, last, first, year)
        y = F.col(year) if year else F.lit(None)
        known = self.spark.table(table).select(F.col("name_key").alias("__key"), F.col("bioguide").alias("__hit"), F.col("tier").alias("__tier"))
        rows = names.withColumn("__asked", name_key(F.col(last), F.col(first), y))
        joined = rows.join(known, F.col("__asked") == F.col("__key"), "left")
        return joined.withColumns({out: F.col("__hit"), "tier": F.col("__tier")}).drop("__asked", "__key", "__hit", "__tier")
