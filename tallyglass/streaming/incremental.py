"""Picking up new filings: a checkpointed file stream, and its batch form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import keep_last
from ..session import remove_tree


def new_files(listing: DataFrame, done: DataFrame, min_bytes: int) -> DataFrame:
    """Listed files (doc_id, length) not taken yet and above the size the source's caller states."""
    return listing.where(F.col("length") > min_bytes).join(
        done.select("doc_id"), "doc_id", "left_anti"
    )


def ingest_available(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    checkpoint: str,
    sink: Callable[[DataFrame, int], None],
    file_format: str = "json",
    files_per_batch: int = 1000,
) -> None:
    """Process every file that arrived since the last run, then stop.

    The stream's own checkpoint remembers which files were taken, so a rerun
    reads only new ones.  ``sink`` must be idempotent per batch: a batch whose
    commit was lost is sent again.
    """
    query = (
        spark.readStream.format(file_format)
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source)
        .writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def year_sink(path: str, key: str, seq: str, year: str = "filing_year") -> Callable[[DataFrame, int], None]:
    """A batch sink that merges into the year partitions the batch touches.

    Those are the batch's own years and the years in which its keys lie so far,
    so a filing whose year is corrected leaves the old one.  Their rows are read
    back, the newest row per key is kept and the partitions are replaced.  Merged
    rows go to a side folder first, because Spark cannot overwrite a path it is
    reading; it is removed at the end, and a batch that is sent again after a
    failure writes the same rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        years = [r[0] for r in batch.select(year).distinct().collect()]  # few per batch
        if not years:
            return
        try:
            table = spark.read.parquet(path).select(*batch.columns)
            moved = table.join(batch.select(key).distinct(), key, "left_semi").select(year).distinct()
            years = sorted({*years, *(r[0] for r in moved.collect())})
            merged = table.where(F.col(year).isin(years)).unionByName(batch)
        except Exception as e:  # no table yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER" not in str(e):
                raise
            merged = batch
        staged = f"{path}_staging/batch-{batch_id}"
        keep_last(merged, [key], seq).write.mode("overwrite").parquet(staged)
        kept = spark.read.parquet(staged)
        (
            kept.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(year)
            .parquet(path)
        )
        # A year that has lost its last row is in no written partition.
        left = {r[0] for r in kept.select(year).distinct().collect()}
        for gone in set(years) - left:
            remove_tree(spark, f"{path}/{year}={gone}")
        remove_tree(spark, staged)

    return write
