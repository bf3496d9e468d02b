"""Substring index: which files of a stored table can hold a pattern.

For every file the index lists the distinct runs of three characters of the
indexed texts, lower-cased as ``ilike`` does it.  A pattern is cut at its
wildcards; a file that lacks a run of three characters of what is left cannot
match and isn't opened.  The rows of the other files are tested as ever, so the
index changes the bytes read and never the result.

Layout below ``path``, one folder for each run of :meth:`TextIndex.refresh`::

    grams/run=<id>   name, gram, file: sorted by gram, so that a lookup skips row groups
    files/run=<id>   file, size, changed: the files the run covers, written last

A file counts as covered only with the size and time of change it was indexed
with.  New, rewritten and uncovered files are read whole, so rows are right
before a refresh, after a run that was killed, and while files come and go.

Null texts match nothing and have no runs; texts under three characters have
none either and cannot hold a longer pattern.  A pattern without three literal
characters in a row reads every file.  It pays where equal and similar texts lie
in the same files, see :func:`write_clustered`.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx

_FILES = "file string, size long, changed timestamp"
_GRAMS = "name string, gram string, file string"


@dataclass
class Candidates:
    """Rows of the files that may match, not yet tested, and what reading them costs."""

    rows: DataFrame
    files: int
    of_files: int
    bytes: int
    of_bytes: int


def write_clustered(df: DataFrame, path: str, by: str, files: int) -> None:
    """Stores a table in ranges of ``by``, ignoring case, so that like texts share files; a frequent text may fill several."""
    key = F.lower(by)
    spread = F.xxhash64(*df.columns)
    df.repartitionByRange(files, key, spread).sortWithinPartitions(key).write.mode("overwrite").parquet(path)


def grams_of(chars: Column) -> Column:
    """Distinct runs of three of the characters, of which there are three or more."""

    def gram(i: Column) -> Column:
        return F.concat(F.get(chars, i), F.get(chars, i + 1), F.get(chars, i + 2))

    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(chars) - 3), gram))


def pattern_grams(pattern: str) -> set[str]:
    """What every text that is LIKE the (lower-cased) pattern must hold; a backslash makes the next character literal."""
    runs, run, at = [], "", 0
    while at < len(pattern):
        c = pattern[at]
        if c in "%_":
            runs.append(run)
            run = ""
        else:
            at += c == "\\"
            run += pattern[at : at + 1]
        at += 1
    return {r[i : i + 3] for r in [*runs, run] for i in range(len(r) - 2)}


class TextIndex:
    """Index of the Parquet table below ``table``, kept below ``path``; both in storage that all executors share.

    ``texts`` names what is indexed by SQL expressions over a row.  A predicate
    over several columns needs an expression that holds each of them, such as
    "concat_ws(', ', last_name, first_name)" for the forms of a name.
    """

    def __init__(self, spark: SparkSession, table: str, path: str, texts: dict[str, str]):
        self.spark, self.table, self.path, self.texts = spark, table, path, texts

    def _runs(self) -> list[str]:
        """Finished runs, those whose list of files is whole."""
        base = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/files")
        store = base.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not store.exists(base):
            return []
        found = [f.getPath() for f in store.listStatus(base)]
        return sorted(p.getName() for p in found if store.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def _stored(self, part: str, schema: str) -> DataFrame:
        runs = self._runs()
        if not runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{part}/{r}" for r in runs])

    def live(self) -> DataFrame:
        """The table's files as they are now: file, size, changed; no content is read."""
        found = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(self.table)
        return found.select(F.col("path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("changed"))

    def covered(self) -> DataFrame:
        """Live files that the index knows as they are."""
        return self.live().join(self._stored("files", _FILES), ["file", "size", "changed"], "left_semi")

    def _read(self, files: Iterable[str]) -> DataFrame:
        whole = self.spark.read.parquet(self.table)
        files = list(files)
        if not files:
            return whole.where(F.lit(False))
        return self.spark.read.schema(whole.schema).option("basePath", self.table).parquet(*files)

    def refresh(self) -> int:
        """Indexes the files that are new or rewritten; how many they were."""
        new = self.live().join(self._stored("files", _FILES), ["file", "size", "changed"], "left_anti").collect()  # as many as Spark's own listing holds
        if not new:
            return 0
        run = f"run={uuid.uuid4().hex}"
        rows = self._read(r.file for r in new)
        # One slash after the scheme of a local file, as the listing writes it.
        file = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/").alias("file")
        named = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.expr(e).cast("string").alias("text")) for n, e in self.texts.items()]))
        # Each text of a file once before its runs are formed.
        texts = rows.select(file, named.alias("t")).select("file", "t.name", F.lower("t.text").alias("text")).distinct()
        chars = texts.select("file", "name", F.split("text", "").alias("chars")).where(F.size("chars") >= 3)
        found = chars.select("name", F.explode(grams_of(F.col("chars"))).alias("gram"), "file").distinct()
        found.repartitionByRange("gram", "name", "file").sortWithinPartitions("gram").write.parquet(f"{self.path}/grams/{run}")
        # Last: until this is whole, the run doesn't count.
        self.spark.createDataFrame(new, _FILES).coalesce(1).write.parquet(f"{self.path}/files/{run}")
        return len(new)

    def candidates(self, text: str, *names: str) -> Candidates:
        """Files where one of the named texts may hold ``text``, whose % and _ are wildcards."""
        lower = self.spark.sql("SELECT lower(:p) AS p", {"p": tx.like_pattern(text)}).first().p
        needed = pattern_grams(lower)
        live = self.live()
        if needed:
            grams = self._stored("grams", _GRAMS).where(F.col("gram").isin(sorted(needed)) & F.col("name").isin(list(names)))
            hits = grams.distinct().groupBy("file", "name").count().where(F.col("count") == len(needed)).select("file")
            chosen = live.join(self.covered().join(hits, "file", "left_anti").select("file"), "file", "left_anti")
        else:
            chosen = live
        found = chosen.select("file", "size").collect()
        size = live.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
        return Candidates(self._read(r.file for r in found), len(found), size[0], sum(r.size for r in found), size[1])

    def search(self, text: str, *names: str) -> DataFrame:
        """The rows where one of the named texts matches, as a scan with ``ilike`` finds them."""
        return self.candidates(text, *names).rows.where(reduce(or_, [tx.matches(F.expr(self.texts[n]).cast("string"), text) for n in names]))
