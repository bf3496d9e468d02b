"""A keyed table fed by a stream: batches append, and one compaction a run merges them.

Layout below ``path``::

    log/stream=<id>/batch=<n>   rows as they came, one folder a batch
    base/version=<v>/<year>=<y>  merged rows, each key once
    manifest/<v>                 which version of each year is live, and up to which batch

A batch writes its own rows and nothing else.  A compaction rewrites only the
years that new rows belong to or in which their keys lie so far.  It takes
effect with its manifest: until that is whole (Spark marks a finished write with
``_SUCCESS``) every reader sees the state before, so a filing that moves to
another year is never in two, and a run that is killed anywhere can be repeated.
A batch sent again overwrites its own folder, or is skipped if it is merged.

Years are numbers.  A null key is a key of its own and a null year a year of its
own; of rows equal in key and seq the one that :func:`keep_last` prefers stays.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import keep_last
from ..session import remove_tree, settle
from .incremental import ingest_available

_NO_YEAR = "__HIVE_DEFAULT_PARTITION__"
_MANIFEST = "kind string, name string, value long"


class AppendLog:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, seq: str, year: str = "filing_year"):
        self.spark, self.path, self.schema, self.key, self.seq, self.year = spark, path, schema, key, seq, year

    # -- state -----------------------------------------------------------------

    def _folders(self, path: str) -> list[str]:
        """Names of the folders directly below ``path``."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        store = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(f.getPath().getName() for f in store.listStatus(at) if f.isDirectory()) if store.exists(at) else []

    def _whole(self, path: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def _versions(self) -> list[int]:
        """Published versions, newest first."""
        return sorted((int(n) for n in self._folders(f"{self.path}/manifest") if self._whole(f"{self.path}/manifest/{n}")), reverse=True)

    def _manifest(self, version: int | None) -> tuple[dict[str, int], dict[str, int]]:
        """Live version of each year, and last merged batch of each stream; one row for each of them."""
        if version is None:
            return {}, {}
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest/{version}").collect()
        return tuple({r.name: r.value for r in rows if r.kind == kind} for kind in ("year", "batch"))

    def _live(self) -> tuple[dict[str, int], dict[str, int]]:
        return self._manifest(next(iter(self._versions()), None))

    def _pending(self, merged: dict[str, int]) -> list[tuple[str, int]]:
        """(stream, batch) of whole batches that no published compaction holds."""
        found = []
        for folder in self._folders(f"{self.path}/log"):
            stream = folder.partition("=")[2]
            for name in self._folders(f"{self.path}/log/{folder}"):
                n = int(name.partition("=")[2])
                if n > merged.get(stream, -1) and self._whole(self._batch(stream, n)):
                    found.append((stream, n))
        return found

    def _batch(self, stream: str, n: int) -> str:
        return f"{self.path}/log/stream={stream}/batch={n}"

    def _log(self, pending: list[tuple[str, int]]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*[self._batch(*p) for p in pending]).select(*self.schema.names)

    def _base(self, years: dict[str, int]) -> DataFrame:
        if not years:
            return self.spark.createDataFrame([], self.schema)
        at = f"{self.path}/base"
        wide = T.StructType([*self.schema.fields, T.StructField("version", T.LongType())])
        found = self.spark.read.schema(wide).option("basePath", at).parquet(*[f"{at}/version={v}/{self.year}={y}" for y, v in years.items()])
        return found.select(*self.schema.names)

    def _with_keys(self, df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        return df.join(keys, F.col(self.key).eqNullSafe(F.col("__key")), how)

    # -- use -------------------------------------------------------------------

    def append(self, rows: DataFrame, batch: int, stream: str = "batch") -> None:
        """Stores one batch; numbers must rise within a stream."""
        if batch > self._live()[1].get(stream, -1):
            rows.select(*self.schema.names).write.mode("overwrite").parquet(self._batch(stream, batch))

    def read(self) -> DataFrame:
        """Each key's newest row; keys without news are passed on without being grouped."""
        years, merged = self._live()
        pending, base = self._pending(merged), self._base(years)
        if not pending:
            return base
        log = self._log(pending)
        keys = log.select(F.col(self.key).alias("__key")).distinct()
        touched = keep_last(self._with_keys(base, keys, "left_semi").unionByName(log), [self.key], self.seq)
        return self._with_keys(base, keys, "left_anti").unionByName(touched.select(*self.schema.names))

    def compact(self) -> None:
        """Merges the batches that have come since the last compaction."""
        versions = self._versions()
        years, merged = self._live()
        pending = self._pending(merged)
        if not pending:
            return
        version = 1 + next(iter(versions), -1)
        log, base = self._log(pending), self._base(years)
        keys = settle(log.select(F.col(self.key).alias("__key")).distinct(), "log-keys")
        held = self._with_keys(base.select(self.key, self.year), keys, "left_semi").select(self.year)
        touched = [r[0] for r in log.select(self.year).unionAll(held).distinct().collect()]  # one value a year
        ours = F.col(self.year).isin([y for y in touched if y is not None])
        if None in touched:
            ours = ours | F.col(self.year).isNull()
        target = f"{self.path}/base/version={version}"
        rows = keep_last(base.where(ours).unionByName(log), [self.key], self.seq).select(*self.schema.names)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(self.year).parquet(target)
        live = {y: v for y, v in years.items() if y not in {self._year_name(t) for t in touched}}
        live |= {name.partition("=")[2]: version for name in self._folders(target) if name.startswith(f"{self.year}=")}
        last = reduce(lambda m, p: m | {p[0]: max(p[1], m.get(p[0], -1))}, pending, merged)
        self._publish(version, live, last)
        self._sweep()

    @staticmethod
    def _year_name(year) -> str:
        return _NO_YEAR if year is None else str(year)

    def _publish(self, version: int, years: dict[str, int], merged: dict[str, int]) -> None:
        rows = [("year", *i) for i in years.items()] + [("batch", *i) for i in merged.items()]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/{version}")

    def _sweep(self) -> None:
        """Removes what neither of the last two manifests names, so that a reader of the one before can finish."""
        kept = self._versions()[:2]
        if len(kept) < 2:
            return
        years = [self._manifest(v)[0] for v in kept]
        live = {(v, y) for m in years for y, v in m.items()}
        for folder in self._folders(f"{self.path}/base"):
            version = int(folder.partition("=")[2])
            for name in self._folders(f"{self.path}/base/{folder}"):
                if version <= kept[0] and (version, name.partition("=")[2]) not in live:
                    remove_tree(self.spark, f"{self.path}/base/{folder}/{name}")
        before = self._manifest(kept[1])[1]
        for folder in self._folders(f"{self.path}/log"):
            stream = folder.partition("=")[2]
            for name in self._folders(f"{self.path}/log/{folder}"):
                if int(name.partition("=")[2]) <= before.get(stream, -1):
                    remove_tree(self.spark, f"{self.path}/log/{folder}/{name}")


def ingest_log(log: AppendLog, source: str, schema: T.StructType, checkpoint: str, file_format: str = "json", files_per_batch: int = 1000) -> None:
    """Appends every file that arrived since the last run, then compacts once.

    The checkpoint's own id names the stream, so a new checkpoint, which counts
    its batches from 0 again, is not taken for one that is merged.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        stream = json.loads(batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        log.append(batch, batch_id, stream)

    ingest_available(log.spark, source, schema, checkpoint, sink, file_format, files_per_batch)
    log.compact()
