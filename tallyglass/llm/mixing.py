"""Mixing sources to target weights: repetition rates, whole copies and one hash-seeded copy more.

Edge cases: a null text has size 0; null sources form one source, ordered last;
a source without words has target 0 and repetition 0; an empty table gives an
empty result; equal rows (same id, same size) share their decision; other
columns are passed through by :func:`emit` and never read here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, numbered, settle, word_count

WEIGHTS = (5.0, 2.0, 1.0)


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = 3.0) -> DataFrame:
    """One row for each source: source, source_size, weight, target.

    ``sized`` has source and size.  The weights repeat over the sources in code
    point order (null last).  Targets share the total of all sizes by weight and
    stop at ``cap`` times the source's size; the excess is shared again by
    weight among the others until none is above.  Each round of that is one
    aggregate over the per-source table; two sums reach the driver.
    """
    per = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ranked = numbered(per, "_rank", F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    table = settle(
        ranked.select("source", "source_size", F.element_at(cycle, (F.col("_rank") % len(weights) + 1).cast("int")).alias("weight")), "sources"
    )
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = None  # target = least of cap * size and level * weight
    stopped = F.lit(False)
    while True:
        held, free = table.agg(
            F.coalesce(F.sum(F.when(stopped, F.col("source_size"))), F.lit(0)), F.coalesce(F.sum(F.when(~stopped, F.col("weight"))), F.lit(0.0))
        ).first()
        now = (total - cap * held) / free if free else None
        if now is None or now == level:
            break
        level, stopped = now, F.lit(now) * F.col("weight") > cap * F.col("source_size")
    share = F.lit(0.0) if level is None else F.lit(level) * F.col("weight")
    return table.withColumn("target", F.least(share, cap * F.col("source_size")).cast("double"))


def seeded_fraction(*parts: Column, seed: str = "mix") -> Column:
    """A number in [0, 1) that depends on the values of ``parts`` and the seed alone."""
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def copies(sized: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = 3.0, key: str = "doc_id") -> DataFrame:
    """``sized`` (key, source, size, ...) with source_size, target and copies.

    A document of a source with rate target / source_size is taken floor(rate)
    times, and once more with the fraction as probability.
    """
    targets = source_targets(sized, weights, cap).select(F.col("source").alias("_source"), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    more = (seeded_fraction(F.col(key), F.col("size")) < rate - F.floor(rate)).cast("long")
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return joined.withColumn("copies", F.floor(rate) + more)


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size: stored once, since both the sums and the documents need them."""
    return settle(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")


def emit(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = 3.0) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of ``docs``, whatever their names."""
    targets = source_targets(sizes(docs), weights, cap)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    source, per, copy = (free_name(docs, n) for n in ("_source", "_rate", "_copy"))
    rates = targets.select(F.col("source").alias(source), rate.alias(per))
    more = (seeded_fraction(F.col("doc_id"), word_count(F.col("text"))) < F.col(per) - F.floor(per)).cast("long")
    joined = docs.join(rates, docs["source"].eqNullSafe(F.col(source)))
    times = (F.floor(per) + more).cast("int")
    taken = joined.withColumn(copy, times).where(F.col(copy) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copy))))
    return taken.select(*[docs[c] for c in docs.columns])
