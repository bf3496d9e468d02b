"""Removal of repeated line runs: a suffix array over line ids, built by distributed prefix doubling.

A line is a ``\\n``-split piece with at least one word; blank lines carry no id
and vanish when they lie inside a removed run.  From each line starts its
shortest run of whole lines with at least ``min_words`` words.  Where that run
also occurs earlier (order: id, text hash, line number), all its lines go; runs
that overlap join into the maximal repeated runs.  The first occurrence stays.

Edge cases: null texts stay null, texts without a repeated run stay as they are,
a text that loses all lines becomes empty; rows that repeat both id and text
count as one document and share its result; null ids are an id of their own,
ordered first; other columns pass through untouched, whatever their names.

Method.  The first symbols are ranked in order of their line ids, by a range
sort of the distinct ids.  Round k turns the pair of ranks at i and i + 2**k
into the rank of the prefix of 2**(k+1) lines, by a range sort of the distinct
pairs.  Only prefixes that occur twice or more are kept, as all others are
settled: they share no such prefix with any neighbour in the suffix array.

The suffix array holds the starts of runs of 2**k to 2**(k+1) - 1 lines, level
by level: ordered by the rank of their first 2**k lines, then by that of the
2**k lines that end the run, which are their first n lines in order; equal ones
follow each other by document and line.  Two ranks give the longest common
prefix of neighbours, as far as n.  A stretch of neighbours that share n lines
is an interval of one repeated run, whose first member stays; every other one
shares n lines with the row before it, which is all that has to be looked at.
The array is dealt by range with document and line among the columns, so a run
that a third of all lines belong to is divided like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, free_name, settle, word_count

MIN_WORDS = 50


def _key(docs: DataFrame, doc: str) -> Column:
    """One struct for a document row; equal for equal (id, text), with a null id as a value of its own."""
    return F.struct(F.col(doc).alias("id"), F.xxhash64(doc, "text").alias("h"))


def _line_table(docs: DataFrame, doc: str, min_words: int) -> DataFrame:
    """key, pos, raw, line id, words, and the length and last raw line of the shortest run from here."""
    lines = (
        docs.where("text IS NOT NULL").select(_key(docs, doc).alias("key"), "text").distinct()
        .select("key", F.posexplode(F.split("text", "\n")).alias("raw", "line"))
        .where(F.col("line").rlike(WORD))
        .select("key", "raw", F.xxhash64("line").alias("line_id"), F.length("line").alias("chars"), word_count(F.col("line")).alias("words"))
    )
    order = Window.partitionBy("key").orderBy("raw")
    at = lines.withColumn("pos", F.row_number().over(order)).withColumn("seen", F.sum("words").over(order) - F.col("words"))
    run = Window.partitionBy("key").orderBy("seen").rangeBetween(Window.currentRow, min_words - 1)
    return at.select(
        "key", "pos", "raw", "line_id", "words", F.count("*").over(run).cast("int").alias("n"), F.max("raw").over(run).alias("raw_end"),
        F.sum("words").over(run).alias("run_words"), F.sum("chars").over(run).alias("run_chars"),
    )


def _ranked(classes: DataFrame, *by: str) -> DataFrame:
    """Order-preserving ranks of distinct rows: range sort, then ids that grow along the ranges; stored, so they are fixed."""
    return settle(classes.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("rank", F.monotonically_increasing_id()), "ranks")


def _suffix_neighbours(starts: DataFrame) -> DataFrame:
    """The starts with ``shared``: lines in common with the start before it in the suffix array, as far as n (0, 2**k or n)."""
    prefix = ["k", "head", "tail", "n", "run_chars"]
    order = [*prefix, "key", "pos"]
    dealt = starts.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    own = Window.partitionBy("range").orderBy(*order)
    array = dealt.withColumns({"before": F.lag(F.struct(*prefix)).over(own), "ends": F.lead("k").over(own).isNull()})
    array = settle(array, "suffixes")
    # The first start of a range follows the last one of the range before; one row a range.
    ends = array.where("ends").select("range", F.lag(F.struct(*prefix)).over(Window.orderBy("range")).alias("across"))
    array = array.join(ends, "range").withColumn("before", F.coalesce("before", "across"))
    head = (F.col("before.k") == F.col("k")) & (F.col("before.head") == F.col("head"))
    whole = head & (F.col("before.tail") == F.col("tail")) & (F.col("before.n") == F.col("n")) & (F.col("before.run_chars") == F.col("run_chars"))
    shared = F.when(whole, F.col("n")).when(head, F.expr("shiftleft(1, k)")).otherwise(0)
    return array.withColumn("shared", shared.cast("int"))


def repeated_runs(docs: DataFrame, doc: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """key, first, last: the maximal runs of raw line numbers that repeat earlier text; disjoint in each document."""
    lines = settle(_line_table(docs, doc, min_words), "lines")
    twice = lines.groupBy("line_id").agg(F.count("*").alias("c")).where("c > 1").select("line_id")
    # A run with a line that occurs once cannot repeat, so its start drops out here or in a later round.
    start = lines.join(_ranked(twice, "line_id"), "line_id")
    level = settle(start.select("key", "pos", "raw", "n", "raw_end", "run_words", "run_chars", "rank"), "level")
    info, found, k = level, [], 0
    while not level.isEmpty():
        size = 2**k
        begin = info.where(F.col("n").between(size, 2 * size - 1) & (F.col("run_words") >= min_words))
        a = begin.drop("rank").join(level.select("key", "pos", F.col("rank").alias("head")), ["key", "pos"])
        a = a.withColumn("_end", F.col("pos") + F.col("n") - size)
        b = level.select("key", F.col("pos").alias("_end"), F.col("rank").alias("tail"))
        found.append(a.join(b, ["key", "_end"]).select("key", "pos", "raw", "raw_end", F.lit(k).alias("k"), "n", "run_chars", "head", "tail"))
        if 2 * size > min_words:
            break
        here = level.select("key", "pos", F.col("rank").alias("head"))
        after = level.select("key", (F.col("pos") - size).alias("pos"), F.col("rank").alias("tail"))
        pairs = settle(here.join(after, ["key", "pos"]), "pairs")
        classes = pairs.groupBy("head", "tail").agg(F.count("*").alias("c")).where("c > 1").select("head", "tail")
        level = settle(pairs.join(_ranked(classes, "head", "tail"), ["head", "tail"]).select("key", "pos", "rank"), "level")
        k += 1
    if not found:
        return level.select("key", F.col("raw").alias("first"), F.col("raw_end").alias("last"))
    runs = found[0]
    for x in found[1:]:
        runs = runs.unionAll(x)
    # Stored, since dealing by range reads it twice.
    later = _suffix_neighbours(settle(runs, "runs")).where("shared = n")
    order = Window.partitionBy("key").orderBy("raw", "raw_end")
    reach = F.max("raw_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = later.select("key", "raw", "raw_end").withColumn("new", (F.coalesce(reach, F.lit(-2)) < F.col("raw")).cast("int"))
    islands = islands.withColumn("island", F.sum("new").over(order))
    return islands.groupBy("key", "island").agg(F.min("raw").alias("first"), F.max("raw_end").alias("last")).drop("island")


def remove_repeated_lines(docs: DataFrame, doc: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the later copies of repeated runs cut from ``text``, and ``removed``: the cut runs (first, last), or null.

    Where ``docs`` has a column ``removed``, the runs are called :func:`free_name` of it, as in ``removed_1``.
    """
    key, spans = free_name(docs, "_key"), free_name(docs, "removed")
    runs = repeated_runs(docs.select(F.col(doc).alias(doc), "text"), doc, min_words)
    cut = runs.groupBy(F.col("key").alias(key)).agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias(spans))
    keyed = docs.withColumn(key, _key(docs, doc))
    lines = F.split(F.col("text"), "\n")
    outside = lambda _, i: ~F.exists(F.col(spans), lambda r: i.between(r["first"], r["last"]))
    text = F.when(F.col(spans).isNull(), F.col("text")).otherwise(F.array_join(F.filter(lines, outside), "\n"))
    return keyed.join(cut, key, "left").withColumn("text", text).drop(key)
