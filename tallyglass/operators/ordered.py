"""Order-dependent work inside documents, safe when one document is huge.

A plain window over a document puts the whole document in one task.  Here every
document is cut into chunks along its own order, and a chunk is an automaton
whose state is what it carries: counts, maxima, latest values, texts.  One pass
over the source runs every chunk from the empty state and stores its rows; the
state at a chunk's last row is its summary.  Summaries, one row per chunk, are
composed along each document, which is associative, and the second pass adds to
the stored rows the state their chunk begins with.  A document shorter than a chunk
begins empty; a table that has only such documents (:func:`sized`) needs neither
the stored rows nor the second pass, and gets one window per document.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle

CHUNK, END = "__chunk", "__end"


@dataclass(frozen=True)
class Order:
    """How rows line up inside a document.

    The leading order column (a whole number) is cut every ``cut`` values; with
    ``fine``, every value of it is a cut and the second column is cut every
    ``fine`` values.  So chunks follow from the order and cannot contradict it.
    """

    keys: list[str]
    by: list[str]
    cut: int = 65536
    fine: int | None = None
    #: No document has more rows than a chunk may have, so none is cut.
    whole: bool = False

    def position(self) -> Column:
        return F.struct(*[F.col(c) for c in self.by])

    def within(self, *extra: str) -> "Order":
        return replace(self, keys=[*self.keys, *extra])

    def chunk(self) -> Column:
        if self.whole:
            return F.lit(0).cast("bigint")
        if self.fine is None:
            return F.floor(F.col(self.by[0]) / self.cut).cast("bigint")
        return (F.col(self.by[0]) * (1 << 40) + F.floor(F.col(self.by[1]) / self.fine)).cast("bigint")


def sized(df: DataFrame, order: Order) -> Order:
    """The order, marked whole when no document of a table has more rows than a chunk may have.

    Counts the keys alone, so ask it of raw rows.  What is cut follows from values of the order, which may
    lie far apart: without this a document of thirty rows could be thirty chunks.
    """
    if order.whole:
        return order
    long = df.groupBy(*order.keys).count().where(F.col("count") > (order.fine or order.cut))
    return replace(order, whole=not long.take(1))


def mark_chunks(df: DataFrame, order: Order) -> DataFrame:
    """Add ``__chunk``."""
    return df if CHUNK in df.columns else df.withColumn(CHUNK, order.chunk())


def by_document(df: DataFrame, order: Order) -> DataFrame:
    """Place raw rows where :func:`running` will need them.

    Called before rows are parsed: the raw cells or lines cross the network,
    not the wider parsed rows, and parsing runs on every task even when the
    source is one unsplittable file.  The later windows reuse this placement.
    """
    marked = mark_chunks(df, order)
    return marked.repartition(*order.keys) if order.whole else marked.repartition(*order.keys, CHUNK)


def _in_window(kind: str, c: Column, w) -> Column:
    if kind == "sum":
        return F.sum(c).over(w)
    if kind == "max":
        return F.max(c).over(w)
    if kind == "last":
        return F.last(c, ignorenulls=True).over(w)
    if kind == "concat":
        return F.array_join(F.collect_list(c).over(w), " ")
    raise ValueError(kind)


def running(df: DataFrame, order: Order, **values: tuple[str, Column]) -> DataFrame:
    """Add running values (inclusive of the current row) over each document.

    Each value is (kind, column); kind is sum, max, last (non-null) or concat.
    """
    marked = mark_chunks(df, order)
    inputs = {name: f"__in_{name}" for name in values}
    own = Window.partitionBy(*order.keys, *([] if order.whole else [CHUNK])).orderBy(*order.by)
    w = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = marked.withColumns({inputs[n]: c for n, (_, c) in values.items()})
    if order.whole:
        return local.withColumns({n: _in_window(kind, F.col(inputs[n]), w) for n, (kind, _) in values.items()}).drop(*inputs.values())
    local = local.withColumns({n: _in_window(kind, F.col(inputs[n]), w) for n, (kind, _) in values.items()} | {END: F.lead(F.lit(1)).over(own).isNull()})
    # The only pass over the source; the rest reads what is stored here.
    local = settle(local.drop(*inputs.values()), "chunks")
    summaries = local.where(END).select(*order.keys, CHUNK, *values)
    along = Window.partitionBy(*order.keys).orderBy(CHUNK)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = {
        f"__carry_{n}": F.concat_ws(" ", F.collect_list(F.nullif(F.col(n), F.lit(""))).over(before)) if kind == "concat" else _in_window(kind, F.col(n), before)
        for n, (kind, _) in values.items()
    }
    carry = summaries.withColumns(carried | {"__later": F.lag(F.lit(1)).over(along).isNotNull()}).where("__later")
    # Stored, so that Spark knows its size and moves the smaller side only.
    carry = settle(carry.select(*order.keys, CHUNK, *carried), "carries")
    merged = local.drop(END).join(carry, [*order.keys, CHUNK], "left")
    out = {}
    for n, (kind, _) in values.items():
        here, past = F.col(n), F.col(f"__carry_{n}")
        if kind == "sum":
            out[n] = here + F.coalesce(past, F.lit(0))
        elif kind == "max":
            out[n] = F.greatest(here, past)
        elif kind == "last":
            out[n] = F.coalesce(here, past)
        else:
            out[n] = F.concat_ws(" ", F.nullif(past, F.lit("")), F.nullif(here, F.lit("")))
    return merged.withColumns(out).drop(*carried)


def _joined(position: Column, text: Column, sep: str = " ") -> Column:
    """Ordered concatenation of the non-null texts of a group."""
    pairs = F.collect_list(F.when(text.isNotNull(), F.struct(position.alias("p"), text.alias("t"))))
    return F.array_join(F.transform(F.array_sort(pairs), lambda x: x["t"]), sep)


def fold(
    df: DataFrame,
    keys: list[str],
    position: Column,
    *,
    chunk: str = CHUNK,
    concat: dict[str, Column] | None = None,
    first: dict[str, Column] | None = None,
    last: dict[str, Column] | None = None,
    total: dict[str, Column] | None = None,
    sep: str = " ",
) -> DataFrame:
    """Fold ordered rows into one row per key, in two steps.

    Rows are folded per (key, chunk) first and the partial rows per key after,
    so a key that holds a large share of all rows is folded by many tasks.
    ``first`` and ``last`` skip NULLs; ``concat`` skips NULLs, keeps blanks.
    """
    concat, first, last, total = (x or {} for x in (concat, first, last, total))
    at = "__at"
    src = df.withColumn(at, position)

    def keyed(c: Column) -> Column:
        return F.when(c.isNotNull(), F.struct(F.col(at).alias("p"), c.alias("t")))

    partial = src.groupBy(*keys, chunk).agg(
        F.min(at).alias("__from"),
        *[_joined(F.col(at), c, sep).alias(n) for n, c in concat.items()],
        *[F.count(c).alias(f"__n_{n}") for n, c in concat.items()],
        *[F.min(keyed(c)).alias(n) for n, c in first.items()],
        *[F.max(keyed(c)).alias(n) for n, c in last.items()],
        *[F.sum(c).alias(n) for n, c in total.items()],
    )
    return partial.groupBy(*keys).agg(
        F.min("__from").alias("first_at"),
        *[
            _joined(F.col("__from"), F.when(F.col(f"__n_{n}") > 0, F.col(n)), sep).alias(n)
            for n in concat
        ],
        *[F.min(n)["t"].alias(n) for n in first],
        *[F.max(n)["t"].alias(n) for n in last],
        *[F.sum(n).alias(n) for n in total],
    )


def number_rows(df: DataFrame, by: list[str], block: Column, name: str = "id", fine: Column | None = None) -> DataFrame:
    """Dense ids from 1 over the whole table without a global sort task.

    ``block`` is a BIGINT that never falls as the order grows; ``fine``, if
    given, cuts a block again and must never fall within it.  Rows are numbered
    inside their cut and shifted by the count of all rows before it.
    """
    cut = ["__block", "__cut"]
    blocked = df.withColumn("__block", block.cast("bigint")).withColumn("__cut", (F.lit(0) if fine is None else fine).cast("bigint"))
    local = blocked.withColumn(
        name, F.row_number().over(Window.partitionBy(*cut).orderBy(*by)).cast("bigint")
    )
    counts = blocked.groupBy(*cut).agg(F.count(F.lit(1)).alias("n"))

    def earlier(w) -> Column:
        return F.coalesce(
            F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )

    cuts = counts.withColumn("__a", earlier(Window.partitionBy("__block").orderBy("__cut")))
    blocks = counts.groupBy("__block").agg(F.sum("n").alias("n")).withColumn(
        "__group", F.expr("__block DIV 4096")
    )
    within = blocks.withColumn("__b", earlier(Window.partitionBy("__group").orderBy("__block")))
    # One row per 4096 blocks: few enough for the one ordered pass.
    groups = blocks.groupBy("__group").agg(F.sum("n").alias("n")).withColumn(
        "__c", earlier(Window.orderBy("__group"))
    )
    offsets = (
        cuts.select(*cut, "__a")
        .join(within.select("__block", "__group", "__b"), "__block")
        .join(groups.select("__group", "__c"), "__group")
        .select(*cut, (F.col("__a") + F.col("__b") + F.col("__c")).alias("__offset"))
    )
    return (
        local.join(offsets, cut)
        .withColumn(name, F.col(name) + F.col("__offset"))
        .drop(*cut, "__offset")
    )
