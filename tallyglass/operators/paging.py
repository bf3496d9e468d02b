"""Pages of a total order: after a known row, and deep ones by order statistics.

``offset(n).limit(m)`` brings n + m rows to one task.  Here the row before the
page is found first: the sort columns alone are dealt by range, each range is
counted, and the one range that holds the position gives the row.  The last row
of the page is found with it, and the page is what lies between the two.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle


@dataclass(frozen=True)
class SortKey:
    """A column of an order: ascending with nulls first, or descending with nulls last."""

    column: str
    descending: bool = False

    @property
    def order(self) -> Column:
        c = F.col(self.column)
        return c.desc_nulls_last() if self.descending else c.asc_nulls_first()

    def past(self, value) -> Column:
        """Whether a row comes after ``value`` in this column; nulls count as the least value."""
        c = F.col(self.column)
        if value is None:
            return F.lit(False) if self.descending else c.isNotNull()
        return (c < F.lit(value)) | c.isNull() if self.descending else c > F.lit(value)


def follows(keys: list[SortKey], row: tuple) -> Column:
    """Whether a row comes after ``row``, given by its values of ``keys``, in the order of ``keys``."""
    if len(keys) != len(row):
        raise ValueError(f"{len(row)} values for the order by {[k.column for k in keys]}")
    same = [F.col(k.column).eqNullSafe(F.lit(v)) for k, v in zip(keys, row)]
    beyond = [reduce(and_, [*same[:i], k.past(v)]) for i, (k, v) in enumerate(zip(keys, row))]
    return F.coalesce(reduce(or_, beyond), F.lit(False))


def after(df: DataFrame, keys: list[SortKey], row: tuple) -> DataFrame:
    """The rows that follow ``row``."""
    return df.where(follows(keys, row))


def row_at(df: DataFrame, keys: list[SortKey], position: int, ranges: int | None = None) -> tuple | None:
    """Values of ``keys`` of the row at a 0-based position, None beyond the last row."""
    return rows_at(df, keys, [position], ranges)[0]


def rows_at(df: DataFrame, keys: list[SortKey], positions: list[int], ranges: int | None = None) -> list[tuple | None]:
    """As :func:`row_at` for several positions, from one deal of the rows.

    The driver receives one count for each range and these rows.  No task holds
    more than a range of sort columns; ``ranges`` sets how many there are, else
    Spark's number of shuffle partitions does.
    """
    names = [k.column for k in keys]
    order = [k.order for k in keys]
    n = [ranges] if ranges else []
    dealt = df.select(*names).repartitionByRange(*n, *order).withColumn("__range", F.spark_partition_id())
    stored = settle(dealt, "page-keys")
    counts = sorted(map(tuple, stored.groupBy("__range").count().collect()))

    def find(position: int) -> tuple | None:
        for part, rows in counts:
            if position < rows:
                inside = stored.where(F.col("__range") == part).orderBy(*order).offset(position).limit(1)
                return tuple(inside.select(*names).first())
            position -= rows
        return None

    return [find(p) for p in positions]


def deep_page(df: DataFrame, keys: list[SortKey], limit: int, offset: int, ranges: int | None = None) -> DataFrame:
    """The rows of ``orderBy(keys).offset(offset).limit(limit)``.

    The keys must tell all rows apart, as an order that ends with an id does;
    of rows that agree in all keys with the row before the page none is given.
    """
    order = [k.order for k in keys]
    if offset == 0:
        return df.orderBy(*order).limit(limit)
    before, last = rows_at(df, keys, [offset - 1, offset + limit - 1], ranges)
    rest = df.limit(0) if before is None else after(df, keys, before)
    if last is not None:
        # Only the page's own rows get their other columns from joins below that the keys do not need.
        rest = rest.where(~follows(keys, last))
    return rest.orderBy(*order).limit(limit)
