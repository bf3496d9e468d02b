"""Pages by position and by row, against the plain offset and limit."""

import random

import pytest
from pyspark.sql import functions as F

from tallyglass.operators.paging import SortKey, after, deep_page, row_at

ORDERS = [
    [SortKey("a"), SortKey("id")],
    [SortKey("a", descending=True), SortKey("id")],
    [SortKey("b", descending=True), SortKey("a"), SortKey("id")],
    [SortKey("a"), SortKey("b", descending=True), SortKey("id", descending=True)],
]


@pytest.fixture(scope="module")
def table(spark):
    """One value of ``a`` in a third of the rows, nulls in both columns."""
    rnd = random.Random(5)
    rows = [
        (i, "hot" if i % 3 == 0 else rnd.choice([None, "", "x", "é", "Z"]), rnd.choice([None, -1.5, 0.0, 7.25, float("nan")]))
        for i in range(600)
    ]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "id long, a string, b double").withColumn("extra", F.col("id") * 2).repartition(5)


def ids(df):
    return [r.id for r in df.collect()]


@pytest.mark.parametrize("keys", ORDERS)
def test_deep_page_is_offset_and_limit(table, keys):
    whole = ids(table.orderBy(*[k.order for k in keys]))
    for offset, limit in [(0, 5), (1, 1), (199, 40), (598, 10), (600, 3), (5000, 3), (300, 0)]:
        page = deep_page(table, keys, limit, offset, ranges=7)
        assert page.columns == table.columns
        assert ids(page) == whole[offset : offset + limit], (keys, offset)


@pytest.mark.parametrize("keys", ORDERS)
def test_walk_through_all_pages(table, keys):
    order = [k.order for k in keys]
    whole = ids(table.orderBy(*order))
    row, seen = None, []
    while len(seen) < len(whole):
        rest = table if row is None else after(table, keys, row)
        page = rest.orderBy(*order).limit(150).collect()
        seen += [r.id for r in page]
        row = tuple(page[-1][k.column] for k in keys)
    assert seen == whole
    assert not after(table, keys, row).collect()


def test_row_at_and_errors(spark, table):
    keys = [SortKey("a"), SortKey("id")]
    assert row_at(table.where("false"), keys, 0) is None
    assert row_at(table, keys, 600) is None
    assert row_at(table, [SortKey("id")], 599) == (599,)
    with pytest.raises(ValueError):
        after(table, keys, (1,))


def test_one_range_of_sort_columns_in_a_task(spark, table, monkeypatch):
    """The stored ranges hold the sort columns only, and none of them most of the rows although one value is hot."""
    import tallyglass.operators.paging as paging

    stored, inner = [], paging.settle
    monkeypatch.setattr(paging, "settle", lambda df, name: stored.append(inner(df, name)) or stored[-1])
    row_at(table, [SortKey("a"), SortKey("id")], 300, ranges=8)
    assert stored[0].columns == ["a", "id", "__range"]
    assert max(r["count"] for r in stored[0].groupBy("__range").count().collect()) < 200
