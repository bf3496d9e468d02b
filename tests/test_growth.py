"""What keeps shuffles in proportion: rows are narrow while they move, pages are bounded before they are joined."""

import re

from conftest import SMALL
from pyspark.sql import functions as F

from tallyglass.operators.paging import SortKey, after, deep_page, rows_at
from tallyglass.plans.catalogue.views import GROUPED, VIEWS, Views


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_joins_of_holdings_are_grouped(spark):
    text, grouped = GROUPED["holdings_v"]
    assert text in VIEWS["holdings_v"] and text != grouped
    found = Views(spark, SMALL).holdings.where(F.col("asset").contains("ring"))
    joins = re.findall(r"Join Inner,[^\n]*", plan(found))
    assert len(joins) == 3 and "l_orderkey" in joins[0] and {j.count("p_partkey") + j.count("c_custkey") for j in joins[1:]} == {1}
    assert not re.search(r"Filter[^\n]*ring[^\n]*\n[^\n]*Join Inner,[^\n]*l_orderkey", plan(found))


def test_a_deep_page_is_bounded_on_both_sides(spark):
    rows = [(i, None if i % 5 == 0 else i % 7) for i in range(200)]
    table = spark.createDataFrame(rows, "id long, a long")
    for keys in ([SortKey("a", True), SortKey("id")], [SortKey("a"), SortKey("id", True)]):
        in_order = [tuple(r) for r in table.orderBy(*[k.order for k in keys]).select(*[k.column for k in keys]).collect()]
        assert rows_at(table, keys, [3, 150, 200], ranges=5) == [in_order[3], in_order[150], None]
        assert after(table, keys, in_order[150]).count() == 49
        page = deep_page(table, keys, 10, 120, ranges=5)
        assert [(r[keys[0].column], r.id) for r in page.collect()] == in_order[120:130]
        assert "NOT " in plan(page)
