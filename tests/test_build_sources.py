"""Sources of the fact tables: read once, parsed at the same time."""

import threading

from pyspark.sql import functions as F

from tallyglass.functions import text as tx
from tallyglass.functions import values as vl
from tallyglass.operators import structure as st
from tallyglass.plans import build
from tallyglass.session import together
from tallyglass.sources import documents as dc


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_replies_are_read_once(spark):
    rows = [
        (1, '```json\n{"has_assets": true, "holdings": [{"asset": "A"}, null]}\n```'), (2, '{"has_assets": false, "holdings": [{"asset": "B"}]}'),
        (3, 'here: {"has_assets": true, "holdings": [{"asset": "C", "value": "J"}]} done'), (4, '{"has_assets": true}'), (5, "none"), (6, None),
        (7, '{"holdings": [{"asset": "D"}]}'), (8, '{"has_assets": true, "holdings": []}'),
    ]
    found = dc.extracted_holdings(spark.createDataFrame(rows, "page long, raw string").withColumn("raw", F.concat("raw", F.lit("\n"))))
    assert sorted((r.page, r.asset, r.value) for r in found.collect()) == [(1, "", ""), (1, "A", ""), (3, "C", "J")]
    assert plan(found).count("from_json") + plan(found).count("JsonToStructs") == 1


def test_jobs_run_together():
    met = threading.Barrier(3, timeout=20)
    assert together(*[lambda i=i: (met.wait(), i)[1] for i in range(3)]) == [0, 1, 2]
    assert together() == []


def test_sources_begin_together(spark):
    met = threading.Barrier(3, timeout=60)
    rows = spark.createDataFrame([("1", "Fund A"), ("2", "Fund B")], "doc_id string, asset string")
    filers = spark.createDataFrame([("1", "Doe", "Ann", "NV")], "doc_id string, last string, first string, state string")
    index = spark.createDataFrame([("doe", "D1", ["ann"], 1990, 2000, 1)], "last string, bioguide string, firsts array<string>, min_year int, max_year int, seq bigint")
    begun = lambda df: lambda: (met.wait(), df)[1]
    sources = [build.Source("House", begun(rows), lambda: filers, ".pdf"), build.Source("Senate", begun(rows), filers, ".html")]
    got = build.build_holdings(sources, begun(index), 1998).select("chamber", "asset", "last_name", "bioguide").collect()
    assert sorted(map(tuple, got), key=str) == [(c, a, n, k) for c in ("House", "Senate") for a, n, k in (("Fund A", "Doe", "D1"), ("Fund B", "Unknown", None))]


def test_cells_are_cleaned_once(spark):
    page = "<h2>H</h2><p>text</p><table><tr><th>Transaction Date</th><th>Asset Name</th><th>Amount</th></tr><tr><td>3/4/24</td><td>Fund\x7f</td><td>$1</td></tr></table>"
    pages = spark.createDataFrame([(1, page)], "doc_id int, html string")
    reports = dc.html_report(pages, parts=["heading", "tables"])
    assert reports.columns == ["doc_id", "heading", "tables"]
    found = st.senate_ptr(reports)
    assert [(r.transaction_date, r.asset, r.amount, r.comment) for r in found.collect()] == [("2024-03-04", "Fund", "$1", "")]
    # The header, the cells, and the two dates.
    assert plan(found).count("translate(") <= 6


def test_merged_rows_of_odd_cells(spark):
    head, text = ["Asset", "Owner", "Transaction Type", "Date", "Notification", "Amount"], "SP Fund (AB) P 01/05/2024 01/10/2024 $1,001 - $15,000"
    bodies = [[text, "", " ", None, "", ""], [text, "\x7f", "", "", "", ""], ["\x7f", "", "", "", "", ""], ["Fund (AB)", "JT", "Purchase", "1/5/24", "", "$1"], [text], []]
    rows = [("P", i, c) for i, c in enumerate([head, *bodies])]
    found = st.house_ptr(spark.createDataFrame(rows, "doc_id string, row_no int, cells array<string>"), ["doc_id"], ["row_no"])
    # A cell with a control character is not empty to the test for merged rows.
    assert [(r.row_no, r.asset, r.transaction_date, r.amount) for r in found.orderBy("row_no").collect()] == [
        (1, "Fund (AB)", "2024-01-05", "$1,001 - $15,000"), (2, text, "", ""), (4, "Fund (AB)", "2024-01-05", "$1"), (5, "Fund (AB)", "2024-01-05", "$1,001 - $15,000"),
    ]
    # Header test and roles, cells, the test for merged rows, dates.
    assert plan(found).count("translate(") <= 13


def test_lines_and_cells_are_read_by_cheap_forms(spark):
    odd = ["", " ", "a", "  a\t\tb ", "F S: New", " S O : Fund F  S : Old", "Fund F S New", "\x85a　 b ", "x\x1f\x7fy", "Ä  ß:", "\n F\tS:\nrest", "1. Fund A  Dividend K T", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "i int, t string")
    slow = F.regexp_replace("t", tx.STRIP_CLASS + "+", " ")
    label = tx.strip_all(F.regexp_replace(tx.strip_all(F.regexp_replace("t", r"\s*F\s+S\s*:.*$", "")), r"^S\s+O\s*:\s*", ""))
    words = F.array_join(F.filter(F.split("t", tx.STRIP_CLASS + "+"), lambda x: x != ""), " ")
    asked = df.select(tx.collapse_spaces("t"), slow, tx.strip_labels("t"), label, F.trim(tx.collapse_spaces("t")), words, vl.normalize_date("t"), vl.normalize_date(tx.clean("t", True), cleaned=True))
    for r in asked.collect():
        assert r[0] == r[1] and r[2] == r[3] and r[4] == r[5] and r[6] == r[7]
    assert "split(" not in plan(df.select(vl.parse_codes("t")))
    page = spark.createDataFrame([(1, "<table><tr><th>Transaction Date</th></tr><tr><td>3/4/24</td></tr></table>")], "doc_id int, html string")
    # The header, the cells, and the slashes of the two dates.
    assert plan(st.senate_ptr(dc.html_report(page, parts=["tables"]))).count("translate(") <= 4
