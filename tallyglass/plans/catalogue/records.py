"""Records recovered from tables and text lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import fixed_values as fv
from ...functions import text as tx
from ...operators import structure as st
from ...operators.ordered import CHUNK, Order, fold, running, sized
from ...sources import documents as dc
from . import query
from .aggregates import HOUSE_ROWS
from .views import cell_order, line_order

_AT = ["doc_id", "page", "table_no", "row_no"]


# -- one row at a time -------------------------------------------------------


def query_sql(name: str) -> str:
    """The oracle of one of the queries below, to be part of another."""
    from . import _ORACLES

    return _ORACLES[name]


@query(f"""WITH {HOUSE_ROWS} SELECT doc_id, page, table_no, row_no, header,
  regexp_matches(lower(concat_ws('|', c0, c1, c2, c3, c4, c5)), 'transaction|amount') AS ptr FROM house5""")
def header_class(v):
    c = st.clean_cells(F.col("cells"))
    return v.house_cells.select(
        *_AT, st.is_asset_header(c).alias("header"), st.is_ptr_header(c).alias("ptr")
    )


_HOUSE_MAP = """CASE variant WHEN 0 THEN '1,2,3,4,5,6,7,-' WHEN 1 THEN '1,-,2,3,4,5,6,7' ELSE '-,3,-,-,2,-,-,-' END"""
_SENATE_MAP = """CASE variant WHEN 0 THEN '1,2,3,4,7,5,6,-' WHEN 1 THEN '1,-,2,3,6,4,5,-' ELSE '-,-,-,-,-,2,-,-' END"""


@query(f"SELECT doc_id, {_HOUSE_MAP} AS house, {_SENATE_MAP} AS senate FROM ptr_cells_v WHERE row_no = 0")
def column_map(v):
    def text(rules):
        m = st.column_map(F.col("cells"), rules)
        return F.concat_ws(",", *[F.coalesce(m[r].cast("string"), F.lit("-")) for r in rules])

    return v.ptr_rows.where("row_no = 0").select(
        "doc_id", text(st.HOUSE_ROLES).alias("house"), text(st.SENATE_ROLES).alias("senate")
    )


@query(f"WITH {HOUSE_ROWS} SELECT doc_id, page, table_no, row_no, six, owner, value, income_type, income FROM house5")
def layout_infer(v):
    lay = st.holding_layout(st.clean_cells(F.col("cells")))
    return v.house_cells.select(*_AT, lay.alias("l")).select(
        *_AT, F.col("l.six_columns").alias("six"), "l.owner", "l.value", "l.income_type", "l.income"
    )


@query("""SELECT doc_id, row_no, sub, sub2, c0 <> '' AND concat(c1, c2, c3, c4, c5, c6) = '' AS smashed FROM ptr_cells_v""")
def smashed_flag(v):
    return v.ptr_rows.select("doc_id", "row_no", "sub", "sub2", st.is_smashed(F.col("cells")).alias("smashed"))


# Merged cells in a few shapes, with the fields each must yield.
_MERGED = """merged AS (SELECT l_orderkey AS o, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, CAST(l_suppkey % 5 AS INT) AS k,
  lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') || '/' || lpad(CAST(day(l_shipdate) AS VARCHAR), 2, '0') || '/' ||
    CAST(year(l_shipdate) AS VARCHAR) AS d, strftime(l_shipdate, '%Y-%m-%d') AS iso FROM lineitem)"""


def _merged_text():
    s = F.col("l_suppkey").cast("string")
    d = F.date_format("l_shipdate", "MM/dd/yyyy")
    k = F.col("l_suppkey") % 5
    lit = F.lit
    return (
        F.when(k == 0, F.concat(lit("SP Apple "), s, lit(" S (partial) "), d, lit(" 01/10/2024 $1,001 - $15,000")))
        .when(k == 1, F.concat(lit("Pepsi "), s, lit(" P "), d, lit(" "), d, lit(" $1,001 -\nmore $15,000 name\nF S: New")))
        .when(k == 2, F.concat(lit("JT Fund "), s, lit(" Exchange (New) "), d, lit(" $50,001 – $100,000")))
        .when(k == 3, F.concat(lit("dep. child Bond "), s, lit("\nS "), d, lit(" 02/02/2024")))
        .otherwise(F.concat(lit("gift of "), s))
    )


@query(f"""WITH {_MERGED} SELECT o, n, p, s,
  CASE k WHEN 0 THEN 'Apple ' || s WHEN 1 THEN 'Pepsi ' || s || ' more name' WHEN 2 THEN 'Fund ' || s WHEN 3 THEN 'Bond ' || s END AS asset,
  CASE k WHEN 0 THEN 'Sale (Partial)' WHEN 1 THEN 'Purchase' WHEN 2 THEN 'Exchange' WHEN 3 THEN 'Sale (Full)' END AS tx_type,
  CASE WHEN k < 4 THEN iso END AS tx_date,
  CASE k WHEN 0 THEN '2024-01-10' WHEN 1 THEN iso WHEN 2 THEN '' WHEN 3 THEN '2024-02-02' END AS disc_date,
  CASE k WHEN 0 THEN '$1,001 - $15,000' WHEN 1 THEN '$1,001 - $15,000' WHEN 2 THEN '$50,001 – $100,000' WHEN 3 THEN '' END AS amount,
  CASE k WHEN 0 THEN 'SP' WHEN 1 THEN 'DC' WHEN 2 THEN 'JT' WHEN 3 THEN 'DEP. CHILD' END AS owner FROM merged""")
def smashed_parse(v):
    rows = v.lineitem.select(
        F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"),
        F.col("l_suppkey").alias("s"), _merged_text().alias("text"),
    )
    return rows.select("o", "n", "p", "s", st.merged_cell(F.col("text")).alias("m")).select(
        "o", "n", "p", "s", "m.*"
    )


@query("""SELECT l_orderkey AS o, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, CASE l_suppkey % 4
  WHEN 0 THEN 'a $1,001 - $2|rest' WHEN 1 THEN 'a $1 - $2|-|b $3 -|c' WHEN 2 THEN 'x $5 -' ELSE 'a $7 -|none|b $8 - $9' END AS joined
FROM lineitem""")
def split_amount(v):
    k = F.col("l_suppkey") % 4
    text = (
        F.when(k == 0, "a $1,001 -\n$2 rest")
        .when(k == 1, "a $1 -\n$2 -\nb $3 -\nc")
        .when(k == 2, "x $5 -")
        .otherwise("a $7 -\nnone\nb $8 -  \n$9")
    )
    return v.lineitem.select(
        F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"),
        F.col("l_suppkey").alias("s"),
        F.array_join(st.join_split_amounts(F.split(text, "\n")), "|").alias("joined"),
    )


# -- running state within a document ----------------------------------------


@query(f"WITH {HOUSE_ROWS} SELECT doc_id, page, table_no, row_no, in_section FROM house5")
def section_latch(v):
    rows = v.house_cells.withColumn("header", st.is_asset_header(st.clean_cells(F.col("cells"))))
    return running(rows, sized(v.house_cells, cell_order()), on=("max", F.col("header").cast("int"))).select(
        *_AT, (F.col("on") == 1).alias("in_section")
    )


@query(f"""WITH {HOUSE_ROWS} SELECT doc_id, entry, string_agg(asset, ' ' ORDER BY page, table_no, row_no) AS asset,
  max(CASE WHEN emit THEN owner END) AS owner, max(CASE WHEN emit THEN value END) AS value,
  max(CASE WHEN emit THEN income_type END) AS income_type, max(CASE WHEN emit THEN income END) AS income
FROM house5 WHERE in_section AND (emit OR more) GROUP BY doc_id, entry HAVING max(CASE WHEN emit THEN 1 ELSE 0 END) = 1""")
def house_holdings(v):
    return st.house_holdings(v.house_cells, cell_order()).select(
        "doc_id", "entry", "asset", "owner", "value", "income_type", "income"
    )


@query(f"""WITH {HOUSE_ROWS} SELECT doc_id, entry, string_agg(asset, ' ' ORDER BY page, table_no, row_no) AS asset,
  count(*) AS n_rows FROM house5 WHERE in_section AND (emit OR more) GROUP BY doc_id, entry
HAVING max(CASE WHEN emit THEN 1 ELSE 0 END) = 1 AND count(*) > 1""")
def stitch_rows(v):
    rows = st.house_rows(v.house_cells, cell_order()).where("in_section AND (emit OR more)")
    return (
        fold(
            rows, ["doc_id", "entry"], cell_order().position(), concat={"asset": F.col("asset")},
            total={"n_rows": F.lit(1), "emits": F.col("emit").cast("int")},
        )
        .where("emits = 1 AND n_rows > 1")
        .select("doc_id", "entry", "asset", "n_rows")
    )


def _like_any(col: str, words: list[str]) -> str:
    return " OR ".join("contains({}, '{}')".format(col, w.replace("'", "''")) for w in words)


_NOISE_J = f"""(regexp_matches(line, '(?i)^[0-9]+\\.\\s+(Income Gain Codes|Value Codes|Value Method)')
  OR regexp_matches(line, '(?i)^(Page\\s+[0-9]+\\s+of\\s+[0-9]+|<!--\\s*page\\s+[0-9]+)') OR {_like_any('line', fv.JUDICIAL_NOISE)})"""
_NOISE_E = f"({_like_any('line', fv.EXECUTIVE_NOISE)})"


@query(f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE {_NOISE_J}) AS judicial_noise,
  count(*) FILTER (WHERE {_NOISE_E}) AS executive_noise FROM l GROUP BY doc_id""")
def line_noise(v):
    line = F.col("line")
    return dc.lines(v.documents).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(st.is_judicial_noise(line)).alias("judicial_noise"),
        F.count_if(tx.contains_any(line, fv.EXECUTIVE_NOISE)).alias("executive_noise"),
    )


# -- judiciary pages ---------------------------------------------------------

# The kinds of line the view is made of; codes as stated for parse_codes.
_JROWS = f"""jl AS (SELECT 'J' || CAST(l_partkey AS VARCHAR) AS doc_id, l_orderkey AS p, CAST(l_linenumber AS BIGINT) AS t,
    l_suppkey AS u, CAST(l_quantity AS INT) % 10 AS k, CAST(l_linenumber AS VARCHAR) AS num, CAST(l_suppkey AS VARCHAR) AS sk FROM lineitem),
jw AS (SELECT *, k IN (1, 2, 3, 8, 9) AS numbered, sum(CASE WHEN k = 0 AND u % 2 = 0 THEN 1 ELSE 0 END) OVER w AS opened,
    sum(CASE WHEN k IN (1, 2, 3, 8, 9) THEN 1 ELSE 0 END) OVER w AS entry FROM jl
    WINDOW w AS (PARTITION BY doc_id ORDER BY p, t, u ROWS UNBOUNDED PRECEDING)),
jk AS (SELECT *, CASE k WHEN 0 THEN CASE WHEN CAST(sk AS BIGINT) % 2 = 0 THEN 'VII. Investments and Trusts' ELSE 'VIII. Notes' END
      WHEN 4 THEN 'series ' || sk WHEN 5 THEN 'class' END AS added,
    CASE k WHEN 1 THEN 'Fund ' || sk || ' (X)' WHEN 3 THEN 'Bond ' || sk WHEN 8 THEN 'Trust ' || sk END AS named,
    CASE k WHEN 1 THEN 'K' WHEN 2 THEN 'J' WHEN 5 THEN 'L' END AS vc, CASE k WHEN 1 THEN 'A' WHEN 5 THEN 'B' END AS ic,
    CASE k WHEN 1 THEN 'Dividend' WHEN 5 THEN 'Interest' END AS it, CASE k WHEN 1 THEN 'T' WHEN 2 THEN 'T' WHEN 5 THEN 'U' END AS mc,
    CASE k WHEN 3 THEN 'Sold|03/04/24|J|A' WHEN 9 THEN 'Buy|12/31/2023|P1|E' END AS deal
  FROM jw WHERE k NOT IN (6, 7) AND opened > CASE WHEN k = 0 AND u % 2 = 0 THEN 1 ELSE 0 END),
je AS (SELECT doc_id, entry, min(CASE WHEN numbered THEN num END) AS number, min(named) AS own,
    string_agg(added, ' ' ORDER BY p, t, u) AS more, coalesce(max(ic) FILTER (WHERE k = 5), max(ic), '') AS income_code,
    coalesce(max(vc) FILTER (WHERE k = 5), max(vc), '') AS value_code, coalesce(max(it) FILTER (WHERE k = 5), max(it), '') AS income_type,
    coalesce(max(mc) FILTER (WHERE k = 5), max(mc), '') AS method_code, max(deal) AS deal
  FROM jk GROUP BY doc_id, entry HAVING max(CASE WHEN numbered THEN 1 ELSE 0 END) = 1)"""


@query(f"""WITH {_JROWS} SELECT doc_id, entry, number, own, more, value_code, income_code, income_type, method_code,
  coalesce(split_part(deal, '|', 1), '') AS tx_type, coalesce(split_part(deal, '|', 2), '') AS tx_date,
  coalesce(split_part(deal, '|', 3), '') AS tx_value, coalesce(split_part(deal, '|', 4), '') AS tx_gain FROM je""")
def numbered_entries(v):
    return st.judicial_entries(v.judicial_lines, line_order())


# Names one entry after the other, as a recursion over the kept entries of a document.
def _inherited(gate: str) -> str:
    return f"""WITH RECURSIVE {_JROWS},
kept AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY entry) AS i FROM je WHERE {gate}
  AND number <> '0'),
walk AS (SELECT doc_id, i, trim(regexp_replace(trim(coalesce(own, '') || coalesce(' ' || more, '')), '\\s*\\([A-Z]\\)\\s*$', '')) AS asset,
    own IS NOT NULL OR more IS NOT NULL AS out FROM kept WHERE i = 1
  UNION ALL SELECT k.doc_id, k.i, CASE WHEN k.own IS NULL AND k.more IS NULL AND w.asset = '' THEN '' ELSE
    trim(regexp_replace(trim(coalesce(k.own, w.asset) || coalesce(' ' || k.more, '')), '\\s*\\([A-Z]\\)\\s*$', '')) END,
    k.own IS NOT NULL OR k.more IS NOT NULL OR w.asset <> ''
  FROM walk w JOIN kept k ON k.doc_id = w.doc_id AND k.i = w.i + 1)"""


_VALUE = "CASE {c} " + " ".join(f"WHEN '{k}' THEN '{x}'" for k, x in fv.VALUE_RANGES.items()) + " ELSE {c} END"


@query(_inherited("(value_code <> '' OR income_code <> '')") + f"""
SELECT k.doc_id, k.entry, w.asset, {_VALUE.format(c='k.value_code')} AS value, k.income_type, k.income_code AS income
FROM walk w JOIN kept k ON k.doc_id = w.doc_id AND k.i = w.i WHERE w.out""")
def judicial_holdings(v):
    return st.judicial_holdings(v.judicial_lines, line_order())


_TX_OUT = f"""SELECT k.doc_id, k.entry, CASE split_part(k.deal, '|', 2) WHEN '03/04/24' THEN '2024-03-04' ELSE '2023-12-31' END AS transaction_date,
  w.asset, CASE split_part(k.deal, '|', 1) WHEN 'Buy' THEN 'Purchase' ELSE 'Sale (Full)' END AS transaction_type,
  {_VALUE.format(c="split_part(k.deal, '|', 3)")} AS amount, coalesce(regexp_extract(w.asset, '\\(([A-Z]{{1,5}})\\)', 1), '') AS ticker
FROM walk w JOIN kept k ON k.doc_id = w.doc_id AND k.i = w.i WHERE w.out"""


@query(_inherited("deal IS NOT NULL") + "\n" + _TX_OUT)
def judicial_tx(v):
    return st.judicial_transactions(v.judicial_lines, line_order())


@query(_inherited("deal IS NOT NULL") + """
SELECT k.doc_id, k.entry, w.asset, k.own IS NULL AS inherited FROM walk w JOIN kept k ON k.doc_id = w.doc_id AND k.i = w.i WHERE w.out""")
def inherit_prev(v):
    order = sized(v.judicial_lines, line_order())
    entries = st.judicial_entries(v.judicial_lines, order).where("tx_date <> '' AND number <> '0'")
    return st.inherit_names(entries, ["doc_id"], drop_arrows=False, whole=order.whole).select(
        "doc_id", "entry", "asset", F.col("own").isNull().alias("inherited")
    )


# -- executive pages ---------------------------------------------------------

_EROWS = """el AS (SELECT 'E' || CAST(l_partkey AS VARCHAR) AS doc_id, l_orderkey AS p, CAST(l_linenumber AS BIGINT) AS t,
    l_suppkey AS u, CAST(l_quantity AS INT) % 9 AS k, CAST(l_suppkey AS VARCHAR) AS sk, l_suppkey % 3 AS sec FROM lineitem),
ew AS (SELECT *, last_value(CASE WHEN k = 0 THEN CASE WHEN sec = 2 THEN 0 ELSE 1 END END IGNORE NULLS) OVER w AS in_target,
    sum(CASE WHEN k IN (0, 1, 2, 5) THEN 1 ELSE 0 END) OVER w AS entry FROM el WHERE k <> 6
    WINDOW w AS (PARTITION BY doc_id ORDER BY p, t, u ROWS UNBOUNDED PRECEDING))"""


@query(f"WITH {_EROWS} SELECT doc_id, p, t, u, entry FROM ew WHERE in_target = 1 AND k <> 0")
def section_switch(v):
    return st.executive_rows(v.executive_lines, line_order()).select("doc_id", "p", "t", "u", "entry")


_EXEC = f"""WITH {_EROWS},
ee AS (SELECT doc_id, entry, max(k) FILTER (WHERE k IN (1, 2, 5)) AS kind, max(sk) FILTER (WHERE k IN (1, 2, 5)) AS sk,
  arg_min(CASE k WHEN 3 THEN 'Holding Company ' || sk ELSE 'Partners ' || sk END, (p, t, u)) FILTER (WHERE k IN (3, 8)) AS found
  FROM ew WHERE in_target = 1 AND k <> 0 GROUP BY doc_id, entry)
SELECT doc_id, entry, CASE kind WHEN 1 THEN 'Fund ' || sk WHEN 5 THEN 'Club ' || sk ELSE found END AS asset,
  CASE kind WHEN 1 THEN '$1,001 - $15,000' WHEN 2 THEN '$15,001 - $50,000' ELSE '' END AS value,
  CASE kind WHEN 1 THEN 'Dividend' WHEN 2 THEN 'Interest' ELSE '' END AS income_type,
  CASE kind WHEN 1 THEN 'None / <$1,001' WHEN 2 THEN '$201 - $1,000' ELSE '' END AS income
FROM ee WHERE kind IS NOT NULL AND (kind <> 2 OR found IS NOT NULL)"""


@query(_EXEC)
def executive_holdings(v):
    return st.executive_holdings(v.executive_lines, line_order())


@query(_EXEC + " AND kind = 2")
def pending_pair(v):
    held = st.executive_holdings(v.executive_lines, line_order())
    return held.where("income = '$201 - $1,000'")


# -- periodic reports --------------------------------------------------------


@query("""SELECT 'P' || CAST(l_orderkey AS VARCHAR) AS doc_id, CAST(l_linenumber AS BIGINT) AS row_no, l_partkey AS sub, l_suppkey AS sub2,
  strftime(l_shipdate, '%Y-%m-%d') AS transaction_date,
  CASE WHEN l_suppkey % 5 = 0 THEN '2024-01-10' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS disclosure_date,
  CASE WHEN l_suppkey % 5 = 0 THEN 'Fund ' || l_suppkey || ' (AB) Inc' ELSE 'Fund ' || l_suppkey || ' (TK)' END AS asset,
  CASE WHEN l_suppkey % 5 = 0 THEN '' WHEN l_orderkey % 3 = 0 THEN 'ST' ELSE '' END AS asset_type,
  CASE WHEN l_suppkey % 5 = 0 THEN 'Sale (Partial)' WHEN l_returnflag = 'A' THEN 'Purchase' WHEN l_returnflag = 'N' THEN 'Sale (Full)'
    ELSE 'gift' END AS transaction_type,
  '$1,001 - $15,000' AS amount, CASE WHEN l_suppkey % 5 = 0 THEN 'AB' ELSE 'TK' END AS ticker,
  CASE WHEN l_suppkey % 5 <> 0 AND l_orderkey % 3 = 1 THEN 'note' ELSE '' END AS comment
FROM lineitem WHERE l_orderkey % 3 < 2 AND (l_suppkey % 5 = 0 OR l_suppkey % 7 <> 1)""")
def house_ptr(v):
    return st.house_ptr(v.ptr_rows, ["doc_id"], ["row_no", "sub", "sub2"])


def _reports(v):
    return dc.html_report(v.reports, "report_id", "html")


@query("""SELECT o_orderkey AS doc_id, 'Fund ' || CAST(o_custkey AS VARCHAR) AS asset, 'Stock' AS asset_type, 'Self' AS owner,
  '$1,001 - $15,000' AS value, '$' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS income_type, 'None' AS income
FROM orders WHERE o_orderkey % 3 <> 2""")
def senate_holdings(v):
    return st.senate_holdings(_reports(v)).select(
        "doc_id", "asset", "asset_type", "owner", "value", "income_type", "income"
    )


@query("""SELECT o_orderkey AS doc_id, '2024-03-04' AS transaction_date, '' AS disclosure_date,
  'Corp (' || upper(substr(o_orderpriority, 3, 3)) || ')' AS asset, '' AS asset_type, 'Sale (Partial)' AS transaction_type,
  '$' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS amount, upper(substr(o_orderpriority, 3, 3)) AS ticker, 'None' AS comment
FROM orders WHERE o_orderkey % 3 = 2
UNION ALL SELECT o_orderkey, '', '', 'Fund ' || CAST(o_custkey AS VARCHAR), 'Stock', '', '$' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR), '', 'None'
FROM orders WHERE o_orderkey % 3 <> 2""")
def senate_ptr(v):
    return st.senate_ptr(_reports(v)).select(
        "doc_id", "transaction_date", "disclosure_date", "asset", "asset_type", "transaction_type", "amount",
        "ticker", "comment",
    )


# -- scanned pages -----------------------------------------------------------


@query("""WITH pg AS (SELECT l_partkey AS doc, l_orderkey % 70 AS page, max(CASE WHEN l_quantity > 40 THEN 1 ELSE 0 END) AS found
  FROM lineitem GROUP BY 1, 2),
d AS (SELECT doc, page, found, row_number() OVER (PARTITION BY doc ORDER BY page) - 1 AS pg FROM pg),
r AS (SELECT * FROM (SELECT *, pg - coalesce(max(CASE WHEN found = 1 THEN pg END) OVER (PARTITION BY doc ORDER BY pg), -1) AS run FROM d) q WHERE pg < 60),
c AS (SELECT doc, min(pg) AS cut FROM r WHERE pg > 5 AND run >= 5 GROUP BY doc)
SELECT r.doc, r.pg, r.found FROM r LEFT JOIN c ON r.doc = c.doc WHERE c.cut IS NULL OR r.pg <= c.cut""")
def early_stop(v):
    pages = (
        v.lineitem.groupBy(F.col("l_partkey").alias("doc"), (F.col("l_orderkey") % 70).alias("page"))
        .agg(F.max((F.col("l_quantity") > 40).cast("int")).alias("found"))
    )
    order = Order(["doc"], ["page"], 64)
    # dense page numbers of each document
    dense = running(pages, order, pg=("sum", F.lit(1))).withColumn("pg", F.col("pg") - 1).drop(CHUNK)
    out = st.early_stop(dense, Order(["doc"], ["pg"], 64), "pg", F.col("found"))
    return out.select("doc", "pg", "found")
