"""Counts, quality accounting, table loads and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import text as tx
from ...functions import values as vl
from ...operators import quality as ql
from ...operators import structure as st
from ...schema import HOLDINGS, TRANSACTIONS, evolve
from ...session import work_folder
from ...sources import tables as tb
from .. import search as se
from . import query
from .views import cell_order


# -- counts ------------------------------------------------------------------


@query("SELECT count(*) AS total FROM holdings_v")
def stats_total(v):
    return se.stats(v.holdings)["total"]


@query("SELECT count(DISTINCT last_name || first_name) AS members FROM holdings_v")
def stats_members(v):
    return se.stats(v.holdings)["members"]


@query("SELECT chamber, count(*) AS count FROM holdings_v GROUP BY chamber")
def stats_chambers(v):
    return se.stats(v.holdings)["chambers"]


@query("SELECT filing_type, count(*) AS n, count(*) < 50 AS too_few FROM filing_index_v GROUP BY filing_type")
def filing_type_counts(v):
    return ql.value_counts(v.filing_index, "filing_type")


@query("""SELECT 'holdings' AS table_name, count(*) AS n FROM holdings_v UNION ALL
SELECT 'transactions', count(*) FROM transactions_v UNION ALL
SELECT 'committee_members', count(*) FROM committee_members_v UNION ALL SELECT 'no_such_table', 0""")
def table_counts(v):
    names = ["holdings", "transactions", "committee_members"]
    for n in names:
        getattr(v, n).createOrReplaceTempView(f"counted_{n}")
    counts = ql.catalog_counts(v.spark, [*(f"counted_{n}" for n in names), "counted_no_such_table"])
    return counts.select(F.replace("table_name", F.lit("counted_"), F.lit("")).alias("table_name"), "n")


@query("""WITH n AS (SELECT DISTINCT chamber, last_name || ', ' || first_name AS name FROM holdings_v WHERE bioguide IS NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY chamber ORDER BY name) AS rn, count(*) OVER (PARTITION BY chamber) AS c FROM n)
SELECT chamber, max(c) AS n_names, string_agg(name, '; ' ORDER BY name) AS shown,
  greatest(max(c) - 10, 0) AS n_more FROM r WHERE rn <= 10 GROUP BY chamber""")
def unresolved_report(v):
    return ql.unresolved(v.holdings)


# -- row classes of annual tables, for the quality queries and others ---------

MONEY = "'\\$[0-9,]+'"
HOUSE_ROWS = f"""house1 AS (SELECT *, regexp_matches(coalesce(c3, ''), {MONEY}) AS six,
    contains(lower(concat_ws(' ', nullif(c0, ''), nullif(c1, ''), nullif(c2, ''), nullif(c3, ''), nullif(c4, ''), nullif(c5, ''))), 'asset')
    AND regexp_matches(lower(concat_ws(' ', nullif(c0, ''), nullif(c1, ''), nullif(c2, ''), nullif(c3, ''), nullif(c4, ''), nullif(c5, ''))), 'value|income') AS header,
    trim(regexp_replace(trim(regexp_replace(c0, '^.*⇒\\s*', '')), '^[-–—]+\\s*', '')) AS asset FROM cells_v),
house2 AS (SELECT *, CASE WHEN six THEN c2 ELSE c1 END AS owner, coalesce(CASE WHEN six THEN c3 ELSE c2 END, '') AS value,
    coalesce(CASE WHEN six THEN c4 ELSE c3 END, '') AS income_type, coalesce(CASE WHEN six THEN c5 ELSE c4 END, '') AS income FROM house1),
house3 AS (SELECT *, NOT header AND NOT (asset <> '' AND regexp_matches(asset, '^[0-9]\\. ')) AS body,
    value <> '' AND regexp_matches(value, '^[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2,4}}$') AS dated FROM house2),
house4 AS (SELECT *, body AND NOT dated AND asset <> '' AND regexp_matches(value || income || asset, {MONEY}) AS emit FROM house3),
house5 AS (SELECT *, body AND NOT dated AND asset <> '' AND NOT regexp_matches(value, {MONEY}) AND NOT emit AS more,
    max(CASE WHEN header THEN 1 ELSE 0 END) OVER w = 1 AS in_section,
    sum(CASE WHEN emit OR header THEN 1 ELSE 0 END) OVER w AS entry FROM house4
    WINDOW w AS (PARTITION BY doc_id ORDER BY page, table_no, row_no ROWS UNBOUNDED PRECEDING))"""
FLAGS = f"""{HOUSE_ROWS},
flags AS (SELECT doc_id, page, table_no, row_no, 'date-in-value-skipped' AS category, value AS sample FROM house5 WHERE in_section AND body AND dated
  UNION ALL SELECT doc_id, page, table_no, row_no, 'tx-type-in-income', income FROM house5 WHERE in_section AND body AND NOT dated
    AND income <> '' AND regexp_matches(income, '(?i)^(?:P|S|S\\s*\\(partial\\)|Buy|Sell|Exchange)$')
  UNION ALL SELECT doc_id, page, table_no, row_no, 'empty-asset', value FROM house5 WHERE in_section AND body AND NOT dated
    AND asset = '' AND regexp_matches(value, {MONEY}))"""


@query(f"WITH {FLAGS} SELECT * FROM flags")
def quality_flags(v):
    return st.house_quality_flags(v.house_cells, cell_order())


@query(f"""WITH {FLAGS} SELECT category, count(*) AS n, arg_min(sample, (doc_id, page, table_no, row_no)) AS sample
FROM flags GROUP BY category""")
def quality_summary(v):
    flags = st.house_quality_flags(v.house_cells, cell_order())
    return ql.summarise(flags, ["doc_id", "page", "table_no", "row_no"])


@query("""SELECT t.id, t.comment AS last, r.comment AS roster_last FROM transactions_v t
JOIN transactions_v r ON r.id = t.id + 1 WHERE lower(t.comment) <> lower(r.comment)""")
def id_name_mismatch(v):
    filings = v.transactions.select("id", (F.col("id") + 1).alias("doc_id"), F.col("comment").alias("last"))
    roster = v.transactions.select(F.col("id").alias("doc_id"), F.col("comment").alias("last"))
    return ql.name_mismatches(filings, roster).select("id", "last", "roster_last")


# -- loads -------------------------------------------------------------------

_LOAD_BY = ["order_key", "line_number", "part_key", "supp_key"]


@query("""SELECT row_number() OVER (ORDER BY order_key, line_number, part_key, supp_key) AS id, id AS row_key, chamber, asset, bioguide
FROM holdings_v""")
def load_holdings(v):
    rows = v.holdings.select(
        F.col("id").alias("row_key"), "chamber", "asset", "bioguide", *_LOAD_BY
    )
    block = F.expr("order_key DIV 4096")
    path = work_folder(v.spark, "holdings")
    return tb.rebuild(rows, path, _LOAD_BY, block).select("id", "row_key", "chamber", "asset", "bioguide")


@query("""SELECT id, chamber, CASE WHEN filing_year IN (1996, 1997) THEN amount || ' *' ELSE amount END AS amount, filing_year
FROM transactions_v WHERE NOT (filing_year = 1997 AND id % 2 = 0)""")
def reload_year(v):
    path = work_folder(v.spark, "transactions")
    rows = v.transactions.select("id", "chamber", "amount", "filing_year")
    tb.reload_years(rows, path)
    again = rows.where("filing_year IN (1996, 1997) AND NOT (filing_year = 1997 AND id % 2 = 0)").withColumn(
        "amount", F.concat("amount", F.lit(" *"))
    )
    tb.reload_years(again, path)
    return tb.reload_years(again, path).select("id", "chamber", "amount", "filing_year")


@query("""SELECT chamber, last_name, first_name, state, asset, asset_type, owner, value, income_type, income, source_file,
  CAST(NULL AS VARCHAR) AS bioguide FROM holdings_v""")
def evolve_schema(v):
    old = v.holdings.drop("bioguide", "id")
    return evolve(old, HOLDINGS).drop("id")


@query("""SELECT 'SCOTUS' AS chamber, count(*) AS n FROM holdings_v WHERE chamber = 'SCOTUS' GROUP BY chamber
UNION ALL SELECT chamber, count(*) FROM transactions_v GROUP BY chamber""")
def union_chambers(v):
    a = evolve(v.holdings.drop("id").where("chamber = 'SCOTUS'"), TRANSACTIONS)
    b = evolve(v.transactions, TRANSACTIONS)
    return (
        a.withColumn("part", F.lit(1)).unionByName(b.withColumn("part", F.lit(2)))
        .groupBy("part", "chamber").agg(F.count(F.lit(1)).alias("n")).drop("part")
    )


@query("""SELECT last || ', Hon.. ' || first AS NAME, office AS OFFICE, doc_id AS DOCID FROM filing_index_v WHERE ordinal % 9 <> 0""")
def roster_render(v):
    rows = v.filing_index.withColumn("doc_id", F.when(F.col("ordinal") % 9 != 0, F.col("doc_id")))
    return tb.render_roster(rows, "last", "first", "office", "doc_id").orderBy("NAME")


@query("""SELECT conv_id, string_agg('<!-- page ' || CAST(turn + 1 AS VARCHAR) || ' -->' || chr(10) || coalesce(text, ''),
  chr(10) || chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id""")
def page_concat(v):
    return tb.join_pages(v.conversations, "conv_id", "turn", "text")
