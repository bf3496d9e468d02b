"""Search predicates, enrichment joins, sorting, paging and the example questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import fixed_values as fv
from ...functions import names as nm
from ...functions import text as tx
from ...functions import values as vl
from ...operators import dedupe, joins
from ...operators import paging as deep
from ...operators.paging import SortKey
from ...operators.text_index import TextIndex, write_clustered
from ...session import work_folder
from ...sources import rosters as rs
from ...sources import tables as tb
from .. import analytics as an
from .. import search as se
from . import query
from .views import Views

_LEGEND = "NOT regexp_matches(h.asset, '^[1-9]\\. ')"
_JOIN = "FROM holdings_v h LEFT JOIN member_info_v mi ON h.bioguide = mi.bioguide"
_JOIN_TX = "FROM transactions_v t LEFT JOIN member_info_v mi ON t.bioguide = mi.bioguide"
_STATE = "coalesce(nullif(trim(h.state), ''), mi.state)"
_STATE_TX = "coalesce(nullif(trim(t.state), ''), mi.state)"


def _joined(v: Views):
    return se.with_member(v.holdings, v.member_info)


# -- predicates --------------------------------------------------------------


@query("SELECT id, asset FROM holdings_v WHERE lower(asset) LIKE '%ring brand_1%'")
def like_ci(v):
    return v.holdings.where(tx.matches("asset", "RING brand_1")).select("id", "asset")


_ANY4 = """(h.last_name ILIKE '{p}' OR h.first_name ILIKE '{p}' OR (h.last_name || ', ' || h.first_name) ILIKE '{p}'
  OR (coalesce(mi.last_name, h.last_name) || ', ' || coalesce(mi.display_first, h.first_name)) ILIKE '{p}')"""
_ANY3 = """(h.last_name ILIKE '{p}' OR h.first_name ILIKE '{p}'
  OR (h.last_name || ', ' || h.first_name) ILIKE '{p}')"""


@query(f"SELECT h.id, h.last_name, h.first_name, mi.display_first {_JOIN} WHERE {_ANY4.format(p='%last5, ted%')}")
def search_member(v):
    return _joined(v).where(se.member_is("last5, ted", canonical=True)).select(
        "id", "last_name", "first_name", F.col("mi_display").alias("display_first")
    )


@query(f"SELECT h.id, h.last_name, h.first_name FROM holdings_v h WHERE {_ANY3.format(p='%uniq9%')}")
def export_member(v):
    return v.holdings.where(se.member_is("uniq9", canonical=False)).select(
        "id", "last_name", "first_name"
    )


@query("SELECT id, asset, asset_type FROM holdings_v WHERE asset ILIKE '%eco%' OR asset_type ILIKE '%eco%'")
def search_asset(v):
    return v.holdings.where(se.any_column_has("eco", "asset", "asset_type")).select(
        "id", "asset", "asset_type"
    )


@query("SELECT id, asset, asset_type FROM holdings_v WHERE asset ILIKE '%ring brand_1%' OR asset_type ILIKE '%ring brand_1%'")
def search_asset_indexed(v):
    """As search_asset over a stored table: only files that can hold the words are opened."""
    root = work_folder(v.spark, "indexed")
    write_clustered(v.holdings.select("id", "asset", "asset_type"), f"{root}/table", "asset", 32)
    index = TextIndex(v.spark, f"{root}/table", f"{root}/index", {"asset": "asset", "asset_type": "asset_type"})
    index.refresh()
    return index.search("ring BRAND_1", "asset", "asset_type")


@query("""SELECT id, asset_type FROM holdings_v
WHERE asset_type ILIKE '%prom%' OR asset_type ILIKE '%stand%' OR asset_type IS NULL OR trim(asset_type) = ''""")
def facet_multi(v):
    return v.holdings.where(se.facet("asset_type", "prom| stand |__none__|")).select("id", "asset_type")


@query("SELECT id, chamber FROM holdings_v WHERE chamber = 'Senate'")
def facet_chamber(v):
    return v.holdings.where(F.col("chamber") == "Senate").select("id", "chamber")


_JUSTICES = " ".join(f"WHEN '{k}' THEN '{p}'" for k, p in fv.JUSTICE_PARTY.items())
# A filer list in which some rows carry the last name of a justice.
_FILERS = """filers AS (SELECT id, chamber, bioguide, CASE WHEN chamber = 'SCOTUS' THEN
  CASE supp_key % 4 WHEN 0 THEN 'Kagan' WHEN 1 THEN 'ALITO' WHEN 2 THEN 'Jackson' ELSE last_name END
  ELSE last_name END AS last_name FROM holdings_v)"""


@query(f"""WITH {_FILERS} SELECT h.id, h.last_name, mi.party
FROM filers h LEFT JOIN member_info_v mi ON h.bioguide = mi.bioguide
WHERE mi.party ILIKE '%republic%' OR (h.chamber = 'SCOTUS' AND
  CASE lower(h.last_name) {_JUSTICES} ELSE NULL END ILIKE '%republic%')""")
def facet_party(v):
    named = (
        F.when(F.col("supp_key") % 4 == 0, "Kagan").when(F.col("supp_key") % 4 == 1, "ALITO")
        .when(F.col("supp_key") % 4 == 2, "Jackson").otherwise(F.col("last_name"))
    )
    filers = v.holdings.withColumn(
        "last_name", F.when(F.col("chamber") == "SCOTUS", named).otherwise(F.col("last_name"))
    )
    return se.with_member(filers, v.member_info).where(se.party_is("republic")).select(
        "id", "last_name", F.col("mi_party").alias("party")
    )


@query(f"SELECT h.id, h.state {_JOIN} WHERE h.state = 'N05' OR (nullif(trim(h.state), '') IS NULL AND mi.state = 'N05')")
def facet_state(v):
    return _joined(v).where(se.state_is("N05")).select("id", "state")


@query(f"SELECT t.id, {_STATE_TX} AS state {_JOIN_TX} WHERE {_STATE_TX} = 'N05'")
def facet_state_tx(v):
    return (
        se.with_member(v.transactions, v.member_info)
        .where(se.effective_state() == "N05")
        .select("id", se.effective_state().alias("state"))
    )


@query("""SELECT id, transaction_date FROM transactions_v
WHERE transaction_date >= '1996-03-01' AND transaction_date <= '1997-08-31'""")
def date_range(v):
    return v.transactions.where(
        (F.col("transaction_date") >= "1996-03-01") & (F.col("transaction_date") <= "1997-08-31")
    ).select("id", "transaction_date")


@query(f"SELECT h.id, h.asset FROM holdings_v h WHERE {_LEGEND}")
def legend_filter(v):
    return v.holdings.where(se.not_legend()).select("id", "asset")


@query("SELECT doc_id, page, table_no, row_no, c0 FROM cells_v WHERE regexp_matches(c0, '^[0-9]\\. ')")
def legend_parse(v):
    return v.cells.where(F.col("c0").rlike(r"^\d\. ")).select("doc_id", "page", "table_no", "row_no", "c0")


@query(f"""SELECT h.id, {_STATE} AS state, mi.party, coalesce(mi.display_first, h.first_name) AS display_first {_JOIN}""")
def enrich_project(v):
    return _joined(v).select("id", *se._member_out())


@query("""SELECT ordinal, filing_type, filing_type IN ('O', 'A', 'OA') OR lower(filing_type) LIKE '%annual%' AS annual,
  filing_type = 'O' AS original, filing_type = 'P' AS ptr FROM filing_index_v""")
def filing_type(v):
    return v.filing_index.select(
        "ordinal", "filing_type", rs.is_annual("filing_type").alias("annual"),
        (F.trim("filing_type") == "O").alias("original"), rs.is_ptr("filing_type").alias("ptr"),
    )


@query("SELECT ordinal, filer FROM filing_index_v WHERE filer LIKE '%Senator%' OR filer LIKE '%Sen.%'")
def office_pred(v):
    return v.filing_index.where(rs.is_senator("filer")).select("ordinal", "filer")


@query("SELECT bioguide, first_name, last_name FROM member_info_v WHERE bioguide IN ('M000000000003', 'M000000000042')")
def roster_lookup(v):
    return v.roster.where(F.col("id.bioguide").isin("M000000000003", "M000000000042")).select(
        "id.bioguide", F.col("name.first").alias("first_name"), F.col("name.last").alias("last_name")
    )


@query("""WITH x AS (SELECT chamber, owner, count(*) AS n FROM holdings_v WHERE asset LIKE '%ring%' GROUP BY chamber, owner)
SELECT chamber, owner, n FROM x WHERE n > 1""")
def sql_explorer(v):
    v.holdings.createOrReplaceTempView("tallyglass_holdings")
    return se.run_select(
        v.spark,
        "WITH x AS (SELECT chamber, owner, count(*) AS n FROM tallyglass_holdings "
        "WHERE asset LIKE :word GROUP BY chamber, owner) SELECT chamber, owner, n FROM x WHERE n > 1;",
        {"word": "%ring%"},
    )


# -- joins -------------------------------------------------------------------


@query(f"SELECT h.id, h.bioguide, mi.party {_JOIN}")
def enrich_party(v):
    return _joined(v).select("id", "bioguide", F.col("mi_party").alias("party"))


@query("""WITH seats AS (SELECT lower(cm.last_name) l, lower(cm.first_name) f, count(*) AS seats
  FROM committee_members_v cm JOIN committees_v c ON cm.thomas_id = c.thomas_id
  WHERE c.name LIKE '%A%' AND c.parent_id IS NULL GROUP BY 1, 2)
SELECT h.id, h.last_name, h.first_name, s.seats FROM holdings_v h
JOIN seats s ON lower(h.last_name) = s.l AND lower(h.first_name) = s.f""")
def committee_holdings(v):
    return an.committee_holdings_by_name(v.holdings, v.committee_members, v.committees, "a").select(
        "id", "last_name", "first_name", "seats"
    )


@query("""SELECT h.id, h.bioguide, count(*) AS seats FROM holdings_v h
JOIN committee_members_v cm ON cm.bioguide = h.bioguide JOIN committees_v c ON cm.thomas_id = c.thomas_id
WHERE c.name ILIKE '%nation_1%' GROUP BY h.id, h.bioguide""")
def committee_holdings_key(v):
    return an.committee_holdings(
        v.holdings, v.committee_members, v.committees, "nation_1", full_only=False
    ).select("id", "bioguide", "seats")


@query("""SELECT l.l_orderkey || '-' || l.l_linenumber || '-' || l.l_partkey AS doc,
  coalesce(s.s_name, 'Unknown') AS last, '' AS first, coalesce(CAST(s.s_nationkey AS VARCHAR), '') AS state
FROM lineitem l LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 3 = 0) s ON l.l_suppkey = s.s_suppkey""")
def lookup_default(v):
    roster = v.supplier.where("s_suppkey % 3 = 0").select(
        F.col("s_suppkey").alias("doc_id"), F.col("s_name").alias("last"), F.lit("").alias("first"),
        F.col("s_nationkey").cast("string").alias("state"),
    )
    filings = v.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("doc"),
        F.col("l_suppkey").alias("doc_id"),
    )
    return rs.with_lookup_default(filings, roster).select("doc", "last", "first", "state")


@query("""SELECT ordinal, doc_id FROM filing_index_v f WHERE NOT EXISTS
  (SELECT 1 FROM orders o WHERE 'D' || CAST(o.o_orderkey AS VARCHAR) = f.doc_id AND o.o_orderstatus = 'F')""")
def new_members(v):
    old = v.orders.where("o_orderstatus = 'F'").select(
        F.concat(F.lit("D"), F.col("o_orderkey").cast("string")).alias("doc_id")
    )
    return dedupe.new_rows(v.filing_index, old, "doc_id").select("ordinal", "doc_id")


@query("""SELECT m.bioguide, CASE WHEN EXISTS (SELECT 1 FROM transactions_v t WHERE t.bioguide = m.bioguide
  AND t.filing_year >= 2000) THEN 1 ELSE 0 END AS is_current FROM member_info_v m""")
def is_current(v):
    recent = v.transactions.where("filing_year >= 2000 AND bioguide IS NOT NULL")
    return dedupe.is_current(v.member_info.select("bioguide"), recent)


# -- sorting and paging ------------------------------------------------------

_OUT = f"""h.id, h.chamber, h.last_name, h.first_name, h.asset, h.asset_type, h.owner, h.value, h.income_type, h.income,
  {_STATE} AS state, mi.party, coalesce(mi.display_first, h.first_name) AS display_first"""


@query(f"SELECT {_OUT} {_JOIN} WHERE {_LEGEND} ORDER BY h.asset DESC NULLS LAST, h.id LIMIT 100")
def sort_whitelist(v):
    return se.search_holdings(v.holdings, v.member_info, sort_col="asset", sort_dir="desc", limit=100).rows


@query(f"""SELECT {_OUT} {_JOIN} WHERE {_LEGEND}
ORDER BY h.chamber NULLS FIRST, h.last_name NULLS FIRST, h.first_name NULLS FIRST, h.id LIMIT 200 OFFSET 300""")
def paginate(v):
    return se.search_holdings(v.holdings, v.member_info, sort_col="no_such", limit=200, offset=300).rows


@query(f"""SELECT {_OUT} {_JOIN} WHERE {_LEGEND}
ORDER BY h.chamber NULLS FIRST, h.last_name NULLS FIRST, h.first_name NULLS FIRST, h.id LIMIT 200 OFFSET 300""")
def next_page(v):
    """The page behind the last row of the first 300, found by that row's id."""
    shown = se.search_holdings(v.holdings, v.member_info, limit=300).rows.select("id").collect()
    return se.search_holdings(v.holdings, v.member_info, limit=200, after_id=shown[-1].id).rows


_OWN = "h.id, h.chamber, h.last_name, h.first_name, h.asset, h.value"


@query(f"""SELECT {_OWN} FROM holdings_v h
ORDER BY h.value DESC NULLS LAST, h.asset NULLS FIRST, h.id LIMIT 500 OFFSET 3000""")
def deep_page(v):
    keys = [SortKey("value", descending=True), SortKey("asset"), SortKey("id")]
    found = deep.deep_page(v.holdings, keys, limit=500, offset=3000)
    return found.select("id", "chamber", "last_name", "first_name", "asset", "value")


_MEMBERS = f"""SELECT coalesce(mi.last_name, h.last_name) AS last_name,
  coalesce(mi.display_first, h.first_name) AS first_name, h.chamber, {_STATE} AS state, mi.party,
  min(h.last_name) AS raw_last {_JOIN}"""


@query(f"""SELECT last_name, first_name, chamber, state, party FROM ({_MEMBERS}
WHERE h.last_name ILIKE '%last1%' OR h.first_name ILIKE '%last1%' GROUP BY 1, 2, 3, 4, 5)
ORDER BY raw_last NULLS FIRST, last_name NULLS FIRST, first_name NULLS FIRST, chamber NULLS FIRST,
  state NULLS FIRST, party NULLS FIRST LIMIT 600""")
def members_browse(v):
    return se.browse_members(v.holdings, v.member_info, q="last1", limit=600)


@query(f"""SELECT DISTINCT last_name, first_name, chamber, state, party FROM ({_MEMBERS}
WHERE (h.state = 'N07' OR (nullif(trim(h.state), '') IS NULL AND mi.state = 'N07')) AND mi.party ILIKE '%demo%'
GROUP BY 1, 2, 3, 4, 5)""")
def members_distinct(v):
    return se.browse_members(v.holdings, v.member_info, state="N07", party="demo")


# -- whole endpoints ---------------------------------------------------------

_FULL = f"""{_JOIN} WHERE {_LEGEND} AND (h.asset ILIKE '%ring%' OR h.asset_type ILIKE '%ring%')
AND (mi.party ILIKE '%republican%' OR (h.chamber = 'SCOTUS' AND CASE lower(h.last_name) {_JUSTICES} ELSE NULL END
  ILIKE '%republican%'))
AND (h.state = 'N05' OR (nullif(trim(h.state), '') IS NULL AND mi.state = 'N05'))"""
_FULL_ARGS = {"asset": "ring", "party": "Republican", "state": "N05"}


@query(f"""SELECT {_OUT} {_FULL}
ORDER BY h.chamber NULLS FIRST, h.last_name NULLS FIRST, h.first_name NULLS FIRST, h.id LIMIT 500""")
def search_full(v):
    return se.search_holdings(v.holdings, v.member_info, **_FULL_ARGS).rows


@query(f"SELECT count(*) AS total {_FULL}")
def search_full_total(v):
    return se.search_holdings(v.holdings, v.member_info, **_FULL_ARGS).total


_EXPORT = ["chamber", "last_name", "first_name", "state", "asset", "asset_type", "owner", "value", "income_type", "income"]


@query(f"""SELECT {', '.join(f"coalesce({c}, '') AS {c}" for c in _EXPORT)}
FROM holdings_v h WHERE {_LEGEND} AND {_ANY3.format(p='%last2%')} AND chamber = 'House' AND state = ' '
AND (asset_type ILIKE '%eco%' OR asset_type IS NULL OR trim(asset_type) = '')""")
def export_rows(v):
    """Written as CSV and read back: header, quotes and blanks included."""
    found = se.export_holdings(
        v.holdings, member="last2", chamber="House", state=" ", asset_type="eco|__none__"
    )
    path = work_folder(v.spark, "export")
    tb.write_csv(found, path)
    return tb.read_csv(v.spark, path, _EXPORT)


@query(f"""SELECT t.id, t.chamber, t.last_name, t.first_name, t.transaction_date, t.disclosure_date, t.asset,
  t.asset_type, t.transaction_type, t.amount, t.ticker, t.comment, {_STATE_TX} AS state, mi.party,
  coalesce(mi.display_first, t.first_name) AS display_first {_JOIN_TX}
WHERE (t.asset ILIKE '%urg%' OR t.ticker ILIKE '%urg%') AND t.transaction_type ILIKE '%sale%'
AND (t.asset_type ILIKE '%sto%' OR t.asset_type IS NULL OR trim(t.asset_type) = '')
AND t.transaction_date >= '1996-01-01' AND t.transaction_date <= '1999-12-31' AND mi.party ILIKE '%dem%'
ORDER BY t.transaction_date DESC NULLS LAST, t.last_name NULLS FIRST, t.id LIMIT 500""")
def tx_full(v):
    return se.search_transactions(
        v.transactions, v.member_info, asset="urg", tx_type="sale", asset_type="sto|__none__",
        date_from="1996-01-01", date_to="1999-12-31", party="dem",
    ).rows


@query("SELECT DISTINCT asset_type FROM holdings_v WHERE asset_type <> ''")
def asset_types(v):
    return se.asset_types(v.holdings)


# -- example questions -------------------------------------------------------

_LO = "CAST(replace(regexp_extract(value, '\\$([0-9,]+)', 1), ',', '') AS DECIMAL(18,2))"


def _words(col: str, words: list[str]) -> str:
    return "regexp_matches(" + col + ", '(?i)(?:" + "|".join(words) + ")')"


_CO = ["ring", "bolt", "widget"]
_H = "FROM holdings_v h WHERE " + _LEGEND


@query(f"SELECT h.id, h.last_name, h.asset, h.value {_H} AND h.chamber = 'House' AND {_words('h.asset', ['ring', 'hex'])}")
def ex_sector_chamber(v):
    return an.mentioning(v.holdings, ["ring", "hex"], "House").select("id", "last_name", "asset", "value")


@query(f"""SELECT last_name, first_name, count(*) AS n_holdings {_H} AND h.chamber = 'Senate'
  AND asset_type ILIKE '%standard%'
GROUP BY ALL ORDER BY n_holdings DESC, last_name NULLS FIRST, first_name NULLS FIRST LIMIT 20""")
def ex_top_senators(v):
    return an.top_filers(v.holdings, "Senate", "standard")


@query("""SELECT h.id, h.asset, count(*) AS seats FROM holdings_v h JOIN committee_members_v cm ON cm.bioguide = h.bioguide
JOIN committees_v c ON cm.thomas_id = c.thomas_id WHERE c.name ILIKE '%asia%' AND c.parent_id IS NULL
GROUP BY h.id, h.asset""")
def ex_committee(v):
    return an.committee_holdings(v.holdings, v.committee_members, v.committees, "asia").select(
        "id", "asset", "seats"
    )


@query("""SELECT id, last_name, asset, transaction_type, transaction_date FROM transactions_v
WHERE (asset ILIKE '%high%' OR ticker ILIKE '%high%') AND transaction_date BETWEEN '1997-01-01' AND '1998-12-31'""")
def ex_issuer_trades(v):
    return an.trades_of(v.transactions, "high", "1997-01-01", "1998-12-31").select(
        "id", "last_name", "asset", "transaction_type", "transaction_date"
    )


_TAGGED = """tagged AS (SELECT id, last_name, chamber, CASE supp_key % 9 WHEN 0 THEN 'Exxon Mobil' WHEN 1 THEN 'apple inc'
 WHEN 2 THEN 'Meta Platforms' WHEN 3 THEN 'BOEING co' WHEN 4 THEN 'Shell plc' ELSE asset END AS asset FROM holdings_v)"""


def _tagged(v: Views):
    names = ["Exxon Mobil", "apple inc", "Meta Platforms", "BOEING co", "Shell plc"]
    pick = F.col("asset")
    for i, n in enumerate(names):
        pick = F.when(F.col("supp_key") % 9 == i, n).otherwise(pick)
    return v.holdings.withColumn("asset", pick)


def _has_sector(name: str) -> str:
    return _words("asset", fv.SECTORS[name])


@query(f"WITH {_TAGGED} SELECT id, last_name, asset FROM tagged h WHERE {_LEGEND} AND {_has_sector('energy')}")
def ex_energy(v):
    return an.sector_holdings(_tagged(v), "energy").select("id", "last_name", "asset")


@query(f"WITH {_TAGGED} SELECT id, last_name, asset FROM tagged h WHERE {_LEGEND} AND {_has_sector('defense')}")
def ex_defense(v):
    return an.sector_holdings(_tagged(v), "defense").select("id", "last_name", "asset")


@query(f"SELECT h.id, h.first_name, h.asset, h.value {_H} AND lower(h.last_name) = 'last7'")
def ex_one_member(v):
    return an.holdings_of(v.holdings, "Last7").select("id", "first_name", "asset", "value")


_COMMITTEE_SECTOR = """WITH {t} SELECT h.id, h.asset, count(*) AS seats FROM (SELECT t.*, b.bioguide FROM tagged t
  JOIN (SELECT id, bioguide FROM holdings_v) b USING (id)) h JOIN committee_members_v cm ON cm.bioguide = h.bioguide
JOIN committees_v c ON cm.thomas_id = c.thomas_id WHERE c.name ILIKE '%{c}%' {full} AND {legend} AND {words}
GROUP BY h.id, h.asset"""


@query(_COMMITTEE_SECTOR.format(t=_TAGGED, c="america", full="AND c.parent_id IS NULL", legend=_LEGEND, words=_has_sector("defense")))
def ex_committee_defense(v):
    held = an.sector_holdings(_tagged(v), "defense")
    return an.committee_holdings(held, v.committee_members, v.committees, "america").select("id", "asset", "seats")


@query(_COMMITTEE_SECTOR.format(t=_TAGGED, c="nation_2", full="", legend=_LEGEND, words=_has_sector("tech")))
def ex_committee_tech(v):
    held = an.sector_holdings(_tagged(v), "tech")
    return an.committee_holdings(held, v.committee_members, v.committees, "nation_2", full_only=False).select(
        "id", "asset", "seats"
    )


@query(f"""SELECT h.id, h.last_name, h.asset, h.value, {_LO} AS lo {_H} AND h.chamber = 'Senate'
ORDER BY lo DESC, h.id LIMIT 50""")
def ex_largest(v):
    return an.largest(v.holdings, "Senate").select("id", "last_name", "asset", "value", "lo")


@query("""SELECT last_name, first_name, chamber, count(*) AS n_trades, min(transaction_date) AS first_trade
FROM transactions_v WHERE filing_year = 1997 AND regexp_matches(asset, '(?i)(?:urgent|low)') GROUP BY ALL""")
def ex_traders_in_year(v):
    return an.traders_in(v.transactions, ["urgent", "low"], 1997)


@query(f"SELECT h.id, h.last_name, h.asset, h.value {_H} AND h.chamber = 'SCOTUS'")
def ex_whole_chamber(v):
    return an.whole_chamber(v.holdings, "SCOTUS").select("id", "last_name", "asset", "value")


@query(f"""WITH {_TAGGED} SELECT id, asset, concat_ws(',', {', '.join(
    f"CASE WHEN {_words('asset', w)} THEN '{n}' END" for n, w in fv.SECTORS.items())}) AS sectors FROM tagged""")
def sector_tag(v):
    return _tagged(v).select("id", "asset", vl.sector("asset").alias("sectors"))
