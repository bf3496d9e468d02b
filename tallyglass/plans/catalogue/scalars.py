"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import fixed_values as fv
from ...functions import names as nm
from ...functions import text as tx
from ...functions import values as vl
from ...sources import rosters as rs
from . import query

WS = tx.STRIP_CLASS


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


# Holdings names and documents with some dirt added, the same on both sides.
_DIRTY = "chr(9) || coalesce(asset, '') || chr(7) || ' ' || owner || chr(127) || chr(160)"


@query(f"""SELECT id, {_strip(f"regexp_replace({_DIRTY}, '[\\x00-\\x08\\x0b-\\x1f]', '', 'g')")} AS v1,
  {_strip(f"regexp_replace({_DIRTY}, '[\\x00-\\x08\\x0b-\\x1f\\x7f]', '', 'g')")} AS v2 FROM holdings_v""")
def clean_text(v):
    dirty = F.concat(
        F.lit("\t"), F.coalesce("asset", F.lit("")), F.lit("\x07 "), F.col("owner"), F.lit("\x7f\xa0")
    )
    return v.holdings.select("id", tx.clean(dirty).alias("v1"), tx.clean(dirty, True).alias("v2"))


_HON = "CASE WHEN line_number = 1 THEN 'The  Honorable ' || first_name WHEN line_number = 6 THEN first_name || ' Hon. X' ELSE first_name END"


def _hon(v):
    f = F.col("first_name")
    return v.holdings.withColumn(
        "f",
        F.when(F.col("line_number") == 1, F.concat(F.lit("The  Honorable "), f))
        .when(F.col("line_number") == 6, F.concat(f, F.lit(" Hon. X")))
        .otherwise(f),
    )


@query(f"SELECT id, {_strip(f'''regexp_replace({_HON}, '(?i)\\b(?:the\\s+honorable|hon\\.\\.?)\\s*', '', 'g')''')} AS f FROM holdings_v")
def strip_hon_any(v):
    return _hon(v).select("id", nm.strip_hon_anywhere("f").alias("f"))


@query(f"SELECT id, trim(regexp_replace(trim({_HON}), '(?i)^hon\\.\\.?\\s+', '')) AS f FROM holdings_v")
def strip_hon_prefix(v):
    return _hon(v).select("id", nm.strip_hon_prefix("f").alias("f"))


@query("""SELECT id, CASE WHEN lower(substr(first_name, 1, 4)) = 'hon.'
  THEN trim(substr(first_name, strpos(first_name, ' ') + 1)) ELSE first_name END AS f FROM holdings_v""")
def strip_hon_sql(v):
    return v.holdings.select("id", nm.strip_hon_first_word("first_name").alias("f"))


_CRED = "|".join(fv.CREDENTIALS)
_CREDITED = """CASE c_custkey % 5 WHEN 0 THEN 'MD, FACS, ' || first_name WHEN 1 THEN first_name || ' Lee, Ph.D., JD.'
  WHEN 2 THEN 'MD' WHEN 3 THEN 'Do' || first_name ELSE first_name || ' Esq.' END"""


@query(f"""WITH t AS (SELECT bioguide, {_CREDITED} AS s FROM member_info_v),
w AS (SELECT bioguide, s, array_to_string(list_transform(list_filter(regexp_split_to_array(s, '[,\\s]+'), lambda x: x <> ''),
  lambda x: regexp_replace(x, '\\.+$', '')), ' ') AS j FROM t),
k AS (SELECT bioguide, s, regexp_replace(regexp_replace(j, '(?i)^((?:{_CRED})(?: |$))+', ''),
  '(?i)((?:^| )(?:{_CRED}))+$', '') AS r FROM w)
SELECT bioguide, CASE WHEN r = '' THEN s ELSE r END AS f FROM k""")
def strip_creds(v):
    f, k = F.col("first_name"), F.col("c_custkey") % 5
    s = (
        F.when(k == 0, F.concat(F.lit("MD, FACS, "), f))
        .when(k == 1, F.concat(f, F.lit(" Lee, Ph.D., JD.")))
        .when(k == 2, "MD")
        .when(k == 3, F.concat(F.lit("Do"), f))
        .otherwise(F.concat(f, F.lit(" Esq.")))
    )
    return v.member_info.select("bioguide", nm.strip_credentials(s).alias("f"))


@query("""SELECT doc_id, trim(regexp_replace(lower(strip_accents(text)), '[^\\x00-\\x7F]', '', 'g'), chr(32) || chr(10)) AS w FROM documents""")
def norm_name(v):
    return v.documents.select("doc_id", nm.fold_accents("text").alias("w"))


@query("""WITH t AS (SELECT id, CASE WHEN supp_key % 2 = 0 THEN last_name || ', Hon.. ' || first_name || ' B'
  ELSE 'The Honorable ' || trim(first_name || ' Q') || '  ' || last_name END AS s FROM holdings_v),
h AS (SELECT id, trim(regexp_replace(s, '(?i)\\b(?:the\\s+honorable|hon\\.\\.?)\\s*', '', 'g')) AS s FROM t)
SELECT id, CASE WHEN contains(s, ',') THEN trim(split_part(s, ',', 1)) ELSE regexp_extract(s, '(\\S+)$', 1) END AS last,
  CASE WHEN contains(s, ',') THEN trim(regexp_extract(s, '^[^,]*,(.*)$', 1))
  ELSE regexp_replace(trim(regexp_extract(s, '^(.*)\\s\\S+$', 1)), '\\s+', ' ', 'g') END AS first FROM h""")
def split_name(v):
    f, last = F.col("first_name"), F.col("last_name")
    s = F.when(
        F.col("supp_key") % 2 == 0, F.concat(last, F.lit(", Hon.. "), f, F.lit(" B"))
    ).otherwise(F.concat(F.lit("The Honorable "), F.trim(F.concat(f, F.lit(" Q"))), F.lit("  "), last))
    n = nm.split_name(s)
    return v.holdings.select("id", n["last"].alias("last"), n["first"].alias("first"))


@query("""WITH t AS (SELECT id, trim(regexp_replace(trim(first_name), '(?i)^hon\\.\\.?\\s+', '')) AS s FROM holdings_v),
c AS (SELECT id, CASE WHEN s = '' THEN '' ELSE lower(regexp_extract(s, '(\\S+)$', 1)) END AS a,
  CASE WHEN s = '' THEN '' ELSE lower(regexp_extract(s, '^(\\S+)', 1)) END AS b, lower(s) AS w FROM t)
SELECT id, a || CASE WHEN b <> a THEN '|' || b ELSE '' END ||
  CASE WHEN w <> a AND w <> b THEN '|' || w ELSE '' END AS tries FROM c""")
def name_words(v):
    return v.holdings.select(
        # every other name has a no-break space where the view has a blank
        "id",
        F.array_join(
            F.transform(
                nm.name_candidates(F.when(F.col("supp_key") % 2 == 0, F.translate("first_name", " ", "\u00a0")).otherwise(F.col("first_name"))),
                lambda x: F.translate(x, "\u00a0", " "),
            ), "|",
        ).alias("tries")
    )


_HEADING = """CASE k % 4 WHEN 0 THEN 'The Honorable ' || f || ' ' || l || ' Jr.' WHEN 1 THEN
  'The Honorable ' || f || ' ' || l || ' (Former Senator) of state' WHEN 2 THEN f || ' ' || l || ' iii (Member)'
  ELSE 'Hon (' || l || ', ' || f || ' Q.)' END"""
_HEADINGS = f"heads AS (SELECT bioguide, {_HEADING} AS s FROM (SELECT bioguide, c_custkey AS k, first_name AS f, last_name AS l FROM member_info_v) q)"


def _headings(v):
    f, last, k = F.col("first_name"), F.col("last_name"), F.col("c_custkey") % 4
    s = (
        F.when(k == 0, F.concat(F.lit("The Honorable "), f, F.lit(" "), last, F.lit(" Jr.")))
        .when(k == 1, F.concat(F.lit("The Honorable "), f, F.lit(" "), last, F.lit(" (Former Senator) of state")))
        .when(k == 2, F.concat(f, F.lit(" "), last, F.lit(" iii (Member)")))
        .otherwise(F.concat(F.lit("Hon ("), last, F.lit(", "), f, F.lit(" Q.)")))
    )
    return v.member_info.select("bioguide", s.alias("s"))


@query(f"""WITH {_HEADINGS} SELECT bioguide, trim(regexp_replace(trim(regexp_replace(trim(regexp_replace(s,
  '(?i)the\\s+honorable\\s*', '', 'g')), '(?i)\\s+(jr|sr|ii|iii|iv)\\.?$', '')),
  '(?i)\\s*\\((?:Former\\s+)?(?:Senator|Representative|Congressman|Member)\\s*\\).*$', '')) AS name FROM heads""")
def strip_suffix(v):
    return _headings(v).select("bioguide", nm.strip_suffix("s").alias("name"))


@query(f"WITH {_HEADINGS} SELECT bioguide, regexp_extract(s, '\\(([A-Za-z][^,)]{{1,30}},\\s*[A-Za-z][^)]{{1,30}})\\)', 1) AS name FROM heads")
def paren_name(v):
    return _headings(v).select("bioguide", nm.parenthesised_name("s").alias("name"))


_NICK = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in fv.NICKNAMES.items())


@query(f"SELECT id, lower(first_name) AS f, CASE lower(first_name) {_NICK} END AS other FROM holdings_v")
def nickname(v):
    f = F.lower("first_name")
    return v.holdings.select("id", f.alias("f"), nm.nickname(f).alias("other"))


@query("""SELECT bioguide, CASE WHEN c_custkey % 3 = 0 THEN display_first
  WHEN c_custkey % 3 = 1 AND lower(display_first) <> lower(first_name) THEN display_first
  ELSE first_name END AS shown FROM member_info_v""")
def display_first(v):
    k = F.col("c_custkey") % 3
    return v.member_info.select(
        "bioguide",
        nm.display_first(
            F.col("first_name"),
            F.when(k == 0, F.col("display_first")).otherwise(""),
            F.when(k == 1, F.concat_ws(" ", "display_first", "last_name")).otherwise(""),
        ).alias("shown"),
    )


_ARROWED = "CASE WHEN supp_key % 3 = 0 THEN 'A ⇒ B ⇒ ' || asset WHEN supp_key % 3 = 1 THEN '–— ' || asset ELSE asset END"


@query(f"""SELECT id, trim(regexp_replace(trim(regexp_replace({_ARROWED}, '^.*⇒\\s*', '')), '^[-–—]+\\s*', '')) AS asset
FROM holdings_v""")
def clean_asset(v):
    a, k = F.col("asset"), F.col("supp_key") % 3
    s = F.when(k == 0, F.concat(F.lit("A ⇒ B ⇒ "), a)).when(k == 1, F.concat(F.lit("–— "), a)).otherwise(a)
    return v.holdings.select("id", tx.clean_asset(s).alias("asset"))


@query("""SELECT doc_id, row_no, sub, sub2, trim(regexp_replace(trim(regexp_replace(c0, '\\s*F\\s+S\\s*:.*$', '')),
  '^S\\s+O\\s*:\\s*', '')) AS asset, regexp_matches(c0, '(?i)^F\\s+S\\s*:') AS label_row FROM ptr_cells_v""")
def strip_labels(v):
    return v.ptr_cells.select(
        "doc_id", "row_no", "sub", "sub2", tx.strip_labels("c0").alias("asset"),
        tx.is_label_row("c0").alias("label_row"),
    )


@query("SELECT doc_id, p, t, u, trim(regexp_replace(trim(line || ' (K) '), '\\s*\\([A-Z]\\)\\s*$', '')) AS line FROM judicial_lines_v")
def strip_marker(v):
    return v.judicial_lines.select(
        "doc_id", "p", "t", "u", tx.strip_class_marker(F.concat("line", F.lit(" (K) "))).alias("line")
    )


_TICK = "CASE WHEN supp_key % 2 = 0 THEN asset ELSE replace(replace(asset, '(', '['), ')', ']') END"


@query(f"""SELECT id, coalesce(CASE WHEN regexp_extract({_TICK}, '\\(([A-Z]{{1,5}})\\)', 1) <> ''
  THEN regexp_extract({_TICK}, '\\(([A-Z]{{1,5}})\\)', 1)
  ELSE regexp_extract({_TICK}, '\\[([A-Z]{{1,5}})\\]', 1) END, '') AS ticker FROM holdings_v""")
def ticker(v):
    a = F.col("asset")
    s = F.when(F.col("supp_key") % 2 == 0, a).otherwise(F.translate(a, "()", "[]"))
    return v.holdings.select("id", tx.ticker(s).alias("ticker"))


@query("""SELECT ordinal, regexp_extract(link, '/search/view/(?:annual|ptr)/([0-9a-f-]+)/', 1) AS uuid,
  'x' AS tail FROM filing_index_v""")
def link_id(v):
    return v.filing_index.select(
        "ordinal", tx.report_uuid("link").alias("uuid"),
        tx.last_path_segment(F.lit("http://a/b/x//")).alias("tail"),
    )


@query("SELECT page_id, regexp_extract(regexp_replace(url, '/+$', ''), '([^/]*)$', 1) AS segment FROM pages")
def link_tail(v):
    return v.pages.select("page_id", tx.last_path_segment("url").alias("segment"))


@query(f"SELECT page_id, {_strip('''regexp_replace(html, '<[^>]+>', '', 'g')''')} AS text FROM pages")
def strip_tags(v):
    return v.pages.select("page_id", tx.strip_tags("html").alias("text"))


@query("""SELECT doc_id, regexp_replace(text, '\\s+', ' ', 'g') AS once, regexp_replace(text, '\\s{2,}', ' ', 'g') AS twice
FROM documents""")
def ws_collapse(v):
    return v.documents.select(
        "doc_id", tx.collapse_spaces("text").alias("once"), tx.collapse_spaces("text", 2).alias("twice")
    )


_MERGED = "CASE supp_key % 5 WHEN 4 THEN 'Dep. Child' ELSE owner END || ' ' || coalesce(asset, 'x')"


@query(f"""SELECT id, CASE owner WHEN 'SP' THEN 'spouse' WHEN 'JT' THEN 'joint' WHEN 'DC' THEN 'dependent child' ELSE 'self' END AS label,
  CASE WHEN supp_key % 5 = 4 THEN 'DEP. CHILD' WHEN owner = '' THEN 'DC' ELSE owner END AS owner,
  trim(coalesce(asset, 'x')) AS rest FROM holdings_v""")
def owner_code(v):
    merged = F.concat(
        F.when(F.col("supp_key") % 5 == 4, "Dep. Child").otherwise(F.col("owner")),
        F.lit(" "), F.coalesce("asset", F.lit("x")),
    )
    s = vl.split_owner(merged)
    return v.holdings.select(
        "id", vl.owner_label("owner").alias("label"), s["owner"].alias("owner"), s["rest"].alias("rest")
    )


@query("SELECT id, transaction_date AS iso, strftime(CAST(transaction_date AS DATE), '%Y%m%d') AS typed FROM transactions_v")
def norm_date(v):
    iso = vl.normalize_date(F.concat(F.lit(" on "), F.col("raw_date"), F.lit(" or so ")))
    return v.transactions.select(
        "id", iso.alias("iso"), F.date_format(vl.to_date(iso), "yyyyMMdd").alias("typed")
    )


@query("""SELECT DISTINCT filing_year, '01/01/' || CAST(filing_year + 1 AS VARCHAR) || ' 00:00:00' AS window_start,
  '12/31/' || CAST(filing_year + 1 AS VARCHAR) || ' 23:59:59' AS window_end FROM transactions_v""")
def submit_window(v):
    w = vl.submission_window("filing_year")
    return v.transactions.select(
        "filing_year", w["start"].alias("window_start"), w["end"].alias("window_end")
    ).distinct()


@query("""SELECT id, CASE WHEN supp_key % 7 = 0 THEN 'Z' WHEN supp_key % 7 = 1 THEN 'Over $50,000,000'
  ELSE value END AS value FROM holdings_v""")
def value_range(v):
    k = F.col("supp_key") % 7
    code = F.when(k == 0, "Z").when(k == 1, "p4").otherwise(F.col("value_code"))
    return v.holdings.select("id", vl.value_range(code).alias("value"))


@query("""SELECT id, CAST(CASE WHEN supp_key % 7 = 1 THEN '50000000' WHEN supp_key % 7 IN (2, 3) THEN '0' WHEN supp_key % 7 = 4 THEN '5000' ELSE replace(regexp_extract(value, '\\$([0-9,]+)', 1), ',', '') END
  AS DECIMAL(18,2)) AS lo, CASE WHEN supp_key % 7 = 1 THEN NULL WHEN supp_key % 7 IN (2, 3) THEN CAST('1001' AS DECIMAL(18,2))
  WHEN supp_key % 7 = 4 THEN CAST('5000' AS DECIMAL(18,2)) WHEN value LIKE 'Over%' THEN NULL ELSE
  CAST(replace(regexp_extract(value, '- \\$([0-9,]+)', 1), ',', '') AS DECIMAL(18,2)) END AS hi FROM holdings_v""")
def range_bounds(v):
    k = F.col("supp_key") % 7
    text = F.when(k == 1, "Over $50,000,000").when(k == 2, "None / <$1,001").when(k == 3, "None (or less than $1,001)")
    b = vl.range_bounds(text.when(k == 4, "$5,000").otherwise(F.col("value")))
    return v.holdings.select("id", b["lo"].alias("lo"), b["hi"].alias("hi"))


@query("""SELECT id, CASE id % 5 WHEN 0 THEN 'Purchase' WHEN 1 THEN 'Exchange' WHEN 2 THEN 'gift' ELSE transaction_type END
  AS transaction_type FROM transactions_v""")
def tx_type(v):
    k = F.col("id") % 5
    s = (
        F.when(k == 0, "a PURCHASE ").when(k == 1, "exchange").when(k == 2, "gift")
        .otherwise(F.lower("transaction_type"))
    )
    return v.transactions.select("id", vl.tx_type(s).alias("transaction_type"))


@query("""SELECT id, CASE id % 6 WHEN 0 THEN 'Purchase' WHEN 1 THEN 'Sale (Full)' WHEN 2 THEN 'Sale (Full)' WHEN 3 THEN 'Exchange'
  WHEN 4 THEN CASE WHEN id % 12 = 4 THEN 'Gift' ELSE 'Gift (In-Kind)' END ELSE 'Purchase' END AS transaction_type FROM transactions_v""")
def tx_type_judicial(v):
    words = F.array(*[F.lit(w) for w in ("Buy", "SOLD", "redeemed", "exchange", "gift", "purchase")])
    word = F.when(F.col("id") % 12 == 10, "gift (in-kind)").otherwise(F.get(words, (F.col("id") % 6).cast("int")))
    return v.transactions.select("id", vl.tx_type_judicial(word).alias("transaction_type"))


_EXEC = "FROM executive_lines_v"
_MONEY = "(?i)(None\\s*\\(or less than[^)]+\\)|\\$[0-9,]+(?:\\s*(?:to|-)\\s*\\$?[0-9,]+(?:\\.[0-9]+)?)?)"


def _amount(i: int) -> str:
    raw = f"regexp_extract_all(line, '{_MONEY}', 1)[{i}]"
    return (
        f"CASE WHEN {raw} IS NULL THEN '' WHEN lower({raw}) LIKE 'none%' THEN 'None / <$1,001' "
        f"ELSE regexp_replace(trim({raw}), '\\s+', ' ', 'g') END"
    )


_INC = "regexp_extract(line, '(?i)\\b(DIVIDEND|INTEREST|RENT|ROYALT\\w+|OTHER)\\b', 1)"


@query(f"""SELECT doc_id, p, t, u, {_amount(1)} AS value, upper(substr({_INC}, 1, 1)) || lower(substr({_INC}, 2)) AS income_type,
  {_amount(2)} AS income {_EXEC}""")
def parse_values(v):
    return v.executive_lines.select("doc_id", "p", "t", "u", vl.parse_values("line").alias("x")).select(
        "doc_id", "p", "t", "u", "x.*"
    )


_EIF = "(?i)^(.*?)(\\s+(?:Yes|No|N/A)\\s+.*)$"


@query(f"""SELECT doc_id, p, t, u, CASE WHEN regexp_matches(line, '{_EIF}') THEN trim(regexp_extract(line, '{_EIF}', 1)) ELSE line END
  AS description, regexp_extract(line, '{_EIF}', 2) AS values_text {_EXEC}""")
def eif_split(v):
    return v.executive_lines.select("doc_id", "p", "t", "u", vl.eif_split("line").alias("x")).select(
        "doc_id", "p", "t", "u", "x.*"
    )


# What each kind of judiciary line must peel to, stated kind by kind.
_KIND = "CAST(l_quantity AS INT) % 10"


def _by_kind(**by: str) -> str:
    cases = " ".join(f"WHEN {k[1:]} THEN {x}" for k, x in by.items())
    return f"CASE {_KIND} {cases} ELSE '' END"


_N, _S = "CAST(l_linenumber AS VARCHAR)", "CAST(l_suppkey AS VARCHAR)"


@query(f"""SELECT 'J' || CAST(l_partkey AS VARCHAR) AS doc_id, l_orderkey AS p, CAST(l_linenumber AS BIGINT) AS t, l_suppkey AS u,
  CASE {_KIND} WHEN 0 THEN CASE WHEN l_suppkey % 2 = 0 THEN 'VII. Investments and Trusts' ELSE 'VIII. Notes' END
    WHEN 1 THEN {_N} || '. Fund ' || {_S} || ' (X)' WHEN 2 THEN {_N} || '. (add''l)' WHEN 3 THEN {_N} || '. Bond ' || {_S}
    WHEN 4 THEN 'series ' || {_S} WHEN 5 THEN 'class' WHEN 6 THEN '1. Income Gain Codes: A=$1,000 or less'
    WHEN 7 THEN 'Page 3 of 9' WHEN 8 THEN {_N} || '. Trust ' || {_S} ELSE {_N} || '.' END AS text,
  {_by_kind(k1="'A'", k5="'B'")} AS income_code, {_by_kind(k1="'Dividend'", k5="'Interest'")} AS income_type,
  {_by_kind(k1="'K'", k2="'J'", k5="'L'")} AS value_code, {_by_kind(k1="'T'", k2="'T'", k5="'U'")} AS method_code,
  {_by_kind(k3="'Sold'", k9="'Buy'")} AS tx_type, {_by_kind(k3="'03/04/24'", k9="'12/31/2023'")} AS tx_date,
  {_by_kind(k3="'J'", k9="'P1'")} AS tx_value, {_by_kind(k3="'A'", k9="'E'")} AS tx_gain FROM lineitem""")
def parse_codes(v):
    return v.judicial_lines.select("doc_id", "p", "t", "u", vl.parse_codes("line").alias("x")).select(
        "doc_id", "p", "t", "u", "x.*"
    )


@query("""SELECT ordinal, office, regexp_extract(office, '^([A-Z]{2})', 1) AS state, regexp_extract(office, '[0-9]+') AS district
FROM filing_index_v""")
def office_split(v):
    o = rs.split_office("office")
    return v.filing_index.select("ordinal", "office", o["state"].alias("state"), o["district"].alias("district"))
