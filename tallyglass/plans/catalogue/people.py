"""Name resolution, aliases, member tables, and keep-one rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import fixed_values as fv
from ...functions import names as nm
from ...operators import aliases as al
from ...operators import dedupe
from ...operators import members as mb
from ...operators import resolve as rv
from ...operators.name_dictionary import NameDictionary
from ...session import settle, work_folder
from . import query

# -- keep-one rules ----------------------------------------------------------


@query("""SELECT ordinal, last, first, doc_id FROM (SELECT *, row_number() OVER (
  PARTITION BY lower(last), substr(lower(first), 1, 3) ORDER BY ordinal) AS rn FROM filing_index_v) q WHERE rn = 1""")
def dedupe_first(v):
    return dedupe.keep_first_filing(v.filing_index).select("ordinal", "last", "first", "doc_id")


_ORIGINAL = """SELECT ordinal, last, first, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY {keys}
  ORDER BY contains(link, 'Amendment'), CASE WHEN contains(link, 'Amendment') THEN ordinal ELSE -ordinal END) AS rn
  FROM filing_index_v) q WHERE rn = 1"""


@query(_ORIGINAL.format(keys="lower(last), lower(first)"))
def dedupe_prefer_original(v):
    return dedupe.prefer_original(
        v.filing_index, ["last", "first"], F.contains("link", F.lit("Amendment"))
    ).select("ordinal", "last", "first", "doc_id")


@query(_ORIGINAL.format(keys="lower(last)"))
def dedupe_prefer_original_last_only(v):
    return dedupe.prefer_original(
        v.filing_index, ["last"], F.contains("link", F.lit("Amendment"))
    ).select("ordinal", "last", "first", "doc_id")


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY event_id DESC) AS rn FROM events) q WHERE rn = 1""")
def upsert_last_wins(v):
    rows = v.events.select("user_id", "event_id", "event_type")
    return dedupe.keep_last(rows, ["user_id"], "event_id")


@query("""SELECT ordinal, last, CASE WHEN ordinal % 50 = 0 AND ordinal % 100 <> 0 THEN 'X' || doc_id ELSE doc_id END AS doc_id
FROM filing_index_v""")
def apply_corrections(v):
    wrong = v.filing_index.where("ordinal % 50 = 0").select(
        F.when(F.col("ordinal") % 100 == 0, "Somebody Else").otherwise(F.upper("last")).alias("last"),
        "doc_id",
        F.concat(F.lit("X"), "doc_id").alias("new_doc_id"),
    )
    return dedupe.apply_corrections(v.filing_index.select("ordinal", "last", "doc_id"), wrong)


_CASES = ", ".join(f"({i}, '{last}', '{first}', '{office}', '{doc}')" for i, (last, first, office, doc) in enumerate(fv.WRONG_DOC_IDS))


def _case_filings(v):
    """Every tenth filer of the index is one of the listed cases; some file for another office, some are listed under the wrong id."""
    case = F.get(F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(c, ("last", "first", "office", "wrong"))]) for c in fv.WRONG_DOC_IDS]), (F.col("user_id") % 40).cast("int"))
    return v.filing_index.select(
        "ordinal", "filing_type", "doc_id", F.coalesce(F.upper(case["last"]), F.col("last")).alias("last"), F.coalesce(F.concat(case["first"], F.lit(" B")), F.col("first")).alias("first"),
        F.when(F.col("event_id") % 2 == 0, case["office"]).otherwise(F.col("office")).alias("office"), F.when(F.col("event_id") % 7 == 0, case["wrong"]).alias("listed"),
    )


@query(f"""WITH c(i, last, first, office, wrong) AS (VALUES {_CASES}),
filed AS (SELECT x.ordinal, x.filing_type, x.doc_id, x.event_id, coalesce(upper(c.last), x.last) AS last, c.i, c.wrong,
  CASE WHEN x.event_id % 2 = 0 AND c.i IS NOT NULL THEN 0 WHEN x.office = c.office THEN 0 ELSE 1 END AS far FROM filing_index_v x LEFT JOIN c ON c.i = x.user_id % 40),
best AS (SELECT i, doc_id AS new_id FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY far, doc_id) AS rn FROM filed
  WHERE i IS NOT NULL AND filing_type IN ('O', 'A', 'OA')) q WHERE rn = 1)
SELECT ordinal, last, CASE WHEN f.event_id % 7 = 0 AND f.i IS NOT NULL THEN coalesce(b.new_id, f.wrong) ELSE f.doc_id END AS doc_id FROM filed f LEFT JOIN best b ON b.i = f.i""")
def correct_doc_ids(v):
    """The listed cases looked up in the bulk index, and the roster with the ids found there."""
    filed = _case_filings(v)
    corrections = dedupe.find_corrections(filed, dedupe.known_cases(v.spark))
    roster = filed.select("ordinal", "last", F.coalesce("listed", "doc_id").alias("doc_id"))
    return dedupe.apply_corrections(roster, corrections)


# -- aliases -----------------------------------------------------------------


@query("""SELECT bioguide, last_name, first_name FROM member_info_v WHERE first_name <> ''
UNION SELECT bioguide, last_name, display_first FROM member_info_v
WHERE display_first <> '' AND lower(display_first) <> lower(first_name)""")
def seed_aliases(v):
    return al.seed_when_empty(al.seed_aliases(v.member_info).limit(0), v.member_info)


@query("""SELECT lower(last_name) AS last_lc, min(bioguide) AS bioguide FROM member_info_v GROUP BY 1 HAVING count(*) = 1""")
def unique_last(v):
    return al.unique_last_names(v.member_info)


_HON_CUT = """CASE WHEN lower(substr(first_name, 1, 4)) = 'hon.'
  THEN trim(substr(first_name, strpos(first_name, ' ') + 1)) ELSE first_name END"""


def _learned(fact: str, aliases: str, out: str) -> str:
    return f"""{out}_names AS (SELECT DISTINCT last_name, {_HON_CUT} AS first_name FROM {fact}
  WHERE first_name <> '' AND lower(chamber) IN ('senate', 'house')),
{out} AS (SELECT DISTINCT mi.bioguide, n.last_name, n.first_name FROM {out}_names n
  JOIN member_info_v mi ON lower(mi.last_name) = lower(n.last_name)
  JOIN (SELECT lower(last_name) AS l FROM member_info_v GROUP BY 1 HAVING count(*) = 1) u ON u.l = lower(n.last_name)
  WHERE NOT EXISTS (SELECT 1 FROM {aliases} na WHERE na.bioguide = mi.bioguide
    AND (lower(na.first_name) = lower(n.first_name) OR lower(n.first_name) LIKE lower(na.first_name) || ' %'
      OR lower(n.first_name) LIKE '% ' || lower(na.first_name))))"""


def _fixed(fact: str, aliases: str, out: str) -> str:
    return f"""{out}_names AS (SELECT DISTINCT last_name, first_name,
    trim(regexp_replace(trim(first_name), '(?i)^hon\\.\\.?\\s+', '')) AS s
  FROM {fact} WHERE bioguide IS NULL AND chamber IN ('House', 'Senate')),
{out}_tries AS (SELECT last_name, first_name, 1 AS pos, lower(regexp_extract(s, '(\\S+)$', 1)) AS c FROM {out}_names WHERE s <> ''
  UNION ALL SELECT last_name, first_name, 2, lower(regexp_extract(s, '^(\\S+)', 1)) FROM {out}_names WHERE s <> ''
  UNION ALL SELECT last_name, first_name, 3, lower(s) FROM {out}_names WHERE s <> ''),
{out}_hits AS (SELECT t.last_name, t.first_name, t.pos, min(na.bioguide) AS found FROM {out}_tries t
  JOIN {aliases} na ON lower(na.last_name) = lower(t.last_name) AND lower(na.first_name) = t.c GROUP BY 1, 2, 3),
{out}_best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY last_name, first_name ORDER BY pos) rn
  FROM {out}_hits) q WHERE rn = 1),
{out} AS (SELECT f.*, CASE WHEN f.bioguide IS NULL AND f.chamber IN ('House', 'Senate') THEN b.found ELSE f.bioguide END AS key
  FROM {fact} f LEFT JOIN {out}_best b ON f.last_name = b.last_name AND f.first_name = b.first_name)"""


@query(f"WITH {_learned('holdings_v', 'name_aliases_v', 'la')} SELECT bioguide, last_name, first_name FROM la")
def learn_aliases(v):
    return al.learn_aliases(v.holdings, v.member_info, v.name_aliases)


@query(f"WITH {_fixed('holdings_v', 'name_aliases_v', 'fx')} SELECT id, key AS bioguide FROM fx")
def fix_null_keys(v):
    return al.fix_null_keys(v.holdings, v.name_aliases).select("id", "bioguide")


@query(f"""WITH {_learned('holdings_v', 'name_aliases_v', 'la')},
known1 AS (SELECT bioguide, last_name, first_name FROM name_aliases_v UNION SELECT * FROM la),
{_fixed('holdings_v', 'known1', 'fh')},
{_learned('transactions_v', 'known1', 'lt')},
known2 AS (SELECT * FROM known1 UNION SELECT * FROM lt),
{_fixed('transactions_v', 'known2', 'ft')}
SELECT 'holding' AS kind, id, key AS bioguide FROM fh UNION ALL
SELECT 'transaction', CAST(id AS VARCHAR), key FROM ft UNION ALL
SELECT 'alias', last_name || '/' || first_name, bioguide FROM known2""")
def repair_pipeline(v):
    h, t, a = al.repair(v.holdings, v.transactions, v.member_info, v.name_aliases)
    return (
        h.select(F.lit("holding").alias("kind"), "id", "bioguide")
        .unionByName(t.select(F.lit("transaction").alias("kind"), F.col("id").cast("string").alias("id"), "bioguide"))
        .unionByName(
            a.select(F.lit("alias").alias("kind"), F.concat_ws("/", "last_name", "first_name").alias("id"), "bioguide")
        )
    )


@query(f"""WITH n AS (SELECT DISTINCT last_name, first_name, lower({_HON_CUT}) AS f FROM holdings_v),
hit AS (SELECT n.last_name, n.first_name, min(na.bioguide) AS bioguide FROM n JOIN name_aliases_v na
  ON lower(na.last_name) = lower(n.last_name) AND (lower(na.first_name) = n.f OR n.f LIKE lower(na.first_name) || ' %'
  OR n.f LIKE '% ' || lower(na.first_name)) GROUP BY 1, 2)
SELECT n.last_name, n.first_name, h.bioguide, mi.party AS matched_party,
  coalesce(mi.display_first, mi.first_name) AS matched_display_first
FROM n LEFT JOIN hit h ON n.last_name = h.last_name AND n.first_name = h.first_name
LEFT JOIN member_info_v mi ON h.bioguide = mi.bioguide""")
def alias_lookup_top1(v):
    names = v.holdings.select("last_name", "first_name").distinct()
    return al.first_covering_alias(names, v.name_aliases, v.member_info).select(
        "last_name", "first_name", "bioguide", "matched_party", "matched_display_first"
    )


@query("""SELECT DISTINCT 'filed' AS kind, last_name, first_name, chamber AS extra FROM holdings_v
WHERE chamber = 'House' AND (lower(last_name) LIKE 'last1%' OR lower(last_name) LIKE 'un%q7%')
UNION ALL SELECT 'alias', na.last_name, na.first_name, mi.party FROM name_aliases_v na
JOIN member_info_v mi ON mi.bioguide = na.bioguide
WHERE lower(na.last_name) LIKE '%last1%' OR lower(na.last_name) LIKE '%un%q7%'""")
def suspect_names(v):
    filed, listed = al.suspect_names(v.holdings, v.name_aliases, v.member_info, ["Last1", "Un'q7"])
    return filed.select(F.lit("filed").alias("kind"), "last_name", "first_name", F.col("chamber").alias("extra")).unionByName(
        listed.select(F.lit("alias").alias("kind"), "last_name", "first_name", F.col("party").alias("extra"))
    )


_SUSPECTS = "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in fv.SUSPECT_LAST_NAMES) + "]"


def _like_suspect(c: str, before: str) -> str:
    return "(" + " OR ".join(f"lower({c}) LIKE '{before}{x.lower().replace(chr(39), '%')}%'" for x in fv.SUSPECT_LAST_NAMES) + ")"


@query(f"""WITH h AS (SELECT chamber, first_name, coalesce({_SUSPECTS}[order_key % 60 + 1] || CASE WHEN line_number = 1 THEN ' Jr.' ELSE '' END, last_name) AS last_name FROM holdings_v),
a AS (SELECT bioguide, first_name, coalesce('De ' || {_SUSPECTS}[CAST(substr(bioguide, 2) AS BIGINT) % 60 + 1], last_name) AS last_name FROM name_aliases_v)
SELECT DISTINCT 'filed' AS kind, last_name, first_name, chamber AS extra FROM h WHERE chamber = 'House' AND {_like_suspect('last_name', '')}
UNION ALL SELECT 'alias', a.last_name, a.first_name, mi.party FROM a JOIN member_info_v mi ON mi.bioguide = a.bioguide WHERE {_like_suspect('a.last_name', '%')}""")
def suspect_filings(v):
    """The listed last names among the filings of the House and the aliases; a third of both bear one of them."""
    names = F.array(*map(F.lit, fv.SUSPECT_LAST_NAMES))
    own = F.get(names, (F.col("order_key") % 60).cast("int"))
    filed = v.holdings.withColumn("last_name", F.coalesce(F.concat(own, F.when(F.col("line_number") == 1, " Jr.").otherwise("")), "last_name"))
    given = F.get(names, (F.substring("bioguide", 2, 99).cast("long") % 60).cast("int"))
    aliases = v.name_aliases.withColumn("last_name", F.coalesce(F.concat(F.lit("De "), given), "last_name"))
    filings, listed = al.suspect_names(filed, aliases, v.member_info)
    return filings.select(F.lit("filed").alias("kind"), "last_name", "first_name", F.col("chamber").alias("extra")).unionByName(
        listed.select(F.lit("alias").alias("kind"), "last_name", "first_name", F.col("party").alias("extra"))
    )


# -- resolver ----------------------------------------------------------------

_NICK = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in fv.NICKNAMES.items())


def _expand(x: str) -> str:
    return f"CASE {x} {_NICK} END"


_FIRST = "lower(strip_accents(first_name))"
_SHOWN = "lower(strip_accents(display_first))"
# One row per (member, first-name form).
_FORMS = f"""forms AS (SELECT lower(last_name) AS last, bioguide, min_year, max_year, c_custkey AS seq, {_FIRST} AS form FROM member_info_v
  UNION SELECT lower(last_name), bioguide, min_year, max_year, c_custkey, {_expand(_FIRST)} FROM member_info_v)"""


def _asked(v):
    f, k = F.col("first_name"), F.col("id") % 7
    first = (
        F.when(k == 0, F.concat(F.lit("Zed "), f))
        .when(k == 1, F.concat(F.upper(f), F.lit(" Q, MD")))
        .when(k == 2, F.lit("Xavier"))
        .otherwise(f)
    )
    year = F.when(F.col("id") % 11 == 0, 1950).otherwise(F.col("filing_year"))
    last = F.when(F.col("id") % 13 == 0, F.concat("last_name", F.lit(", MD"))).otherwise(F.col("last_name"))
    return v.transactions.select("id", last.alias("last_name"), first.alias("first_name"), year.alias("year"))


_ASKED = """asked AS (SELECT id, lower(last_name) AS last, lower(strip_accents(
  regexp_replace(CASE id % 7 WHEN 0 THEN 'Zed ' || first_name WHEN 1 THEN upper(first_name) || ' Q' WHEN 2 THEN 'Xavier'
  ELSE first_name END, '(?i)^hon\\.\\.?\\s+', ''))) AS f,
  CASE WHEN id % 11 = 0 THEN 1950 ELSE filing_year END AS year FROM transactions_v)"""
# 'Zed Hon. Ted' keeps its inner honorific: only a leading one is dropped.
_CANDS = f"""{_FORMS}, {_ASKED},
entries AS (SELECT DISTINCT last, bioguide, min_year, max_year, seq FROM forms),
ask AS (SELECT DISTINCT last, f, year FROM asked),
pairs AS (SELECT a.last, a.f, a.year, e.bioguide, e.min_year, e.max_year, e.seq,
    e.min_year <= a.year + 1 AND e.max_year >= a.year - 1 AS ok FROM ask a JOIN entries e ON a.last = e.last),
flagged AS (SELECT *, max(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY last, f, year) AS anyok FROM pairs),
kept AS (SELECT *, count(*) OVER (PARTITION BY last, f, year) AS n FROM flagged WHERE ok OR anyok = 0)"""


_RESOLVED = f"""WITH {_CANDS},
tries AS (SELECT last, f, year, 1 AS tier, f AS key FROM ask
  UNION ALL SELECT last, f, year, 2, split_part(f, ' ', 1) FROM ask WHERE f LIKE '% %'
  UNION ALL SELECT last, f, year, 3, regexp_extract(f, '(\\S+)$', 1) FROM ask WHERE f LIKE '% %'
  UNION ALL SELECT last, f, year, 4, {_expand('f')} FROM ask),
scored AS (SELECT k.last, k.f, k.year, k.bioguide, k.max_year, k.seq, t.tier FROM kept k
  JOIN tries t ON k.last = t.last AND k.f = t.f AND k.year = t.year
  JOIN forms fo ON fo.bioguide = k.bioguide AND fo.form = t.key
  UNION ALL SELECT last, f, year, bioguide, max_year, seq, 5 FROM kept WHERE n = 1),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY last, f, year ORDER BY tier, max_year DESC, seq) AS rn
  FROM scored) q WHERE rn = 1)
SELECT a.id, b.bioguide, b.tier FROM asked a LEFT JOIN best b ON a.last = b.last AND a.f = b.f AND a.year = b.year"""


@query(_RESOLVED)
def resolve_names(v):
    return rv.resolve_names(_asked(v), settle(v.name_index, "index")).select("id", "bioguide", "tier")


@query(_RESOLVED)
def resolve_again(v):
    """Through the dictionary: two thirds of the names come first, then all, of which the rest is resolved."""
    index, names = settle(v.name_index, "index"), _asked(v)
    known = NameDictionary(v.spark, work_folder(v.spark, "names"), buckets=16)
    known.learn(names.where("id % 3 <> 0"), index, "last_name", "first_name", "year")
    return known.resolve(names, index).select("id", "bioguide", "tier")


@query(f"""WITH {_CANDS} SELECT last, year, max(CASE WHEN ok THEN n END) AS n_overlap, count(DISTINCT bioguide) AS n_kept,
  CASE WHEN count(DISTINCT bioguide) = 1 THEN min(seq) END AS only_seq
FROM kept GROUP BY last, year""")
def interval_join(v):
    points = v.transactions.select(
        F.lower("last_name").alias("last"),
        F.when(F.col("id") % 11 == 0, 1950).otherwise(F.col("filing_year")).alias("year"),
    ).distinct()
    return rv.overlap_counts(v.name_index, points).select(
        "last", "year", F.when(F.col("n_ok") > 0, F.col("n_ok")).alias("n_overlap"),
        F.col("n").alias("n_kept"), "only_seq",
    )


_DATED = "c_custkey % 6 <> 0"
_BOUNDS = f"""CASE WHEN {_DATED} THEN min_year ELSE 1789 END AS min_year,
  CASE WHEN {_DATED} THEN max_year WHEN is_current = 0 THEN 1900 ELSE 2099 END AS max_year"""


@query(f"SELECT bioguide, {_BOUNDS} FROM member_info_v")
def term_bounds(v):
    return rv.term_bounds(v.roster).select("id.bioguide", "min_year", "max_year")


_VARIANTS = f"""(SELECT string_agg(f, ',' ORDER BY f) FROM (SELECT DISTINCT unnest([{_FIRST}, {_SHOWN}, {_expand(_FIRST)},
  {_expand(_SHOWN)}]) AS f) q WHERE f IS NOT NULL)"""


@query(f"SELECT bioguide, {_VARIANTS} AS firsts FROM member_info_v")
def first_variants(v):
    n = "name."
    return v.roster.select(
        "id.bioguide",
        F.array_join(
            rv.first_variants(F.col(n + "first"), F.col(n + "nickname"), F.col(n + "official_full")), ","
        ).alias("firsts"),
    )


_PEOPLE = ", ".join(
    f"('{last}', '{key}', '{','.join(sorted(firsts))}', {lo}, {hi}, {4 * 10**15 + i})"
    for i, (key, last, firsts, lo, hi) in enumerate(fv.PRINCIPAL_INDEX)
)


@query(f"""SELECT lower(last_name) AS last, bioguide, {_VARIANTS} AS firsts, {_BOUNDS},
  c_custkey + CASE WHEN is_current = 0 THEN 0 ELSE 1000000000000000 END AS seq FROM member_info_v
UNION ALL SELECT * FROM (VALUES {_PEOPLE}) p""")
def name_index(v):
    return rv.name_index(v.roster).withColumn("firsts", F.array_join("firsts", ","))


_MANUAL = "CASE c_custkey % 97 WHEN 5 THEN 'luna' WHEN 6 THEN 'watson coleman' WHEN 7 THEN 'justice' ELSE lower(last_name) END"


@query(f"""WITH i AS (SELECT {_MANUAL} AS last, bioguide, c_custkey AS seq FROM member_info_v)
SELECT last, bioguide, seq FROM i
UNION ALL SELECT 'paulina luna', bioguide, seq + 2000000000000000 FROM i WHERE last = 'luna'
UNION ALL SELECT 'coleman', bioguide, seq + 2000000000000000 FROM i WHERE last = 'watson coleman'
UNION ALL SELECT 'justice ii', bioguide, seq + 2000000000000000 FROM i WHERE last = 'justice'
UNION ALL SELECT last, bioguide, seq FROM (VALUES {_PEOPLE}) p(last, bioguide, f, a, b, seq)""")
def manual_aliases(v):
    k = F.col("seq") % 97
    index = v.name_index.withColumns(
        {
            "last": F.when(k == 5, "luna").when(k == 6, "watson coleman").when(k == 7, "justice").otherwise(F.col("last")),
            "is_historical": F.lit(True),
        }
    )
    return rv.with_manual_entries(index).select("last", "bioguide", "seq")


@query("""SELECT id, CASE id % 3 WHEN 0 THEN 'EXEC_TRUMP' WHEN 1 THEN 'D000671_SYN' END AS bioguide,
  CASE id % 3 WHEN 0 THEN CASE id % 2 WHEN 0 THEN 1 ELSE 2 END WHEN 1 THEN CASE id % 2 WHEN 0 THEN 1 ELSE 5 END END AS tier
FROM transactions_v""")
def principals(v):
    k, odd = F.col("id") % 3, F.col("id") % 2 == 1
    asked = v.transactions.select(
        "id",
        F.when(k == 0, "TRUMP").when(k == 1, "Delaney").otherwise("Nobody").alias("last_name"),
        F.when(k == 0, F.when(odd, "Donald Zed").otherwise("Donald J."))
        .when(k == 1, F.when(odd, "Zoe").otherwise("Hon.. April McClain")).otherwise("X").alias("first_name"),
        (F.col("filing_year") + 20).alias("year"),
    )
    index = settle(
        rv.with_manual_entries(v.name_index.withColumn("is_historical", F.lit(True))), "index"
    )
    return rv.resolve_names(asked, index).select("id", "bioguide", "tier")


# -- member tables -----------------------------------------------------------


@query("""SELECT bioguide, last_name, first_name, state, '01' AS district, party FROM member_info_v""")
def latest_term(v):
    twice = v.roster.unionByName(
        v.roster.where("seq % 5 = 1").withColumns(
            {"is_historical": F.lit(True), "terms": F.slice("terms", 1, 1)}
        )
    )
    return mb.latest_term(twice).select("bioguide", "last_name", "first_name", "state", "district", "party")


_PEOPLE_INFO = ", ".join(
    f"('{k}', '{last}', '{firsts[0]}', '{shown}', '', '{party}', {now})"
    for k, last, firsts, shown, party, now in fv.PRINCIPALS
)


@query(f"""SELECT bioguide, last_name, first_name, display_first, state, party, is_current FROM member_info_v
UNION ALL SELECT * FROM (VALUES {_PEOPLE_INFO}) p""")
def member_dim(v):
    return mb.member_info(v.roster)


_ALIAS_NICK = " ".join(
    f"WHEN '{a}' THEN '{b}'" for a, b in fv.NICKNAMES.items() if a not in fv.NICKNAMES_NOT_FOR_ALIASES
)
_PEOPLE_ALIASES = ", ".join(
    f"('{k}', '{last}', '{f}')" for k, last, firsts, *_ in fv.PRINCIPALS for f in firsts
)


@query(f"""WITH w AS (SELECT bioguide, last_name, strip_accents(first_name) AS f FROM member_info_v
  UNION SELECT bioguide, last_name, strip_accents(display_first) FROM member_info_v),
x AS (SELECT DISTINCT bioguide, last_name, CASE lower(f) {_ALIAS_NICK} END AS e FROM w)
SELECT bioguide, last_name, f AS first_name FROM w
UNION SELECT bioguide, last_name, upper(substr(e, 1, 1)) || substr(e, 2) FROM x WHERE e IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM w WHERE w.bioguide = x.bioguide AND lower(w.f) = x.e)
UNION SELECT * FROM (VALUES {_PEOPLE_ALIASES}) p""")
def alias_render(v):
    return mb.name_aliases(v.roster)


@query("SELECT thomas_id, name, chamber, parent_id FROM committees_v")
def committee_flatten(v):
    # A region has a fixed handful of nations, so the nested documents stay small.
    subs = v.nation.groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(
        F.collect_list(
            F.struct(
                F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("thomas_id"),
                F.col("n_name").alias("name"),
            )
        ).alias("subcommittees")
    )
    docs = v.region.join(subs, "r_regionkey", "left").select(
        F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("thomas_id"),
        F.col("r_name").alias("name"), F.lit("house").alias("type"), "subcommittees",
    )
    return mb.committees(docs)


@query("""SELECT thomas_id, CASE WHEN rank % 4 = 0 THEN '' ELSE bioguide END AS bioguide,
  CASE WHEN rank % 4 = 0 THEN 'Name' ELSE last_name END AS last_name,
  CASE WHEN rank % 4 = 0 THEN 'Written Q' ELSE first_name END AS first_name,
  CASE WHEN rank % 4 = 0 THEN '' ELSE state END AS state, CASE WHEN rank % 4 = 0 THEN '' ELSE '01' END AS district,
  party, rank, title FROM committee_members_v""")
def membership_flatten(v):
    person = F.struct(
        F.when(F.col("rank") % 4 != 0, F.col("bioguide")).alias("bioguide"),
        F.lit("Written Q Name").alias("name"), "party", "rank", "title",
    )
    docs = v.committee_members.select(
        F.create_map("thomas_id", F.array(person)).alias("assignments")
    ).unionByName(
        v.committee_members.where("rank = 1").select(
            F.create_map("thomas_id", F.lit(None).cast(
                "array<struct<bioguide:string,name:string,party:string,rank:int,title:string>>"
            )).alias("assignments")
        )
    )
    return mb.committee_members(docs, mb.latest_term(v.roster))


_JUSTICES = ", ".join(f"('{last}', '{first}')" for last, first in fv.JUSTICES)


@query(f"""WITH j(last, first) AS (VALUES {_JUSTICES})
SELECT j.last, j.first, count(*) AS n_holdings FROM holdings_v h JOIN j
  ON j.last = CASE h.supp_key % 4 WHEN 0 THEN 'Kagan' WHEN 1 THEN 'Alito' WHEN 2 THEN 'Jackson' ELSE 'Nobody' END
WHERE h.chamber = 'SCOTUS' GROUP BY 1, 2""")
def literal_dims(v):
    dim = v.spark.createDataFrame(fv.JUSTICES, "last string, first string")
    k = F.col("supp_key") % 4
    filers = v.holdings.where("chamber = 'SCOTUS'").select(
        F.when(k == 0, "Kagan").when(k == 1, "Alito").when(k == 2, "Jackson").otherwise("Nobody").alias("last")
    )
    return (
        filers.groupBy("last").agg(F.count(F.lit(1)).alias("n_holdings"))
        .join(F.broadcast(dim), "last")  # nine rows
        .select("last", "first", "n_holdings")
    )
