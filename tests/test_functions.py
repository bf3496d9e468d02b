"""Single values: input, expected."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from tallyglass.functions import fold
from tallyglass.functions import names as nm
from tallyglass.functions import text as tx
from tallyglass.functions import values as vl
from tallyglass.operators import structure as st
from tallyglass.sources import documents as dc
from tallyglass.sources import rosters as rs


@pytest.fixture(scope="module")
def apply(spark):
    def run(fn, *values):
        df = spark.createDataFrame([(v,) for v in values], "x string")
        return [
            tuple(r[0]) if hasattr(r[0], "__fields__") else r[0]
            for r in df.select(fn(F.col("x"))).collect()
        ]

    return run


CASES = [
    (vl.normalize_date, {
        "1/5/24": "2024-01-05", "12-31-1999": "1999-12-31", "3/4/51": "1951-03-04", "n/a": "n/a",
        "2024-01-15": "2024-01-15", " on 1/2/2024 ": "2024-01-02", "13/45/2024": "2024-13-45",
    }),
    (tx.ticker, {"Copper Inc (CPR)": "CPR", "Foo [ST]": "ST", "Foo": "", "a (toolong) [X]": "X", "(AB) (CD)": "AB"}),
    (tx.clean_asset, {"LIVTR ⇒ J & J": "J & J", "- Bond": "Bond", "a ⇒ b ⇒ c": "c", "– x": "x"}),
    (nm.strip_credentials, {"MD, FACS, Neal Patrick": "Neal Patrick", "Ann, Ph.D": "Ann Ph.D", "MD": "MD", "Do Re": "Re"}),
    (nm.fold_accents, {"Velázquez": "velazquez", " ﬁne½ ": "fine12", "日本": "", "Ørsted": "rsted"}),
    (vl.value_range, {"P1": "$1,000,001 - $5,000,000", "p4": "Over $50,000,000", "Z": "Z"}),
    (vl.tx_type, {"purchase": "Purchase", "Sale (Full)": "Sale (Full)", "sale (partial)": "Sale (Partial)", "gift": "gift"}),
    (vl.tx_type_judicial, {"Buy": "Purchase", "sold": "Sale (Full)", "redeemed": "Sale (Full)", "gift": "Gift"}),
    (nm.nickname, {"bob": "robert", "robert": None, "mike": "michael", "michael": "mike"}),
    (tx.strip_labels, {"Fund F S: New": "Fund", "S O: Trust": "Trust"}),
    (nm.strip_hon_prefix, {"Hon.. Ann": "Ann", "hon. Bo": "Bo", "A Hon. B": "A Hon. B"}),
    (nm.strip_hon_anywhere, {"A Hon. B": "A B", "The  Honorable C": "C"}),
    (nm.parenthesised_name, {"The Honorable A (Doe, Jane)": "Doe, Jane", "x (a)": ""}),
    (nm.strip_suffix, {"The Honorable Al Bo Jr.": "Al Bo", "Al Bo (Former Senator) x": "Al Bo"}),
    (tx.last_path_segment, {"http://a/b/c/": "c", "c": "c"}),
    (lambda c: nm.split_name(c), {"Doe, Jane Q": ("Doe", "Jane Q"), "Jane Q  Doe": ("Doe", "Jane Q"), "Doe": ("Doe", "")}),
    (lambda c: rs.split_office(c), {"TX05": ("TX", "05"), "x": ("", ""), "AB": ("AB", "")}),
    (lambda c: vl.split_owner(c), {"SP Iron": ("SP", "Iron"), "dep. child X": ("DEP. CHILD", "X"), "Spring": ("DC", "Spring")}),
    (lambda c: vl.eif_split(c), {"Club Yes $1": ("Club", " Yes $1"), "Club": ("Club", "")}),
    (lambda c: vl.parse_values(c), {
        "N/A None (or less than $1,001) DIVIDEND $201  - $1,000": ("None / <$1,001", "Dividend", "$201 - $1,000"),
        "nothing": ("", "", ""),
    }),
    # text, income, income type, value, method, tx type, tx date, tx value, tx gain
    (lambda c: vl.parse_codes(c), {
        "Iron Fund A Dividend K T": ("Iron Fund", "A", "Dividend", "K", "T", "", "", "", ""),
        "Iron Fund Sold 03/04/24 J A": ("Iron Fund", "", "", "", "", "Sold", "03/04/24", "J", "A"),
        "P1 E": ("P1", "E", "", "", "", "", "", "", ""),
        "Buy 03/04/24": ("", "", "", "", "", "Buy", "03/04/24", "", ""),
        "xx Sold 01/02/2024 x b sold 03/04/2024 J": ("xx", "", "", "", "", "Sold", "01/02/2024", "", ""),
        "": ("", "", "", "", "", "", "", "", ""),
    }),
    (lambda c: st.merged_cell(c), {
        "SP Iron Inc S (partial) 01/02/2024 01/10/2024 $1,001 - $15,000":
            ("Iron Inc", "Sale (Partial)", "2024-01-02", "2024-01-10", "$1,001 - $15,000", "SP"),
        "Iron P 01/02/2024 $1,001 -\nmore $15,000 name\nF S: New":
            ("Iron more name", "Purchase", "2024-01-02", "", "$1,001 - $15,000", "DC"),
        "no type here": None,
        "P 01/02/2024": None,
    }),
    (lambda c: dc.heading_filer(c), {
        "The Honorable A B Doe Jr. (Roe, Ann)": ("Roe", "Ann"), "The Honorable A B Doe Jr.": ("Doe", "A B"), "Notes": ("", ""),
    }),
    (lambda c: F.array_join(nm.name_candidates(c), "|"), {"Hon.. M Shontel": "shontel|m|m shontel", "Al": "al", "": ""}),
    (lambda c: F.array_join(nm.alias_keys(c), "|"), {"a b c": "a b c|a|a b|b c|c", "a": "a"}),
]


@pytest.mark.parametrize("fn, pairs", CASES, ids=lambda x: getattr(x, "__name__", ""))
def test_values(apply, fn, pairs):
    assert apply(fn, *pairs) == list(pairs.values())


def test_cleaning(apply):
    assert apply(tx.clean, None, "\t a\x07\r b \x7f\xa0") == ["", "a b \x7f"]
    assert apply(lambda c: tx.clean(c, True), " a\x7f ") == ["a"]


@settings(max_examples=8, deadline=None)
@given(texts=hs.lists(hs.text(max_size=12), min_size=1, max_size=60))
def test_folding_equals_the_unicode_rule(spark, texts):
    import unicodedata

    texts = [t.replace("\x00", "") for t in texts if t.isprintable() or t.isspace()] or [""]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    want = [
        unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode().lower().strip() for t in texts
    ]
    assert [r[0] for r in df.select(fold.fold_accents("x")).collect()] == want


def test_html_tables_survive_messy_markup(spark):
    html = (
        "<table><tr><th>A<th>B</tr><tr><td>1 <b>x</b><td>&amp;</table>"
        "<table><tr><td>only</td></tr></table>"
    )
    rows = dc.html_cells(spark.createDataFrame([(1, html), (2, None)], "doc_id int, html string")).collect()
    assert [(r.table_no, r.row_no, r.is_header, r.cells) for r in rows] == [
        (0, 0, True, ["A", "B"]), (0, 1, False, ["1 x", "&"]), (1, 0, False, ["only"]),
    ]


def test_extraction_replies(spark):
    raws = [
        '```json\n{"has_assets": true, "holdings": [{"asset": "a"}]}\n```',
        'Sure: {"has_assets": true, "holdings": [{"asset": "b", "value": "v"}, {"asset": "c"}]} ok',
        '{"has_assets": false, "holdings": [{"asset": "no"}]}', "garbage", None, '{"has_assets": true, "holdings": [}',
    ]
    df = spark.createDataFrame(list(enumerate(raws)), "page int, raw string")
    got = [(r.page, r.asset, r.value) for r in dc.extracted_holdings(df).collect()]
    assert got == [(0, "a", ""), (1, "b", "v"), (1, "c", "")]


def test_fold_of_few_and_of_many_letters(spark):
    import unicodedata

    many = "".join(map(chr, [*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0x4E00, 0x4E80), 0xFB01, 0x1D400]))
    texts = ["\u00a0Élan ﬁn ½\U0001d400 日本 Œ ", many, "x" + many, "plain", "", "ß" * 5]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", fold.ascii_fold("t").alias("f")).collect()
    assert {r.t: r.f for r in got} == {t: unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode().strip() for t in texts}
