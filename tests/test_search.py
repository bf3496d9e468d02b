"""Search, browsing, aliases and key repair on a small invented congress."""

import pytest
from pyspark.sql import functions as F

from tallyglass.operators import aliases as al
from tallyglass.plans import search as se
from tallyglass.schema import HOLDINGS, MEMBER_INFO, NAME_ALIASES, TRANSACTIONS

MEMBERS = [
    ("P1", "Penrose", "Roger", "Roger", "OR", "Democrat", 1),
    ("Q2", "Quill", "Frederick", "Fred", "ME", "Republican", 1),
    ("R3", "Rourke", "Salvador", "Sal", "NM", "Republican", 1),
    ("T4", "Tate", "Addison", "Mitch", "IA", "Republican", 1),
    ("U5", "Underhill", "Lena", "Lena", "VT", "Democrat", 1),
    ("V6", "Vance-Ott", "Oscar", "Oscar", "GA", "Republican", 1),
    ("W7", "Wynn", "Clara", "Clara", "NV", "Democrat", 0),
]
# id, chamber, last, first, state, asset, asset_type, key
HELD = [
    (1, "Senate", "Penrose", "Roger", "OR", "Copper Trust", "Stock", "P1"),
    (2, "Senate", "QUILL", "FREDERICK", "", "Zinc Corp", "Stock", "Q2"),
    (3, "Senate", "Rourke", "Sal", " ", "Tin Works", "Stock", "R3"),
    (4, "Senate", "Tate", "Mitch", None, "Lead Fund", "Mutual Fund", "T4"),
    (5, "House", "Underhill", "Hon.. Lena Jo", "", "Iron Inc", "", "U5"),
    (6, "House", "Vance-Ott", "J. Oscar", "", "Salt 100% Co", None, "V6"),
    (7, "Senate", "Wynn", "Clara", "NV", "Index Fund", "Mutual Fund", "W7"),
    (8, "Senate", "Rourke", "Salvador", "", "Nickel Ltd", "Stock", "R3"),
    (9, "SCOTUS", "Kagan", "Elena", "", "Land", "Real Estate", None),
    (10, "SCOTUS", "Kagan", "Elena", "", "1. Income Gain Codes", "", None),
    (11, "SCOTUS", "Kagan", "Elena", "", None, "", None),
]
TRADED = [
    (1, "Senate", "Penrose", "Roger", "OR", "2024-01-15", "Copper Trust", "Purchase", "CPR", "P1"),
    (2, "Senate", "Rourke", "Sal", "", "2024-02-10", "Tin Works", "Sale (Full)", "TIN", "R3"),
    (3, "House", "Underhill", "Hon.. Lena Jo", "", "2024-03-01", "Iron Inc", "Purchase", "IRN", "U5"),
]


@pytest.fixture(scope="module")
def members(spark):
    return spark.createDataFrame(MEMBERS, MEMBER_INFO)


@pytest.fixture(scope="module")
def holdings(spark):
    rows = [
        (i, ch, last, first, st, a, t, "", "$1,001 - $15,000", "None", "", f"f{i}.pdf", key)
        for i, ch, last, first, st, a, t, key in HELD
    ]
    return spark.createDataFrame(rows, HOLDINGS)


@pytest.fixture(scope="module")
def trades(spark):
    rows = [
        (i, ch, last, first, st, "", day, day, a, "Stock", kind, "$1,001 - $15,000", tick, "", f"t{i}", key)
        for i, ch, last, first, st, day, a, kind, tick, key in TRADED
    ]
    return spark.createDataFrame(rows, TRANSACTIONS)


def ids(page):
    return [r.id for r in page.rows.collect()]


def test_enrichment(holdings, members):
    got = {r.id: (r.state, r.party, r.display_first) for r in se.search_holdings(holdings, members).rows.collect()}
    assert got == {
        1: ("OR", "Democrat", "Roger"), 2: ("ME", "Republican", "Fred"), 3: ("NM", "Republican", "Sal"),
        4: ("IA", "Republican", "Mitch"), 5: ("VT", "Democrat", "Lena"), 6: ("GA", "Republican", "Oscar"),
        7: ("NV", "Democrat", "Clara"), 8: ("NM", "Republican", "Sal"), 9: (None, None, "Elena"),
    }  # the legend row and the row without an asset are gone


@pytest.mark.parametrize(
    "args, want",
    [
        ({"member": "penROSE"}, [1]),
        ({"member": "rourke, sal"}, [3, 8]),
        ({"member": "quill, fred"}, [2]),
        ({"member": "nobody"}, []),
        ({"asset": "fund"}, [4, 7]),
        ({"asset": "stock"}, [1, 2, 3, 8]),
        ({"asset": "100%"}, [6]),
        ({"asset": "t_n w"}, [3]),
        ({"asset": "\\d"}, []),
        ({"chamber": "senate"}, []),
        ({"chamber": "House"}, [5, 6]),
        ({"asset_type": "mutual|__none__"}, [4, 5, 6, 7]),
        ({"asset_type": " | "}, [1, 2, 3, 4, 5, 6, 7, 8, 9]),
        ({"party": "democrat"}, [1, 5, 7, 9]),
        ({"party": "Republican"}, [2, 3, 4, 6, 8]),
        ({"state": "NM"}, [3, 8]),
        ({"state": "OR", "party": "rep"}, []),
    ],
)
def test_holding_filters(holdings, members, args, want):
    page = se.search_holdings(holdings, members, **args)
    assert sorted(ids(page)) == want
    assert page.total.head()[0] == len(want)


def test_sorting_and_paging(holdings, members):
    def find(**kw):
        return ids(se.search_holdings(holdings, members, **kw))

    assert find(sort_col="asset", limit=3) == [1, 7, 5]
    assert find(sort_col="asset", sort_dir="desc", limit=2) == [2, 3]
    assert find(sort_col="asset; DROP TABLE x", limit=2) == find(limit=2) == [5, 6]
    everything = find()
    for wrong in ({"limit": -1}, {"offset": -1}, {"limit": 9, "most": 8}):
        with pytest.raises(ValueError):
            find(**wrong)
    assert find(limit=8, most=8) == everything[:8]
    assert find(limit=4) + find(limit=4, offset=4) + find(limit=4, offset=8) == everything


def test_count_without_member_filter_needs_no_join(holdings, members):
    plan = se.search_holdings(holdings, members, asset="x").total._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


@pytest.mark.parametrize(
    "args, want",
    [
        ({}, [3, 2, 1]),
        ({"member": "underhill"}, [3]),
        ({"asset": "tin"}, [2]),
        ({"tx_type": "purch"}, [3, 1]),
        ({"date_from": "2024-02-10", "date_to": "2024-03-01"}, [3, 2]),
        ({"party": "republican"}, [2]),
        ({"state": "NM"}, [2]),
        ({"sort_col": "ticker", "sort_dir": "asc"}, [1, 3, 2]),
    ],
)
def test_transactions(trades, members, args, want):
    assert ids(se.search_transactions(trades, members, **args)) == want


def test_missing_transactions_table(members):
    page = se.search_transactions(None, members)
    assert page.message and page.total.head()[0] == 0 and page.rows.count() == 0


def test_export_has_no_join_and_raw_state(holdings):
    got = se.export_holdings(holdings, state="OR").collect()
    assert [r.asset for r in got] == ["Copper Trust"]
    assert got[0].__fields__ == [
        "chamber", "last_name", "first_name", "state", "asset", "asset_type", "owner", "value",
        "income_type", "income",
    ]
    assert se.export_holdings(holdings, state="NM").count() == 0


def test_members(holdings, members):
    rows = se.browse_members(holdings, members).collect()
    names = [(r.last_name, r.first_name, r.state, r.party) for r in rows]
    assert names.count(("Rourke", "Sal", "NM", "Republican")) == 1  # two spellings, one person
    assert ("Quill", "Fred", "ME", "Republican") in names
    assert names[0][0] == "Kagan" and len(names) == 8
    assert {r.chamber for r in se.browse_members(holdings, members, chamber="House").collect()} == {"House"}
    assert {r.party for r in se.browse_members(holdings, members, party="demo").collect()} == {"Democrat"}
    assert se.browse_members(holdings, members, q="zzz").count() == 0


def test_stats_and_asset_types(holdings):
    s = se.stats(holdings)
    assert s["total"].head()[0] == 11 and s["members"].head()[0] == 9
    assert [tuple(r) for r in s["chambers"].collect()] == [("Senate", 6), ("SCOTUS", 3), ("House", 2)]
    assert [r[0] for r in se.asset_types(holdings).collect()] == ["Mutual Fund", "Real Estate", "Stock"]


# -- aliases -----------------------------------------------------------------


def _facts(spark, rows):
    return spark.createDataFrame(rows, "id int, chamber string, last_name string, first_name string, bioguide string")


def _aliases(spark, rows):
    return spark.createDataFrame(rows, NAME_ALIASES)


def _learn(spark, facts, members, aliases):
    got = al.learn_aliases(
        _facts(spark, facts), spark.createDataFrame(members, MEMBER_INFO), _aliases(spark, aliases)
    )
    return sorted(map(tuple, got.collect()))


def test_learns_a_legal_name(spark):
    facts = [(1, "Senate", "Rourke", "Salvador", None), (2, "senate", "ROURKE", "Hon.. Salvador", None)]
    assert _learn(spark, facts, MEMBERS, [("R3", "Rourke", "Sal")]) == [
        ("R3", "ROURKE", "Salvador"), ("R3", "Rourke", "Salvador"),
    ]


@pytest.mark.parametrize("first", ["Sal", "SAL", "Sal Ann", "J. Sal", "Hon.. Sal", ""])
def test_covered_names_are_not_learned(spark, first):
    assert _learn(spark, [(1, "House", "Rourke", first, None)], MEMBERS, [("R3", "Rourke", "Sal")]) == []


def test_shared_last_names_are_not_learned(spark):
    twins = [*MEMBERS, ("R9", "rourke", "Dana", "Dana", "ND", "Democrat", 1)]
    assert _learn(spark, [(1, "Senate", "Rourke", "Chip", None)], twins, []) == []


def test_other_chambers_are_not_learned(spark):
    assert _learn(spark, [(1, "SCOTUS", "Wynn", "Amy", None)], MEMBERS, []) == []


@pytest.mark.parametrize(
    "first, want",
    [("Mitch", "T4"), ("Hon. Addison", "T4"), ("Z Mitch", "T4"), ("Mitch Z", "T4"), ("Zed", None), ("", None), (None, None)],
)
def test_missing_keys_are_filled(spark, first, want):
    aliases = _aliases(spark, [("T4", "Tate", "Addison"), ("T4", "Tate", "Mitch")])
    facts = _facts(spark, [(1, "Senate", "TATE", first, None), (2, "SCOTUS", "TATE", first, None), (3, "House", "Tate", first, "K")])
    got = {r.id: r.bioguide for r in al.fix_null_keys(facts, aliases).collect()}
    assert got == {1: want, 2: None, 3: "K"}


def test_last_word_is_tried_first(spark):
    aliases = _aliases(spark, [("A", "Tate", "John"), ("B", "Tate", "Trent"), ("C", "Tate", "Trent")])
    facts = _facts(spark, [(1, "House", "Tate", "Hon.. John Trent", None)])
    assert al.fix_null_keys(facts, aliases).head().bioguide == "B"


def test_repair_is_idempotent(spark):
    members = spark.createDataFrame(MEMBERS, MEMBER_INFO)
    aliases = al.seed_aliases(members)
    h = _facts(spark, [(1, "Senate", "Rourke", "Chuy", None), (2, "House", "Tate", "Mitch", None)])
    t = _facts(spark, [(1, "Senate", "Rourke", "Chuy Z", None)])
    once = al.repair(h, t, members, aliases)
    twice = al.repair(once[0], once[1], members, once[2])
    for a, b in zip(once, twice):
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert {r.bioguide for r in once[0].collect()} == {"R3", "T4"}
    assert once[1].head().bioguide == "R3"  # learned from the holdings before


# -- read-only SQL -----------------------------------------------------------


def test_sql_reads(spark, holdings):
    holdings.createOrReplaceTempView("held")
    assert se.run_select(spark, "; SELECT count(*) AS n FROM held WHERE chamber = :c ;", {"c": "House"}).head().n == 2
    assert se.run_select(spark, "WITH x AS (SELECT 1 AS a) SELECT a, a FROM x").columns == ["a", "a_2"]


@pytest.mark.parametrize(
    "sql",
    [
        "", "DROP TABLE held", "INSERT INTO held SELECT * FROM held", "SET x=1", "SHOW TABLES",
        "WITH x AS (SELECT 1 AS id) INSERT INTO held SELECT * FROM x", "SELECT 1; DROP TABLE held",
        "CREATE TABLE t AS SELECT 1", "FROM held INSERT INTO held SELECT *", "EXPLAIN SELECT 1", "CACHE TABLE held",
    ],
)
def test_sql_refuses_everything_else(spark, sql):
    with pytest.raises(se.NotASelect):
        se.run_select(spark, sql)


@pytest.mark.parametrize("how", [{}, {"sort_col": "asset", "sort_dir": "desc"}, {"party": "republican"}])
def test_deep_and_next_pages(holdings, members, monkeypatch, how):
    """Beyond the shallow offsets, and behind a row's id, pages are those of offset and limit."""
    find = lambda **more: ids(se.search_holdings(holdings, members, **how, **more))
    whole = find()
    with monkeypatch.context() as m:
        m.setattr(se, "SHALLOW", 0)
        assert find(limit=2, offset=1) == whole[1:3]
        assert find(limit=5, offset=99) == []
    assert find(limit=2, after_id=whole[1]) == whole[2:4]
    with pytest.raises(ValueError):
        find(after_id=10)  # a legend row is not among the rows found
