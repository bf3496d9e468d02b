"""The resolver against a plain Python reading of its rules."""

import random

import pytest
from pyspark.sql import functions as F

from tallyglass.functions import fixed_values as fv
from tallyglass.operators import resolve as rv


def plain(index, last, first, year):
    """(key, tier) by scanning the candidates of the last name."""
    cands = [e for e in index if e[0] == last.lower()]
    if year:
        near = [e for e in cands if e[3] <= year + 1 and e[4] >= year - 1]
        cands = near or cands
    f = first.lower()
    words = f.split()
    several = " " in f
    tries = [f]
    tries.append(words[0] if several and words[0] != f else None)
    tries.append(words[-1] if several and words[-1] != words[0] else None)
    tries.append(fv.NICKNAMES.get(f))
    for tier, t in enumerate(tries, 1):
        hits = [e for e in cands if t is not None and t in e[2]]
        if hits:
            return min(hits, key=lambda e: (-e[4], e[5]))[1], tier
    return (cands[0][1], 5) if len(cands) == 1 else (None, None)


@pytest.mark.parametrize("seed", [1, 2])
def test_resolver_equals_a_plain_scan(spark, seed):
    random.seed(seed)
    firsts = ["ted", "theodore", "mike", "michael", "bob", "robert", "ann", "lee"]
    lasts = [f"name{i}" for i in range(12)] + ["solo1", "solo2"]
    index = []
    for i in range(70):
        last = random.choice(lasts[:12]) if i > 1 else lasts[12 + i]
        lo = random.randint(1980, 2024)
        index.append(
            (last, f"K{i}", random.sample(firsts, random.randint(1, 3)), lo, lo + random.randint(0, 15), i)
        )
    asked = []
    for i in range(1500):
        first = " ".join(random.sample([*firsts, "zed", "q"], random.randint(1, 3)))
        asked.append((i, random.choice([*lasts, "nobody"]), first, random.choice([None, 0, *range(1970, 2045)])))
    idx = spark.createDataFrame(
        index, "last string, bioguide string, firsts array<string>, min_year int, max_year int, seq bigint"
    )
    df = spark.createDataFrame(asked, "id int, last_name string, first_name string, year int")
    got = {r.id: (r.bioguide, r.tier) for r in rv.resolve_names(df, idx).collect()}
    want = {i: plain(index, last, first, year) for i, last, first, year in asked}
    diff = {i: (asked[i], got[i], want[i]) for i in want if got[i] != want[i]}
    assert len(got) == len(asked) and not diff, list(diff.values())[:3]
    assert {t for _, t in want.values()} == {None, 1, 2, 3, 4, 5}


def test_messy_names(spark):
    idx = spark.createDataFrame(
        [("velazquez", "V", ["nydia"], 1993, 2099, 1), ("dunn", "D", ["neal"], 2017, 2099, 2),
         ("dunn", "E", ["ada"], 2017, 2099, 3)],
        "last string, bioguide string, firsts array<string>, min_year int, max_year int, seq bigint",
    )
    df = spark.createDataFrame(
        [("Velázquez", "Hon.. Nydia M."), ("Dunn, MD, FACS", "MD, FACS, Neal Patrick"), ("Dunn", None), ("DUNN", "Zoe")],
        "last_name string, first_name string",
    ).withColumn("year", F.lit(2024))
    got = {(r.last_name, r.first_name): (r.bioguide, r.tier) for r in rv.resolve_names(df, idx).collect()}
    assert got == {
        ("Velázquez", "Hon.. Nydia M."): ("V", 2), ("Dunn, MD, FACS", "MD, FACS, Neal Patrick"): ("D", 2),
        ("Dunn", None): (None, None), ("DUNN", "Zoe"): (None, None),
    }


def test_no_candidate_pairs_in_the_plan(spark):
    """One last name borne by many members must not multiply the filings."""
    n = 3000
    idx = spark.createDataFrame(
        [("smith", f"K{i}", [f"f{i % 50}"], 1990 + i % 20, 1995 + i % 20, i) for i in range(n)],
        "last string, bioguide string, firsts array<string>, min_year int, max_year int, seq bigint",
    )
    points = spark.createDataFrame([("smith", y) for y in range(1980, 2030)], "last string, year int")
    got = {r.year: r.n_ok for r in rv.overlap_counts(idx, points).collect()}
    rows = [(1990 + i % 20, 1995 + i % 20) for i in range(n)]
    assert got == {y: sum(lo <= y + 1 and hi >= y - 1 for lo, hi in rows) for y in range(1980, 2030)}
    plan = rv.overlap_counts(idx, points)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
