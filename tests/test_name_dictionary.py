"""The dictionary of resolved names gives what the resolver gives, and resolves a name once."""

import random

import pytest

from tallyglass.operators import name_dictionary as nd
from tallyglass.operators import resolve as rv

INDEX = "last string, bioguide string, firsts array<string>, min_year int, max_year int, seq bigint"
NAMES = "id int, last_name string, first_name string, year int"


@pytest.fixture(scope="module")
def index(spark):
    rnd = random.Random(4)
    rows = [(f"name{i % 9}", f"K{i}", [rnd.choice(["ann", "bob", "lee", "robert"])], 1990 + i % 20, 2000 + i % 25, i) for i in range(40)]
    return spark.createDataFrame(rows, INDEX)


def asked(spark, seed, n=80):
    rnd = random.Random(seed)
    last = [None, "", 'Quo"te', *[f"Name{i}" for i in range(11)]]
    rows = [(i, rnd.choice(last), rnd.choice([None, "", "Ann", "Bob X", "Lee", "robert"]), rnd.choice([None, 0, 1995, 2010])) for i in range(n)]
    return spark.createDataFrame(rows, NAMES)


def rows(df):
    return sorted(map(tuple, df.select("id", "last_name", "first_name", "year", "bioguide", "tier").collect()), key=str)


def test_equals_the_resolver_and_learns_once(spark, index, tmp_path):
    book = nd.NameDictionary(spark, str(tmp_path / "names"), buckets=4)
    learnt = []
    for seed in (1, 2, 1):
        names = asked(spark, seed)
        assert rows(book.resolve(names, index)) == rows(rv.resolve_names(names, index))
        learnt.append(book.learn(names, index, "last_name", "first_name", "year")[1])
    assert learnt == [0, 0, 0]
    kept = spark.table(book.table(nd.index_version(index)))
    assert kept.count() == kept.select("name_key").distinct().count()
    again = nd.NameDictionary(spark, str(tmp_path / "names"), buckets=4)
    assert again.learn(asked(spark, 2), index, "last_name", "first_name", "year")[1] == 0


def test_changed_index_is_a_new_version(spark, index, tmp_path):
    book = nd.NameDictionary(spark, str(tmp_path / "names"), buckets=4)
    names = asked(spark, 3)
    book.resolve(names, index)
    changed = index.where("seq <> 7")
    assert nd.index_version(changed) != nd.index_version(index) == nd.index_version(index.orderBy("bioguide").repartition(3))
    assert rows(book.resolve(names, changed)) == rows(rv.resolve_names(names, changed))


def test_without_year_and_without_rows(spark, index, tmp_path):
    book = nd.NameDictionary(spark, str(tmp_path / "names"), buckets=4)
    names = asked(spark, 5)
    assert book.resolve(names.where("false"), index).count() == 0
    assert rows(book.resolve(names, index, year=None)) == rows(rv.resolve_names(names, index, year=None))


def test_dictionary_is_not_shuffled(spark, index, tmp_path):
    book = nd.NameDictionary(spark, str(tmp_path / "names"), buckets=4)
    names = asked(spark, 6)
    table, _ = book.learn(names, index, "last_name", "first_name", "year")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = book.resolve(names, index)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan, plan
