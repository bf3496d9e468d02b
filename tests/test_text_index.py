"""The substring index beside a full scan, and with files that come, change and go."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyglass.functions import text as tx
from tallyglass.operators import text_index as ti
from tallyglass.plans import search as se

SCHEMA = "id int, asset string, last_name string, first_name string"
TEXTS = {"asset": "asset", "name": "concat_ws(', ', last_name, first_name)"}


def rows(n, seed):
    rnd = random.Random(seed)
    word = lambda k: "".join(rnd.choice("abcÉéİ𝒳 %_\\") for _ in range(k))
    odd = [(-1, None, None, "x"), (-2, "", "", ""), (-3, "ab", "Ott", None), (-4, "İstanbul Fund", "O'Neil", "Ann")]
    return odd + [(i, word(rnd.randint(0, 12)), word(4), rnd.choice([None, word(3)])) for i in range(n)]


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("indexed"))
    ti.write_clustered(spark.createDataFrame(rows(400, 1), SCHEMA), f"{root}/t", "asset", 24)
    found = ti.TextIndex(spark, f"{root}/t", f"{root}/i", TEXTS)
    assert found.refresh() > 12 and found.refresh() == 0
    return found


def test_grams_of_patterns():
    assert ti.pattern_grams("%abcd_efg%hi") == {"abc", "bcd", "efg"}
    assert ti.pattern_grams(r"a\%b\\c") == {"a%b", "%b\\", "b\\c"}
    assert ti.pattern_grams("%ab%") == ti.pattern_grams("") == ti.pattern_grams("\\") == set()


def test_random_patterns_equal_a_scan(spark, index):
    rnd, whole, pruned = random.Random(5), spark.read.parquet(index.table), 0
    held = [r.asset for r in whole.select("asset").collect() if r.asset]
    patterns = ["", "%", "ISTANBUL", "i̇st", "ab", "a_c%b", "\\", "100%"]
    for _ in range(12):
        t = rnd.choice(held)
        at = rnd.randrange(len(t))
        part = t[at : at + rnd.randint(2, 8)]
        patterns.append(rnd.choice([part, part.upper(), part[:3] + "%" + part[-2:], part[:2] + "_" + part[3:]]))
    for p in patterns:
        assert ids(index.search(p, "asset")) == ids(whole.where(tx.matches("asset", p))), p
        found = index.candidates(p, "asset")
        pruned += found.files < found.of_files
        assert found.bytes <= found.of_bytes
    assert pruned >= 5


def test_forms_of_a_name(spark, index):
    whole = spark.read.parquet(index.table)
    some = [f"{r.last_name}, {r.first_name}" for r in whole.where("first_name IS NOT NULL AND id > 0").limit(4).collect()]
    for p in ["o'neil, a", "OTT", *some]:
        test = se.member_is(p, canonical=False)
        assert ids(index.candidates(p, "name").rows.where(test)) == ids(whole.where(test)), p


def test_only_files_with_the_words_are_read(spark, tmp_path):
    data = [(i, f"{chr(97 + i % 26) * 4} Holdings", "L", "F") for i in range(2600)]
    ti.write_clustered(spark.createDataFrame(data, SCHEMA), str(tmp_path / "t"), "asset", 26)
    index = ti.TextIndex(spark, str(tmp_path / "t"), str(tmp_path / "i"), {"asset": "asset"})
    index.refresh()
    found = index.candidates("QQQQ", "asset")
    assert found.files <= 3 and found.of_files >= 20 and 5 * found.bytes < found.of_bytes
    assert index.search("QQQQ", "asset").count() == 100
    nothing = index.candidates("zzzzq", "asset")
    assert nothing.files == 0 and nothing.rows.count() == 0 and nothing.rows.columns == ["id", "asset", "last_name", "first_name"]


def test_files_that_come_change_and_go(spark, tmp_path):
    at, write = str(tmp_path / "t"), lambda data, mode: spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode(mode).parquet(str(tmp_path / "t"))
    write([(1, "copper trust", "", "")], "append")
    index = ti.TextIndex(spark, at, str(tmp_path / "i"), {"asset": "asset"})
    assert ids(index.search("copper", "asset")) == [1]  # no index yet
    index.refresh()
    write([(2, "copper fund", "", "")], "append")
    assert ids(index.search("copper", "asset")) == [1, 2] and index.candidates("zinc", "asset").files == 1  # the new one is read
    assert index.refresh() == 1 and index.candidates("zinc", "asset").files == 0
    write([(3, "zinc", "", "")], "overwrite")
    assert ids(index.search("zinc", "asset")) == [3] and ids(index.search("copper", "asset")) == []
    index.refresh()
    # A run killed before its list of files is whole doesn't count.
    for mark in Path(tmp_path / "i" / "files").glob("*/_SUCCESS"):
        mark.unlink()
    assert index.candidates("copper", "asset").files == 1 and ids(index.search("zinc", "asset")) == [3]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "t"))
    index = ti.TextIndex(spark, str(tmp_path / "t"), str(tmp_path / "i"), TEXTS)
    index.refresh()
    assert index.search("abc", "asset", "name").count() == 0


def test_gram_column(spark):
    got = spark.createDataFrame([("aaaa𝒳b",)], "t string").select(ti.grams_of(F.split("t", "")).alias("g")).first().g
    assert sorted(got) == sorted(["aaa", "aa𝒳", "a𝒳b"])
