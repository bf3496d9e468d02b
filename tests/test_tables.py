"""Loads, reloads, readers and the incremental stream."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SMALL

from tallyglass.operators import dedupe
from tallyglass.operators import members as mb
from tallyglass.operators import quality as ql
from tallyglass.operators import structure as st
from tallyglass.operators.ordered import Order
from tallyglass.schema import HOLDINGS, ROSTER, evolve, struct
from tallyglass.session import settle, work_folder
from tallyglass.sources import documents as dc
from tallyglass.sources import rosters as rs
from tallyglass.sources import tables as tb
from tallyglass.streaming import incremental as inc


def rows(df, *cols):
    return sorted(map(tuple, (df.select(*cols) if cols else df).collect()), key=str)


def test_year_reload_touches_only_its_years(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.createDataFrame([(1, "a", 2023), (2, "b", 2024), (3, "c", 2024)], "id int, v string, filing_year int")
    tb.reload_years(base, path)
    new = spark.createDataFrame([(2, "B", 2024), (4, "d", 2025)], "id int, v string, filing_year int")
    for _ in range(2):
        out = tb.reload_years(new, path)
        assert rows(out, "id", "v", "filing_year") == [(1, "a", 2023), (2, "B", 2024), (4, "d", 2025)]


def test_stream_takes_each_file_once(spark, tmp_path):
    schema = struct("id int", "v", "seq int", "filing_year int")
    src, table, ckpt = (str(tmp_path / n) for n in ("in", "table", "ckpt"))
    seen = []
    inner = inc.year_sink(table, "id", "seq")

    def sink(batch, batch_id):
        seen.append(batch.count())
        inner(batch, batch_id)

    def deliver(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").json(src)
        inc.ingest_available(spark, src, schema, ckpt, sink)

    deliver([(1, "a", 1, 2023), (2, "b", 1, 2024)])
    deliver([(2, "B", 2, 2024), (3, "c", 2, 2024)])
    inc.ingest_available(spark, src, schema, ckpt, sink)  # nothing new
    assert seen == [2, 2]
    got = spark.read.parquet(table)
    assert rows(got, "id", "v", "filing_year") == [(1, "a", 2023), (2, "B", 2024), (3, "c", 2024)]
    inner(spark.read.schema(schema).json(src), 99)  # a batch that is sent again
    assert rows(spark.read.parquet(table), "id", "v") == [(1, "a"), (2, "B"), (3, "c")]


def test_new_files(spark):
    listed = spark.createDataFrame([("a", 900), ("b", 100), ("c", 900)], "doc_id string, length int")
    done = spark.createDataFrame([("c",)], "doc_id string")
    assert rows(inc.new_files(listed, done, min_bytes=100)) == [("a", 900)]


def test_house_roster_file(spark, tmp_path):
    p = tmp_path / "r.tsv"
    p.write_text(
        'NAME\tOFFICE\tDOCID\nDoe, Hon.. Jane Q\tNC12\t1006\n"Roe, Hon.. Al ""Chuck"""\tTX05\t822\nSolo\t\t9\n',
        encoding="utf-8",
    )
    assert rows(rs.house_roster(rs.read_tsv(spark, str(p)))) == [
        ("1006", "Doe", "Jane Q", "NC"), ("822", "Roe", 'Al "Chuck"', "TX"), ("9", "Solo", "", ""),
    ]


@pytest.mark.parametrize("sep", ["|", "\t", ","])
def test_bulk_index_names_and_delimiters(spark, tmp_path, sep):
    p = tmp_path / "i.txt"
    lines = [["LastName", "First", "FilingType", "ID", "DocID", "Office"], ["Doe", " Jane ", "O", "7", "", "NC1"]]
    p.write_text("\n".join(sep.join(x) for x in lines))
    r = rs.read_bulk_index(spark, str(p)).head()
    assert (r.doc_id, r.last, r.first, r.filing_type, r.office, r.filing_date) == ("7", "Doe", "Jane", "O", "NC1", "")


def test_manifests_later_year_wins(spark, tmp_path):
    for year, last in ((2023, "Old"), (2024, "New")):
        d = tmp_path / f"house_ptrs_{year}"
        d.mkdir()
        (d / "manifest.tsv").write_text(f"doc_id\tlast\tfirst\toffice\n1\t{last}\tA\tTX05\n\tx\ty\tz\n")
    assert rows(rs.read_manifests(spark, str(tmp_path))) == [("1", "New", "A", "TX", "05", 2024)]


def test_text_documents(spark, tmp_path):
    (tmp_path / "Doe_Jane.md").write_text("one\ntwo")
    docs = dc.read_text_documents(spark, str(tmp_path))
    assert rows(docs) == [("Doe_Jane", "one\ntwo", "Doe", "Jane")]
    assert rows(dc.lines(docs)) == [("Doe_Jane", 0, "one"), ("Doe_Jane", 1, "two")]


def test_prefer_original(spark):
    df = spark.createDataFrame(
        [(1, "Doe", True), (2, "doe", False), (3, "Doe", False), (4, "Doe", True), (5, "Roe", True), (6, "Roe", True)],
        "ordinal int, last string, amended boolean",
    )
    got = dedupe.prefer_original(df, ["last"], F.col("amended"))
    assert rows(got, "ordinal") == [(3,), (5,)]


def test_corrections_need_id_and_name(spark):
    roster = spark.createDataFrame([("Doe", "1"), ("Roe", "1")], "last string, doc_id string")
    fix = spark.createDataFrame([("doe", "1", "9")], "last string, doc_id string, new_doc_id string")
    once = dedupe.apply_corrections(roster, fix)
    assert rows(once) == rows(dedupe.apply_corrections(once, fix)) == [("Doe", "9"), ("Roe", "1")]


def test_evolve_adds_typed_columns(spark):
    old = spark.createDataFrame([(1, "House")], "id int, chamber string")
    new = evolve(old, HOLDINGS, {"owner": "DC"})
    assert new.schema.names == HOLDINGS.names and new.dtypes[0] == ("id", "bigint")
    assert (new.head().owner, new.head().asset) == ("DC", None)


def test_settle_reads_back_the_same(spark):
    df = spark.createDataFrame([(1, ["a"], None)], "a int, b array<string>, c string")
    got = settle(df, "t")
    assert got.collect() == df.collect()
    assert work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_member_tables(spark):
    docs = [
        (("A1",), ("Robert", "Núñez", "Bob", "Bob Núñez"), [("2001-01-03", "2003", "TX", "1", "D"), ("x", None, "CA", "2", "R")], True),
        (("A1",), ("Robert", "Núñez", "Bob", "Bob Núñez"), [("2011", "2013", "NV", "", "I")], False),
        (("B2",), ("Anna", "Luna", None, "Anna Paulina Luna"), None, False),
        ((None,), ("No", "Key", None, None), None, False),
    ]
    schema = T.StructType([*ROSTER.fields, T.StructField("is_historical", T.BooleanType())])
    roster = spark.createDataFrame(docs, schema)
    info = {r.bioguide: tuple(r)[1:] for r in mb.member_info(roster).collect()}
    assert info["A1"] == ("Núñez", "Robert", "Bob", "NV", "I", 1)
    assert info["B2"] == ("Luna", "Anna", "Anna", "", "", 1)
    assert set(info) == {"A1", "B2", "EXEC_TRUMP", "D000671_SYN"}
    aliases = set(map(tuple, mb.name_aliases(roster).collect()))
    assert {("A1", "Nunez", "Bob"), ("A1", "Nunez", "Robert"), ("B2", "Luna", "Anna"), ("B2", "Paulina Luna", "Anna")} <= aliases


def test_early_stop(spark):
    found = {0: 1, 1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 0, 7: 1, 8: 0, 9: 1}
    pages = [("a", p, found.get(p, 0)) for p in range(12)] + [("b", p, int(p % 3 == 0)) for p in range(70)]
    df = spark.createDataFrame(pages, "doc string, page int, found int")
    for limit in (4, 1000):
        got = st.early_stop(df, Order(["doc"], ["page"], limit // 2), "page", F.col("found"))
        by = {r.doc: r.n for r in got.groupBy("doc").agg(F.count("*").alias("n")).collect()}
        assert by == {"a": 7, "b": 60}


def test_quality_summary_takes_the_first_sample(spark):
    df = spark.createDataFrame([(2, "c", "late"), (1, "c", "early"), (3, "d", "x")], "at int, category string, sample string")
    assert rows(ql.summarise(df, ["at"])) == [("c", 2, "early"), ("d", 1, "x")]


def test_absent_tables_count_zero(spark):
    got = ql.table_counts({"a": spark.range(3), "b": None})
    assert rows(got) == [("a", 3), ("b", 0)]


def test_the_assembled_tables_meet_every_tier(spark):
    """No member is left out, and each way to find a key, or none, occurs among the filers."""
    from collections import Counter

    from tallyglass.operators import resolve
    from tallyglass.plans.catalogue import tables as ct
    from tallyglass.plans.catalogue.views import Views

    v = Views(spark, SMALL)
    filers = ct._filers(v, "H", 0)
    assert filers.count() == v.customer.count()
    found = resolve.resolve_names(filers.withColumn("year", F.lit(ct.YEAR)), ct._index(v), "last", "first")
    tiers = Counter(r.tier for r in found.select("tier").collect())
    assert set(tiers) == {None, 1, 2, 3, 4, 5} and min(tiers.values()) > 0
    shared = found.where("last LIKE 'Last%'").groupBy("last").agg(F.count("bioguide").alias("n")).where("n > 1")
    assert shared.count() > 0
    listed = {r.doc_id for r in filers.select("doc_id").collect()}
    assert any(r.doc_id not in listed for r in v.house_cells.select("doc_id").distinct().collect())


def test_index_folder_of_many_kinds(spark, tmp_path):
    """Each file by its own first line; files without rows, without a line, and with fields nobody knows."""
    files = {
        "a.txt": "FilingType|Last|First|StateDst|DocID\nO|Doe|Jane|TX05|1\nP|Roe|Al|NV01|2\n",
        "b.txt": "doc_id\tOffice\tLastName\tFirst\tFiling_Type\n3\tCA12\tPoe\tAnn\tA\n",
        "c.txt": 'First,Last,FilingType,StateDist,DocumentID,Extra\nBo,"Lee, Jr.",O,OH02,4,x\n',
        "d.txt": "FilingType|Last|First|StateDst|DocID\n",
        "e.txt": "",
        "f.txt": "DocID|Last|First|StateDst|FilingType\n5|Moe|Cy|GA01|O\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    got = sorted((r.doc_id, r.last, r.first, r.office, r.filing_type) for r in rs.read_bulk_index(spark, str(tmp_path)).collect())
    assert got == [
        ("1", "Doe", "Jane", "TX05", "O"), ("2", "Roe", "Al", "NV01", "P"), ("3", "Poe", "Ann", "CA12", "A"),
        ("4", "Lee, Jr.", "Bo", "OH02", "O"), ("5", "Moe", "Cy", "GA01", "O"),
    ]
    assert len(rs.header_groups(spark, str(tmp_path))) == 4


def test_corrections_come_from_the_index(spark):
    index = spark.createDataFrame(
        [("10070343", "O", "Blumenauer", "Earl", "OR03"), ("7", "O", "BLUMENAUER", "Earl F.", "or03"), ("1", "O", "Blumenauer", "Earl", "WA01"), ("0", "P", "Blumenauer", "Earl", "OR03"),
         ("9", "A", "Gimenez", "Carlos", "TX01"), ("8", "A", "McHenry", "Paul", "NC10"), ("", "O", "Phillips", "Dean", "MN03")],
        "doc_id string, filing_type string, last string, first string, office string",
    )
    found = dedupe.find_corrections(index, dedupe.known_cases(spark))
    assert sorted(map(tuple, found.collect())) == [("Blumenauer", "10070343", "7"), ("Gimenez", "10066804", "9")]
    roster = spark.createDataFrame([("Blumenauer", "10070343"), ("Other", "10070343"), ("gimenez", "10066804"), ("McHenry", "10068784")], "last string, doc_id string")
    assert sorted(map(tuple, dedupe.apply_corrections(roster, found).collect())) == [("Blumenauer", "7"), ("McHenry", "10068784"), ("Other", "10070343"), ("gimenez", "9")]
