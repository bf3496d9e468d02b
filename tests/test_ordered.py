"""Chunked document work gives what one window per document gives."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyglass.operators import structure as st
from tallyglass.operators.joins import best_row, lookup
from tallyglass.operators.ordered import CHUNK, Order, fold, mark_chunks, number_rows, running
from tallyglass.plans.catalogue.views import Views, cell_order, line_order

SMALL = "/root/testdata/sf0.001"


def _rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    """Three documents; one holds most of the rows."""
    random.seed(5)
    rows = []
    for doc, n in (("hot", 300), ("cold", 40), ("tiny", 1)):
        for i in range(n):
            text = random.choice([None, "", "x", "yy"])
            rows.append((doc, i, random.randint(0, 3), text))
    random.shuffle(rows)
    return spark.createDataFrame(rows, "doc string, pos bigint, n int, text string")


@pytest.mark.parametrize("limit", [10, 1_000_000])
def test_running_values(docs, limit):
    order = Order(["doc"], ["pos"], limit)
    got = running(
        docs, order, s=("sum", F.col("n")), m=("max", F.col("n")), last=("last", F.nullif("text", F.lit(""))),
        all=("concat", F.nullif("text", F.lit(""))),
    )
    w = Window.partitionBy("doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    t = F.nullif("text", F.lit(""))
    want = docs.select(
        "doc", "pos", F.sum("n").over(w).alias("s"), F.max("n").over(w).alias("m"),
        F.last(t, ignorenulls=True).over(w).alias("last"),
        F.array_join(F.collect_list(t).over(w), " ").alias("all"),
    )
    cols = ("doc", "pos", "s", "m", "last", "all")
    assert _rows(got, *cols) == _rows(want, *cols)


def test_chunks_follow_the_order(docs):
    """Whatever the size of a document, a chunk never falls as the order grows."""
    order = Order(["doc"], ["pos"], 7)
    marked = mark_chunks(docs, order).select("doc", "pos", CHUNK).collect()
    assert all(r[CHUNK] == r.pos // 7 for r in marked)
    fine = Order(["doc"], ["n", "pos"], fine=3)
    pairs = sorted((r.n, r.pos, r[CHUNK]) for r in mark_chunks(docs.where("n >= 0"), fine).select("n", "pos", CHUNK).collect())
    assert [p[2] for p in pairs] == sorted(p[2] for p in pairs)


@pytest.mark.parametrize("limit", [10, 1_000_000])
def test_fold_keeps_order_blanks_and_skips_nulls(docs, limit):
    order = Order(["doc"], ["pos"], limit)
    got = fold(
        mark_chunks(docs, order), ["doc"], order.position(), concat={"t": F.col("text")},
        first={"f": F.col("text")}, last={"l": F.col("text")}, total={"n": F.col("n")}, sep="|",
    )
    want = {}
    for doc, pos, n, text in sorted(docs.collect()):
        d = want.setdefault(doc, [[], 0])
        d[1] += n
        if text is not None:
            d[0].append(text)
    for r in got.collect():
        parts, n = want[r.doc]
        assert (r.t, r.n) == ("|".join(parts), n)
        assert (r.f, r.l) == ((parts[0], parts[-1]) if parts else (None, None))


@pytest.mark.parametrize("name", ["house_holdings", "judicial_holdings", "judicial_transactions", "executive_holdings"])
def test_parsers_do_not_depend_on_the_limit(spark, name):
    v = Views(spark, SMALL)
    src, order = {
        "house_holdings": (v.house_cells, cell_order),
        "judicial_holdings": (v.judicial_lines, line_order),
        "judicial_transactions": (v.judicial_lines, line_order),
        "executive_holdings": (v.executive_lines, line_order),
    }[name]
    parse = getattr(st, name)

    # cuts small enough that every document is cut many times
    chunked = lambda: order(64)

    plain = parse(src, order())
    cols = plain.columns
    assert _rows(parse(src, chunked()), *cols) == _rows(plain, *cols)


def test_number_rows_is_dense_and_ordered(spark):
    df = spark.range(0, 5000, 3).withColumn("k", F.pmod(F.xxhash64("id"), F.lit(100000)))
    df = df.unionByName(spark.range(10_000, 10_300).withColumn("k", F.lit(5).cast("bigint")))  # a hot block
    for fine in (None, F.expr("k * 100000 + id DIV 7")):
        got = number_rows(df, ["k", "id"], F.expr("k DIV 37"), "no", fine).orderBy("no").collect()
        assert [r.no for r in got] == list(range(1, len(got) + 1))
        assert [(r.k, r.id) for r in got] == sorted((r.k, r.id) for r in got)


def test_best_row_and_lookup_with_missing_keys(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None)], "k string, r int, t string")
    assert _rows(best_row(df, ["k"], F.col("r")), "k", "r", "t") == [("a", 1, "y"), ("b", 5, None)]
    facts = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, k string")
    dim = spark.createDataFrame([("a", "A")], "k string, v string")
    out = lookup(facts, dim, "k", {"v": "got"})
    assert _rows(out, "id", "k", "got") == [(1, "a", "A"), (2, None, None), (3, "z", None)]


# -- names handed on, against a plain walk -----------------------------------


def _walk(entries, arrows):
    """One entry after the other, as the rule says."""
    import re

    prev, out = "", []
    for key, own, more in entries:
        raw = (own if own is not None else prev) + ("" if more is None else " " + more)
        if not raw:
            continue
        name = re.sub(r"\s*\([A-Z]\)\s*$", "", raw.strip()).strip()
        if arrows:
            name = re.sub(r"^.*⇒\s*", "", name).strip()
            name = re.sub(r"^[-–—]+\s*", "", name).strip()
        prev = name
        out.append((key, name))
    return out


@pytest.mark.parametrize("arrows", [True, False])
def test_inherited_names_match_a_walk(spark, arrows):
    random.seed(11)
    owns = ["Alpha", "Beta (X) (K)", "Gamma (A)", "- Delta"]
    mores = [None, None, None, "more", "tail (B)", "tail (B) (C)", "x ⇒ fresh (D)"]
    rows, want = [], []
    for doc in range(150):
        entries = []
        for e in range(1, random.randint(2, 12)):
            own = random.choice(owns) if random.random() < 0.4 else None
            entries.append((e, own, random.choice(mores)))
        rows += [(f"d{doc}", e, own, more) for e, own, more in entries]
        want += [(f"d{doc}", e, n) for e, n in _walk(entries, arrows)]
    df = spark.createDataFrame(rows, "doc_id string, entry bigint, own string, more string")
    for limit in (3, 1_000_000):
        got = st.inherit_names(df, ["doc_id"], drop_arrows=arrows, cut=limit)
        got = sorted(map(tuple, got.select("doc_id", "entry", "asset").collect()))
        diff = [(a, b) for a, b in zip(got, sorted(want)) if a != b]
        assert len(got) == len(want) and not diff, diff[:3]


@pytest.mark.parametrize("cut", [39, 300])
def test_a_table_of_short_documents_is_not_cut(docs, cut, monkeypatch):
    """Values of the order may lie far apart; what counts is how many rows a document has."""
    from tallyglass.operators import ordered

    far = docs.withColumn("pos", F.col("pos") * 1000)
    order = ordered.sized(far, Order(["doc"], ["pos"], cut))
    assert order.whole == (cut == 300) and ordered.sized(far, Order(["doc"], ["n", "pos"], fine=cut)).whole == order.whole
    stored = []
    monkeypatch.setattr(ordered, "settle", lambda df, name: stored.append(name) or df)
    got = running(ordered.by_document(far, order), order, s=("sum", F.col("n")), all=("concat", F.nullif("text", F.lit(""))))
    w = Window.partitionBy("doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    want = far.select("doc", "pos", F.sum("n").over(w).alias("s"), F.array_join(F.collect_list(F.nullif("text", F.lit(""))).over(w), " ").alias("all"))
    assert _rows(got, "doc", "pos", "s", "all") == _rows(want, "doc", "pos", "s", "all")
    assert stored == ([] if order.whole else ["chunks", "carries"])
