"""Windows of earlier documents against plain Python."""

import hashlib
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyglass.llm import matching, queries

from .conftest import DOCS, plain_words

W = matching.WINDOW


def plain_kept(rows):
    """(id, words, removed, kept) for each row by a dictionary of all windows."""
    order = lambda i: -(2**63) if i is None else i
    least = {}
    for i, text in rows:
        words = plain_words(text)
        for k in range(len(words) - W + 1):
            run = tuple(words[k : k + W])
            least[run] = min(order(i), least.get(run, 2**63))
    out = []
    for i, text in rows:
        words, gone = plain_words(text), set()
        for k in range(len(words) - W + 1):
            if least[tuple(words[k : k + W])] < order(i):
                gone |= set(range(k, k + W))
        out.append((str(i), len(words), len(gone), hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest()))
    return sorted(out)


def results(found):
    removed = F.aggregate("spans", F.lit(0), lambda a, x: a + x["e"] - x["s"])
    got = found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept"), "spans").collect()
    for r in got:
        assert all(a.e < b.s for a, b in zip(r.spans, r.spans[1:])) and all(a.e - a.s >= W for a in r.spans)
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in got)


@pytest.fixture(scope="module")
def shared_rows():
    """Passages in many surroundings, passages cut short, periodic words, repeats inside one document."""
    rng = random.Random(6)
    vocab = [f"v{k}" for k in range(60)]
    some = lambda k: [rng.choice(vocab) for _ in range(k)]
    passages = [some(n) for n in (49, 50, 51, 79, 80, 81, 200)]
    rows = []
    for i in range(160):
        words = some(rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.choice((0, 0, rng.randint(0, 30)))
            words += p[a : len(p) - rng.choice((0, 0, rng.randint(0, 20)))] + some(rng.randint(0, 12))
        if i % 9 == 0:
            words += ["x", "y"] * rng.randint(20, 90)
        if i % 11 == 0 and rows:
            words = rows[-1][1].split() + some(1)
        rows.append((rng.choice((i, i, 7)), rng.choice((" ", "\n", " \t")).join(words)))
    return rows


@pytest.mark.parametrize("most, shard", [(4000, 300_000), (3, 500), (1, 1)])
def test_shared_passages(spark, shared_rows, monkeypatch, most, shard):
    monkeypatch.setattr(matching, "SHARD_WORDS", shard)
    docs = spark.createDataFrame(shared_rows, "doc_id long, text string").repartition(5)
    want = plain_kept(shared_rows)
    assert any(r[2] for r in want)
    assert results(matching.remove_windows(docs, most=most)) == want


def test_tables(docs, doc_rows):
    want = plain_kept([r[:2] for r in doc_rows])
    assert results(matching.remove_windows(docs.withColumn("spans", F.lit(1)).withColumn("kept", F.lit("clash")).withColumn("id", F.lit(2)))) == want


def test_one_passage_in_all_documents(spark):
    """A third of all rows are copies, all hold one passage between words of their own."""
    rng = random.Random(2)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(i, f"{passage} same end " * 2 if i % 3 == 0 else f"{rng.random()} a b {i} c {passage} {rng.random()} {i} d") for i in range(600)]
    assert results(matching.remove_windows(spark.createDataFrame(rows, "doc_id int, text string"), most=20)) == plain_kept(rows)


def test_query(spark, docs, doc_rows, tmp_path):
    docs.select(*DOCS.fieldNames()).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.queries()["op13_window_matches"](spark, str(tmp_path))
    assert got.columns[:4] == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    rows = got.collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in rows) == plain_kept([r[:2] for r in doc_rows])
    assert all(hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256 for r in rows)


def test_index_against_plain_search():
    rng = np.random.default_rng(7)
    symbols = np.concatenate([np.append(rng.integers(1, 4, n), 0) for n in (30, 1, 200, 90)])
    ids = rng.integers(0, 9, len(symbols))
    index = matching.ShardIndex(symbols, 4, ids)
    for _ in range(200):
        at, n = int(rng.integers(0, len(symbols) - 8)), int(rng.integers(1, 8))
        word = symbols[at : at + n]
        if 0 in word:
            continue
        lo, hi = np.array([0]), np.array([len(symbols)])
        for w in word[::-1]:
            lo, hi = index.extend(np.array([w]), lo, hi)
        places = [k for k in range(len(symbols) - n + 1) if (symbols[k : k + n] == word).all()]
        assert int(hi[0] - lo[0]) == len(places)
        assert int(index.least.of(lo, hi)[0]) == min(ids[k] for k in places)
        up, down, depth = index.parent(lo, hi)
        wider = [k for k in range(len(symbols) - int(depth[0]) + 1) if (symbols[k : k + int(depth[0])] == word[: int(depth[0])]).all()]
        assert len(places) < int(down[0] - up[0]) and (not depth[0] or int(down[0] - up[0]) == len(wider))


def test_no_documents(spark, no_docs):
    assert matching.remove_windows(no_docs).count() == 0
    short = spark.createDataFrame([(1, None), (2, ""), (3, "a " * 49), (None, None)], "doc_id long, text string")
    assert results(matching.remove_windows(short)) == plain_kept([(1, None), (2, ""), (3, "a " * 49), (None, None)])


def test_work_tables_and_shuffles_go(spark, shared_rows):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, folder = spark.conf.get(setting), Path(spark.conf.get("spark.checkpoint.dir")) / "tallyglass"
    docs = spark.createDataFrame(shared_rows, "doc_id int, text string")
    rows = matching.anchor_rows(docs, "doc_id").count()
    assert 0 < matching._shared(docs, "doc_id").count() < rows
    held = {p.name for p in folder.iterdir()}
    found = matching.remove_windows(docs, most=20)
    left = {p.name for p in folder.iterdir()} - held
    assert [n.partition("-")[0] for n in left] == ["spans"]
    assert results(found) == plain_kept(shared_rows)
    assert spark.conf.get(setting) == before
