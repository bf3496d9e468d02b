"""Periodic runs against plain Python."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyglass.llm import periodic, queries

from .conftest import DOCS, plain_words


def plain_runs(w, least=24, times=3):
    """All runs by comparing every word with the one a period on."""
    out, ids = {}, {}
    w = np.array([ids.setdefault(x, len(ids)) for x in w], np.int64)
    for p in range(1, len(w) // times + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], w[:-p] == w[p:], [0]])))
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if e - s + p >= max(least, times * p):
                out.setdefault((s, e - s + p), p)
    return sorted((s, n, p) for (s, n), p in out.items())


def plain_planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def plain_digest(w):
    runs = plain_runs(w)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None, None, None)
    gone = {k for s, n, p in runs for k in range(s + p, s + n)}
    kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def solved(texts, **how):
    return [[tuple(r) for r in f.tolist()] for f in periodic.find_runs([np.array(t, np.int64) for t in texts], **how)]


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def test_shaped_texts():
    rng = random.Random(3)
    texts = [[], [1], [5] * 23, [5] * 24, [1, 2] * 12, [1, 2] * 200 + [3] + [1, 2] * 200, fibonacci(700), [rng.randrange(2) for _ in range(900)]]
    for _ in range(30):  # periods inside periods, with damage
        unit = [rng.randrange(3) for _ in range(rng.randint(1, 40))]
        t = (unit * rng.randint(2, 9) + [rng.randrange(4)]) * rng.randint(1, 5)
        t[rng.randrange(len(t))] = 7
        texts.append(t)
    assert solved(texts) == [plain_runs(t) for t in texts]
    assert any(len(plain_runs(t)) > 1 for t in texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=90), min_size=1, max_size=5), st.integers(2, 12), st.integers(2, 3))
def test_random_texts(texts, least, times):
    assert solved(texts, least=least, times=times) == [plain_runs(t, least, times) for t in texts]


def test_places_in_slabs(monkeypatch):
    texts = [[1, 2, 3] * 40, fibonacci(300), [4] * 100]
    monkeypatch.setattr(periodic, "SLAB", 17)
    assert solved(texts) == [plain_runs(t) for t in texts]


def test_extensions():
    rng = random.Random(8)
    text = [rng.randrange(2) for _ in range(400)] + [0] * 60 + fibonacci(200)
    symbols = np.array([-1, *text, -2], np.int64)
    levels = periodic.grammar(symbols)
    assert len(levels[-1].symbols) == 3  # one symbol for the whole text
    i, j = np.array([(a, b) for a in range(1, 661, 7) for b in range(a + 1, 661, 11)]).T
    want = [next(k for k in range(999) if symbols[x + k] != symbols[y + k]) for x, y in zip(i, j)]
    assert periodic.common_extensions(levels, i, j).tolist() == want
    far = len(symbols) - 1
    want = [next(k for k in range(999) if symbols[x - k] != symbols[y - k]) for x, y in zip(i, j)]
    assert periodic.common_extensions(periodic.mirrored(levels), far - i, far - j).tolist() == want


@pytest.mark.parametrize("batch", [periodic.BATCH_WORDS, 300])
def test_tables(docs, doc_rows, monkeypatch, batch):
    monkeypatch.setattr(periodic, "BATCH_WORDS", batch)
    got = periodic.periodic_runs(docs).collect()
    assert len(got) == len(doc_rows)
    want = sorted((str(r[0]), len(w := plain_words(r[1])), plain_runs(w)) for r in doc_rows)
    assert sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs]) for r in got) == want


def test_query(spark, docs, doc_rows, tmp_path):
    more = [(10_000 + i, " ".join(f"w{k % (3 + i % 50)}" for k in range(40 + 9 * i)), "en", "a", 1) for i in range(60)]
    docs.select(*DOCS.fieldNames()).unionAll(spark.createDataFrame(more, DOCS)).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.queries()["op11_periodic_runs"](spark, str(tmp_path))
    assert got.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = sorted(str((r[0], *plain_digest(plain_planted(r[0], plain_words(r[1]))))) for r in doc_rows + more)
    assert sorted(str(tuple(r)[:8]) for r in got.collect()) == want


def test_no_documents(spark, no_docs):
    found = periodic.digest(periodic.periodic_runs(no_docs.withColumn("runs", F.lit("clash")).withColumn("best", F.lit(1))))
    assert found.count() == 0
