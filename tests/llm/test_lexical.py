"""Ranked search against plain Python."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyglass.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain_search(docs, items, top):
    """Every document against every item."""
    held = [(i, Counter(plain_terms(t))) for i, t in docs if plain_terms(t)]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(plain_terms(t))
    out = []
    for item, own in asked.items():
        rows = []
        for i, c in held:
            m = 50 + 50 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if score > 0:
                rows.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if r[1] else r[2], -r[0]) for k, r in enumerate(sorted(rows)[:top])]
    return sorted(out, key=str)


def items_of(doc_rows):
    texts = [r[1] for r in doc_rows if r[1]]
    rows = [(k, " ".join(t.split()[: 5 + 3 * k])) for k, t in enumerate(texts[10:30])]
    rows += [(3, "one more row of item three bibih"), (50, None), (51, ""), (52, "..."), (53, "nowhere-at-all"), (None, "bibih one"), (54, texts[-1]), (55, "X x ÉÀ é bibih"), (55, "X x ÉÀ é bibih")]
    return rows


ITEMS = "item_id long, text string"


@pytest.mark.parametrize("top, docs_each, matches, chunk, size", [(50, 1 << 15, 1 << 21, 256, 4 << 20), (3, 7, 1 << 21, 1, 4 << 20), (5, 100, 300, 2, 200)])
def test_against_every_pair(spark, docs, doc_rows, monkeypatch, top, docs_each, matches, chunk, size):
    for name, value in (("BLOCK_DOCS", docs_each), ("BLOCK_MATCHES", matches), ("CHUNK", chunk), ("ITEM_BYTES", size)):
        monkeypatch.setattr(lexical, name, value)
    items = items_of(doc_rows)
    table = spark.createDataFrame(items, ITEMS).withColumn("rank", F.lit(1)).withColumn("score", F.lit("clash"))
    got = lexical.search(docs, table, top=top)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = plain_search([r[:2] for r in doc_rows], items, top)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert sorted(map(tuple, lexical.search(docs.repartition(9), table, top=top).collect()), key=str) == want


def test_masks_beyond_one_word():
    rng = np.random.default_rng(4)
    held = rng.random((40, 150)) < 0.03
    held[10:20] = held[0]
    doc, term = np.nonzero(held)
    block = lexical.Block(doc, term, np.ones(len(doc), np.int64), np.full(40, 100), np.arange(1, 151))
    own = np.arange(150)
    bound, group = block.masks(own)
    masks = [tuple(r) for r in held.tolist()]
    assert len(bound) == len(set(masks)) and len({(g, m) for g, m in zip(group.tolist(), masks)}) == len(bound)
    assert [int(bound[g]) for g in group] == [int(block.best[r].sum()) for r in held]


def test_ties_and_equal_bounds(spark):
    rows = [(i, "alpha beta" if i % 2 else "alpha gamma") for i in range(200, 0, -1)]
    docs = spark.createDataFrame(rows + [(0, "delta")], "doc_id long, text string").repartition(5)
    got = lexical.search(docs, spark.createDataFrame([(1, "alpha beta gamma")], ITEMS), top=30).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 31))
    assert [(r.item_id, r["rank"], r.doc_id, r.score) for r in got] == sorted(plain_search([*rows, (0, "delta")], [(1, "alpha beta gamma")], 30), key=lambda r: r[1])


def test_empty_tables(spark, docs, no_docs):
    items = spark.createDataFrame([(1, "bibih")], ITEMS)
    assert lexical.search(no_docs, items).count() == 0
    empty = lexical.search(docs, items.limit(0))
    assert empty.columns == ["item_id", "rank", "doc_id", "score"] and empty.count() == 0
    with pytest.raises(TypeError):
        lexical.search(docs.withColumn("doc_id", F.array("doc_id")), items)
