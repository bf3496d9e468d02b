"""Fingerprints, forest and components against brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyglass.llm import forest, simhash
from tallyglass.llm.common import components


def parts_of(nodes, links):
    root = {n: n for n in nodes}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_components(spark):
    rng = np.random.default_rng(4)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(1000, 1200)] + [(5, 2000 + i) for i in range(300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = parts_of({x for l in links for x in l}, links)
    assert got == {n: r for n, r in want.items() if any(n in l and l[0] != l[1] for l in links)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def check_groups(docs, rows, **how):
    got = simhash.near_duplicates(docs, **how).collect()
    fps = {r[1]: plain_fingerprint(r[1]) for r in rows}
    links = [(a, b) for a in set(fps.values()) for b in set(fps.values()) if a < b and bin(a ^ b).count("1") <= 2]
    root, least = parts_of(set(fps.values()), links), {}
    for i, text, *_ in rows:
        if i is not None:
            least[root[fps[text]]] = min(i, least.get(root[fps[text]], i))
    want = sorted(((i is None, i or 0), fps[t], least.get(root[fps[t]], -1)) for i, t, *_ in rows)
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.fp % 2**64, -1 if r.component is None else r.component) for r in got) == want


def test_groups_of_documents(docs, doc_rows, no_docs):
    check_groups(docs, doc_rows)
    assert simhash.near_duplicates(no_docs).count() == 0
    one = simhash.keep_one(docs)
    assert one.columns == docs.columns
    ids = [r.doc_id for r in one.collect()]
    assert ids.count(20) <= 1
    groups = {r.root for r in simhash.near_duplicates(docs).collect()}
    assert len(ids) == len(groups)


@pytest.mark.parametrize("most,thresholds", [(4096, None), (4096, [2]), (40, [1, 0]), (40, [0, 0, 0]), (4096, [1, -1, 0])])
def test_dense_fingerprints_by_every_allocation(spark, most, thresholds):
    """Centres with many variants; every allocation must find every link, however small groups must be."""
    rng = np.random.default_rng(8)
    base = [int(x) for x in rng.integers(0, 2**62, 12)]
    fps = {b ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 5), replace=False)) for b in base for _ in range(30)}
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    if thresholds is None:
        chosen = simhash.plan(df, 2)
    else:
        n, together = simhash.bit_statistics(df)
        chosen = list(zip(simhash.partition_bits(n, together, len(thresholds)), thresholds))
    assert sum(t for _, t in chosen) == 2 - len(chosen) + 1
    assert sorted(b for bits, _ in chosen for b in bits) == list(range(64))
    links = simhash.verified_links(simhash.bounded_groups(simhash.probes(df, chosen), 2, most), 2).collect()
    u = lambda x: x % 2**64
    got = parts_of(fps, [(u(a), u(b)) for a, b in links])
    want = parts_of(fps, [(a, b) for a in fps for b in fps if a < b and bin(a ^ b).count("1") <= 2])
    assert got == want


def test_allocation_is_the_cheapest():
    rng = np.random.default_rng(1)
    for _ in range(20):
        cost = [sorted(rng.integers(1, 100, 3).tolist()) for _ in range(3)]
        every = [(a, b, c) for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3) if a + b + c == 0]
        price = lambda t: sum(cost[i][e] for i, e in enumerate(t) if e >= 0)
        total, chosen = simhash.allocate(cost, 2)
        assert total == price(chosen) == min(map(price, every))


def vectors(spark, n=900, width=16, groups=12, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, width))
    for g in range(groups):
        size = 4 if g else 200
        x[g * 30 + 300 * (g > 0) : g * 30 + 300 * (g > 0) + size] = x[g] + 0.12 * rng.standard_normal((size, width))
    rows = [(i, [float(v) for v in np.float32(x[i])]) for i in range(n)]
    rows += [(n + i, rows[7][1]) for i in range(40)] + [(5000, [2 * v for v in rows[9][1]])]
    odd = [(6000, None), (6001, []), (6002, [0.0] * width), (6003, [float("nan")] + [1.0] * (width - 1)), (6004, [None] + [1.0] * (width - 1)), (6005, [float("inf")] * width), (6006, [1.0, 2.0]), (None, rows[3][1])]
    return rows, odd, spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("key", F.lit("clash"))


@pytest.mark.parametrize("leaf,most", [(64, 8192), (100, 60)])
def test_forest_against_all_pairs(spark, leaf, most):
    rows, odd, df = vectors(spark)
    got = {r.vec_id: r for r in forest.near_duplicates(df, leaf=leaf, most=most).collect() if r.vec_id is not None}
    assert len(got) == len(rows) + len(odd) - 1
    x = np.array([v for _, v in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    ids = [i for i, _ in rows]
    found, true = sum(got[i].n_links for i in ids), int(near.sum())
    assert 0.97 * true <= found <= true
    assert all(got[i].n_links <= d for i, d in zip(ids, near.sum(axis=1)))
    want = parts_of(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near)) if a < b])
    assert np.mean([got[i].component_id == want[i] for i in ids]) > 0.98
    assert all(got[i].kept == (i == got[i].component_id) for i in ids)
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i, _ in odd if i is not None)


def test_forest_without_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert forest.near_duplicates(empty).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in forest.near_duplicates(nothing).orderBy("vec_id").collect()] == [(1, 0, 1, True), (2, 0, 2, True)]


def test_forest_beyond_its_sample(spark, monkeypatch):
    """A table of 16 times the sample: full leaves are split until they are small, with the links still found, for any partitioning."""
    rng = np.random.default_rng(11)
    x = rng.standard_normal((16_000, 32))
    for g in range(400):
        x[g * 8 + 1 : g * 8 + 8] = x[g * 8] + 0.2 * rng.standard_normal((7, 32))
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rounds, leaf_sizes, split, deal = [], [], forest._split, forest._deal
    monkeypatch.setattr(forest, "SPLIT", 512)
    monkeypatch.setattr(forest, "SLICE", 700)
    monkeypatch.setattr(forest, "_split", lambda *a: rounds.append(1) or split(*a))
    monkeypatch.setattr(forest, "_deal", lambda placed, blocks: leaf_sizes.append(placed.groupBy("cell").count().agg(F.max("count")).first()[0]) or deal(placed, blocks))
    run = lambda d: {r.vec_id: (r.n_links, r.component_id, r.kept) for r in forest.near_duplicates(d, leaf=128, sample=1000).collect()}
    got = run(df.repartition(3))
    assert rounds and max(leaf_sizes) <= 256
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    true = sum(int((x[i : i + 1000] @ x.T >= 0.9).sum()) - 1000 for i in range(0, len(x), 1000))
    found = sum(n for n, _, _ in got.values())
    print("recall", found / true, "of", true, "rounds", len(rounds), "leaf", leaf_sizes)
    assert 0.95 * true <= found <= true
    assert run(df.repartition(7, "vec_id")) == got
