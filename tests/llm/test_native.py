"""Sharding, mixing and line runs against plain Python."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from .conftest import DOCS  # noqa: F401  (the folder's own)
from pyspark.sql import functions as F

from tallyglass.llm import line_dedup, mixing, sharding


def jump(key: int, n: int) -> int:
    b, j, key = -1, 0, key % 2**64
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2147483648.0 / ((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 16, 17, 100])
def test_jump_matches_the_published_loop(spark, shards):
    keys = [0, 1, -1, 7, 2**63 - 1, -(2**63), *range(-3000, 3000, 97), *(i * 0x9E3779B97F4A7C15 % 2**63 for i in range(300))]
    rows = spark.createDataFrame([(k,) for k in keys], "k long").select("k", sharding.jump_shard(F.col("k"), shards).alias("s")).collect()
    assert [(r.k, r.s) for r in rows] == [(k, jump(k, shards)) for k in keys]


def test_shards_are_whole_and_grow_stably(docs, doc_rows):
    got = sharding.shard(docs, 16).collect()
    assert len(got) == len(doc_rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = sorted(((r[0] is None, r[0] or 0), len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in doc_rows)
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.size, r.text_crc32) for r in got) == want
    assert len({r.shard for r in got if r.doc_id == 20}) == 1


def test_empty_tables(no_docs):
    assert sharding.shard(no_docs).count() == 0
    assert mixing.copies(mixing.sizes(no_docs)).count() == 0
    assert mixing.emit(no_docs).count() == 0
    assert line_dedup.remove_repeated_lines(no_docs).count() == 0


def water_fill(sizes: dict, weights: dict, cap: float) -> dict:
    total, held = sum(sizes.values()), set()
    while True:
        free = sum(weights[s] for s in sizes if s not in held)
        level = (total - sum(cap * sizes[s] for s in held)) / free
        more = {s for s in sizes if s not in held and level * weights[s] > cap * sizes[s]}
        if not more:
            return {s: cap * sizes[s] if s in held else level * weights[s] for s in sizes}
        held |= more


def test_targets_and_copies(docs, doc_rows):
    got = mixing.copies(mixing.sizes(docs)).collect()
    sizes = defaultdict(int)
    for r in doc_rows:
        sizes[r[3]] += len((r[1] or "").encode().split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = water_fill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 3.0)
    assert len(got) == len(doc_rows)
    taken = defaultdict(int)
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        rate = r.target / r.source_size
        assert int(rate) <= r.copies <= min(3, int(rate) + 1)
        taken[r.doc_id, r.size] = r.copies
    mix = mixing.emit(docs)
    assert mix.columns == docs.columns
    assert mix.where("doc_id = 20").count() == 3 * taken[20, len(doc_rows[20][1].encode().split())]
    assert mix.count() == sum(r.copies for r in got)
    again = mixing.copies(mixing.sizes(docs.repartition(7))).select("doc_id", "copies").collect()
    assert sorted(map(str, again)) == sorted(str(r) for r in mixing.copies(mixing.sizes(docs)).select("doc_id", "copies").collect())


def cut_lines(rows, least):
    """Texts with later copies of shortest runs removed, by plain dictionaries."""
    seen, out = set(), {}
    unique = sorted({(r[0] is not None, r[0] or 0, r[1]) for r in rows if r[1] is not None}, key=lambda r: r[:2])
    for has, i, text in unique:
        lines, gone = text.split("\n"), set()
        real = [k for k, x in enumerate(lines) if x.encode().split()]
        for a in range(len(real)):
            words = 0
            for b in range(a, len(real)):
                words += len(lines[real[b]].encode().split())
                if words >= least:
                    run = tuple(lines[k] for k in real[a : b + 1])
                    if run in seen:
                        gone |= set(range(real[a], real[b] + 1))
                    seen.add(run)
                    break
        out[has, i, text] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


@pytest.mark.parametrize("least", [1, 20, 50])
def test_line_runs_against_brute_force(docs, doc_rows, least):
    got = line_dedup.remove_repeated_lines(docs.withColumn("before", F.col("text")), min_words=least).collect()
    want = cut_lines(doc_rows, least)
    assert len(got) == len(doc_rows)
    for r in got:
        assert r.text == (None if r.before is None else want[r.doc_id is not None, r.doc_id or 0, r.before])
        assert r.removed == r._key == "clash" and (r.removed_1 is None) == (r.text == r.before)
    assert any(r.text != r.before for r in got)


def test_one_line_a_thousand_times(spark):
    line = "word " * 60
    rows = [(i, "\n".join([f"own {i}", line, line]), "en", "s", 1) for i in range(1000)]
    got = line_dedup.remove_repeated_lines(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(hashlib.sha256(r.text.encode()).hexdigest() for r in got if line in r.text) == [hashlib.sha256(f"own 0\n{line}".encode()).hexdigest()]
