"""Suffix arrays and removal of repeated strings against brute force."""

import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyglass.llm import suffix_dedup


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60))
def test_suffix_array_order(symbols):
    s = [*symbols, 0]
    assert suffix_dedup.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_suffix_array_of_structured_strings():
    fib = [1], [1, 2]
    for _ in range(12):
        fib = fib[1], fib[1] + fib[0]
    for s in ([1] * 500, [1, 2] * 300, [2, 1, 1] * 200, fib[1], list(range(1, 400)), list(range(400, 0, -1))):
        s = [*s, 0]
        assert suffix_dedup.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def brute(rows, length=400):
    """(bytes, removed, runs, digest) of each row."""
    texts = [(t or "").encode() for t in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out


def texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß ") for _ in range(rng.randint(2, 9)))
    fresh = lambda n: " ".join(word() for _ in range(n))
    passages = [fresh(k)[:n] for k, n in ((90, 399), (90, 400), (90, 401), (90, 415), (90, 416), (150, 640), (400, 2000))]
    out = [None, "", "short", "ab" * 600, "z" * 1500, "z" * 399, "z" * 400]
    for i in range(70):
        parts = [fresh(rng.randint(0, 60)) for _ in range(rng.randint(1, 4))]
        for p in rng.sample(passages, rng.randint(0, 3)):
            cut = rng.randint(0, 120) if rng.random() < 0.4 else 0
            parts.insert(rng.randrange(len(parts) + 1), p[cut:] if rng.random() < 0.5 else p[: len(p) - cut])
        out.append("".join(parts))
    out += [out[20], out[20], out[30] + "!", "?" + out[31], out[40][:500] + "x" + out[40][500:]]
    return out


@pytest.mark.parametrize("most", [20_000, 2])
def test_removal_against_brute_force(spark, most):
    rows = texts(3)
    df = spark.createDataFrame([(None if i == 15 else i, t, "clash") for i, t in enumerate(rows)], "doc_id long, text string, spans string").repartition(3)
    got = suffix_dedup.remove_repeats(df, most=most).collect()
    mine = sorted((r.n_bytes, sum(s.e - s.s for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got)
    assert mine == sorted(brute(rows))
    assert sum(m[1] for m in mine) > 10_000


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(empty).count() == 0
    short = spark.createDataFrame([(1, None), (2, "a"), (2, "a")], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_bytes, bytes(r.kept)) for r in suffix_dedup.remove_repeats(short).collect()) == [(1, 0, b""), (2, 1, b"a"), (2, 1, b"a")]


def test_small_tables_whole(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = suffix_dedup.remove_repeats(docs).collect()
    assert sorted((r.n_bytes, sum(s.e - s.s for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got) == sorted(brute([r.text for r in docs.collect()]))


def test_passages_of_fifty_words_go_by_their_bytes(spark):
    """A shared passage is cut in both documents from 400 bytes on, however many words it has; a document's own repeats go too."""
    words = lambda tag, n, k: " ".join(f"{tag}{i:0{k}d}" for i in range(n))
    short, long, alone = words("s", 60, 4), words("t", 60, 7), words("u", 80, 6)
    rows = [(1, f"{words('a', 90, 5)} {short}"), (2, f"{short} {words('b', 90, 5)}"), (3, f"{words('c', 90, 5)} {long}"), (4, f"{long} {words('d', 90, 5)}"), (5, f"{alone} and {alone}")]
    got = {r.doc_id: sum(x.e - x.s for x in r.spans) for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert len(short) < 400 < len(long) and got[1] == got[2] == 0
    assert all(len(long) <= got[i] <= len(long) + 2 for i in (3, 4)) and got[5] >= 2 * len(alone)
