"""The near-duplicate stage runs operator 3's search, and keeps what whole texts confirm."""

import os

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tallyglass import session
from tallyglass.llm import simhash


def test_fingerprints_propose_links(spark, monkeypatch):
    asked, real = [], simhash.star_links

    def links(found):
        asked.append(sorted(map(tuple, real(found).collect())))
        return real(found)

    monkeypatch.setattr(simhash, "star_links", links)
    long = " ".join(f"word{i}" for i in range(400))
    rows = [(1, long), (2, long.replace("word7 ", "other ")), (3, long), (4, "a b c"), (5, None), (6, ""), (7, "  ")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = pipeline.near_duplicates(spark, docs, "").select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == [1, 4, 5]
    # Three texts without a word have one fingerprint: links of two of them to the least.
    assert len(asked) == 1 and len(asked[0]) >= 2 and all(b < a for a, b in asked[0])


def test_every_link_of_the_search_is_proposed(spark, monkeypatch):
    """A chain of fingerprints two bits apart, two texts each: no star of the whole group has the links of a chain."""
    asked, real = [], simhash.star_links

    def prints(docs, key="doc_id"):
        bits = F.expr("shiftleft(1L, 2 * cast(split(text, ' ')[0] as int)) - 1")
        return docs.select(F.col(key).alias("key"), F.xxhash64("text").alias("text_hash"), bits.alias("fp"))

    monkeypatch.setattr(simhash, "fingerprints", prints)
    monkeypatch.setattr(simhash, "star_links", lambda found: asked.append({tuple(r) for r in real(found).collect()}) or real(found))
    docs = spark.createDataFrame([(2 * i + j, f"{i} {w}", "en", "s", 3) for i in range(6) for j, w in enumerate("ab")], "doc_id long, text string, lang string, source string, n_chars long")
    assert pipeline.near_duplicates(spark, docs, "").count() == 12
    texts = {}
    for r in docs.select("text", F.xxhash64("text").alias("h")).collect():
        texts.setdefault(int(r.text[0]), []).append(r.h)
    least = {i: min(h) for i, h in texts.items()}
    pairs = [(max(h), min(h)) for h in texts.values()] + [(max(least[i], least[i + 1]), min(least[i], least[i + 1])) for i in range(5)]
    assert asked == [set(pairs)]


def test_work_tables_of_the_search_go(spark, monkeypatch):
    """Only what the result reads is left when the stage has found its groups."""
    made, real = [], session.work_folder
    monkeypatch.setattr(session, "work_folder", lambda spark, name: made.append(real(spark, name)) or made[-1])
    long = " ".join(f"word{i}" for i in range(400))
    rows = [(i, long.replace(f"word{7 * i} ", "other "), "en", "s", len(long)) for i in range(9)] + [(9, "a b c", "en", "s", 5)]
    kept = pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "")
    left = {os.path.basename(p).rsplit("-", 1)[0] for p in made if os.path.exists(p.removeprefix("file://"))}
    assert len(made) > 20 and left == {"groups", "single", "several"}
    assert sorted(r.doc_id for r in kept.collect()) == [0, 9]
