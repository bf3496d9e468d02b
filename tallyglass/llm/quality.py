"""Quality rules with risk-controlled cutoffs.

Each rule is a score of a text, higher is worse.  The labelled texts are split by
hash, copies of a text into one part.  On the first part each stratum chooses its
rules: every rule's best cutoff is looked for, texts are counted by the set of
rules that reach theirs, and rules are taken one by one while another one still
catches a share ``LEAST`` of the bad texts that the others miss, and while the
second part has enough good texts to test one rule more.

On the second part the ``m`` chosen rules get their cutoffs: a cutoff counts as
safe when an exact binomial test rules out that it rejects more than ``risk / m``
of the good documents of that stratum.  Cutoffs are tested from the loosest to
the strictest and testing stops at the first failure (fixed-sequence testing); the
level ``error`` is divided by strata and by the ``m`` rules (Bonferroni).  The
choice knows nothing of the labels that test it, so with probability 1 - ``error``
no stratum loses more than the share ``risk`` of its good documents, and rules that
are not chosen cost no power: with four strata 72 good texts in the second part
(108 in all) can test one rule, 174 two.  Among the safe cutoffs the one that best
parts bad from good is taken, and none where no cutoff helps or too few labels exist.

Edge cases: a null text counts as empty (no words, so the base rule fails it);
null strata are a stratum of their own; labels that are null or have no document
are ignored, a document with several labels is good if any says so; rows that
repeat id and text share one verdict; an empty table gives an empty result;
other columns are ignored by :func:`measure` and kept by :func:`keep_good`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle

RULES = ("symbols", "capitals", "marks", "repeats", "same_lines", "long_words", "short_words")
STEPS = 400  # cutoffs lie on a grid of this many steps over each score's range, 0 to 1
PARTS, CHOOSING = 3, 1  # of so many parts of the labelled texts, this many choose the rules
LEAST = 0.01  # share of the bad texts that a further rule must catch, net of what it costs
SYMBOLS = b"#*$%&|<>"


def _class(members) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


BLANK, SYMBOL = _class(b" \t\n\v\f\r"), _class(SYMBOLS)
TAIL, CAPITAL, MARK = _class(range(0x80, 0xC0)), _class(range(65, 91)), _class(b"!?")


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    code = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(code.__getitem__, words), np.int64, n)
    pair = ids[:-1] * len(code) + ids[1:]
    if len(code) > 2_000_000:
        pair = np.unique(pair, return_inverse=True)[1]
    key = pair[:-1] * len(code) + ids[2:]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    starts = np.concatenate([order[1:][same], order[:-1][same]])
    for shift in range(3):
        twice[starts + shift] = True
    return int(twice.sum())


def describe(text: bytes | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the counts that only the rules need."""
    if not text:
        return (0,) * 8
    words = text.split()
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    lines = [x for x in text.split(b"\n") if x.strip()]
    chars = len(text) - int(count[TAIL].sum()) - int(count[BLANK].sum())
    return (
        len(words), chars, int(count[SYMBOL].sum()), len(lines) - len(set(lines)), repeated_words(words),
        int(count[CAPITAL].sum()), int(count[MARK].sum()), len(lines),
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_marks", "n_lines")


def measure(docs: DataFrame, key: str = "doc_id", stratum: str = "lang") -> DataFrame:
    """key, stratum, text_hash and the counts of each whole text; one pass, nothing shuffled."""
    rows = docs.select(F.col(key).alias("key"), F.col(stratum).cast("string").alias("stratum"), F.xxhash64("text").alias("text_hash"), "text")
    schema = "key " + rows.schema["key"].dataType.simpleString() + ", stratum string, text_hash long, " + ", ".join(f"{c} long" for c in COUNTS)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [describe(t) for t in batch.column(3).cast(pa.binary()).to_pylist()]
            counts = [pa.array([x[i] for x in found], pa.int64()) for i in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *counts], ["key", "stratum", "text_hash", *COUNTS])

    return rows.mapInArrow(task, schema)


def base_failed():
    """Too short, or mostly repeated three-word windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def scores() -> dict:
    """The rules' scores, 0 to 1, higher is worse."""
    share = lambda a, b: F.least(F.lit(1.0), F.col(a) / F.greatest(F.col(b), F.lit(1)))
    mean = F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols": share("n_symbols", "word_chars"), "capitals": share("n_capitals", "word_chars"), "marks": share("n_marks", "n_words"),
        "repeats": share("n_repeat_words", "n_words"), "same_lines": share("n_dup_lines", "n_lines"),
        "long_words": F.least(F.lit(1.0), mean / 40), "short_words": F.greatest(F.lit(0.0), 1 - mean / 40),
    }


def _steps():
    return F.array(*[F.floor(s * STEPS).cast("int") for s in scores().values()])


def binomial_below(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Bin(n, p), summed exactly term by term in the log domain."""
    if k >= n:
        return 1.0
    log_p, log_q, top = math.log(p), math.log1p(-p), math.lgamma(n + 1)
    terms = [top - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * log_p + (n - i) * log_q for i in range(k + 1)]
    most = max(terms)
    return min(1.0, math.exp(most) * math.fsum(math.exp(t - most) for t in terms))


def safe_cutoff(step: np.ndarray, good: np.ndarray, bad: np.ndarray, n_good: int, n_bad: int, risk: float, level: float) -> int | None:
    """The grid step from which to reject, or None.  ``good`` and ``bad`` count labelled documents at each ``step``."""
    best, chosen = 0.0, None
    if not n_good or not n_bad:
        return None
    k = b = 0
    for i in np.argsort(-step):
        k, b = k + int(good[i]), b + int(bad[i])
        # Beyond the expected count the test cannot succeed, so the sum above stays short.
        if k > risk * n_good or binomial_below(k, n_good, risk) > level:
            break
        gain = b / n_bad - 4 * k / n_good
        if gain > best:
            best, chosen = gain, int(step[i])
    return chosen


def likely_cutoff(step: np.ndarray, good: np.ndarray, bad: np.ndarray, risk: float) -> int | None:
    """The step that parts bad from good best among those that reject ``risk`` of the good ones or less; nothing is tested."""
    order = np.argsort(-step)
    k, b = np.cumsum(good[order]), np.cumsum(bad[order])
    if not len(order) or not k[-1] or not b[-1]:
        return None
    gain = np.where(k <= risk * k[-1], b / b[-1] - 4 * k / k[-1], 0.0)
    best = int(np.argmax(gain))
    return int(step[order][best]) if gain[best] > 0 else None


def choose_rules(mask: np.ndarray, good: np.ndarray, bad: np.ndarray, n_test: int, risk: float, level: float) -> list[int]:
    """The rules to test, best first; ``mask`` has a bit for each rule that a group of texts reaches, ``n_test`` good texts will test them."""
    chosen: list[int] = []
    n_good, n_bad = max(1, int(good.sum())), max(1, int(bad.sum()))
    left = np.ones(len(mask), bool)
    while len(chosen) < len(RULES):
        m = len(chosen) + 1
        if binomial_below(0, n_test, risk / m) > level / m:
            break  # not even a cutoff that rejects no good text could pass
        hits = [left & (mask >> i & 1 == 1) for i in range(len(RULES))]
        gains = [bad[h].sum() / n_bad - 4 * good[h].sum() / n_good if i not in chosen else -1.0 for i, h in enumerate(hits)]
        best = int(np.argmax(gains))
        if gains[best] < LEAST:
            break
        chosen.append(best)
        left &= ~hits[best]
    return chosen


def _good_and_bad():
    return F.sum(F.when(F.col("quality") >= 1, 1).otherwise(0)).alias("good"), F.sum(F.when(F.col("quality") < 1, 1).otherwise(0)).alias("bad")


def _per_stratum(rules: DataFrame) -> DataFrame:
    """stratum, steps: rule to step."""
    return rules.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "step"))).alias("steps"))


def _with_stratum(rows: DataFrame, other: DataFrame, how: str = "inner") -> DataFrame:
    """Joined by stratum, null being one of its own."""
    return rows.join(other.withColumnRenamed("stratum", "_stratum"), F.col("stratum").eqNullSafe(F.col("_stratum")), how).drop("_stratum")


def _reached(steps) -> list:
    """For each rule whether the row's step reaches that of the map ``steps``."""
    own = F.col("own_steps")
    return [F.coalesce(own[i] >= F.element_at(steps, F.lit(i)), F.lit(False)) for i in range(len(RULES))]


def cutoffs(measured: DataFrame, labels: DataFrame, key: str = "doc_id", risk: float = 0.05, error: float = 0.1) -> DataFrame:
    """stratum, steps: for each chosen rule the grid step from which the stratum's documents are rejected.

    All labels count.  They are counted per stratum, rule and grid step, and per
    stratum and set of rules, before anything is gathered: a group that is tested
    has at most STEPS + 1 rows, one that chooses 2 to the number of rules.
    """
    truth = labels.where("quality IS NOT NULL").groupBy(F.col(key).alias("key")).agg(F.max("quality").alias("quality"))
    choosing = (F.pmod(F.xxhash64(F.lit("part"), "text_hash"), F.lit(PARTS)) < CHOOSING).alias("choosing")
    known = measured.where(~base_failed()).join(truth, "key").select("stratum", "quality", choosing, _steps().alias("own_steps"))
    known = settle(known, "labelled")
    places = known.select("stratum", "quality", "choosing", F.posexplode("own_steps").alias("rule", "step"))
    grid = settle(places.groupBy("stratum", "choosing", "rule", "step").agg(*_good_and_bad()), "grid")
    level = error / max(1, grid.select("stratum").distinct().count())

    def guess(group: pd.DataFrame) -> pd.DataFrame:
        at = likely_cutoff(group["step"].to_numpy(), group["good"].to_numpy(), group["bad"].to_numpy(), risk)
        return pd.DataFrame({"stratum": group["stratum"][:1], "rule": group["rule"][:1], "step": pd.array([at], "Int32")})

    likely = grid.where("choosing").groupBy("stratum", "rule").applyInPandas(guess, "stratum string, rule int, step int").where("step IS NOT NULL")
    rows = _with_stratum(known.where("choosing"), _per_stratum(likely))
    mask = sum((F.when(hit, 1 << i).otherwise(0) for i, hit in enumerate(_reached(F.col("steps")))), F.lit(0))
    masks = rows.groupBy("stratum", mask.alias("mask")).agg(*_good_and_bad())
    testing = known.where(~F.col("choosing")).groupBy("stratum").agg(_good_and_bad()[0].alias("n_test"))

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        rules = choose_rules(*(group[c].to_numpy() for c in ("mask", "good", "bad")), int(group["n_test"].iloc[0]), risk, level)
        count = len(rules)
        return pd.DataFrame({"stratum": pd.Series([group["stratum"].iloc[0]] * count, dtype=object), "chosen": pd.Series(rules, dtype="int32"), "m": pd.Series([count] * count, dtype="int32")})

    chosen = _with_stratum(masks, testing).groupBy("stratum").applyInPandas(choose, "stratum string, chosen int, m int")

    def test(group: pd.DataFrame) -> pd.DataFrame:
        good, bad, m = group["good"].to_numpy(), group["bad"].to_numpy(), int(group["m"].iloc[0])
        at = safe_cutoff(group["step"].to_numpy(), good, bad, int(good.sum()), int(bad.sum()), risk / m, level / m)
        return pd.DataFrame({"stratum": group["stratum"][:1], "rule": group["rule"][:1], "step": pd.array([at], "Int32")})

    asked = _with_stratum(grid.where(~F.col("choosing")), chosen).where("rule = chosen")
    tested = asked.groupBy("stratum", "rule").applyInPandas(test, "stratum string, rule int, step int").where("step IS NOT NULL")
    return settle(_per_stratum(tested), "cutoffs")


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", stratum: str = "lang", risk: float = 0.05, error: float = 0.1) -> DataFrame:
    """The measured rows with base_failed and kept."""
    measured = settle(measure(docs, key, stratum), "measured")
    joined = _with_stratum(measured.withColumn("own_steps", _steps()), cutoffs(measured, labels, key, risk, error), "left")
    rejected = reduce(or_, _reached(F.col("steps")))
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~rejected).drop("steps", "own_steps")


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", **how) -> DataFrame:
    """The rows of ``docs`` whose text the rules keep, all columns unchanged."""
    good = judge(docs, labels, key, **how).where("kept").select(F.col("key").alias("_key"), F.col("text_hash").alias("_hash")).distinct()
    return docs.join(good, docs[key].eqNullSafe(good["_key"]) & (F.xxhash64(docs["text"]) == good["_hash"]), "left_semi")
