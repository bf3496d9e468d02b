"""Resolving filer names to member keys, year-aware and in tiers.

The candidate pairs (filing, roster entry with the same last name) are never
built: a common last name would make that product explode.  Two smaller facts
about each last name answer the same questions.

* How many entries overlap a year, and which one when it is a single one: a
  sweep over term starts and ends, bounded by the number of years.
* Which entry wins for a given first name and year: an equality join on
  (last, first), against the roster folded to one row per
  (last, first, first year, last year).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import names as nm
from ..functions import text as tx
from ..session import settle

_NUM = "decimal(38,0)"


def term_bounds(roster: DataFrame) -> DataFrame:
    """First and last year over all term dates; unreadable dates are skipped."""
    years = F.filter(
        F.flatten(
            F.transform(
                "terms",
                lambda t: F.array(
                    F.substring(t["start"], 1, 4).try_cast("int"),
                    F.substring(t["end"], 1, 4).try_cast("int"),
                ),
            )
        ),
        lambda y: y.isNotNull(),
    )
    return roster.withColumns(
        {
            "min_year": F.coalesce(F.array_min(years), F.lit(1789)),
            "max_year": F.coalesce(
                F.array_max(years), F.when(F.col("is_historical"), 1900).otherwise(2099)
            ),
        }
    )


def first_variants(first: Column, nick: Column, official: Column) -> Column:
    """Normalised first-name forms of a roster entry, expansions included."""
    forms = F.array(
        nm.fold_accents(first), nm.fold_accents(nick), nm.fold_accents(nm.first_word(official))
    )
    forms = F.array_distinct(F.filter(forms, lambda x: x.isNotNull() & (x != "")))
    more = F.filter(F.transform(forms, nm.nickname), lambda x: x.isNotNull())
    return F.array_sort(F.array_distinct(F.concat(forms, more)))


def name_index(roster: DataFrame) -> DataFrame:
    """(last, bioguide, firsts, min_year, max_year, seq) from nested roster rows.

    Order of preference on equal years: historical, current, manual last
    names, principals.  ``seq`` of the input rows must follow the file order.
    """
    base = term_bounds(roster).select(
        nm.fold_accents(F.col("name.last")).alias("last"),
        F.col("id.bioguide").alias("bioguide"),
        first_variants(
            F.col("name.first"), F.col("name.nickname"), F.col("name.official_full")
        ).alias("firsts"),
        "min_year",
        "max_year",
        F.col("seq").cast("bigint").alias("seq"),
        "is_historical",
    ).where(F.col("bioguide").isNotNull() & (F.col("last") != ""))
    return with_manual_entries(base)


def with_manual_entries(index: DataFrame) -> DataFrame:
    """Add copies under manual last names and the principals, after all others.

    Ranks only have to sort right, so each kind gets its own band of numbers.
    """
    spark = index.sparkSession
    band = 10**15
    ranked = index.withColumn(
        "seq",
        F.col("seq") + F.when(F.col("is_historical"), 0).otherwise(band),
    ).drop("is_historical")
    manual = spark.createDataFrame(
        [(a, b) for a, b in fv.MANUAL_LAST_NAMES.items()], "alias string, last string"
    )
    copies = (
        ranked.join(F.broadcast(manual), "last")  # fixed list of five
        .withColumns({"last": F.col("alias"), "seq": F.col("seq") + 2 * band})
        .select(*ranked.columns)
    )
    people = spark.createDataFrame(
        [
            (last, key, sorted(firsts), lo, hi, 4 * band + i)
            for i, (key, last, firsts, lo, hi) in enumerate(fv.PRINCIPAL_INDEX)
        ],
        "last string, bioguide string, firsts array<string>, min_year int, max_year int, seq bigint",
    ).select(*ranked.columns)
    return ranked.unionByName(copies).unionByName(people)


def overlap_counts(index: DataFrame, points: DataFrame) -> DataFrame:
    """For each (last, year): entries overlapping it, all entries, and the single one.

    ``index``: last, min_year, max_year, seq.  ``points``: distinct (last, year).
    An entry overlaps when min_year <= year + 1 and max_year >= year - 1.
    Both inputs of the window hold at most one row per (last, year).
    """
    seq = F.col("seq").cast(_NUM)
    edges = index.select(
        "last",
        F.explode(
            F.array(
                F.struct(
                    (F.col("min_year") - 1).alias("at"), F.lit(1).alias("n"), seq.alias("s")
                ),
                F.struct(
                    (F.col("max_year") + 2).alias("at"), F.lit(-1).alias("n"), (-seq).cast(_NUM).alias("s")
                ),
            )
        ).alias("e"),
    )
    edges = edges.groupBy("last", F.col("e.at").alias("at")).agg(
        F.sum("e.n").alias("n"), F.sum(F.col("e.s")).cast(_NUM).alias("s")
    )
    totals = index.groupBy("last").agg(
        F.count(F.lit(1)).alias("n_all"), F.sum(seq).cast(_NUM).alias("s_all")
    )
    asked = points.where(F.col("year").isNotNull() & F.col("last").isNotNull())
    timeline = edges.select("last", "at", F.lit(0).alias("ask"), "n", "s").unionByName(
        asked.select(
            "last",
            F.col("year").alias("at"),
            F.lit(1).alias("ask"),
            F.lit(0).cast("bigint").alias("n"),
            F.lit(0).cast(_NUM).alias("s"),
        )
    )
    w = (
        Window.partitionBy("last")
        .orderBy("at", "ask")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    swept = (
        timeline.withColumns({"n_ok": F.sum("n").over(w), "s_ok": F.sum("s").over(w).cast(_NUM)})
        .where(F.col("ask") == 1)
        .select("last", F.col("at").alias("year"), "n_ok", "s_ok")
    )
    unknown = points.where(F.col("year").isNull() & F.col("last").isNotNull()).select(
        "last", "year", F.lit(0).cast("bigint").alias("n_ok"), F.lit(0).cast(_NUM).alias("s_ok")
    )
    n = F.when(F.col("n_ok") > 0, F.col("n_ok")).otherwise(F.col("n_all"))
    s = F.when(F.col("n_ok") > 0, F.col("s_ok")).otherwise(F.col("s_all"))
    return (
        swept.unionByName(unknown)
        .join(totals, "last")
        .select(
            "last", "year", "n_ok", "n_all", n.alias("n"),
            F.when(n == 1, s.cast("bigint")).alias("only_seq"),
        )
    )


def normal_names(names: DataFrame, last: str, first: str) -> DataFrame:
    """Add last_n, first_n and the first-name tries as ARRAY<STRUCT<tier, key>>."""
    before_comma = tx.strip_all(F.substring_index(F.col(last), ",", 1))
    out = names.withColumns(
        {
            "last_n": nm.fold_accents(
                F.when(F.contains(F.col(last), F.lit(",")), before_comma).otherwise(F.col(last))
            ),
            "first_n": nm.fold_accents(
                nm.strip_credentials(nm.strip_hon_prefix(F.coalesce(F.col(first), F.lit(""))))
            ),
        }
    )
    f = F.col("first_n")
    fw, lw = nm.first_word(f), nm.last_word(f)
    several = F.contains(f, F.lit(" "))
    tries = F.array(
        F.struct(F.lit(1).alias("tier"), f.alias("key")),
        F.struct(F.lit(2).alias("tier"), F.when(several & (fw != f), fw).alias("key")),
        F.struct(F.lit(3).alias("tier"), F.when(several & (lw != fw), lw).alias("key")),
        F.struct(F.lit(4).alias("tier"), nm.nickname(f).alias("key")),
    )
    return out.withColumn("tries", F.filter(tries, lambda t: t["key"].isNotNull()))


def resolve_names(
    names: DataFrame, index: DataFrame, last: str = "last_name", first: str = "first_name",
    year: str | None = "year", out: str = "bioguide",
) -> DataFrame:
    """Add the member key and the tier that found it to each row of ``names``.

    ``index`` is read by several branches; pass a stored table, not a long plan.

    Tiers: 1 whole first name, 2 its first word, 3 its last word, 4 its other
    form, 5 the only entry of that last name.  Within a tier the entry serving
    latest wins, then the one listed first.
    """
    y = F.col(year).cast("int") if year else F.lit(None).cast("int")
    asked = names.select(
        F.col(last).alias("__last"), F.col(first).alias("__first"), F.nullif(y, F.lit(0)).alias("year")
    ).distinct()
    # Distinct names only, read by three branches below.
    q = settle(normal_names(asked, "__last", "__first"), "names")
    spans = overlap_counts(
        index, q.select(F.col("last_n").alias("last"), "year").distinct()
    )
    q = _join_spans(q, spans)
    by_first = (
        index.select("last", "bioguide", "min_year", "max_year", "seq", F.explode("firsts").alias("key"))
        .groupBy("last", "key", "min_year", "max_year")
        .agg(F.min(F.struct("seq", "bioguide")).alias("e"))
    )
    tried = q.select(
        "__last", "__first", "year", "last_n", "n_ok", F.explode("tries").alias("t")
    ).select("*", F.col("t.tier").alias("tier"), F.col("t.key").alias("key"))
    hits = (
        tried.join(by_first.withColumnRenamed("last", "last_n"), ["last_n", "key"])
        .where(
            F.col("year").isNull()
            | (F.col("n_ok") == 0)
            | ((F.col("min_year") <= F.col("year") + 1) & (F.col("max_year") >= F.col("year") - 1))
        )
        .groupBy("__last", "__first", "year")
        .agg(
            F.min(
                F.struct(
                    F.col("tier"), (-F.col("max_year")).alias("latest"), F.col("e.seq"), F.col("e.bioguide")
                )
            ).alias("hit")
        )
        .select(
            F.col("__last").alias("__hl"), F.col("__first").alias("__hf"), F.col("year").alias("__hy"),
            F.col("hit.tier").alias("__tier"), F.col("hit.bioguide").alias("__hit"),
        )
    )
    singles = index.select(
        F.col("last").alias("__sl"), F.col("seq").alias("__ss"), F.col("bioguide").alias("__single")
    )
    found = (
        q.join(
            hits,
            F.col("__last").eqNullSafe(F.col("__hl"))
            & F.col("__first").eqNullSafe(F.col("__hf"))
            & F.col("year").eqNullSafe(F.col("__hy")),
            "left",
        )
        .join(
            singles,
            (F.col("last_n") == F.col("__sl")) & (F.col("only_seq") == F.col("__ss")),
            "left",
        )
        .select(
            "__last", "__first", F.col("year").alias("__year"),
            F.coalesce("__hit", "__single").alias(out),
            F.coalesce(F.col("__tier"), F.when(F.col("__single").isNotNull(), 5)).alias("tier"),
        )
    )
    rows = names.withColumn("__y", F.nullif(y, F.lit(0)))
    return rows.join(
        found,
        F.col(last).eqNullSafe(F.col("__last"))
        & F.col(first).eqNullSafe(F.col("__first"))
        & F.col("__y").eqNullSafe(F.col("__year")),
        "left",
    ).drop("__last", "__first", "__year", "__y")


def _join_spans(q: DataFrame, spans: DataFrame) -> DataFrame:
    side = spans.select(
        F.col("last").alias("__pl"), F.col("year").alias("__py"), "n_ok", "n_all", "n", "only_seq"
    )
    return q.join(
        side,
        (F.col("last_n") == F.col("__pl")) & F.col("year").eqNullSafe(F.col("__py")),
    ).drop("__pl", "__py")
