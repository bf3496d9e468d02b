"""The registered queries of the operators, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import forest, lexical, line_dedup, matching, mixing, packing, periodic, quality, quotations, secrets, sharding, simhash, suffix_dedup
from .common import WORD


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts of each text and the verdict of the base rule and the risk-controlled cutoffs."""
    out = quality.judge(_read(spark, folder, "documents"), _read(spark, folder, "labels"))
    return out.select(F.col("key").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_projection_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.9 or more."""
    return forest.near_duplicates(_read(spark, folder, "embeddings"))


def op3_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of each document, linked within two bits."""
    out = simhash.near_duplicates(_read(spark, folder, "documents"))
    return out.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def op4_quotation_links(spark: SparkSession, folder: str) -> DataFrame:
    """All turns, rendered as mails that quote each other, put back into threads without quotes."""
    out = quotations.conversations(quotations.as_mail(_read(spark, folder, "conversations")))
    return out.select(
        "conv_id", "turn", F.col("quotes").alias("n_quotes"), F.col("linked").alias("n_linked"), F.col("parent.scope").alias("parent_conv"), F.col("parent.seq").alias("parent_turn"),
        F.col("root.scope").alias("root_conv"), F.col("root.seq").alias("root_turn"), F.col("depth").cast("long").alias("depth"), "place", F.sha2("own", 256).alias("own_sha256"),
    )


def op5_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and runs removed from each document, and a hash of the bytes that stay."""
    out = suffix_dedup.remove_repeats(_read(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])
    return out.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        F.octet_length("kept").cast("long").alias("n_kept"), F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )


def vocabulary() -> str:
    """The default vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_min_slack_packing(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of at most 2048 ids."""
    return packing.pack(_read(spark, folder, "documents"), vocabulary())


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of each document: counts and digest of the base kinds, and all spans."""
    out = secrets.scan(_read(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return out.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op8_jump_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's shard of 16 by its id, its slot there, and its shard of 17."""
    out = sharding.shard(_read(spark, folder, "documents"), 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op9_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of each document the mix takes."""
    out = mixing.copies(mixing.sizes(_read(spark, folder, "documents")))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


OP9_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM sized GROUP BY source
), ordered AS (
  SELECT *, sum(source_size) OVER (ORDER BY 3.0 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS held,
    sum(w) OVER (ORDER BY 3.0 * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
    sum(source_size) OVER () AS total
  FROM per
), levels AS (
  -- Sources stop in the order of 3 * size / weight; the level is that of the first one that does not stop.
  SELECT (total - 3.0 * coalesce(held, 0))::DOUBLE / free AS level FROM ordered
  WHERE (total - 3.0 * coalesce(held, 0))::DOUBLE / free * w <= 3.0 * source_size
  ORDER BY 3.0 * source_size / w, source NULLS LAST LIMIT 1
), targets AS (
  SELECT source, source_size, least(level * w, 3.0 * source_size)::DOUBLE AS target FROM ordered, levels
), rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate)::BIGINT + CASE WHEN ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '~') || '|' || size::VARCHAR), 1, 12))::BIGINT
     / 281474976710656.0 < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated
"""


def op10_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: lines, cut lines and runs, and a hash of the text that is left."""
    out = line_dedup.remove_repeated_lines(_read(spark, folder, "documents"))
    cut = F.coalesce(F.aggregate("removed", F.lit(0), lambda a, r: a + r["last"] - r["first"] + 1), F.lit(0))
    return out.select(
        "doc_id", cut.cast("long").alias("n_removed_lines"), F.greatest(F.size("removed"), F.lit(0)).cast("long").alias("n_removed_runs"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


OP10_SQL = rf"""
WITH raw_lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS raw FROM documents WHERE text IS NOT NULL
), counted AS (
  SELECT *, len(regexp_extract_all(line, '{WORD}')) AS words FROM raw_lines WHERE regexp_matches(line, '{WORD}')
), placed AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY raw) - words AS seen FROM counted
), starts AS (
  SELECT doc_id, raw, max(raw) OVER w AS raw_end, sum(words) OVER w AS run_words, string_agg(line, chr(10)) OVER w AS run
  FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY seen RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
), later AS (
  SELECT doc_id, raw, raw_end FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, raw) AS nth FROM starts WHERE run_words >= 50) WHERE nth > 1
), marked AS (
  SELECT *, CASE WHEN coalesce(max(raw_end) OVER (PARTITION BY doc_id ORDER BY raw ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -2) < raw THEN 1 ELSE 0 END AS new FROM later
), islands AS (
  SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY raw) AS island FROM marked
), cuts AS (
  SELECT doc_id, min(raw) AS first, max(raw_end) AS last FROM islands GROUP BY doc_id, island
), gone AS (
  SELECT DISTINCT r.doc_id, r.raw FROM raw_lines r JOIN cuts c ON r.doc_id = c.doc_id AND r.raw BETWEEN c.first AND c.last
), kept AS (
  SELECT r.doc_id, string_agg(r.line, chr(10) ORDER BY r.raw) AS text FROM raw_lines r LEFT JOIN gone g ON r.doc_id = g.doc_id AND r.raw = g.raw WHERE g.raw IS NULL GROUP BY r.doc_id
)
SELECT d.doc_id, coalesce((SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id), 0)::BIGINT AS n_removed_lines,
  coalesce((SELECT count(*) FROM cuts c WHERE c.doc_id = d.doc_id), 0)::BIGINT AS n_removed_runs,
  CASE WHEN d.text IS NULL THEN NULL ELSE sha256(coalesce(k.text, '')) END AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The runs of each text, one in ten of which repeats its own words from some place on, and a hash of what is left without them."""
    docs = _read(spark, folder, "documents")
    text = periodic.planted(F.col("doc_id"), F.col("text"))
    return periodic.digest(periodic.periodic_runs(docs.select("doc_id", text.alias("text"))))


def op12_mask_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 best documents of each benchmark item."""
    return lexical.search(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


OP12_SQL = r"""
WITH said AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[0-9A-Za-z\x{80}-\x{10FFFF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM documents
), per AS (
  SELECT doc_id, term, count(*)::BIGINT AS tf FROM said GROUP BY doc_id, term
), lengths AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM per GROUP BY doc_id
), total AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lengths
), factors AS (
  SELECT doc_id, 50 + (50 * n * docs) // terms AS m FROM lengths, total
), asked AS (
  SELECT DISTINCT item_id, translate(unnest(regexp_extract_all(text, '[0-9A-Za-z\x{80}-\x{10FFFF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM benchmark
), weights AS (
  SELECT term, floor(1000 * ln((2 * max(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM per, total GROUP BY term
), scored AS (
  SELECT item_id, per.doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN per ON asked.term = per.term JOIN weights ON weights.term = per.term JOIN factors ON factors.doc_id = per.doc_id GROUP BY item_id, per.doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def op13_window_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each document, those in windows of a document with a smaller id, and the words that stay."""
    out = matching.remove_windows(_read(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])
    return out.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"), F.col("kept").alias("text"))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_projection_forest, op3_simhash_groups, op4_quotation_links, op5_suffix_repeats, op6_min_slack_packing, op7_secret_scan,
        op8_jump_shards, op9_mix_sources, op10_line_runs, op11_periodic_runs, op12_mask_search, op13_window_matches,
    )
}
_ORACLES = {"op9_mix_sources": OP9_SQL, "op10_line_runs": OP10_SQL, "op12_mask_search": OP12_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
