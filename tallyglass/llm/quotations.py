"""Quotation linking: replies find their originals by what they quote, and conversations lose the quotes.

A line's quote level is the number of ``>`` marks it starts with.  Consecutive
lines of one level form a passage; passages and their longer lines are
normalised (case, white space) and hashed.  An original's whole text, its
paragraphs and its longer lines are hashed the same way.  A quoted unit belongs
to the earliest message that says it, one of the same scope before all others,
and only if that message is older than the quoting one.  A passage is settled by
its whole text, else by its longest line that is found.  The shallowest passage
that is found, first in the text, gives the message it replies to.  Threads
follow from pointer doubling; a reply's place is after its thread's shallower
messages.

Messages are ordered by (seq, scope, text hash), nulls first.  Each hash is
reduced to its first message before it is joined, so a phrase that very many
messages share adds one row a message, and a hot hash can be split.

Edge cases: null and empty texts say and quote nothing and stay; a text of
quotes alone becomes empty; quotes without an original are removed but link
nothing; rows that repeat scope, seq and text are one message with one place;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, settle, word_count

MARKS = r"^((?:>[ \t]?)+)"
ATTRIBUTION = r"(?i)^\s*(?:on\b.*)?\bwrote:\s*$"
#: Single lines count as units of their own from this many words.
LINE_WORDS = 5


def quote_level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", ""))


def normalised(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def unit_hash(text: Column) -> Column:
    return F.md5(normalised(text))


def quoted(text: Column) -> Column:
    """``text`` with one more quote level on every line."""
    return F.regexp_replace(text, r"(?m)^", "> ")


def _parsed(messages: DataFrame, scope: str, seq: str) -> DataFrame:
    """key, scope, lines (level, body), own: each distinct message with its own text."""
    key = F.struct(F.col(seq).alias("seq"), F.col(scope).alias("scope"), F.xxhash64("text").alias("h"))
    rows = messages.select(key.alias("key"), F.col(scope).alias("scope"), "text").distinct()
    line = F.transform(F.split("text", "\n"), lambda x: F.struct(quote_level(x).alias("level"), F.regexp_replace(x, MARKS, "").alias("body")))
    rows = rows.withColumn("all_lines", line)
    # "... wrote:" above a deeper quote belongs to nobody, at any level.
    deeper = lambda x, i: F.coalesce(F.get("all_lines", i + 1)["level"] > x["level"], F.lit(False))
    rows = rows.withColumn("lines", F.filter("all_lines", lambda x, i: ~(x["body"].rlike(ATTRIBUTION) & deeper(x, i))))
    mine = F.filter("lines", lambda x: x["level"] == 0)
    own = F.regexp_replace(F.array_join(F.transform(mine, lambda x: x["body"]), "\n"), r"\A\s+|\s+\z", "")
    return rows.select("key", "scope", "lines", own.alias("own"))


def _said(parsed: DataFrame) -> DataFrame:
    """hash, scope, key: every unit that a message says itself."""
    lines = F.filter(F.split("own", "\n"), lambda x: word_count(x) >= LINE_WORDS)
    units = F.array_distinct(F.concat(F.array("own"), F.split("own", r"\n\s*\n"), lines))
    return parsed.select("key", "scope", F.explode(units).alias("unit")).where(word_count(F.col("unit")) > 0).select(unit_hash(F.col("unit")).alias("hash"), "scope", "key")


def passages(parsed: DataFrame) -> DataFrame:
    """key, scope, level, pos, body: the quoted passages of each message."""
    lines = parsed.select("key", "scope", F.posexplode("lines").alias("pos", "line")).select("key", "scope", "pos", "line.level", "line.body").where("level > 0")
    own = Window.partitionBy("key", "level").orderBy("pos")
    block = lines.withColumn("island", F.col("pos") - F.row_number().over(own))
    grouped = block.groupBy("key", "scope", "level", "island").agg(F.min("pos").alias("pos"), F.sort_array(F.collect_list(F.struct("pos", "body"))).alias("b"))
    return grouped.select("key", "scope", "level", "pos", F.array_join(F.col("b.body"), "\n").alias("body")).where(word_count(F.col("body")) > 0)


def quote_links(parsed: DataFrame) -> DataFrame:
    """key, level, pos, origin for each quoted passage; origin is null where nobody said it before."""
    said = _said(parsed)
    anywhere = said.groupBy("hash").agg(F.min("key").alias("first"))
    nearby = said.groupBy("hash", "scope").agg(F.min("key").alias("near")).withColumnRenamed("scope", "_scope").withColumnRenamed("hash", "_hash")
    lines = F.filter(F.split("body", "\n"), lambda x: word_count(x) >= LINE_WORDS)
    units = F.array_distinct(F.concat(F.array("body"), lines))
    asked = passages(parsed).select("key", "scope", "level", "pos", F.posexplode(units).alias("part", "unit"))
    asked = asked.select("key", "scope", "level", "pos", (F.col("part") > 0).alias("partly"), unit_hash(F.col("unit")).alias("hash"), (-word_count(F.col("unit"))).alias("size"))
    met = asked.join(anywhere, "hash", "left").join(nearby, (F.col("hash") == F.col("_hash")) & F.col("scope").eqNullSafe(F.col("_scope")), "left")
    near = F.when(F.col("near") < F.col("key"), F.col("near"))
    origin = F.coalesce(near, F.when(F.col("first") < F.col("key"), F.col("first")))
    ranked = met.select("key", "level", "pos", F.when(origin.isNotNull(), F.struct("partly", near.isNull().alias("far"), "size", origin.alias("origin"))).alias("found"))
    return ranked.groupBy("key", "level", "pos").agg(F.min("found").alias("found")).select("key", "level", "pos", F.col("found.origin").alias("origin"))


def threads(parents: DataFrame) -> DataFrame:
    """key, parent, root, depth from key and parent (null at a root), by doubling the distance looked up each round.

    Messages whose root is known take no part in later rounds except to be looked up.
    """
    root = F.col("parent").isNull()
    state = settle(parents.select("key", "parent", F.coalesce("parent", "key").alias("up"), F.when(root, 0).otherwise(1).alias("depth"), root.alias("known")), "threads")
    active = state.where("NOT known")
    while not active.isEmpty():
        over = state.select(F.col("key").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("more"), F.col("known").alias("known2"))
        ahead = settle(active.drop("known").join(over, "up").select("key", "parent", F.col("up2").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), F.col("known2").alias("known")), "threads")
        state = state.where("known").unionAll(ahead)
        active = ahead.where("NOT known")
    return state.select("key", "parent", F.col("up").alias("root"), "depth")


def conversations(messages: DataFrame, scope: str = "conv_id", seq: str = "turn") -> DataFrame:
    """One row for each row of ``messages``: scope, seq, own text, quotes, linked quotes, parent, root, depth, place.

    parent and root are (seq, scope, h) structs; place counts from 0 in each thread.
    """
    parsed = settle(_parsed(messages, scope, seq), "parsed")
    links = settle(quote_links(parsed), "quotes")
    best = F.min(F.when(F.col("origin").isNotNull(), F.struct("level", "pos", "origin")))
    per = links.groupBy("key").agg(F.count("*").alias("quotes"), F.count("origin").alias("linked"), best.alias("best")).withColumn("parent", F.col("best.origin")).drop("best")
    joined = parsed.select("key", "own").join(per, "key", "left")
    tree = threads(joined.select("key", "parent"))
    placed = numbered(tree, "nth", F.col("root"), F.col("depth"), F.col("key"))
    firsts = placed.groupBy("root").agg(F.min("nth").alias("start"))
    placed = placed.join(firsts, "root").withColumn("place", F.col("nth") - F.col("start")).drop("nth", "start")
    full = placed.join(joined.select("key", "own", "quotes", "linked"), "key").withColumnRenamed("key", "_key")
    rows = messages.select(F.col(scope), F.col(seq), F.struct(F.col(seq).alias("seq"), F.col(scope).alias("scope"), F.xxhash64("text").alias("h")).alias("_mine"))
    none = F.lit(0).cast("long")
    return rows.join(full, F.col("_mine") == F.col("_key")).select(
        scope, seq, "own", F.coalesce("quotes", none).alias("quotes"), F.coalesce("linked", none).alias("linked"), "parent", "root", "depth", "place"
    )


def as_mail(turns: DataFrame, block: int = 4096) -> DataFrame:
    """conv_id, turn, text: each turn as a mail that quotes the turn before it, and that one's own quote of the turn before.

    The quoted depth is two, so a mail is at most three turns long.  All turns are
    numbered by conversation, turn and text hash and read in blocks of ``block``
    numbers, each with the two turns before it; so no task holds a conversation.
    """
    placed = numbered(turns.select("conv_id", "turn", "text"), "nth", F.col("conv_id"), F.col("turn"), F.xxhash64("text"))
    home = F.floor(F.col("nth") / block)
    also = F.when(F.col("nth") % block >= block - 2, F.array(home, home + 1)).otherwise(F.array(home))
    spread = placed.withColumn("home", home).withColumn("block", F.explode(also))
    order = Window.partitionBy("block").orderBy("nth")
    back = lambda k: F.coalesce(F.when(F.lag("conv_id", k).over(order).eqNullSafe(F.col("conv_id")), F.lag("text", k).over(order)), F.lit(""))
    rows = spread.select("conv_id", "turn", "text", "home", "block", back(1).alias("one"), back(2).alias("two")).where("home = block")
    has = lambda c: word_count(F.col(c)) > 0
    inner = F.when(has("two"), F.concat(F.lit("\n> On the day before, they wrote:\n"), quoted(quoted(F.col("two"))))).otherwise("")
    reply = F.when(has("one"), F.concat(F.lit("\n\nOn that day, they wrote:\n"), quoted(F.col("one")), inner)).otherwise("")
    return rows.select("conv_id", "turn", F.concat(F.coalesce("text", F.lit("")), reply).alias("text"))
