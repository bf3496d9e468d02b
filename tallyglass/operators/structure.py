"""Recovering records from irregular tables and text lines."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import text as tx
from ..functions import values as vl
from ..session import settle
from .joins import best_row
from .ordered import CHUNK, Order, by_document, fold, running, sized

# -- cells -------------------------------------------------------------------


def cell(cells: Column, i: int | Column, drop_del: bool = False) -> Column:
    index = F.lit(i) if isinstance(i, int) else i
    return F.coalesce(tx.clean(F.get(cells, index), drop_del), F.lit(""))


def clean_cells(cells: Column, drop_del: bool = False) -> Column:
    return F.transform(cells, lambda c: tx.clean(c, drop_del))


def row_text(cells: Column) -> Column:
    return F.lower(F.array_join(F.filter(cells, lambda c: c != ""), " "))


def is_asset_header(cells: Column) -> Column:
    t = row_text(cells)
    return F.contains(t, F.lit("asset")) & t.rlike("value|income")


def is_ptr_header(cells: Column) -> Column:
    return F.exists(cells, lambda c: F.lower(c).rlike("transaction|amount"))


def is_smashed(cells: Column) -> Column:
    """All the text of the row ended up in its first cell."""
    rest = F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 1, F.lit(0)))
    return (cell(cells, 0) != "") & F.forall(rest, lambda c: tx.clean(c) == "")


def holding_layout(cells: Column) -> Column:
    """Owner, value, income type and income of a cleaned five- or six-column row."""
    names = ["owner", "value", "income_type", "income"]

    def pick(six: Column) -> Column:
        start = F.when(six, 3).otherwise(2)
        return tx.let(
            F.slice(cells, start, F.lit(4)),
            lambda part: F.struct(
                six.alias("six_columns"),
                *[
                    F.coalesce(F.get(part, F.lit(i)), F.lit("")).alias(n)
                    for i, n in enumerate(names)
                ],
            ),
        )

    return tx.let(F.coalesce(vl.has_money(F.get(cells, F.lit(3))), F.lit(False)), pick)


Rule = Callable[[Column], Column]


def _has(*words: str) -> Rule:
    def rule(h: Column) -> Column:
        tests = [F.contains(h, F.lit(w)) for w in words]
        return reduce(or_, tests)

    return rule


def _has_not(word: str, *unless: str) -> Rule:
    return lambda h: _has(word)(h) & ~_has(*unless)(h)


HOUSE_ROLES: dict[str, Rule] = {
    "asset": _has_not("asset", "type"),
    "asset_type": _has_not("type", "transaction"),
    "owner": _has("owner"),
    "tx_type": _has("transaction type", "trans type"),
    "tx_date": lambda h: _has("transaction date")(h) | _has_not("date", "notif")(h),
    "disc_date": _has("notif"),
    "amount": _has("amount"),
    "comment": _has("comment", "description"),
}
SENATE_ROLES: dict[str, Rule] = {
    "asset": lambda h: _has("asset name")(h) | _has_not("asset", "type")(h),
    "asset_type": _has("asset type"),
    "owner": _has("owner"),
    "tx_type": _has("transaction type"),
    "amount": _has("amount"),
    "tx_date": lambda h: _has("transaction date")(h) | _has_not("date", "notif")(h),
    "disc_date": _has("notif", "disclosure"),
    "comment": _has("comment"),
}


def column_map(header: Column, roles: dict[str, Rule]) -> Column:
    """STRUCT<role: 1-based position of the first matching header cell, NULL if none>."""

    def positions(low: Column) -> Column:
        return F.struct(
            *[
                F.nullif(
                    F.array_position(F.transform(low, rule), F.lit(True)).cast("int"), F.lit(0)
                ).alias(role)
                for role, rule in roles.items()
            ]
        )

    return tx.let(F.transform(header, lambda c: F.lower(tx.clean(c, True))), positions)


def mapped(cells: Column, roles: Column, role: str) -> Column:
    at = roles[role]
    return F.when(at.isNull(), "").otherwise(cell(cells, at - 1, True))


def picked(cells: Column, roles: Column, role: str) -> Column:
    """:func:`mapped` of cells that are clean already."""
    return F.coalesce(F.get(cells, roles[role] - 1), F.lit(""))


def _cleaned(rows: DataFrame, cells: Column) -> DataFrame:
    """Add ``clean``, each cell cleaned once.

    The outer explode keeps tests on what is read from it above the cleaning.
    """
    return rows.withColumn("clean", F.explode_outer(F.array(clean_cells(cells, True))))


# -- House annual tables -----------------------------------------------------


def house_rows(cells: DataFrame, order: Order) -> DataFrame:
    """Row classes, layout and running section/entry numbers of annual tables."""
    c = clean_cells(F.col("cells"))
    order = sized(cells, order)
    rows = by_document(cells, order).withColumn("cells", c)
    lay = holding_layout(F.col("cells"))
    rows = rows.withColumns(
        {
            "header": is_asset_header(F.col("cells")),
            "asset": tx.clean_asset(F.coalesce(F.get("cells", F.lit(0)), F.lit(""))),
            "lay": lay,
            "filled": F.exists(F.col("cells"), lambda x: x != ""),
        }
    ).select("*", "lay.*").drop("lay")
    dated = (F.col("value") != "") & F.col("value").rlike(fv.DATE_CELL)
    body = (
        ~F.col("header")
        & F.col("filled")
        & ~((F.col("asset") != "") & F.col("asset").rlike(r"^\d\. "))
    )
    named = F.col("asset") != ""
    emit = body & ~dated & named & vl.has_money(F.concat("value", "income", "asset"))
    more = body & ~dated & named & ~vl.has_money("value") & ~emit
    rows = rows.withColumns({"body": body, "dated": body & dated, "emit": emit, "more": more}).drop("cells", "filled")
    return running(
        rows,
        order,
        in_section=("max", F.col("header").cast("int")),
        entry=("sum", (F.col("emit") | F.col("header")).cast("int")),
    ).withColumn("in_section", F.col("in_section") == 1)


def house_holdings(cells: DataFrame, order: Order) -> DataFrame:
    """One row per holding; name-only rows after it are joined to its name."""
    rows = house_rows(cells, order).where(
        F.col("in_section") & (F.col("emit") | F.col("more"))
    )
    own = {
        n: F.when(F.col("emit"), F.col(n)) for n in ("owner", "value", "income_type", "income")
    }
    return (
        fold(
            rows,
            [*order.keys, "entry"],
            order.position(),
            concat={"asset": F.col("asset")},
            first=own,
            total={"emits": F.col("emit").cast("int")},
        )
        .where(F.col("emits") > 0)
        .drop("emits")
    )


def house_quality_flags(cells: DataFrame, order: Order) -> DataFrame:
    """One row per parse problem: category and the offending text."""
    rows = house_rows(cells, order).where(F.col("in_section") & F.col("body"))
    flags = F.array(
        F.when(F.col("dated"), F.struct(F.lit("date-in-value-skipped").alias("category"), F.col("value").alias("sample"))),
        F.when(
            ~F.col("dated") & (F.col("income") != "") & F.col("income").rlike(fv.TX_TYPE_CELL),
            F.struct(F.lit("tx-type-in-income").alias("category"), F.col("income").alias("sample")),
        ),
        F.when(
            ~F.col("dated") & (F.col("asset") == "") & vl.has_money("value"),
            F.struct(F.lit("empty-asset").alias("category"), F.col("value").alias("sample")),
        ),
    )
    return rows.select(
        *order.keys, *order.by, F.explode(F.filter(flags, lambda x: x.isNotNull())).alias("flag")
    ).select(*order.keys, *order.by, "flag.*")


# -- Senate annual tables ----------------------------------------------------


def senate_holdings(reports: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Rows of each report's first asset table, by position, headers dropped; ``reports`` as :func:`html_report` gives them."""

    def headed(table: Column, word: str) -> Column:
        heads = F.filter(table["rows"], lambda r: r["is_header"])
        return F.exists(heads, lambda r: F.contains(F.lower(F.array_join(clean_cells(r["cells"]), " ")), F.lit(word)))

    first = F.get(F.filter("tables", lambda t: headed(t, "asset") & headed(t, "value")), F.lit(0))
    rows = reports.select(doc, first.alias("t")).select(doc, F.col("t.table_no").alias("table_no"), F.explode("t.rows").alias("r"))
    data = rows.where(~F.col("r.is_header") & (F.size("r.cells") >= 7))
    names = ["asset", "asset_type", "owner", "value", "income_type", "income"]
    return (
        data.select(doc, "table_no", F.col("r.row_no").alias("row_no"), clean_cells(F.col("r.cells")).alias("cells"))
        .select(doc, "table_no", "row_no", *[F.get("cells", F.lit(i + 1)).alias(n) for i, n in enumerate(names)])
        .where(~F.lower("asset").isin("asset", ""))
    )


# -- judiciary text ----------------------------------------------------------


def is_judicial_noise(line: Column) -> Column:
    return (
        line.rlike(fv.JUDICIAL_LEGEND)
        | line.rlike(fv.JUDICIAL_PAGE)
        | tx.contains_any(line, fv.JUDICIAL_NOISE)
    )


def judicial_entries(lines: DataFrame, order: Order) -> DataFrame:
    """Numbered entries with their codes; ``own`` is NULL where a name is inherited."""
    order = sized(lines, order)
    ln = by_document(lines, order).withColumn("line", tx.strip_all("line"))
    line = F.col("line")
    usable = (line != "") & ~is_judicial_noise(line)
    numbered, rest = F.col("number") != "", F.col("rest")
    ln = ln.withColumns({"number": F.regexp_extract(line, r"^(\d+)\.\s+", 1), "rest": tx.strip_all(F.regexp_extract(line, r"^\d+\.\s+(.*)", 1))})
    ln = ln.withColumns(
        {
            "opens": F.contains(line, F.lit("VII."))
            | F.contains(F.upper(line), F.lit("INVESTMENTS AND TRUSTS")),
            "numbered": usable & numbered,
            "usable": usable,
            "continued": numbered & rest.rlike(fv.JUDICIAL_CONTINUED),
            "body": F.when(
                numbered, tx.strip_all(F.regexp_replace(rest, fv.JUDICIAL_CONTINUED, ""))
            ).otherwise(line),
        }
    ).drop("rest")
    ln = running(
        ln,
        order,
        opened=("sum", F.col("opens").cast("int")),
        entry=("sum", F.col("numbered").cast("int")),
    ).where(F.col("usable") & (F.col("opened") > F.col("opens").cast("int")))
    ln = ln.withColumn("c", vl.parse_codes("body"))
    coded = F.col("numbered") | (F.col("c.value_code") != "") | (F.col("c.tx_date") != "")
    inherits = F.col("continued") | (F.col("c.text") == "")

    def code(name: str) -> Column:
        return F.when(coded & (F.col(f"c.{name}") != ""), F.col(f"c.{name}"))

    deal = F.when(
        F.col("c.tx_date") != "",
        F.struct("c.tx_type", "c.tx_date", "c.tx_value", "c.tx_gain"),
    )
    folded = fold(
        ln,
        [*order.keys, "entry"],
        order.position(),
        concat={
            "more": F.when(
                ~F.col("numbered"), F.when(coded, F.col("c.text")).otherwise(F.col("body"))
            )
        },
        first={
            "number": F.when(F.col("numbered"), F.col("number")),
            "own": F.when(F.col("numbered") & ~inherits, F.col("c.text")),
        },
        last={
            **{n: code(n) for n in ("value_code", "income_code", "income_type", "method_code")},
            "deal": deal,
        },
        total={"added": (~F.col("numbered")).cast("int")},
    )
    blank = F.lit("")
    return folded.where(F.col("number").isNotNull()).select(
        *order.keys,
        "entry",
        F.col("number"),
        "own",
        F.when(F.col("added") > 0, F.col("more")).alias("more"),
        *[
            F.coalesce(F.col(n), blank).alias(n)
            for n in ("value_code", "income_code", "income_type", "method_code")
        ],
        *[
            F.coalesce(F.col("deal")[n], blank).alias(n)
            for n in ("tx_type", "tx_date", "tx_value", "tx_gain")
        ],
    )


def _strip_markers(text: Column, times: Column) -> Column:
    once = tx.strip_class_marker(text)
    more = tx.strip_all(
        F.regexp_replace(
            text,
            F.concat(F.lit(r"(?:\s*\([A-Z]\)){0,"), times.cast("string"), F.lit(r"}\s*$")),
            F.lit(""),
        )
    )
    return F.when(times <= 1, once).otherwise(more)


def inherit_names(entries: DataFrame, keys: list[str], drop_arrows: bool, cut: int = 65536, whole: bool = False) -> DataFrame:
    """Give unnamed entries the name of the entry kept before them.

    The input holds only the entries that will be kept.  A name grows by the
    text appended to inheriting entries, and loses one trailing class marker
    per entry that passes it on, so the pieces of a name are kept apart until
    the number of passes is known.  ``whole``: no document has more entries
    than ``cut``.
    """
    text = F.concat_ws(" ", "own", "more")
    heads = F.col("own").isNotNull()
    if drop_arrows:
        heads = heads | F.coalesce(F.contains("more", F.lit("⇒")), F.lit(False))
        text = F.regexp_replace(text, r"^.*⇒\s*", "")
    order = Order(keys, ["entry"], cut, whole=whole)
    piece = tx.strip_all(text)
    rows = entries.withColumns(
        {
            "head": heads,
            "piece": F.when(heads | F.col("more").isNotNull(), piece),
        }
    )
    rows = running(
        rows,
        order,
        island=("sum", F.col("head").cast("int")),
        part=("sum", F.col("piece").isNotNull().cast("int")),
        seen=("sum", F.lit(1)),
    )
    if whole:
        # Read twice: for the parts and for the names.
        rows = settle(rows, "entries")
    parts = fold(
        rows,
        [*keys, "island", "part"],
        F.col("entry"),
        first={"text": F.col("piece"), "start": F.col("seen")},
        total={"passes": F.lit(1)},
    ).select(*keys, "island", "part", "text", "start", "passes")
    final = F.when(F.col("text").isNotNull(), _strip_markers(F.col("text"), F.col("passes")))
    by_part = Order([*keys, "island"], ["part"], cut, whole=whole)
    parts = parts.withColumn("final", final)
    parts = running(parts, by_part, upto=("concat", F.nullif(F.col("final"), F.lit(""))))
    # Text of the parts before this one: the running text without its own end.
    before = F.when(
        F.coalesce(F.col("final"), F.lit("")) == "", F.col("upto")
    ).otherwise(F.expr("substring(upto, 1, greatest(length(upto) - length(final) - 1, 0))"))
    parts = parts.select(*keys, "island", "part", "text", "start", before.alias("before"))
    named = rows.drop(CHUNK).join(parts, [*keys, "island", "part"])
    current = _strip_markers(F.col("text"), (F.col("seen") - F.col("start") + 1))
    name = F.concat_ws(
        " ", F.nullif(F.col("before"), F.lit("")), F.nullif(current, F.lit(""))
    )
    if drop_arrows:
        name = tx.clean_asset(name)
    return (
        named.withColumn("asset", name)
        .where((F.col("asset") != "") | F.col("piece").isNotNull())
        .drop("head", "piece", "island", "part", "seen", "text", "start", "before")
    )


def _real_number(c: str = "number") -> Column:
    return ~F.col(c).rlike(r"^0+$")


def judicial_holdings(lines: DataFrame, order: Order) -> DataFrame:
    order = sized(lines, order)
    entries = judicial_entries(lines, order).where(
        _real_number() & ((F.col("value_code") != "") | (F.col("income_code") != ""))
    )
    named = inherit_names(entries, order.keys, drop_arrows=True, whole=order.whole)
    return named.select(
        *order.keys,
        "entry",
        "asset",
        vl.value_range("value_code").alias("value"),
        "income_type",
        F.col("income_code").alias("income"),
    )


def judicial_transactions(lines: DataFrame, order: Order) -> DataFrame:
    order = sized(lines, order)
    entries = judicial_entries(lines, order).where(_real_number() & (F.col("tx_date") != ""))
    return inherit_names(entries, order.keys, drop_arrows=False, whole=order.whole).select(
        *order.keys,
        "entry",
        vl.normalize_date("tx_date").alias("transaction_date"),
        "asset",
        vl.tx_type_judicial("tx_type").alias("transaction_type"),
        vl.value_range("tx_value").alias("amount"),
        tx.ticker("asset").alias("ticker"),
    )


# -- executive text ----------------------------------------------------------


def executive_rows(lines: DataFrame, order: Order) -> DataFrame:
    """Lines of the target parts, with the numbered row each belongs to."""
    order = sized(lines, order)
    ln = by_document(lines, order).withColumn("line", tx.strip_all("line"))
    line = F.col("line")
    ln = ln.where((line != "") & ~tx.contains_any(line, fv.EXECUTIVE_NOISE))
    sched = F.regexp_extract(line, fv.EXECUTIVE_SCHEDULE, 1)
    part = F.regexp_extract(line, fv.EXECUTIVE_PART, 1)
    target = (
        F.when(sched != "", sched.rlike("^0*2$").cast("int"))
        .when(part != "", part.rlike("^0*[26]$").cast("int"))
    )
    numbered = line.rlike(fv.EXECUTIVE_ROW) & target.isNull()
    rest = tx.strip_all(F.regexp_extract(line, fv.EXECUTIVE_ROW + "(.*)", 1))
    ln = ln.withColumns({"target": target, "numbered": numbered, "rest": rest})
    return running(
        ln,
        order,
        in_target=("last", F.col("target")),
        entry=("sum", (F.col("numbered") | F.col("target").isNotNull()).cast("int")),
    ).where((F.col("in_target") == 1) & F.col("target").isNull())


def executive_holdings(lines: DataFrame, order: Order) -> DataFrame:
    """Numbered rows; a row of values alone takes the first fitting later line as name."""
    rows = executive_rows(lines, order)
    waits = F.col("numbered") & F.col("rest").rlike(fv.EIF_START)
    split = vl.eif_split("rest")
    line = F.col("line")
    fits = (
        ~F.col("numbered")
        & ~tx.contains_any(F.lower(line), fv.EXECUTIVE_NOT_A_NAME)
        & ~line.rlike(fv.EIF_START)
        & ~F.substring(line, 1, 25).rlike(fv.EXECUTIVE_MONEY)
    )
    vals = vl.parse_values(
        F.when(waits, F.col("rest")).otherwise(split["values_text"])
    )
    folded = fold(
        rows,
        [*order.keys, "entry"],
        order.position(),
        first={
            "waiting": F.when(F.col("numbered"), waits),
            "own": F.when(F.col("numbered") & ~waits, split["description"]),
            "found": F.when(fits, line),
            "vals": F.when(F.col("numbered"), vals),
        },
    )
    name = F.when(F.col("waiting"), F.col("found")).otherwise(F.col("own"))
    return (
        folded.where(F.col("waiting").isNotNull())
        .withColumn("asset", tx.strip_all(tx.collapse_spaces(name, 2)))
        .where(F.length("asset") > 2)
        .select(
            *order.keys, "entry", "asset",
            F.col("vals.value").alias("value"),
            F.col("vals.income_type").alias("income_type"),
            F.col("vals.income").alias("income"),
        )
    )


# -- periodic transaction reports --------------------------------------------


def join_split_amounts(lines: Column) -> Column:
    """Pull the upper amount of a range back from the next line.

    A line ending in '$X -' takes the first amount of the following line; what
    is left of that line stays, and is not looked at again as a first half.
    """
    text = "array<string>"

    def push(acc, *items):
        done = acc["done"]
        for item in items:
            done = F.concat(done, item)
        return done

    def one(c: Column) -> Column:
        return F.array(c)

    def step(acc, line):
        waiting = acc["open"].isNotNull()
        takes = waiting & line.rlike(fv.ONE_AMOUNT)
        amount = F.regexp_extract(line, fv.ONE_AMOUNT, 0)
        rest = F.trim(F.regexp_replace(line, "^(.*?)" + fv.ONE_AMOUNT, "$1"))
        joined = F.concat(F.rtrim(acc["open"]), F.lit(" "), amount)
        starts = line.rlike(fv.SPLIT_AMOUNT)
        none = F.array().cast(text)
        kept = F.when(waiting, one(acc["open"])).otherwise(none)
        return F.struct(
            F.when(
                takes, push(acc, one(joined), F.when(rest != "", one(rest)).otherwise(none))
            )
            .otherwise(push(acc, kept, F.when(starts, none).otherwise(one(line))))
            .alias("done"),
            F.when(~takes & starts, line).cast("string").alias("open"),
        )

    return F.aggregate(
        lines,
        F.struct(F.array().cast(text).alias("done"), F.lit(None).cast("string").alias("open")),
        step,
        lambda acc: F.when(
            acc["open"].isNotNull(), F.concat(acc["done"], F.array(acc["open"]))
        ).otherwise(acc["done"]),
    )


def _cut(text: Column, piece: Column, at: Column) -> Column:
    """Text without the piece that starts at a 1-based position."""
    return F.when(piece == "", text).otherwise(
        F.concat(
            F.substr(text, F.lit(1), at - 1), F.substr(text, at + F.length(piece))
        )
    )


def merged_cell(text: Column) -> Column:
    """STRUCT<asset, tx_type, tx_date, disc_date, amount, owner> of a merged row.

    NULL when no transaction type or no asset is left in it.  Fields are taken
    out of the text one after the other: amount, dates, type, owner.
    """
    lines = F.filter(F.split(text, "\n"), lambda x: ~tx.is_label_row(tx.strip_all(x)))
    whole = tx.strip_all(F.array_join(join_split_amounts(lines), " "))
    return tx.let(whole, _take_amount)


def _take_amount(t: Column) -> Column:
    def cut(amount: Column) -> Column:
        back = F.instr(F.reverse(t), F.reverse(amount))
        at = F.length(t) - back - F.length(amount) + 2
        return tx.let(
            tx.strip_all(_cut(t, amount, at)), lambda rest: _take_dates(rest, amount)
        )

    return tx.let(tx.strip_all(F.regexp_extract(t, fv.MONEY_RANGE, 1)), cut)


def _take_dates(t: Column, amount: Column) -> Column:
    def cut(dates: Column) -> Column:
        d0, d1 = (F.coalesce(F.get(dates, F.lit(i)), F.lit("")) for i in (0, 1))
        return tx.let(
            _cut(t, d0, F.instr(t, d0)),
            lambda one: tx.let(
                tx.strip_all(tx.collapse_spaces(_cut(one, d1, F.instr(one, d1)))),
                lambda rest: _take_type(rest, amount, d0, d1),
            ),
        )

    return tx.let(F.regexp_extract_all(t, F.lit(r"(\d{2}/\d{2}/\d{4})"), F.lit(1)), cut)


def _take_type(t: Column, amount: Column, d0: Column, d1: Column) -> Column:
    def split(hit: Column) -> Column:
        at = F.instr(t, hit)
        before = tx.strip_all(F.substr(t, F.lit(1), at - 1))
        after = tx.strip_all(F.substr(t, at + F.length(hit)))
        code = F.regexp_replace(F.lower(F.regexp_extract(hit, fv.MERGED_TYPE, 1)), " ", "")
        return tx.let(
            vl.split_owner(before),
            lambda own: tx.let(
                tx.strip_all(
                    tx.collapse_spaces(F.concat_ws(" ", own["rest"], F.nullif(after, F.lit(""))))
                ),
                lambda asset: F.when(
                    (hit != "") & (asset != ""),
                    F.struct(
                        asset.alias("asset"),
                        _merged_kind(code).alias("tx_type"),
                        vl.normalize_date(d0, cleaned=True).alias("tx_date"),
                        vl.normalize_date(d1, cleaned=True).alias("disc_date"),
                        amount.alias("amount"),
                        own["owner"].alias("owner"),
                    ),
                ),
            ),
        )

    return tx.let(F.regexp_extract(t, fv.MERGED_TYPE, 0), split)


def _merged_kind(code: Column) -> Column:
    return (
        F.when(F.contains(code, F.lit("partial")), "Sale (Partial)")
        .when(F.contains(code, F.lit("full")), "Sale (Full)")
        .when(F.contains(code, F.lit("exchange")), "Exchange")
        .when(F.contains(code, F.lit("received")), "Received")
        .when(code == "p", "Purchase")
        .otherwise("Sale (Full)")
    )


def table_headers(cells: DataFrame, table: list[str], row: list[str]) -> DataFrame:
    """First row of each table, found with a map-side combined minimum."""
    return best_row(
        cells.select(*table, *row, "cells"), table, *[F.col(c) for c in row]
    ).select(*table, F.col("cells").alias("header"), *[F.col(c).alias(f"__h_{c}") for c in row])


def house_ptr(cells: DataFrame, table: list[str], row: list[str]) -> DataFrame:
    """Transactions of House periodic reports, merged rows included."""
    heads = table_headers(cells, table, row).where(
        is_ptr_header(clean_cells(F.col("header"), True))
    )
    heads = heads.withColumn("roles", column_map(F.col("header"), HOUSE_ROLES)).drop("header")
    data = cells.join(heads, table)
    is_head = None
    for c in row:
        same = F.col(c) == F.col(f"__h_{c}")
        is_head = same if is_head is None else is_head & same
    data = data.where(~is_head & F.exists("cells", lambda c: F.coalesce(c, F.lit("")) != ""))
    data = _cleaned(data, F.col("cells"))
    first, rest = F.coalesce(F.get("clean", F.lit(0)), F.lit("")), F.slice("clean", F.lit(2), F.greatest(F.size("clean") - 1, F.lit(0)))
    # Most rows have text behind the first cell, which the clean cells show at once.
    smashed = F.when(F.forall(rest, lambda c: c == ""), is_smashed(F.col("cells"))).otherwise(False)
    record = F.when(smashed, tx.let(tx.let(first, merged_cell), _merged_record)).otherwise(tx.let(picked(F.col("clean"), F.col("roles"), "asset"), _plain_record))
    # Unreadable rows give NULL.  The outer explode keeps the test for that above
    # the parse; pushed below it, every row would be parsed twice.
    return (
        data.select(*table, *row, F.explode_outer(F.array(record)).alias("r"))
        .where(F.col("r").isNotNull())
        .select(*table, *row, "r.*")
    )


def _ptr_record(asset: Column, tx_date, disc_date, kind, amount, asset_type, comment) -> Column:
    return tx.let(
        tx.strip_labels(asset),
        lambda name: F.struct(
            tx_date.alias("transaction_date"),
            disc_date.alias("disclosure_date"),
            name.alias("asset"),
            asset_type.alias("asset_type"),
            kind.alias("transaction_type"),
            amount.alias("amount"),
            tx.ticker(name).alias("ticker"),
            comment.alias("comment"),
        ),
    )


def _merged_record(m: Column) -> Column:
    none = F.lit("")
    return F.when(
        m.isNotNull(),
        _ptr_record(
            m["asset"], m["tx_date"], m["disc_date"], m["tx_type"], m["amount"], none, none
        ),
    )


def _plain_record(asset: Column) -> Column:
    c, r = F.col("clean"), F.col("roles")
    return F.when(
        (asset != "") & ~tx.is_label_row(asset),
        _ptr_record(
            asset,
            vl.normalize_date(picked(c, r, "tx_date"), cleaned=True),
            vl.normalize_date(picked(c, r, "disc_date"), cleaned=True),
            vl.tx_type(picked(c, r, "tx_type")),
            picked(c, r, "amount"),
            picked(c, r, "asset_type"),
            picked(c, r, "comment"),
        ),
    )


def senate_ptr(reports: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Transactions of Senate periodic reports; columns come from the first <th> row of each table."""
    head = F.get(F.filter("t.rows", lambda r: r["is_header"]), F.lit(0))["cells"]
    tables = reports.select(doc, F.explode("tables").alias("t")).select(
        doc, F.col("t.table_no").alias("table_no"), head.alias("head"), F.col("t.rows").alias("rows")
    )
    named = tables.where(F.exists("head", lambda c: F.lower(c).rlike("asset|transaction")))
    named = named.withColumn("roles", column_map(F.col("head"), SENATE_ROLES))
    rows = named.select(doc, "table_no", "roles", F.explode("rows").alias("r"))
    data = rows.where(~F.col("r.is_header")).select(doc, "table_no", F.col("r.row_no").alias("row_no"), F.col("r.cells").alias("cells"), "roles")
    data = _cleaned(data, F.col("cells"))
    c, r = F.col("clean"), F.col("roles")
    asset = picked(c, r, "asset")
    return data.where(~F.lower(asset).isin("asset name", "n/a", "")).select(
        doc,
        "table_no",
        "row_no",
        vl.normalize_date(picked(c, r, "tx_date"), cleaned=True).alias("transaction_date"),
        vl.normalize_date(picked(c, r, "disc_date"), cleaned=True).alias("disclosure_date"),
        asset.alias("asset"),
        picked(c, r, "asset_type").alias("asset_type"),
        vl.tx_type(picked(c, r, "tx_type")).alias("transaction_type"),
        picked(c, r, "amount").alias("amount"),
        tx.ticker(asset).alias("ticker"),
        picked(c, r, "comment").alias("comment"),
    )


# -- scanned pages -----------------------------------------------------------


def early_stop(
    pages: DataFrame, order: Order, page: str, found: Column, empties: int = 5, past: int = 5, most: int = 60
) -> DataFrame:
    """Pages read before reading stops.

    Reading stops at the first page past index ``past`` that ends a run of
    ``empties`` pages without holdings; pages from index ``most`` on are never
    read.
    """
    rows = pages.where(F.col(page) < most).withColumn("__found", found.cast("int"))
    rows = running(
        rows,
        order,
        __seen=("sum", F.lit(1)),
        __last=("last", F.when(F.col("__found") == 1, F.col(page))),
    )
    run = F.col(page) - F.coalesce(F.col("__last"), F.lit(-1))
    stops = rows.withColumn(
        "__stop", (F.col(page) > past) & (run >= empties) & (F.col("__found") == 0)
    )
    cut = stops.where("__stop").groupBy(*order.keys).agg(F.min(page).alias("__cut"))
    return (
        stops.join(cut, order.keys, "left")
        .where(F.col("__cut").isNull() | (F.col(page) <= F.col("__cut")))
        .drop("__seen", "__last", "__found", "__stop", "__cut", CHUNK)
    )
