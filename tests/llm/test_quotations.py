"""Quotation links and threads against plain Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyglass.llm import quotations, queries

SCHEMA = "conv_id long, turn long, text string"


def level(line):
    m = re.match(r"((?:>[ \t]?)+)", line)
    return m[1].count(">") if m else 0


def body(line):
    return re.sub(r"^((?:>[ \t]?)+)", "", line)


def norm(text):
    return " ".join(text.split()).lower()


def parse(text):
    lines = [(level(x), body(x)) for x in (text or "").split("\n")] if text is not None else []
    says = lambda i, k, x: re.search(r"(?i)^\s*(?:on\b.*)?\bwrote:\s*$", x) and i + 1 < len(lines) and lines[i + 1][0] > k
    lines = [(k, x) for i, (k, x) in enumerate(lines) if not says(i, k, x)]
    own = "\n".join(x for k, x in lines if not k).strip()
    blocks = []
    for i, (k, x) in enumerate(lines):
        if k:
            if blocks and blocks[-1][0] == k and blocks[-1][3] == i - 1:
                blocks[-1][2].append(x)
                blocks[-1][3] = i
            else:
                blocks.append([k, i, [x], i])
    return (own if text is not None else None), [(k, i, "\n".join(b)) for k, i, b, _ in blocks if norm("\n".join(b))]


def brute(rows):
    first = lambda x: (x is not None, x if x is not None else 0)
    keys = sorted(set(rows), key=lambda r: (first(r[1]), first(r[0]), hashlib.md5(repr(r[2]).encode()).digest()))
    parsed = {k: parse(k[2]) for k in keys}
    said = []
    for k in keys:
        own = parsed[k][0] or ""
        units = {norm(own), *map(norm, re.split(r"\n\s*\n", own)), *(norm(x) for x in own.split("\n") if len(x.split()) >= 5)} - {""}
        said.append((k, units))
    place = {k: i for i, k in enumerate(keys)}
    parent, counts = {}, {}
    for k in keys:
        links = []
        for lev, pos, text in parsed[k][1]:
            options = []
            for part, unit in enumerate(dict.fromkeys([text, *(x for x in text.split("\n") if len(x.split()) >= 5)])):
                holders = [q for q, units in said if norm(unit) in units]
                near = [q for q in holders if q[0] == k[0]][:1]
                found = near[0] if near and place[near[0]] < place[k] else None
                far = found is None
                if far and holders and place[holders[0]] < place[k]:
                    found = holders[0]
                if found:
                    options.append((part > 0, far, -len(unit.split()), place[found], found))
            links.append((lev, pos, min(options)[4] if options else None))
        counts[k] = (len(links), sum(x[2] is not None for x in links))
        real = sorted((x for x in links if x[2]), key=lambda x: x[:2])
        parent[k] = real[0][2] if real else None

    def climb(k):
        depth = 0
        while parent[k]:
            k, depth = parent[k], depth + 1
        return k, depth

    return {k: (parsed[k][0], *counts[k], parent[k], *climb(k)) for k in keys}


def mails(seed):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(50)]
    say = lambda: "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(2, 12))) for _ in range(rng.randint(1, 4)))
    quote = lambda t: "\n".join("> " + x for x in t.split("\n"))
    rows = [(1, 0, None), (1, 1, ""), (1, 2, ">\n> "), (None, None, "hello there all of you"), (1, 3, "> hello there all of you\nyes")]
    turn = 4
    for _ in range(120):
        old = rng.choice(rows)[2] or "nothing"
        kind = rng.randrange(6)
        text = say()
        if kind == 0:
            text = quote(old) + "\n" + text
        elif kind == 1:
            text = text + "\nOn a day somebody wrote:\n" + quote(quote(old).upper()) + "\n" + say()
        elif kind == 2:
            text = quote(rng.choice(old.split("\n"))) + "\n" + text + "\n\n" + quote(old)
        elif kind == 3:
            text = rng.choice(rows)[2]
        elif kind == 4:
            text = "> never said by anyone\n" + text + "\nhe wrote:\nno quote"
        rows.append((rng.randint(1, 4), turn, text))
        turn += 1
    return rows + [rows[9], rows[9]]


@pytest.mark.parametrize("seed", [1, 2])
def test_threads_against_brute_force(spark, seed):
    rows = mails(seed)
    got = quotations.conversations(spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA + ", root string").repartition(3)).collect()
    want = brute(rows)
    by_id = {k[:2]: v for k, v in want.items()}
    assert len(got) == len(rows) and len(by_id) == len(want)
    seen = {}
    for r in got:
        own, quotes, linked, parent, root, depth = by_id[r.conv_id, r.turn]
        assert (r.own, r.quotes, r.linked, r.depth) == (own, quotes, linked, depth)
        assert (None if r.parent is None else (r.parent.scope, r.parent.seq)) == (parent and parent[:2])
        assert (r.root.scope, r.root.seq) == root[:2]
        seen.setdefault((r.root.scope, r.root.seq), {})[r.conv_id, r.turn] = (r.place, r.depth, r.turn)
    for members in seen.values():
        ordered = sorted(members.values())
        assert [p for p, *_ in ordered] == list(range(len(ordered)))
        assert [d for _, d, _ in ordered] == sorted(d for _, d, _ in ordered)
    assert any(d > 1 for m in seen.values() for _, d, _ in m.values())


def test_long_chain_and_common_phrase(spark):
    rows = [(0, 0, "start of it all right here")]
    for i in range(1, 60):
        rows.append((0, i, f"> {rows[-1][2].split(chr(10))[-1]}\nreply number {i} follows the one before"))
    rows += [(5, 100 + i, "the same words from everyone here") for i in range(500)] + [(6, 1000 + i, f"> the same words from everyone here\nme too {i}") for i in range(500)]
    got = {(r.conv_id, r.turn): r for r in quotations.conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[0, i].depth == i and got[0, i].root.seq == 0 and got[0, i].place == i for i in range(60))
    assert all(got[6, 1000 + i].parent.seq == 100 for i in range(500))
    assert quotations.conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_turn_finds_the_one_before(spark):
    """On the whole small table: text without quotes comes back, and a turn's parent says what the turn before said."""
    folder = "/root/testdata/sf0.001"
    turns = {(r.conv_id, r.turn): r.text for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()}
    got = queries.op4_quotation_links(spark, folder).collect()
    assert len(got) == len(turns)
    for r in got:
        assert r.own_sha256 == hashlib.sha256(turns[r.conv_id, r.turn].strip().encode()).hexdigest()
        before = turns.get((r.conv_id, r.turn - 1))
        if before:
            assert r.parent_conv == r.conv_id == r.root_conv and norm(before) in norm(turns[r.parent_conv, r.parent_turn])


@pytest.mark.parametrize("block", [2, 3, 7, 4096])
def test_mails_of_a_hot_conversation(spark, block):
    """A conversation with a third of all rows is cut into blocks; every mail still quotes the two turns before it."""
    rnd = random.Random(9)
    rows = [(rnd.choice([5, None, *range(20)]) if i % 3 else 5, i // 2, rnd.choice([None, "", f"said {i}", f"a {i}\n\nb"])) for i in range(120)]
    rows += [(7, 900, "same"), (7, 900, "same"), (None, None, "no turn")]
    rows = [r for i, r in enumerate(rows) if r not in rows[:i] or r[1] == 900]
    rows = list({(c, t): (c, t, x) for c, t, x in rows if t != 900}.values()) + [(7, 900, "same")] * 2
    quote = lambda text: "\n".join("> " + x for x in text.split("\n"))
    want, talks = [], {}
    for c, t, x in rows:
        talks.setdefault(c, []).append((t is not None, t or 0, x))
    for c, talk in talks.items():
        talk.sort(key=lambda r: r[:2])
        for i, (known, t, x) in enumerate(talk):
            one, two = (((talk[i - k][2] or "") if i >= k else "") for k in (1, 2))
            text = x or ""
            if one.split():
                text += "\n\nOn that day, they wrote:\n" + quote(one)
                if two.split():
                    text += "\n> On the day before, they wrote:\n" + quote(quote(two))
            want.append((c, t if known else None, text))
    got = quotations.as_mail(spark.createDataFrame(rows, SCHEMA).withColumn("nth", F.lit(1)), block).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert quotations.as_mail(spark.createDataFrame([], SCHEMA)).count() == 0
