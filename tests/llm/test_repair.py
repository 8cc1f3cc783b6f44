"""Conversation repair against a search over all edits, on the given table and on odd ones."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from veilframe.llm import conversation_repair as cr
from veilframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def cheapest(rows, must, cut):
    """(cost, audit, lines): least cost first, then least audit."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, lines
        if (i, state) in seen:
            continue
        seen.add((i, state))
        for new in NEXT[state]:
            if new in "ua":
                name = {"u": "user", "a": "assistant"}[new]
                heapq.heappush(heap, (cost + 2, audit + "I", i, new, (*lines, f"{name}:")))
                if i < len(rows) and not must[i]:
                    heapq.heappush(heap, (cost + 2 + cut[i], audit + "R", i + 1, new, (*lines, f"{name}:{rows[i][1]}")))
            if i < len(rows) and not must[i] and rows[i][0][:1] == new:
                heapq.heappush(heap, (cost + cut[i], audit + "K", i + 1, new, (*lines, f"{rows[i][0]}:{rows[i][1]}")))
        if i < len(rows):
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, lines))


def plain(table, damaged=True):
    """Digest rows of (conv, turn, role, text) rows."""
    out, by = [], {}
    for conv, turn, role, text in table:
        rows = by.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        rows += [(turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    for conv, rows in by.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        blank, twice, cut, seen = [], [], [], set()
        for _, role, text in rows:
            body = text.rstrip(" \t\n\v\f\r")
            blank.append(not body)
            twice.append(bool(body) and (role, text) in seen)
            cut.append(bool(body) and not twice[-1] and body[-1] not in ".!?")
            seen.add((role, text))
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
        turns = [r[0] for r in rows if r[0] is not None]
        cost, audit, lines = cheapest([r[1:] for r in rows], [b or t for b, t in zip(blank, twice)], cut)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, sum(blank), sum(twice), sum(cut), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "p", 3) for r in rows], "conv_id long, turn long, role string, text string, part long, kinds string, n long")


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op12_conversation_structure_repair"](spark, SF)) == plain(rows)


def test_edits_are_the_least_audit():
    rng = random.Random(5)
    texts = {0: "", 1: "x.", 2: "x"}
    for _ in range(1500):
        rows = [(rng.choice(["system", "user", "user", "assistant", " "]), rng.choice([0, 1, 1, 2])) for _ in range(rng.randint(0, 9))]
        kinds = bytes(cr.GONE if t == 0 else cr.kind_of(role, t == 2) for role, t in rows)
        cost, audit, _ = cheapest([(r, texts[t]) for r, t in rows], [t == 0 for _, t in rows], [t == 2 for _, t in rows])
        own, end = cr.edits(kinds)
        assert "".join(own) + cr.TAIL[end] == audit
        assert cr._price({"kinds": kinds}, audit) == cost


@pytest.fixture
def said():
    rng = random.Random(8)
    rows = []
    for conv in range(60):
        for turn in range(rng.choice([0, 1, 2, 5, 9, 30])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((conv, None if rng.random() < 0.05 else turn + rng.choice([0, 0, 0, 4]), role, rng.choice(["Yes.", "No?", "cut", " \n", "", None, "Eh! ", f"{rng.random()}."])))
    return rows


def test_random_tables(spark, said):
    df = frame(spark, said)
    assert got(cr.repair(cr.damage(df), copies_col="copies")) == plain(said)
    assert got(cr.repair(df)) == plain(said, damaged=False)


@pytest.mark.parametrize("most", [1, 3])
def test_conversations_over_many_tasks(spark, said, monkeypatch, most):
    """Borders inside of conversations change nothing: one holds nine tenths of all rows."""
    rng = random.Random(2)
    hot = [(7, i // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", "", f"{i}."])) for i in range(600)] + [(7, 3, "user", "same.")] * 40
    monkeypatch.setattr(cr, "PIECE_ROWS", most)
    rows = said + hot
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(cr.repair(cr.damage(frame(spark, rows)), copies_col="copies")) == plain(rows)
        turns = cr.repaired_turns(frame(spark, rows)).where("conv_id = 7").orderBy("place").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = next(r for r in plain(rows, damaged=False) if r[0] == 7)
    assert "".join(t.edit for t in turns) == want[-2] and [t.place for t in turns] == list(range(len(turns)))
    assert hashlib.sha256("\n".join(f"{t.role}:{t.text}" for t in turns if t.role is not None).encode()).hexdigest() == want[-1]


def test_odd_tables(spark):
    assert got(cr.repair(frame(spark, []))) == []
    long = "word " * 300_000
    rows = [(1, 0, "user", long + "."), (1, 1, "assistant", long), (None, None, None, None), (None, 2, "user", "a."), (2, -(2**62), "user", "a."), (2, 2**62, "assistant", "a."),
            (3, None, "user", "x."), (3, None, "user", "x."), (3, 0, "user", "x."), (4, 1, "ünknown", "x。")]
    assert got(cr.repair(frame(spark, rows))) == plain(rows, damaged=False)
    absent = frame(spark, [(5, 1, "user", "a."), (5, 2, "user", "b.")]).withColumn("times", F.lit(0))
    assert got(cr.repair(absent, copies_col="times")) == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
