"""Pairs of long lists: each once, and only those in reach are compared."""

from __future__ import annotations

import random

import numpy as np
from llm import brute
from pyspark import cloudpickle
from pyspark.sql import functions as F

from veilframe.llm import common, fuzzy_lines, set_join


def test_pairs_meet_at_their_first_shared_key(spark):
    rng = random.Random(5)
    owners = {i: sorted(rng.sample(range(40), 12)) for i in range(30)} | {i: list(range(60, 90)) for i in range(30, 40)}
    rows = spark.createDataFrame([(i, k) for i, keys in owners.items() for k in keys], "owner long, key long")
    held = common.with_earlier(rows, "key", "key", "owner")
    left, right = (held.select("key", F.col("owner").alias(f"{p}o"), F.col("earlier").alias(f"{p}e")) for p in "lr")
    given = left.join(right, "key").where((F.col("lo") < F.col("ro")) & ~common.met_before("le", "re")).select("lo", "ro").collect()
    assert {tuple(r) for r in given} == {(a, b) for a in owners for b in owners if a < b and set(owners[a]) & set(owners[b])}
    assert sum(r.lo >= 30 and r.ro >= 30 for r in given) == 45  # ten equal sets: once a pair, not once a key


def test_long_lists_of_the_set_join(spark):
    """Families that share most tokens but not enough of them, and a few that do, ids of several texts among them."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        words = list(base)
        for at in rng.sample(range(120), rng.choice([1, 4, 6, 9])):
            words[at] = f"x{rng.randrange(400)}"
        rows.append((i, " ".join(words)))
    assert {tuple(r) for r in set_join.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == brute.jaccard(rows, 4, 85)


def test_far_long_lines_are_not_compared(spark, monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklm", k=6)) for _ in range(2000)]
    rows = [(i, " ".join(rng.choices(words, k=150))) for i in range(120)]
    rows += [(1000 + i, " ".join(w if rng.random() > 0.02 else "other" for w in rows[i][1].split())) for i in range(20)]
    asked, verified = [], fuzzy_lines._verified

    def counted(forms, pairs, similarity):
        asked.append(pairs.count())
        return verified(forms, pairs, similarity)

    monkeypatch.setattr(fuzzy_lines, "_verified", counted)
    got = {r.doc_id: r.text for r in fuzzy_lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), distance=None).collect()}
    split = [t.split() for _, t in rows]
    for at, (i, text) in enumerate(rows):
        repeats = any(fuzzy_lines.similar(split[j], split[at], 0.9) for j in range(at))
        assert got[i] == ("" if repeats else text)
    assert sum(asked) < 200


def test_far_long_lines_are_not_written(spark, monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghijklm", k=6)) for _ in range(2000)]
    rows = [(i, " ".join(rng.choices(words, k=150))) for i in range(200)]
    rows += [(1000 + i, " ".join(w if rng.random() > 0.02 else "other" for w in rows[i][1].split())) for i in range(20)]
    written, materialize = [], fuzzy_lines.materialize

    def counted(df, name):
        out = materialize(df, name)
        if name == "candidates":
            written.append(out.count())
        return out

    monkeypatch.setattr(fuzzy_lines, "materialize", counted)
    got = fuzzy_lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), distance=None).where("text = ''").collect()
    assert {r.doc_id for r in got} == {1000 + i for i in range(20)}
    assert sum(written) < 20 * 16 + 50  # a pair at most once a key that it shares


def test_groups_are_tables(spark):
    """What the stages use several times is read, not planned again each time."""
    links = spark.createDataFrame([(1, 2), (2, 3), (7, 9)], "a long, b long")
    groups = common.components(links)
    more = common.merged(groups, spark.createDataFrame([(3, 7), (20, 21)], "a long, b long"))
    for found in (groups, more):
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in groups.collect()} == {(1, 1), (2, 1), (3, 1), (7, 7), (9, 7)}
    assert {tuple(r) for r in more.collect()} == {(1, 1), (2, 1), (3, 1), (7, 1), (9, 1), (20, 20), (21, 20)}


def test_texts_are_cut_into_words_as_seldom_as_possible(spark, monkeypatch):
    """Lines and word counts come from one pass, the index from another, all forms that are compared from a third."""
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghijklm", k=6)) for _ in range(60)]
    rows = [(i, " ".join(w if rng.random() > 0.06 else rng.choice("xyz") for w in words[:40])) for i in range(60)]
    passes, frame = [], type(spark.range(0))

    def counted(df, fn, *args, **kwargs):
        if df.columns == ["id", "text"]:
            passes.append(fn.__qualname__)
        return frame_map(df, fn, *args, **kwargs)

    frame_map = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", counted)
    monkeypatch.setattr(fuzzy_lines, "REACH", 6)
    cloudpickle.register_pickle_by_value(fuzzy_lines)
    try:
        got = {r.doc_id: r.text for r in fuzzy_lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), distance=None).collect()}
    finally:
        cloudpickle.unregister_pickle_by_value(fuzzy_lines)
    assert got == brute.line_dedup(rows, len, distance_bits=None)
    assert len(passes) == 3


def test_rarest_words_are_one_order_for_all_lines():
    """Lines that share all but k words share one of the k + 1 chosen, also among repeated words and equal counts."""
    rng = np.random.default_rng(7)
    held = rng.integers(0, 1 << 20, 1 << fuzzy_lines.SLOT_BITS).astype(np.int32)
    vocabulary = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    vocabulary[:40] = (vocabulary[0] >> np.uint64(32) << np.uint64(32)) + np.arange(40, dtype=np.uint64)  # alike in their upper halves
    lines = []
    for _ in range(200):
        line = list(rng.choice(vocabulary, rng.integers(10, 60)))
        other = list(line)
        for at in rng.integers(0, len(line), len(line) // 10):
            other[at] = rng.choice(vocabulary)
        lines += [line, other]
    counts = np.array([len(x) for x in lines])
    line, key = fuzzy_lines.rarest(np.concatenate(lines).astype(np.uint64), counts, held, 0.9)
    assert (np.bincount(line) == fuzzy_lines.allowed(counts, 0.9) + 1).all()
    chosen = [set(key[line == i].tolist()) for i in range(len(lines))]
    assert all(len(x) == fuzzy_lines.allowed(n, 0.9) + 1 for x, n in zip(chosen, counts.tolist()))
    assert all(chosen[i] & chosen[i + 1] for i in range(0, len(lines), 2))
    assert fuzzy_lines.rarest(np.zeros(0, np.uint64), np.zeros(0, np.int64), held, 0.9)[0].tolist() == []


def test_similar_is_the_edit_distance(spark):
    rng = random.Random(8)
    for _ in range(3000):
        a = [rng.choice("abcdefgh") for _ in range(rng.randint(5, 40))]
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randint(0, 1)] = rng.choice([[], ["z"], ["a"]])
        assert fuzzy_lines.similar(a, b, 0.9) == (brute.distance(a, b) <= int(0.1 * max(len(a), len(b)) + 1e-9))


def test_removed_lines_of_rows_that_share_an_id(spark):
    rows = [(1, "a b c d e\nx\na b c d e"), (1, "a b c d e\nx\na b c d e"), (2, "a b c d e\nf g h i j"), (2, "f g h i j\na b c d e"), (3, "f g h i j"), (4, "p q r s t")]
    gone = fuzzy_lines.removed_lines(spark.createDataFrame(rows, "doc_id long, text string"), distance=None)
    # Of id 2, lines 0 and 1 hold both groups: that of id 1, and one whose first line it keeps.
    assert {r.id: r.lines for r in gone.collect()} == {1: [2], 2: [0, 1, 1], 3: [0]}
