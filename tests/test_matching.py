"""Dictionary rewriting by trie: against plain regular expressions, at length, and with a large dictionary."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from veilframe.functions import text as X
from veilframe.operators import dictionary as D
from veilframe.operators import matching as M

WORDS = ["foo", "Foo", "bar", "BAR", "é", "baz", "昇迪", "c++", "a", "foo bar", "foo  bar", "bar,baz", "@", "<b", ">", "x1", "凡"]


def plain(text, fakes, match):
    """Leftmost, longest, with bounds; tags first."""
    bounds = {"A-Za-z0-9": "A-Za-z0-9", "\\p{L}\\p{N}": r"^\W_", "A-Za-z": "A-Za-z"}[match.bounds]
    side = f"[{bounds}{'@' if match.avoid_at else ''}]" if not bounds.startswith("^") else (r"(?:[^\W_]|@)" if match.avoid_at else r"[^\W_]")
    han = [e for e in fakes if re.search("[一-鿿]", e)]
    rest = [e for e in fakes if e not in han]

    def either(entries):
        return "|".join(re.escape(e) for e in sorted(entries, key=len, reverse=True))

    parts = ([f"(?<!{side})(?:{either(rest)})(?!{side})"] if rest else []) + ([either(han)] if han else [])
    rule = re.compile(("<[^>]+>|" if match.avoid_tags else "") + "(?:" + "|".join(parts) + ")", re.I if match.ignore_case else 0)

    def one(m):
        fake = fakes.get(m.group().lower() if match.ignore_case else m.group())
        return m.group() if fake is None else M.case_like(m.group(), fake) if match.case_adapt else fake

    return rule.sub(one, text)


@pytest.mark.parametrize("match", [D.MAP_SCRUB, D.KNOWN, D.LITERAL, D.EXACT_CODES])
def test_rewriting_against_regular_expressions(match):
    rng = random.Random(11)
    for _ in range(3000):
        entries = {" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(1, 6))}
        keys = {e.lower() if match.ignore_case else e for e in entries if any(c.isalnum() for c in e)}
        keys = {k for k in keys if re.search(r"[A-Za-z]|[一-鿿]", k) and "<" not in k and ">" not in k}
        if not keys:
            continue
        fakes = {k: f"Q{i}x" for i, k in enumerate(sorted(keys))}
        text = "".join(rng.choice(WORDS) + rng.choice([" ", "", " ", ",", "  "]) for _ in range(rng.randint(0, 12)))
        assert M.Matcher(fakes.items(), match).rewrite(text)[0] == plain(text, fakes, match), (fakes, text)


def test_case_like_is_the_expression(spark):
    rng = random.Random(3)
    pairs = [("".join(rng.choice("aBéß1 Q-") for _ in range(rng.randint(0, 5))), "".join(rng.choice("xYz É-2") for _ in range(rng.randint(0, 6)))) for _ in range(400)]
    df = spark.createDataFrame(pairs, "o string, f string").select("o", "f", X.case_like(F.col("o"), F.col("f")).alias("s"))
    assert [(r["o"], r["f"], r["s"]) for r in df.collect()] == [(o, f, M.case_like(o, f)) for o, f in pairs]


def test_time_grows_with_the_text():
    """200,000 words against 50,000 entries that share their first words, and ten times fewer."""
    rng = random.Random(5)
    entries = [(f"the {i} word{i} of {i}", f"Q{i}") for i in range(50_000)]
    matcher = M.Matcher(entries, D.MAP_SCRUB)

    def spent(n):
        text = " ".join(f"the {i} word{i} of {i}" if rng.random() < 0.3 else "the" for i in (rng.randrange(60_000) for _ in range(n)))
        begun = time.process_time()
        new, used = matcher.rewrite(text)
        assert used and "word" in text
        return time.process_time() - begun

    spent(1000)
    few, many = spent(20_000), spent(200_000)
    assert many < 30 * few and many < 20


@pytest.mark.parametrize("bounded", [True, False])
def test_any_size_of_dictionary_gives_the_same(spark, monkeypatch, bounded):
    if not bounded:
        monkeypatch.setattr(M, "MOST_ENTRIES", 0)
    rows = [("Foo Works", "Q W"), ("foo", "z"), ("昇迪", "凡科"), ("one two three four five six seven eight", "long"), ("one two three four five six seven", "less")]
    texts = [(1, "FOO WORKS and foo-works, 昇迪x one two three four five six seven eight nine"), (2, None), (3, ""), (3, ""), (4, "one two three four five six seven nine"), (None, "foo")]
    prepared = D.prepare(spark.createDataFrame(rows, "entry string, fake string"), D.MAP_SCRUB)
    df = spark.createDataFrame(texts, "id int, t string").withColumn("text", F.lit("clash"))
    got = M.rewritten(df.where("id is not null or true"), "id", "t", prepared, D.MAP_SCRUB)
    want = {1: "Q W and z-works, 凡科x long nine", 2: None, 3: "", 4: "less nine"}
    assert {r["id"]: r["text"] for r in got.where("id is not null").collect()} == want
    assert M.rewritten(df.limit(0), "id", "t", prepared, D.MAP_SCRUB).collect() == []
    none = D.prepare(spark.createDataFrame([], "entry string, fake string"), D.MAP_SCRUB)
    assert {r["text"] for r in M.rewritten(df.where("id = 1"), "id", "t", none, D.MAP_SCRUB).collect()} == {texts[0][1]}


def test_protected_texts_stay(spark):
    matcher = M.Matcher([("foo", "bar"), ("zed", "qux")], D.MAP_SCRUB)
    assert matcher.rewrite("Foo zed", frozenset({"foo"})) == ("Foo qux", ["qux"])
