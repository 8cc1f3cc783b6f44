import random
import re

import pytest
from pyspark.sql import functions as F

from veilframe.config import Config
from veilframe.operators import detector as DT
from veilframe.operators import dictionary as D
from veilframe.operators import freetext as FT
from veilframe.operators import geo
from veilframe.operators import spans as S
from veilframe.operators.joins import lookup

SPANS = "array<struct<start:int,end:int,type:string>>"


class PlantedDetector:
    """Finds planted tokens; stands in for a model."""

    def entities_batch(self, texts):
        rule = re.compile("Zzyzx Qwerty|Foo Barsson")
        return [[DT.Found(*m.span(), "person", 0.9) for m in rule.finditer(t)] for t in texts]


def test_windows_cover_the_text_and_overlap(spark):
    text = "".join(chr(97 + i % 26) for i in range(8123))
    rows = spark.createDataFrame([(text,)], "t string").select(F.explode(S.windows(F.col("t"))).alias("w")).select("w.*").collect()
    rows = sorted(rows, key=lambda r: r["offset"])
    assert all(text[r["offset"] : r["offset"] + 800] == r["piece"] for r in rows)
    assert all(b["offset"] - a["offset"] == 700 for a, b in zip(rows, rows[1:]))
    assert rows[-1]["offset"] + len(rows[-1]["piece"]) == len(text)


def test_entities_far_into_a_text_are_found_once(spark):
    texts = [(1, "a" * 5000 + "Zzyzx Qwerty" + "b" * 3000), (2, "c" * 6000 + "Foo Barsson" + "d" * 4000), (3, "x" * 795 + "Zzyzx Qwerty")]
    found = DT.detect(spark.createDataFrame(texts, "id int, t string"), ["id"], "t", PlantedDetector, spread=4)
    got = sorted((r["id"], r["start"], r["end"], r["span"]) for r in found.collect())
    assert got == [(1, 5000, 5012, "Zzyzx Qwerty"), (2, 6000, 6011, "Foo Barsson"), (3, 795, 807, "Zzyzx Qwerty")]


def test_score_floors(spark):
    class Weak:
        def entities_batch(self, texts):
            return [[DT.Found(0, 3, "person", 0.39), DT.Found(0, 4, "org", 0.3)] for _ in texts]

    found = DT.detect(spark.createDataFrame([(1, "abcdefg")], "id int, t string"), ["id"], "t", Weak)
    assert [(r["type"], r["end"]) for r in found.collect()] == [("org", 4)]


def brute_leftmost(spans):
    out, last = [], -1
    for s in sorted(spans, key=lambda s: (s[0], -s[1], s[2])):
        if s[0] >= last:
            out.append(s)
            last = s[1]
    return out


def brute_merge(groups, text):
    tagged = sorted((rank, -(e - s), s, e, t) for rank, g in enumerate(groups) for s, e, t in g)
    kept = []
    for _, _, s, e, t in tagged:
        pieces = [(s, e)]
        clashing = [k for k in kept if s < k[1] and k[0] < e]
        if not clashing:
            kept.append((s, e, t))
            continue
        for ks, ke, _ in clashing:
            pieces = [q for ps, pe in pieces for q in ([(ps, pe)] if ks >= pe or ke <= ps else [(ps, ks), (ke, pe)]) if q[1] > q[0]]
        for ps, pe in pieces:
            raw = text[ps:pe]
            left = len(raw) - len(raw.lstrip(" ,.\t"))
            right = len(raw) - len(raw.rstrip(" ,.\t"))
            if pe - right - ps - left >= 2:
                kept.append((ps + left, pe - right, t))
    return sorted(kept, key=lambda s: (s[0], -s[1], s[2]))


def test_span_selection_matches_brute_force(spark):
    rng = random.Random(7)

    def some(n):
        out = set()
        while len(out) < n:
            s = rng.randrange(60)
            out.add((s, s + rng.randrange(1, 15), rng.choice("abc")))
        return list(out)

    text = "ab, c. de fg,hi " * 5
    cases = [(i, some(6), some(5)) for i in range(60)]
    df = spark.createDataFrame(cases, f"id int, a {SPANS}, b {SPANS}")
    rows = df.select("id", S.leftmost_longest(F.concat("a", "b")).alias("l"), S.priority_merge([F.col("a"), F.col("b")], F.lit(text)).alias("m")).collect()
    by_id = {c[0]: c for c in cases}
    for r in rows:
        _, a, b = by_id[r["id"]]
        assert [tuple(x) for x in r["l"]] == brute_leftmost(a + b)
        assert [tuple(x) for x in r["m"]] == brute_merge([a, b], text)


def test_priority_merge_keeps_the_rest_of_a_span(spark):
    df = spark.createDataFrame([([(13, 15, "state_province")], [(0, 15, "city")])], f"g {SPANS}, m {SPANS}")
    out = df.select(S.priority_merge([F.col("g"), F.col("m")], F.lit("Punta Gorda, FL")).alias("o")).first()["o"]
    assert [tuple(x) for x in out] == [(0, 11, "city"), (13, 15, "state_province")]


ENTRIES = [("Foo Bar", "Qux Zed"), ("foo", "vireo"), ("Bar Baz Qux", "Onyx"), ("a.b@vexil.example", "x@y.z"), ("AT&T", "Nexus"),
           ("Vexil Inc.", "Lumen"), ("甲乙", "云舟"), ("one two three four five six seven eight", "Long"), ("one two three four five six seven nine", "Other")]
TEXTS = ["Foo Bar Baz Qux", "foo bar baz qux foobar foo-bar", "call AT&T or at&t, not ATT", "by Vexil Inc. and Vexil Inc", "这是甲乙公司",
         "one two three four five six seven nine; one two three four five six seven eight", "mail a.b@vexil.example!", "", "éfoo fooé 3foo foo"]


def brute_replace(text):
    table = {}
    for e, f in sorted(ENTRIES, key=lambda p: p):
        table.setdefault(e.lower(), f)
    words = sorted(table, key=lambda k: (-len(k), k))
    latin = "|".join(re.escape(w) for w in words if w.isascii())
    han = "|".join(re.escape(w) for w in words if not w.isascii())
    rule = re.compile(rf"(?<![^\W_])(?:{latin})(?![^\W_])|(?:{han})", re.I)
    return rule.sub(lambda m: table[m.group(0).lower()], text), len(rule.findall(text))


def test_dictionary_replacement_matches_brute_force(spark):
    dictionary = spark.createDataFrame(ENTRIES, "entry string, fake string")
    texts = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    got = {r["id"]: (r["text"], r["replacements"]) for r in D.scrub_with_map(texts, "text", dictionary, D.MAP_SCRUB).collect()}
    assert got == {i: brute_replace(t) for i, t in enumerate(TEXTS)}


def test_literals_spare_markup_and_addresses(spark):
    dictionary = spark.createDataFrame([("Meta", "vertex"), ("foo bar", "qux zed"), ("ab", "cd")], "entry string, fake string")
    texts = spark.createDataFrame([(1, "<meta a='foo bar'>META foo bar, foo bar@x.com ab</meta>")], "id int, text string")
    out = D.scrub_with_map(texts, "text", dictionary, D.LITERAL).first()
    assert out["text"] == "<meta a='foo bar'>VERTEX qux zed, foo bar@x.com ab</meta>" and out["replacements"] == 2


def test_overflow_is_skipped_and_rounds_reach_a_fixpoint(spark):
    dictionary = spark.createDataFrame([("alpha", "beta beta"), ("beta", "gamma")], "entry string, fake string")
    texts = spark.createDataFrame([(1, "alpha")], "id int, text string")
    assert D.scrub_with_map(texts, "text", dictionary, width=6).first()["skipped"]
    assert D.scrub_with_map(texts, "text", dictionary).first()["text"] == "beta beta"
    assert D.scrub_with_map(texts, "text", dictionary, rounds=2).first()["text"] == "gamma gamma"


def test_lookup_with_hot_keys(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("k"), "id")
    table = rows.groupBy("k").agg(F.count("*").alias("n")).where("k <> 'k1'").withColumn("f", F.upper("k"))
    got = lookup(rows, table, ["k"], weight="n", hot_rows=100)
    assert got.columns == ["k", "id", "f"] and got.count() == 3000
    assert got.where((F.col("k") != "k1") & ~F.col("f").eqNullSafe(F.upper("k"))).count() == 0
    assert got.where((F.col("k") == "k1") & F.col("f").isNotNull()).count() == 0


def test_email_patterns(spark):
    cases = {
        "a.b@vexil.example_c.d@vexil.example@unq": ["a.b@vexil.example", "c.d@vexil.example"],
        "x\\nfoo@vexil.example": ["foo@vexil.example"],
        "Qwertña-Zzyzx.Qwerty@vexil.example": ["Zzyzx.Qwerty@vexil.example"],
        "q%2Ffoo.bar%40vexil.example": ["foo.bar@vexil.example"],
        "foo.bar&#64;vexil.example foo&amp;#x40;vexil.example": ["foo.bar@vexil.example", "foo@vexil.example"],
        "no mail": [],
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", FT.emails_in(F.col("t")).alias("e"))
    got = {r["t"]: r["e"] for r in df.collect()}
    assert got == cases


def test_span_filter_rules(spark):
    rows = [("Zzyzx", "person", True), ("a@b", "person", False), ("Senior Engineer", "org", False), ("you", "person", False), ("email", "email", False),
            ('""', "phone", False), ("12", "phone", True), ("Vexil", "org", False)]
    df = spark.createDataFrame(rows, "s string, t string, want boolean")
    kept = DT.keep_span(F.col("s"), F.col("t"), Config().generic_words, ["vexil"])
    assert df.where(kept != F.col("want")).count() == 0
    edges = spark.createDataFrame([("chers", "a", "", False), ("Foo", "@", "", False), ("Foo", " ", "@", False), ("Foo", "é", "", True)], "s string, b string, a string, want boolean")
    kept = DT.keep_span(F.col("s"), F.lit("person"), [], before=F.col("b"), after=F.col("a"))
    assert edges.where(kept != F.col("want")).count() == 0


@pytest.mark.parametrize(
    ("cell", "want"),
    [("FL", [("FL", "state_province")]), ("Punta Gorda, FL", [("FL", "state_province")]), ("move to fl soon", []), ("WA 98683", [("WA", "state_province"), ("98683", "postal_code")]),
     ("Georgia United States", [("Georgia", "state_province"), ("United States", "country")]), ("Georgia", [("Georgia", "country")]), ("New York\nUSA", [("New York", "state_province"), ("USA", "country")])],
)
def test_place_recognition(spark, cell, want):
    places = geo.gazetteer(geo.world_places(spark))
    df = spark.createDataFrame([(1, cell)], "id int, t string")
    spans = geo.geo_spans(df, "id", "t", places).first()["spans"]
    assert [(cell[s["start"] : s["end"]], s["type"]) for s in spans] == want


def test_street_parts(spark):
    rows = [("1115 SE 164th Street", ("1115 SE ", "164th", " Street")), ("9 Deer Creek Rd, Apt 4", ("9 ", "Deer Creek Rd,", " Apt 4")), ("Deer Creek", None), ("9 Street", None)]
    df = spark.createDataFrame([(a,) for a, _ in rows], "s string").select("s", geo.street_parts(F.col("s")).alias("p"))
    assert {r["s"]: tuple(r["p"]) if r["p"] else None for r in df.collect()} == dict(rows)


def test_json_safety(spark):
    rows = [('{"a":1}', '{"a":2}', '{"a":2}'), ('{"a":1}', '{"b":2}', "pre"), ('{"a":1}', '{"a":x}', "pre"), ("prose", "{broken", "{broken")]
    df = spark.createDataFrame(rows, "o string, s string, want string")
    assert df.where(FT.json_safe(F.col("o"), F.col("s"), F.lit("pre")) != F.col("want")).count() == 0


def test_known_names_that_are_words_are_not_swept(spark):
    known = spark.createDataFrame([("person", "Good", "Foo"), ("person", "Zzyzx", "Baz"), ("email", "a@b.co", "c@d.co"), ("person", "Workday", "Q")], "ptype string, original string, fake string")
    entries = {r["entry"] for r in FT.sweep_dictionary(known, Config(), ["workday"]).collect()}
    assert entries == {"Zzyzx", "a@b.co", "a%40b.co"}
