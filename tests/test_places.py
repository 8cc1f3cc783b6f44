"""Places in texts: runs of any length, against a plain search, with a gazetteer of any size."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from veilframe.operators import geo

PLACES = [
    ("united kingdom of great britain", "country", False), ("united kingdom", "country", False), ("sao paulo", "city", False), ("fl", "state_province", False),
    ("georgia", "country", True), ("st. john's", "city", False), ("new york", "city", False), ("york", "city", False), ("de", "country", False),
]
TEXTS = [
    "In the United  Kingdom of Great\nBritain and São Paulo", "Punta Gorda, FL 33950", "the fl of it", "FL", "x\nFL\ny", "New York York, DE", "new, york",
    "Georgia georgia", "", "St. John's", None, "SÃO PAULO é York",
]


def plain(text):
    """Every run of words, longest first, from the left."""
    folded = "".join(map(geo._plain, text))
    spans = [m.span() for m in re.finditer(geo.WORD, folded)]
    known = {nk: (t, a) for nk, t, a in PLACES}
    finder, out, i = geo.PlaceFinder([]), [], 0
    while i < len(spans):
        for j in range(len(spans) - 1, i - 1, -1):
            start, end = spans[i][0], spans[j][1]
            hit = known.get(" ".join(folded[start:end].split()))
            if hit and finder._trusted(text, start, end, len(spans) == 1):
                out.append((start, end, *hit))
                i = j
                break
        i += 1
    return out


def test_runs_against_a_plain_search():
    rng = random.Random(2)
    words = ["united", "Kingdom", "of", "great", "Britain", "new", "York", "FL", "DE", "x", ",", "\n", "12345", "São", "Paulo", "st.", "john's"]
    finder = geo.PlaceFinder(PLACES)
    for text in [t for t in TEXTS if t is not None] + ["".join(rng.choice(words) + rng.choice([" ", " ", "  ", ""]) for _ in range(rng.randint(0, 14))) for _ in range(4000)]:
        assert finder.found(text) == plain(text), text


@pytest.mark.parametrize("bounded", [True, False])
def test_any_size_of_gazetteer_gives_the_same(spark, monkeypatch, bounded):
    if not bounded:
        monkeypatch.setattr(geo, "MOST_PLACES", 0)
    places = spark.createDataFrame(PLACES, "nk string, ptype string, ambiguous boolean")
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, cell string").withColumn("start", F.lit("clash"))
    got = {}
    for r in geo.gazetteer_spans(df, "id", "cell", places).collect():
        got.setdefault(r["id"], []).append((r["start"], r["end"], r["type"], r["ambiguous"]))
    assert {i: sorted(s) for i, s in got.items()} == {i: plain(t) for i, t in enumerate(TEXTS) if t and plain(t)}
    assert (0, 4) not in got and any(TEXTS[0][a:b].startswith("United  Kingdom of Great") for a, b, *_ in got[0])
    assert geo.gazetteer_spans(df.limit(0), "id", "cell", places).collect() == []


def test_time_grows_with_the_text():
    finder = geo.PlaceFinder([("aa " * n + f"b{n}", "city", False) for n in range(1, 12)] + PLACES)

    def spent(n):
        text = "aa york new " * n
        begun = time.process_time()
        assert len(finder.found(text)) == n
        return time.process_time() - begun

    spent(500)
    assert spent(60_000) < 30 * spent(6_000)
