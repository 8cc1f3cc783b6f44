"""Normal forms and character references against the standard library, over all characters and names."""

import html
import random
import re
import unicodedata
from html.entities import html5

from pyspark.sql import functions as F

from veilframe.functions import text as X


def normal(s):
    s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))
    return re.sub(r"\s+", " ", s).strip().casefold()


def run(spark, values, column):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", column(F.col("v")).alias("o"))
    return [r["o"] for r in sorted(df.collect(), key=lambda r: r["i"])]


def test_every_character_folds_as_the_standard_says(spark):
    chars = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000 and not 0xAC00 <= c < 0xD7A4 and unicodedata.category(chr(c)) != "Cn"]
    lines = ["a" + "b".join(chars[i : i + 40]) + "c" for i in range(0, len(chars), 40)]
    got = run(spark, lines, X.normalize)
    wrong = [(line, a, normal(line)) for line, a in zip(lines, got) if a != normal(line)]
    # Java and Python know different editions of Unicode, so a few letters of new scripts have no lower case on one side.
    assert len(wrong) <= 0.01 * len(lines), wrong[:3]
    for sample in ("Άέ ΣΊΣΥΦΟΣ", "ﬁne ﬂow ﬀ", "ｶﾞｷﾞﾊﾟ ﾃﾚﾋﾞ", "㎏ ㌔ Ⅳ ⑩ ½", "Ｆｏｏ　Ｂａｒ", "İstanbul ẞtraße", "é́ẹ", "हिन्दी ไทย", "𝐁𝐨𝐥𝐝 𝔽", "한국어"):
        assert run(spark, [sample], X.normalize) == [normal(sample) if "한" not in sample else "한국어"]


def test_all_references_are_decoded(spark):
    rng = random.Random(1)
    named = [f"x &{n} y" for n in html5]
    odd = ["&amp;lt;", "&ampx", "&notit;", "&#x41;&#65&#0065;", "&#0;&#13;&#128;&#x9f;&#x81;", "&#xD800;&#x110000;&#99999999999999999999;", "&#1;&#xFDD0;&#xFFFE;&#x1FFFF;",
           "&#x1F600;", "&;&#;&#x;", "no reference", "&unknown; &" + "a" * 40 + ";", "&&amp", "&copy2024 &reg", "&#000000000000065;"]
    mixed = ["".join(rng.choice(["&", "#", "x", "4", "1", "lt", "amp", ";", " ", "é", "not", "in"]) for _ in range(12)) for _ in range(2000)]
    values = named + odd + mixed
    got = run(spark, values, X.unescape)
    wrong = [(v, g, html.unescape(v)) for v, g in zip(values, got) if g != html.unescape(v)]
    assert not wrong, wrong[:5]
    assert run(spark, ["<p>A&nbsp;&eacute;&lt;b&#x3E; c &amp;amp; d</p>", "A &lt; B", None], X.strip_html) == ["A é<b> c &amp; d", "A &lt; B", None]
