import datetime
import decimal
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe import config as C
from veilframe.config import Config
from veilframe.functions import text as X
from veilframe.functions.seeds import permute_chars
from veilframe.operators import generators as G
from veilframe.operators.allocate import spelled_name, words_of
from veilframe.plans.plan import is_amount_column, person_role, table_domain


def strings(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def mapped(spark, values, build):
    rows = strings(spark, values).select("v", build(F.col("v")).alias("f")).collect()
    return {r["v"]: r["f"] for r in rows}


def shape(value):
    return re.sub("[G-Z]", "Z", re.sub("[g-z]", "z", re.sub("[A-F]", "A", re.sub("[a-f]", "a", re.sub("[0-9]", "9", value)))))


def test_ids_keep_their_class_and_never_a_letter(spark):
    values = ["P0000001", "P3003490", "00000000-0000-4000-8000-00000000000a", "VXIL_PO000001", "712020:ec6a", "a", "x-Y_z", "é9"]
    out = mapped(spark, values, G.fake_id)
    for v, f in out.items():
        assert shape(v) == shape(f), (v, f)
        assert all(a != b for a, b in zip(v, f) if a.isascii() and a.isalpha()), (v, f)


def test_letters_never_map_to_themselves(spark):
    letters = [chr(c) for c in (*range(65, 91), *range(97, 123))]
    grid = strings(spark, letters)
    for salt in range(12):
        assert grid.where(permute_chars(F.col("v"), f"s{salt}") == F.col("v")).count() == 0


def test_ids_are_a_bijection_per_mask(spark):
    codes = spark.range(10000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("v"))
    fakes = codes.select(G.fake_id(F.col("v")).alias("f"))
    assert fakes.distinct().count() == 10000
    assert fakes.where(~F.col("f").rlike("^[0-9]{4}$")).count() == 0


def test_long_ids_and_layout(spark):
    long = "Ab9" * 60
    once = mapped(spark, [long], G.fake_id)[long]
    assert len(once) == 180 and shape(once) == shape(long)
    again = strings(spark, [long] * 5).repartition(5).select(G.fake_id(F.col("v"))).distinct().collect()
    assert [r[0] for r in again] == [once]


def test_phone_keeps_everything_but_digits(spark):
    out = mapped(spark, ["+1 (415) 555-0100", "n/a"], G.fake_phone)
    assert re.fullmatch(r"\+\d \(\d{3}\) \d{3}-\d{4}", out["+1 (415) 555-0100"])
    assert re.fullmatch(r"\+1-555-\d{4}", out["n/a"])


def test_postal_keeps_no_digit(spark):
    out = mapped(spark, ["00000-0000", "SW1A 1AA", "123456"], G.fake_postal)
    for v, f in out.items():
        assert len(v) == len(f)
        assert all(a != b for a, b in zip(v, f) if a.isdigit())
        assert all(a == b for a, b in zip(v, f) if not a.isdigit())


def test_country_forms(spark):
    out = mapped(spark, ["US", "usa", "United States", "INDIA", "in", "China"], G.fake_country)
    assert out["US"] in {c[1] for c in C.COUNTRIES}
    assert out["usa"].upper() in {c[2] for c in C.COUNTRIES} and out["usa"].islower()
    assert out["United States"] in {c[0] for c in C.COUNTRIES}
    assert out["INDIA"] != "INDIA" and out["in"] != "in" and out["China"] != "China"


def test_urls(spark):
    cfg = Config(forced_words={"vexil": "aventor"})
    values = ["http://www.vexil.example/path?q=1", "https://u:p@www.foobar.co.uk:8080/a#b", "foo.example.com/x", "https://*", "two words", "https://Foo x https://b.com"]
    out = mapped(spark, values, lambda v: G.fake_url(v, cfg))
    assert out[values[0]] == "http://www.aventor.example/path?q=1"
    assert re.fullmatch(r"https://www\.[a-z]+\.co\.uk:8080/a#b", out[values[1]]) and "foobar" not in out[values[1]]
    assert re.fullmatch(r"foo\.[a-z]+\.com/x", out["foo.example.com/x"])
    assert out["https://*"] == "https://*"
    assert out["two words"] is None and out["https://Foo x https://b.com"] is None


def test_domains(spark):
    cfg = Config(forced_words={"vexil": "aventor"})
    out = mapped(spark, ["Gmail.com", "vexil.com", "foo.co.uk", "nodot", ""], lambda v: G.fake_domain(v, cfg))
    assert out["Gmail.com"] == "Gmail.com" and out["vexil.com"] == "aventor.com" and out["nodot"] == "nodot"
    assert out[""] == "example.com" and out["foo.co.uk"].endswith(".co.uk") and not out["foo.co.uk"].startswith("foo")


def test_birth_dates_stay_near_and_valid(spark):
    values = ["1980.07", "1999.10.16", "2000-02-29", "1976/1", "16.7", "1980.13"]
    out = mapped(spark, values, G.fake_birth)
    moved = datetime.date(*map(int, out["1999.10.16"].split(".")))
    assert 1995 <= moved.year <= 2003 and moved != datetime.date(1999, 10, 16)
    datetime.date(*map(int, out["2000-02-29"].split("-")))
    assert re.fullmatch(r"\d{4}\.\d{2}", out["1980.07"]) and out["1980.07"] != "1980.07"
    assert re.fullmatch(r"\d{4}/\d{1,2}", out["1976/1"])
    assert re.fullmatch(r"\d{2}\.\d", out["16.7"]) and re.fullmatch(r"\d{4}\.\d{2}", out["1980.13"])


def test_amounts_keep_type_scale_and_bound(spark):
    schema = T.StructType([
        T.StructField("k", T.IntegerType()), T.StructField("d", T.DecimalType(38, 18)),
        T.StructField("i", T.IntegerType()), T.StructField("b", T.ByteType()), T.StructField("f", T.DoubleType()), T.StructField("s", T.StringType()),
    ])
    big = decimal.Decimal("99999999999999999999.999999999999999999")
    rows = [(1, decimal.Decimal("719.44"), 500, 127, 10.0, "12.5"), (2, decimal.Decimal("0"), 0, 0, 0.0, "x"), (3, big, -500, -128, -1.0, "0")]
    df = spark.createDataFrame(rows, schema)
    key = F.col("k").cast("string")
    out = df.select("k", *[G.fake_amount(F.col(f.name), f.dataType, "t", f.name, key).alias(f.name) for f in schema.fields[1:]])
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in schema.fields]
    got = {r["k"]: r for r in out.collect()}
    assert got[1]["d"] != decimal.Decimal("719.44") and abs(got[1]["d"] - decimal.Decimal("719.44")) <= decimal.Decimal("107.92")
    assert 425 <= got[1]["i"] <= 575 and got[2]["d"] == 0 and got[2]["i"] == 0 and got[2]["f"] == 0 and got[2]["s"] == "x"
    assert got[3]["d"] is not None and abs(got[3]["d"] / big - 1) <= decimal.Decimal("0.1501")


def test_amount_columns():
    assert all(is_amount_column(c) for c in ("totalamount", "NetPrice", "qty", "exchangerate", "budget"))
    assert not any(is_amount_column(c) for c in ("price_id", "orderyear", "ratetype", "discount_code", "flagged_total_flag", "name"))


def test_roles_and_domains():
    assert [person_role(c) for c in ("First_Name", "surname", "fullname", None)] == ["first", "last", "full", "full"]
    cfg = Config(resume_tables=("cv",))
    assert table_domain("cv_anonymized", cfg) == "resume" and table_domain("mail", cfg) == "general"


def test_reference_columns_are_denied():
    for name in ("stepname", "ProductLine", "Billing_type_name", "applicationname", "ProjectGroup"):
        assert re.search(C.HINTS["reference"], name, re.I)
    assert not re.search(C.HINTS["reference"], "fullname", re.I)


def test_stop_words(spark):
    out = mapped(spark, ["admin", "team0012", "Target", "Target Corp", "管理员", "Zzyzx"], X.is_harvest_stop)
    assert out == {"admin": True, "team0012": True, "Target": True, "Target Corp": False, "管理员": True, "Zzyzx": False}


def test_fit_width(spark):
    out = mapped(spark, ["Bridgeport Systems", "Short", "Bridgeportsystems", "a b c d e f g h"], lambda v: X.fit_width(v, 12))
    assert out == {"Bridgeport Systems": "Bridgeport", "Short": "Short", "Bridgeportsystems": "Bridgeportsy", "a b c d e f g h": "a b c d e f"}


def test_case_like(spark):
    rows = [("SMITH", "abc-def", "ABC-DEF"), ("smith", "Abc", "abc"), ("Smith", "abc-DEF x", "Abc-Def X"), ("iPhone", "abC", "abC"), ("12", "abC", "abC")]
    df = spark.createDataFrame(rows, "o string, f string, want string")
    assert df.where(X.case_like(F.col("o"), F.col("f")) != F.col("want")).count() == 0


def test_forced_words(spark):
    forced = {"vexil": "aventor", "vexiledge": "aventoredge"}
    out = mapped(spark, ["VEXIL Vexil vexilglobal VexilEdge %2Fvexil"], lambda v: X.apply_forced(v, forced, False))
    assert list(out.values()) == ["AVENTOR Aventor aventorglobal Aventoredge %2Faventor"]
    bounded = mapped(spark, ["vexilglobal vexil"], lambda v: X.apply_forced(v, forced, True))
    assert list(bounded.values()) == ["vexilglobal aventor"]


def test_bilingual_split(spark):
    out = mapped(spark, ["Lat Name （甲乙）", "Lat Name (甲 乙)lat.name@vexil.example", "甲乙", "Lat (Foo)"], X.split_bilingual)
    assert tuple(out["Lat Name （甲乙）"]) == ("Lat Name", "甲乙", "（", "）", "")
    assert out["Lat Name (甲 乙)lat.name@vexil.example"]["email"] == "lat.name@vexil.example"
    assert out["甲乙"] is None and out["Lat (Foo)"] is None


def test_json_expressions(spark):
    tricky = '{"a":{"b c":"x\\":y, \\"z\\": 1","d":[{"e":1}]}}'
    row = strings(spark, [tricky]).select(X.json_keys(F.col("v")).alias("k"), X.is_json(F.col("v")).alias("ok")).first()
    assert row["k"] == ["a", "b c", "d", "e"] and row["ok"]
    assert mapped(spark, ['a"b\n'], X.json_escape) == {'a"b\n': 'a\\"b\\n'}


def test_spellings_are_unique(spark):
    slots = spark.range(0, 200_000, 1, 8).withColumn("id", F.col("id") * 13)
    for endings in (C.GIVEN_ENDINGS, C.SURNAME_ENDINGS):
        assert slots.select(spelled_name(F.col("id"), endings).alias("n")).distinct().count() == 200_000
    assert spark.range(50_000).select(words_of(F.col("id"), C.ORG_HEADS, " ").alias("w")).distinct().count() == 50_000
    both = slots.select(spelled_name(F.col("id"), C.GIVEN_ENDINGS).alias("n")).intersect(
        slots.select(spelled_name(F.col("id"), C.SURNAME_ENDINGS).alias("n"))
    )
    assert both.count() == 0
