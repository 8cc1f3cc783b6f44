"""Whole-table behaviour: resolve, apply, sinks, the incremental copy."""

import json
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.config import Config
from veilframe.operators import apply as A
from veilframe.operators import resolve as R
from veilframe.operators.detector import RuleDetector, StreetRuleDetector
from veilframe.plans import keys as K
from veilframe.plans import plan as P
from veilframe.plans import profile as PR
from veilframe.plans.plan import ColumnPlan, RowFilter
from veilframe.sources import entity_map as em
from veilframe.sources import tables as S
from veilframe.streaming.incremental import IncrementalAnonymizer

CFG = Config(forced_words={"vexil": "aventor"}, company_map={"meta": "Vertex Labs"})
VALUES = [
    ("person", "full", "Zzyzx Qwerty"), ("person", "first", "Zzyzx"), ("person", "last", "Qwerty"), ("person", "full", "Qwerty, Zzyzx"),
    ("email", "", "zzyzx.qwerty@vexil.example"), ("person", "full", "Dr. Foo-Bar Baz (Vexil Corp)"), ("person", "full", "Zed Yyx [C]"),
    ("person", "full", "Lat Name （甲乙）lat.name@vexil.example"), ("person", "full", "甲乙丙"), ("person", "full", "管理员"),
    ("person", "full", "Qwerty_CV.docx"), ("person", "full", "P0091302"), ("org", "", "Vexil Global Ltd."), ("org", "", "UNSCO"), ("org", "", "Foo"),
    ("org", "", "昇迪"), ("org_code", "", "VXILABC Site VXIL_x"), ("org_code", "", "C_LLM_Foo_LLM"), ("location", "", "Faketown"), ("location", "", "上海,在线"),
    ("state_province", "", "CA"), ("street_name", "", "Streetfoo"), ("country", "", "USA"), ("url", "", "http://www.vexil.example/p"), ("birth", "", "1980.07"),
    ("person", "full", "a"), ("person", "full", "Old Foo"), ("location", "", "New Foo"), ("country", "", "New Foo"), ("person", "full", "Ulde Bar"),
    ("email", "", "ulde.bar@foo.example"), ("person", "full", "x Aventor y"),
]
MAP = [
    (1, "Names", "Old Foo", "Foo Bar", None, None), (2, "Country", "New Foo", "Older Foo", None, "N"), (3, "Other", "VXIL", "WPST", None, None),
    (4, "Names", "Ulde Bar", "Lum Nox", None, None), (5, "Other", "gone", None, None, None),
]


def frame(spark, values, parts=1):
    rows = [(p, r, o, None, None, 1) for p, r, o in values]
    return spark.createDataFrame(rows, R.VALUE_SCHEMA).repartition(parts)


@pytest.fixture(scope="module")
def entity_map(spark):
    return spark.createDataFrame(MAP, em.SCHEMA)


@pytest.fixture(scope="module")
def resolved(spark, entity_map):
    answer = R.resolve(frame(spark, VALUES), entity_map, config=CFG)
    rows = {(r["ptype"], r["original"]): r for r in answer.values.collect()}
    return answer, rows


def test_every_value_is_answered_once(resolved):
    _, rows = resolved
    assert len(rows) == len(VALUES) and all(r["fake"] is not None for r in rows.values())


def test_people_agree_across_forms(resolved):
    fake = {k: r["fake"] for k, r in resolved[1].items()}
    first, last = fake["person", "Zzyzx"], fake["person", "Qwerty"]
    assert fake["person", "Zzyzx Qwerty"] == f"{first} {last}" == fake["person", "Qwerty, Zzyzx"]
    assert fake["email", "zzyzx.qwerty@vexil.example"] == f"{first}.{last}@aventor.example".lower()
    assert re.fullmatch(r"Dr\. [A-Z]\w+-[A-Z]\w+ [A-Z]\w+ \(Aventor Corp\)", fake["person", "Dr. Foo-Bar Baz (Vexil Corp)"])
    assert re.fullmatch(r"[A-Z]\w+ [A-Z]\w+ \[C\]", fake["person", "Zed Yyx [C]"])


def test_bilingual_names_are_one_identity(resolved):
    out = resolved[1]["person", "Lat Name （甲乙）lat.name@vexil.example"]["fake"]
    m = re.fullmatch(r"(\w+) (\w+) （([一-鿿]{3,})）(\w+)\.(\w+)@aventor\.example", out)
    assert m and m.group(1).lower() == m.group(4) and m.group(2).lower() == m.group(5)
    assert re.fullmatch("[一-鿿]{3,}", resolved[1]["person", "甲乙丙"]["fake"])


def test_guards_and_reuse(resolved):
    rows = resolved[1]
    assert rows["person", "管理员"]["fake"] == "管理员" and rows["person", "a"]["outcome"] == "KEPT-SHORT"
    assert rows["person", "Qwerty_CV.docx"]["fake"].endswith(".docx") and "Qwerty" not in rows["person", "Qwerty_CV.docx"]["fake"]
    assert rows["person", "P0091302"]["etype"] == "id" and re.fullmatch(r"[G-Z]\d{7}", rows["person", "P0091302"]["fake"])
    assert (rows["person", "Old Foo"]["fake"], rows["person", "Old Foo"]["outcome"]) == ("Foo Bar", "REUSE:1")
    assert rows["country", "New Foo"]["outcome"] == "NOT-PII-SKIPPED" and rows["country", "New Foo"]["fake"] == "New Foo"
    assert rows["location", "New Foo"]["outcome"] == "REUSE-CROSS-TYPE" and rows["location", "New Foo"]["fake"] == "Older Foo"
    assert rows["person", "x Aventor y"]["fake"] == "x Aventor y"
    assert rows["email", "ulde.bar@foo.example"]["fake"].startswith("lum.nox@")


def test_organisations_and_places(resolved):
    fake = {k: r["fake"] for k, r in resolved[1].items()}
    assert fake["org", "Vexil Global Ltd."] == "Aventor Global Ltd." and re.fullmatch("[A-Z]{5}", fake["org", "UNSCO"])
    assert " " in fake["org", "Foo"] and re.fullmatch("[一-鿿]{4,}", fake["org", "昇迪"])
    assert fake["org_code", "VXILABC Site VXIL_x"].startswith("WPST") and " WPST_" in fake["org_code", "VXILABC Site VXIL_x"]
    parts = fake["org_code", "C_LLM_Foo_LLM"].split("_")
    assert parts[1] == parts[3] != "LLM"
    assert fake["location", "上海,在线"].endswith(",在线") and not fake["location", "上海,在线"].startswith("上海")
    assert re.fullmatch("[A-Z]{2}", fake["state_province", "CA"]) and fake["state_province", "CA"] != "CA"


def test_layout_does_not_change_fakes(spark, entity_map, resolved):
    again = R.resolve(frame(spark, VALUES[::-1], 7), entity_map, config=CFG).values
    assert {(r["ptype"], r["original"]): r["fake"] for r in again.collect()} == {k: r["fake"] for k, r in resolved[1].items()}


def test_stored_pairs_win_next_time(spark, entity_map, resolved):
    answer, rows = resolved
    added = em.new_rows(answer.new_pairs(), entity_map)
    ids = sorted(r["id"] for r in added.collect())
    assert ids == list(range(6, 6 + len(ids)))
    assert added.where("label = 'Other' and original rlike '^P0'").count() == 0
    grown = em.append(entity_map, added)
    more = VALUES + [("person", "full", "Newly Arrived"), ("org", "", "Bar"), ("location", "", "Othertown")]
    second = {(r["ptype"], r["original"]): r for r in R.resolve(frame(spark, more), grown, tokens=answer.tokens, config=CFG).values.collect()}
    for key, r in rows.items():
        assert second[key]["fake"] == r["fake"], key
    used = {r["fake"].lower() for r in rows.values()}
    assert not {second["person", "Newly Arrived"]["fake"].lower(), second["org", "Bar"]["fake"].lower(), second["location", "Othertown"]["fake"].lower()} & used


def test_mail_table_end_to_end(spark):
    body = (
        '<html><meta x><p>Hi Foo Bar, Meta here <a href="mailto:foo.bar@vexil.example">..</a> zzyzx said q%2Ffoo.bar%40vexil.example and '
        "foo.bar&#64;vexil.example, thanks Zzyzx Qwerty linkedin.com/in/zzyzx-qwerty linkedin.com/company/foo Dr. Hans Meier</p></html>"
    )
    recipients = '[{"emailAddress":{"name":"Foo Bar","address":"foo.bar@vexil.example"},"birth":"1980.07","phone":"","ResourceName":"Raul Qwertña-Raul.Q@vexil.example"}]'
    rows = [("m1", "Zzyzx Qwerty", "zzyzx.qwerty@vexil.example", recipients, body, "Re: Vexil 昇迪凡科", 10)]
    mail = spark.createDataFrame(rows, "id string, from_name string, from_address string, to_recipients string, body string, subject string, n int")
    plan = [ColumnPlan("from_name", "person"), ColumnPlan("from_address", "email")] + [ColumnPlan(c, "freetext", "freetext") for c in ("to_recipients", "body", "subject")]
    out = A.anonymize(mail, plan, "mail", ["id"], em.empty_map(spark), config=CFG, make_detector=RuleDetector)
    assert out.df.schema == mail.schema
    r = out.df.first()
    assert r["id"] == "m1" and r["n"] == 10
    to = json.loads(r["to_recipients"])[0]
    name, address = to["emailAddress"]["name"], to["emailAddress"]["address"]
    assert address == name.lower().replace(" ", ".") + "@aventor.example" and to["phone"] == "" and to["birth"] != "1980.07"
    local, _, resource_mail = to["ResourceName"].rpartition("-")
    assert resource_mail.split("@")[1] == "aventor.example" and "Raul" not in to["ResourceName"] and local
    text = r["body"]
    assert text.startswith("<html><meta x><p>Hi " + name + ", Vertex Labs here") and text.count(address.split("@")[0]) == 3
    assert "%40aventor.example" in text and "&#64;aventor.example" in text and "linkedin.com/company/foo" in text
    for leak in ("Zzyzx", "zzyzx", "Qwerty", "foo.bar", "Foo Bar", "Meier", "vexil"):
        assert leak not in text, leak
    assert r["from_name"] in text and "昇迪凡科" not in r["subject"] and r["subject"].startswith("Re: Aventor ")


def test_orders_with_ids_amounts_filters_and_widths(spark):
    schema = T.StructType([
        T.StructField("pid", T.StringType()), T.StructField("po", T.StringType()), T.StructField("amount", T.DecimalType(38, 18)), T.StructField("kind", T.StringType()),
        T.StructField("who", T.StringType(), True, {"max_len": 6}), T.StructField("note", T.StringType()),
    ])
    import decimal

    rows = [("VXIL", "VXIL_PO000001", decimal.Decimal("719.44"), "Customer", "Zzyzx Qwerty", "keep"), ("ABCD", "ABCD_PO000002", decimal.Decimal(0), "Priority", "Critical", "keep"), (None, "X-1", None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    plan = [ColumnPlan("pid", "id"), ColumnPlan("po", "id"), ColumnPlan("amount", "amount"), ColumnPlan("who", "person", row_filter=RowFilter("KIND", ("Customer",))), ColumnPlan("note", "org", enabled=False)]
    out = A.anonymize(df, plan, "orders", ["po"]).df
    assert out.schema == df.schema and out.count() == 3
    got = out.collect()
    one = next(r for r in got if r["kind"] == "Customer")
    two = next(r for r in got if r["kind"] == "Priority")
    assert one["po"].startswith(one["pid"] + "_") and one["pid"] != "VXIL" and len(one["po"]) == 13
    assert two["who"] == "Critical" and two["amount"] == 0 and one["note"] == "keep"
    assert len(one["who"]) <= 6 and one["who"] != "Zzyzx "[:6]
    none = next(r for r in got if r["kind"] is None)
    assert none["pid"] is None and none["amount"] is None and none["who"] is None


def test_composite_addresses(spark):
    cell = "12 NE Foo Street, Suite 2\nPunta Gorda, FL 00000\nUSA"
    df = spark.createDataFrame([("c1", cell, "bar@vexil.example Germany")], "id string, address1_composite string, other string")
    plan = [ColumnPlan("address1_composite", "location_composite"), ColumnPlan("other", "location_composite")]
    out = A.anonymize(df, plan, "contact", ["id"], config=CFG, make_geo_detector=StreetRuleDetector).df.first()
    lines = out["address1_composite"].split("\n")
    assert re.fullmatch(r"12 NE [\w\-]+ Street, Suite 2", lines[0]) and "Foo" not in lines[0]
    assert re.fullmatch(r"Punta Gorda, [A-Z]{2} \d{5}", lines[1]) and "FL" not in lines[1] and "00000" not in lines[1]
    assert re.fullmatch("[A-Z]{3}", lines[2]) and lines[2] != "USA"
    assert "@aventor.example" in out["other"] and "Germany" not in out["other"]


def test_merge_sink_changes_only_its_columns(spark, tmp_path):
    src = spark.createDataFrame([("a", "C0001", "x"), ("b", "C0002", "y"), (None, "C0003", "z")], "k string, code string, rest string")
    copy = src.withColumn("rest", F.lit("old"))
    merged = A.merge_into(copy, src, [ColumnPlan("code", "id"), ColumnPlan("rest", "org", enabled=False)], ["k"])
    got = {r["k"]: r for r in merged.collect()}
    assert len(got) == 3 and all(r["rest"] == "old" and r["code"] not in ("C0001", "C0002", "C0003") for r in got.values())
    with pytest.raises(K.KeyNotUnique):
        A.merge_into(copy, src.withColumn("k", F.lit("a")), [ColumnPlan("code", "id")], ["k"])
    A.rebuild(src, [ColumnPlan("code", "id")], str(tmp_path / "copy"), keys=["k"])
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 3


def test_keys_and_csv_exchange(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi"\nthere, ok'), (2, "long text"), (3, None)], "id int, t string")
    S.export_texts(df, "id", "t", str(tmp_path / "csv"))
    back = S.import_texts(spark, str(tmp_path / "csv"))
    assert {(r["row_id"], r["text"]) for r in back.collect()} == {("1", 'say "hi"\nthere, ok'), ("2", "long text")}
    assert K.choose_key(df) == ["id", "t"] and K.choose_key(df, source_key=["id"]) == ["id"]
    assert K.key_uniqueness(df.limit(0), ["id"]).first()["is_unique"]
    with pytest.raises(K.KeyNotUnique):
        K.choose_key(spark.createDataFrame([(1,), (1,)], "a int"))
    assert S.row_budget("full") is None and S.row_budget("7") == 7


def test_keys_of_wide_tables(spark):
    """A key may lie behind any number of columns, and holds no column it does not need."""
    few = [F.lit(i).alias(f"c{i}") for i in range(13)]
    wide = spark.range(500).select(*few, "id")
    assert K.choose_key(wide) == ["id"]
    two = spark.range(900).select(*few, (F.col("id") % 30).alias("a"), F.floor(F.col("id") / 30).alias("b"), F.when(F.col("id") % 7 > 0, F.col("id") % 9).alias("x"))
    assert K.choose_key(two) == ["a", "b"]
    three = spark.range(1000).select(*few, (F.col("id") % 10).alias("a"), (F.floor(F.col("id") / 10) % 10).alias("b"), F.lit(None).cast("int").alias("n"), F.floor(F.col("id") / 100).alias("c"))
    assert K.choose_key(three) == ["a", "b", "c"]
    with pytest.raises(K.KeyNotUnique):
        K.choose_key(three.unionByName(three))
    assert K.find_key(wide.limit(0)) == ["c0"] and K.order_columns(wide) == wide.columns


def test_plan_tools(spark):
    df = spark.createDataFrame([("Zzyzx Qwerty", "a@b.co", "Gold", 1.0)], "fullname string, work string, stepname string, totalamount double")
    plan = PR.analyze(df)
    by = {r["column"]: r for r in plan.collect()}
    assert by["fullname"]["type"] == "person" and by["work"]["type"] == "email" and by["stepname"]["type"] == "skip" and not by["totalamount"]["enabled"]
    assert by["fullname"]["samples"] == ["Zzyzx Qwerty"]
    assert P.unknown_columns(plan, {"nope": None, "WORK": None}) == ["nope"]
    listed = P.plan_list(plan)
    assert [p.column for p in P.override(listed, ["STEPNAME"])] == ["stepname"]
    with pytest.raises(ValueError):
        P.override(listed, ["nope"])
    assert P.plan_list(P.plan_frame(spark, listed)) == listed


def test_trial_only_reads_the_map(spark, tmp_path, entity_map):
    df = spark.createDataFrame([(i, f"Zed Num{chr(97 + i)}") for i in range(5)], "id int, fullname string")
    A.trial(df, [ColumnPlan("fullname", "person")], str(tmp_path), entity_map, 3, ["id"], config=CFG)
    assert spark.read.parquet(f"{tmp_path}/copy").count() == 3 and spark.read.parquet(f"{tmp_path}/map").count() == 3
    assert {r["outcome"] for r in spark.read.parquet(f"{tmp_path}/audit").collect()} == {"NEW:DRY-RUN"}


def test_incremental_copy_survives_a_repeated_batch(spark, tmp_path):
    source, state = tmp_path / "in", str(tmp_path / "state")
    plan = [ColumnPlan("fullname", "person"), ColumnPlan("company", "org")]
    first = spark.createDataFrame([(1, "Zzyzx Qwerty", "Foo Works"), (2, "Zed Yyx", "Bar")], "id int, fullname string, company string")
    second = spark.createDataFrame([(3, "Zzyzx Qwerty", "Foo Works"), (4, "Qwe Yyx", "Baz")], first.schema)
    first.write.parquet(str(source / "a"))
    job = IncrementalAnonymizer(spark, plan, state, keys=["id"], config=CFG)
    job.start(f"{source}/*", first.schema).awaitTermination()
    learned = job.entity_map().count()
    second.write.parquet(str(source / "b"))
    job.start(f"{source}/*", first.schema).awaitTermination()
    once = {r["id"]: (r["fullname"], r["company"]) for r in spark.read.parquet(job.output()).collect()}
    grown = job.entity_map()
    assert len(once) == 4 and once[1] == once[3] and once[2][0].split()[1] == once[4][0].split()[1]
    assert learned == 4 and grown.count() == 6 and grown.select("id").distinct().count() == 6
    job.process(second, 1)
    assert {r["id"]: (r["fullname"], r["company"]) for r in spark.read.parquet(job.output()).collect()} == once
    assert job.entity_map().count() == 6


def test_splits_of_heavy_rows_are_cut_finer(spark, tmp_path):
    from checks.expressions import compound_ids

    rows = spark.range(600).select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"))
    path = str(tmp_path / "orders.parquet")
    rows.repartition(24).write.parquet(path)
    splits, cores = spark.read.parquet(path).rdd.getNumPartitions(), spark.sparkContext.defaultParallelism
    assert splits >= cores  # enough of them that the plain scan leaves them as they are
    assert S.scan(spark, path, spread=True).rdd.getNumPartitions() == splits
    assert S.scan(spark, path, spread=True, tasks_per_split=3).rdd.getNumPartitions() == 3 * splits
    found = compound_ids(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() >= 8 * splits
    assert {r.o_orderkey for r in found.collect()} == set(range(600)) and found.count() == 600
