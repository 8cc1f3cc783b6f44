"""Consistency over calls and runs, and the shape of the copy's plan."""

import pytest
from pyspark.sql import functions as F

from veilframe.config import GIVEN_ENDINGS, Config
from veilframe.operators import allocate
from veilframe.operators import resolve as R
from veilframe.operators.allocate import digits, marks_of, slots, spelled_name, words_of
from veilframe.operators.apply import anonymize
from veilframe.operators.ledger import Ledger
from veilframe.operators.people import HINT_TYPE
from veilframe.plans.plan import ColumnPlan
from veilframe.sources import entity_map as em
from veilframe.streaming.incremental import IncrementalAnonymizer


def values(spark, rows):
    return spark.createDataFrame([(p, r, o, c, None, 1) for p, r, o, c in rows], R.VALUE_SCHEMA)


def word(number):
    out = ""
    for _ in range(4):
        number, at = divmod(number, 26)
        out += "abcdefghijklmnopqrstuvwxyz"[at]
    return "Q" + out


def fakes(answer):
    return {(r["ptype"], r["role"], r["original"], r["country"]): r["fake"] for r in answer.values.collect()}


@pytest.mark.parametrize("kept", ["ledger", "map"])
def test_two_runs_share_no_fake(spark, kept):
    """Thousands of one-word companies crowd the candidates, so most carry a tail."""
    first = values(spark, [("org", "", word(i * 7), None) for i in range(1500)] + [("person", "full", f"甲乙{chr(0x4E10 + i)}", None) for i in range(60)])
    second = values(spark, [("org", "", word(i * 7 + 3), None) for i in range(1500)] + [("person", "full", f"丙丁{chr(0x4E10 + i)}", None) for i in range(60)])
    one = R.resolve(first, em.empty_map(spark))
    if kept == "ledger":
        two = R.resolve(second, ledger=one.ledger.settled())
    else:
        two = R.resolve(second, em.append(em.empty_map(spark), em.new_rows(one.new_pairs(), em.empty_map(spark))))
    a, b = fakes(one), fakes(two)
    assert len({f.lower() for f in [*a.values(), *b.values()]}) == len(a) + len(b) == 3120


def test_later_calls_answer_as_earlier_ones(spark):
    long = "Zzyzx " * 60
    rows = [("org", "", "Foo Works", None), ("person", "first", "Kim", None), ("person", "last", "Kim", None), ("email", "", "kim.foo@bar.example", None), ("org", "", long, None)]
    one = R.resolve(values(spark, rows), em.empty_map(spark))
    two = R.resolve(values(spark, rows + [("org", "", "Bar Works", None)]), ledger=one.ledger.settled())
    a, b = fakes(one), fakes(two)
    assert all(b[k] == f for k, f in a.items())
    assert {r["original"] for r in two.values.where("outcome = 'NEW'").collect()} == {"Bar Works"}
    assert len(set(b.values())) == len(b)


def test_a_text_of_several_types_has_one_fake(spark):
    rows = [("org", "", "Qvorn", None), ("location", "", "Qvorn", None), ("city", "", "Qvorn", None), ("odd", "", "qvorn", None)]
    assert len({f.lower() for f in fakes(R.resolve(values(spark, rows))).values()}) == 1
    strict = fakes(R.resolve(values(spark, rows), em.empty_map(spark), config=Config(strict_labels=True)))
    assert strict["org", "", "Qvorn", None] != strict["location", "", "Qvorn", None] == strict["city", "", "Qvorn", None]


def test_names_of_different_types_are_kept_apart(spark, monkeypatch):
    """Whatever a generator returns, two originals do not get one name; the one in the map keeps its own."""
    known = spark.createDataFrame([(1, "CompanyName", "Old", "Same Name", None, None)], em.SCHEMA)
    same = lambda keys, ctx: keys.select(*R.KEYS, F.lit("Same Name").alias("fake"))
    monkeypatch.setitem(R.GENERATORS, "org", same)
    monkeypatch.setitem(R.GENERATORS, "location", same)
    rows = [("org", "", "Foo", None), ("location", "", "Bar", None), ("org", "", "Baz", None), ("org", "", "Old", None)]
    got = fakes(R.resolve(values(spark, rows), known))
    assert len({f.lower() for f in got.values()}) == 4 and got["org", "", "Old", None] == "Same Name"


def test_states_stay_within_the_faked_country(spark):
    from veilframe import config as C
    from veilframe.operators.generators import fake_country

    rows = [("state_province", "", s, c) for c in ("Germany", "India", "Utopia") for s in ("CA", "Texas", "Ohio", "NY", "Utah", "Iowa", "Maine", "Idaho", "Nevada", "Oregon")]
    got = fakes(R.resolve(values(spark, rows)))
    for country in ("Germany", "India", "Utopia"):
        there = spark.range(1).select(fake_country(F.lit(country)).alias("c")).first()["c"]
        alpha = next(c[1] for c in C.COUNTRIES if there in c)
        own = {w.lower() for pair in C.SUBDIVISIONS.get(alpha, ()) for w in pair}
        mine = [f.lower() for (_, _, _, c), f in got.items() if c == country]
        assert len(set(mine)) == len(mine) == 10
        if own:
            pool = {w.replace("-", " ") for w in own}
            assert all(f in own or all(part in " ".join(pool) for part in f.replace("-", " ").split()) for f in mine)


def test_numbers_are_spelled_at_any_length(spark):
    """Every long has its own spelling, also past the lengths that used to be the end."""
    numbers = [0, 1, 19, 20, 20**6 + 5, 20**6 + 6, 2**40, 2**40 + 1, 2**53 + 1, 2**53 + 2, 2**62, 2**63 - 1]
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    words = [f"w{i}" for i in range(20)]
    got = df.select("n", words_of(F.col("n"), words, " ").alias("w"), spelled_name(F.col("n"), GIVEN_ENDINGS).alias("s"), digits(F.col("n"), 2).alias("d")).collect()
    assert len({r["w"] for r in got}) == len({r["s"] for r in got}) == len(numbers)
    for r in got:
        value = 0
        for w in reversed(r["w"].split(" ")):
            value = value * 20 + int(w[1:]) + 1
        assert value - 1 == r["n"]
        assert sum((d + 1) << i for i, d in enumerate(r["d"])) - 1 == r["n"]


def test_marks_continue_where_slots_ended(spark):
    rows = [spark.createDataFrame([("g", f"{part}-{i}") for i in range(5000)], "g string, nk string") for part in "ab"]
    first = slots(rows[0], ["g"], "nk")
    second = slots(rows[1], ["g"], "nk", marks_of(first))
    both = first.select("slot").unionByName(second.select("slot"))
    assert both.distinct().count() == 10_000
    assert allocate.merged_marks(marks_of(first), marks_of(second)).agg(F.max("next")).first()[0] > 1


def joins(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum(line.count("Join ") for line in plan.splitlines())


def test_copy_joins_once_however_many_columns(spark):
    plan = [ColumnPlan("who", "person"), ColumnPlan("firm", "org"), ColumnPlan("town", "location"), ColumnPlan("code", "id"), ColumnPlan("site", "url")]
    df = spark.createDataFrame([(i, f"Zed {word(i)}", word(i % 40), f"Town{word(i % 7)}", f"AB{i:06d}", f"https://www.{word(i)}.example/x") for i in range(300)], "id int, who string, firm string, town string, code string, site string")
    assert joins(anonymize(df, plan[3:], keys=["id"]).df) == 0
    copy = anonymize(df, plan, keys=["id"]).df
    assert joins(copy) == 1
    got, want = {r["id"]: r for r in copy.collect()}, df.collect()
    for p in plan:
        pairs = {(w[p.column], got[w["id"]][p.column]) for w in want}
        assert len({o for o, _ in pairs}) == len(pairs) and all(o != f for o, f in pairs), p.column
        assert p.type == "url" or len({f for _, f in pairs}) == len(pairs), p.column  # hosts take their words from a pool
    # With a map, identifiers it knows keep their fake there; the others still need no table.
    known = spark.createDataFrame([(1, "Other", "AB000007", "ZX999999", None, None)], em.SCHEMA)
    again = {r["id"]: r["code"] for r in anonymize(df, plan[3:], keys=["id"], entity_map=known).df.collect()}
    assert again[7] == "ZX999999" and all(again[i] == got[i]["code"] for i in range(300) if i != 7)


def test_copy_of_a_mostly_empty_table(spark):
    """Rows without a value take no part in the join and are spread over its tasks."""
    df = spark.range(20_000).select("id", F.when(F.col("id") % 10 == 0, F.concat(F.lit("Firm "), F.col("id").cast("string"))).alias("firm"))
    copy = anonymize(df, [ColumnPlan("firm", "org")], keys=["id"]).df
    got = copy.agg(F.count("*").alias("n"), F.count("firm").alias("full"), F.count_distinct("firm").alias("d")).first()
    assert (got["n"], got["full"], got["d"]) == (20_000, 2_000, 2_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        from veilframe.operators.joins import lookup

        table = df.where("firm is not null").select("firm", F.lit("x").alias("fake"))
        sizes = [r["n"] for r in lookup(df, table, ["firm"]).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        for key, value in (("spark.sql.autoBroadcastJoinThreshold", "10485760"), ("spark.sql.adaptive.enabled", "true"), ("spark.sql.shuffle.partitions", "4")):
            spark.conf.set(key, value)
    assert max(sizes) < 3 * 20_000 / 16


def test_hinted_addresses_agree_with_the_row(spark):
    """Addresses without separators are read by the names of their row, and stay apart."""
    rows = [(1, "Zzyzx", "Qwerty", "zzyzxqwerty@bar.example"), (2, "Foo", "Qwerty", "fqwerty@bar.example"), (3, "Zzyzx", "Noone", "noone.zzyzx@bar.example")]
    df = spark.createDataFrame(rows, "id int, firstname string, lastname string, email string")
    plan = [ColumnPlan("firstname", "person"), ColumnPlan("lastname", "person"), ColumnPlan("email", "email")]
    got = {r["id"]: r for r in anonymize(df, plan, keys=["id"]).df.collect()}
    local = {i: r["email"].split("@")[0] for i, r in got.items()}
    assert local[1] == (got[1]["firstname"] + got[1]["lastname"]).lower()
    assert got[2]["lastname"].lower() in local[2] and "qwerty" not in local[2]
    assert local[3] == f"{got[3]['lastname']}.{got[3]['firstname']}".lower()
    assert HINT_TYPE and len(set(local.values())) == 3


def test_versions_are_replaced_as_a_whole(spark, tmp_path):
    plan, state = [ColumnPlan("firm", "org")], str(tmp_path / "state")
    job = IncrementalAnonymizer(spark, plan, state, keys=["id"], compact_every=2)
    parts = [spark.createDataFrame([(i, word(i)) for i in range(n, n + 200)], "id int, firm string") for n in (0, 200, 400)]
    for number, part in enumerate(parts):
        job.process(part, number)
    once = {r["id"]: r["firm"] for r in spark.read.parquet(job.output()).collect()}
    assert len(set(once.values())) == 600 and job.entity_map().count() == 600
    assert all(len(folders) < 2 for folders in job.version().folders.values())
    job.process(parts[2], 2)
    assert {r["id"]: r["firm"] for r in spark.read.parquet(job.output()).collect()} == once
    assert job.entity_map().count() == 600 and job.version(2).batch == 1
