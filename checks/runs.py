"""Consistency of whole copies: within one run, and over runs that go on from one another."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.base import CONTACTS_SQL, contacts, name_expr, name_sql, query, table
from checks.tables import CONTACT_PLAN, CUSTOMER_PLAN
from veilframe.config import DEFAULT
from veilframe.operators.apply import anonymize
from veilframe.operators.detector import RuleDetector
from veilframe.plans.plan import ColumnPlan
from veilframe.session import ensure_checkpoint_dir, materialize
from veilframe.sources import entity_map as em
from veilframe.streaming.incremental import IncrementalAnonymizer

COUNTED = ("fullname", "email", "company", "city")


def _violations(pairs, kind):
    """Of ``original, fake`` pairs: distinct originals, those with several fakes, fakes with several originals."""
    folded = pairs.select(F.lower("original").alias("o"), F.lower("fake").alias("f")).distinct()
    split = folded.groupBy("o").agg(F.count("*").alias("n")).agg(F.count("*").alias("originals"), F.count_if(F.col("n") > 1).alias("split"))
    shared = folded.groupBy("f").agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1))
    return split.select(F.lit(kind).alias("kind"), "originals", "split", shared.scalar().alias("shared"))


def _union(frames):
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _letters(spark, sf_dir):
    """Contacts with a letter that names another contact, in JSON and in prose."""
    c = contacts(spark, sf_dir)
    other = c.select((F.col("c_custkey") + 1).alias("c_custkey"), F.col("fullname").alias("o_name"), F.col("email").alias("o_email"))
    both = c.join(other, "c_custkey", "left")
    json = F.concat(F.lit('{"from": {"name": "'), F.col("o_name"), F.lit('", "address": "'), F.col("o_email"), F.lit('"}}'))
    prose = F.concat(F.lit("Dr. "), F.col("o_name"), F.lit(" of Quorvex Norrin Ltd wrote to "), F.col("email"))
    return both.withColumn("sender", json).withColumn("note", prose).drop("o_name", "o_email")


LETTER_PLAN = [*CONTACT_PLAN, ColumnPlan("sender", "freetext", "freetext"), ColumnPlan("note", "freetext", "freetext")]
_counts = " UNION ALL ".join(f"SELECT '{c}' AS kind, count(DISTINCT lower({c})) AS originals, 0::BIGINT AS split, 0::BIGINT AS shared FROM {CONTACTS_SQL}" for c in COUNTED)


@query(
    "copy_one_fake_per_original",
    f"""{_counts} UNION ALL SELECT 'all', (SELECT count(*) FROM (SELECT DISTINCT lower(v) FROM (
  SELECT fullname AS v FROM {CONTACTS_SQL} UNION ALL SELECT email FROM {CONTACTS_SQL} UNION ALL SELECT company FROM {CONTACTS_SQL} UNION ALL SELECT city FROM {CONTACTS_SQL}))), 0, 0
UNION ALL SELECT 'letters', (SELECT count(*) - 1 FROM customer), 0, 0""",
)
def copy_one_fake_per_original(spark, sf_dir):
    """One fake per original and one original per fake over columns, JSON and detected spans of one copy."""
    source = materialize(_letters(spark, sf_dir), "letters")
    copy = materialize(anonymize(source, LETTER_PLAN, "contact", ["c_custkey"], make_detector=RuleDetector).df, "copy")
    both = source.select("c_custkey", *[F.col(c).alias(f"o_{c}") for c in COUNTED]).join(copy, "c_custkey")
    pairs = {c: both.select(F.col(f"o_{c}").alias("original"), F.col(c).alias("fake")) for c in COUNTED}
    # What a letter says of the other contact is what that contact's own row says.
    other = copy.select((F.col("c_custkey") + 1).alias("c_custkey"), *[F.col(c).alias(f"x_{c}") for c in ("fullname", "email")])
    letters = copy.join(other, "c_custkey")
    firm = F.regexp_extract("note", " of (.+ Ltd) wrote to ", 1)
    said = (
        (F.get_json_object("sender", "$.from.name") == F.col("x_fullname")) & (F.get_json_object("sender", "$.from.address") == F.col("x_email"))
        & F.contains("note", F.col("x_fullname")) & F.contains("note", F.col("email"))
    )
    told = letters.agg(F.count("*").alias("originals"), F.count_if(~said).alias("split"), F.count_distinct(firm).alias("firms")).select(
        F.lit("letters").alias("kind"), "originals", "split", (F.col("firms") - 1).alias("shared")
    )
    return _union([_violations(p, c) for c, p in pairs.items()] + [_violations(_union(list(pairs.values())), "all"), told])


def _firm(key):
    return F.concat(name_expr(key, 3), F.lower(name_expr(F.floor(key / 3), 11)))


_firm_sql = f"({name_sql('c_custkey', 3)} || lower({name_sql('(c_custkey // 3)', 11)}))"
RUN_PLAN = [ColumnPlan("firm", "org"), ColumnPlan("fullname", "person"), ColumnPlan("email", "email"), ColumnPlan("city", "location")]


def _runs(spark, sf_dir, kept: bool):
    """Originals and fakes of two runs over halves of the contacts; the second knows the ledger, or the map alone."""
    rows = contacts(spark, sf_dir).withColumn("firm", _firm(F.col("c_custkey")))
    known, ledger, out = em.empty_map(spark), None, []
    for half in (0, 1):
        part = materialize(rows.where(F.col("c_custkey") % 2 == half), "half")
        result = anonymize(part, RUN_PLAN, "contact", ["c_custkey"], entity_map=known, ledger=ledger)
        copy = result.df.select("c_custkey", *[F.col(p.column).alias(f"f_{p.column}") for p in RUN_PLAN])
        out.append(materialize(part.join(copy, "c_custkey"), "run"))
        if kept:
            ledger = result.ledger.settled()
        else:
            known = materialize(em.append(known, result.map_rows(known)), "map")
    return _union(out)


_run_counts = " UNION ALL ".join(
    f"SELECT '{kind}:{p.column}' AS kind, count(DISTINCT lower({_firm_sql if p.column == 'firm' else p.column})) AS originals, 0::BIGINT AS split, 0::BIGINT AS shared FROM {CONTACTS_SQL}"
    for kind in ("ledger", "map") for p in RUN_PLAN
)


@query("two_runs_injective", _run_counts)
def two_runs_injective(spark, sf_dir):
    """Two runs over halves of a table share no fake and split no original, by the kept ledger or by the map alone."""
    frames = []
    for kind, kept in (("ledger", True), ("map", False)):
        rows = _runs(spark, sf_dir, kept)
        frames += [_violations(rows.select(F.col(p.column).alias("original"), F.col(f"f_{p.column}").alias("fake")), f"{kind}:{p.column}") for p in RUN_PLAN]
    return _union(frames)


def _streamed(spark, sf_dir, rows, schema, plan, table_name):
    """The state of a stream over three files, stopped and started anew after each."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/veilframe/stream-{uuid.uuid4().hex}"
    for number in range(3):
        rows.where(F.col("c_custkey") % 3 == number).coalesce(1).write.parquet(f"{folder}/in/{number}")
        job = IncrementalAnonymizer(spark, plan, f"{folder}/state", table=table_name, keys=["c_custkey"], config=DEFAULT, compact_every=2)
        job.start(f"{folder}/in/*", schema, max_files=1).awaitTermination()
    return job


@query("incremental_files", None)
def incremental_files(spark, sf_dir):
    """Customers in three files, with a stop after each: the same as one batch over all."""
    customer = table(spark, sf_dir, "customer")
    job = _streamed(spark, sf_dir, customer, customer.schema, CUSTOMER_PLAN, "customer")
    return spark.read.parquet(job.output()).drop("batch").withColumn("c_acctbal", F.round("c_acctbal", 6))


_stream_counts = " UNION ALL ".join(
    f"SELECT '{p.column}' AS kind, count(DISTINCT lower({_firm_sql if p.column == 'firm' else p.column})) AS originals, 0::BIGINT AS split, 0::BIGINT AS shared FROM {CONTACTS_SQL}"
    for p in RUN_PLAN
)


@query("incremental_one_fake_per_original", f"{_stream_counts} UNION ALL SELECT 'map ids', (SELECT count(*) FROM customer), 0, 0")
def incremental_one_fake_per_original(spark, sf_dir):
    """Contacts in three files: no original with two fakes, no fake with two originals, no map id twice."""
    rows = contacts(spark, sf_dir).withColumn("firm", _firm(F.col("c_custkey")))
    job = _streamed(spark, sf_dir, rows, rows.schema, RUN_PLAN, "contact")
    copy = spark.read.parquet(job.output()).select("c_custkey", *[F.col(p.column).alias(f"f_{p.column}") for p in RUN_PLAN])
    both = materialize(rows.join(copy, "c_custkey"), "both")
    frames = [_violations(both.select(F.col(p.column).alias("original"), F.col(f"f_{p.column}").alias("fake")), p.column) for p in RUN_PLAN]
    ids = job.ledger().entity_map.groupBy("id").agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("split"))
    problems = em.injectivity_report(job.ledger().entity_map).agg(F.count("*")).scalar()
    rows_done = both.agg(F.count("*")).scalar()
    return _union([*frames, ids.select(F.lit("map ids").alias("kind"), rows_done.alias("originals"), "split", problems.alias("shared"))])


from checks.base import ORACLES  # noqa: E402

# The stream must end where the batch job ends.
ORACLES["incremental_files"] = ORACLES["customer_copy"]
