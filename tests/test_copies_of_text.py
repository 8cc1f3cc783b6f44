"""Checks that read texts or copies several times move them once."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import tables
from veilframe.operators import verify as V


def test_cells_meet_their_entries_where_they_lie(spark):
    df = spark.createDataFrame([("one two", "x"), ("two", "one two"), (None, "two")], "a string, b string")
    words = spark.createDataFrame([("two", "q")], "entry string, fake string")
    cells = V.text_cells(df, ["a", "b"])
    assert {(r.text, r.copies) for r in cells.collect()} == {("one two", 2), ("x", 1), ("two", 2)}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = V.occurrences(cells, words)
        moved = [x for x in found._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in x]
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert moved and plan.count("hashpartitioning(rid") == 3  # cells for their words, cells for their counts, maps
        assert {tuple(r) for r in found.collect()} == {("embedded", 2), ("whole_cell", 2)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_copy_is_counted_from_a_table(spark, monkeypatch):
    written = []
    kept = tables.materialize
    monkeypatch.setattr(tables, "materialize", lambda df, name: written.append(name) or kept(df, name))
    customers = spark.range(40).select(
        F.col("id").alias("c_custkey"), F.lit(1).alias("c_nationkey"), F.lit(2.5).alias("c_acctbal"), F.lit("AUTOMOBILE").alias("c_mktsegment")
    )
    monkeypatch.setattr("checks.base.table", lambda *_: customers)
    row = tables.contact_copy_check(spark, "").first()
    assert (row.rows, row.shared, written) == (40, 0, ["copied"])
