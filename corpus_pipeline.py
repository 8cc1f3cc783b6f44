"""The corpus pipeline: language, lines, near duplicates, benchmarks, packing.

Each stage takes all that the one before it kept and returns documents with the
same columns; the last returns packed pieces. Between stages the documents are a
Parquet table in the shared folder, so a lost executor only costs the stage at
hand. Rows without text are dropped by the first stage; a document whose text a
later stage empties is dropped there. The stages lower the session's rows per
batch, as whole texts are handed to Python.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.llm import complement_packing, ecoc_language, fm_index, fuzzy_lines, set_join
from veilframe.llm.common import split_by_keys, table
from veilframe.session import materialize

NEAR_WORDS, NEAR_PERCENT = 5, 80
# Rows of whole texts that a task holds at once, when they are read and when they go to Python.
BATCH_ROWS = {"spark.sql.parquet.columnarReaderBatchSize": 1024, "spark.sql.execution.arrow.maxRecordsPerBatch": 2048}


def in_small_batches(stage):
    """The stage with at most ``BATCH_ROWS``; a session that asks for fewer keeps them."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for key, rows in BATCH_ROWS.items():
            if not 0 < int(spark.conf.get(key)) <= rows:
                spark.conf.set(key, str(rows))
        return stage(spark, docs, sf_dir)

    return run


@in_small_batches
def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; undetermined and ambiguous ones go."""
    found = ecoc_language.identify(docs, ecoc_language.fit(docs))
    return found.where("not ambiguous").select(*docs.columns)


@in_small_batches
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier line repeats; documents with no line left go."""
    return fuzzy_lines.dedup_lines(docs, distance=None).where(F.col("text").rlike(r"\S"))


@in_small_batches
def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; rows without an id stay.

    Only documents that may go or repeat are joined with the groups, so the
    texts of the others do not move, however many groups there are.
    """
    groups = set_join.jaccard_groups(docs, size=NEAR_WORDS, percent=NEAR_PERCENT).where("doc_id is not null")
    groups = materialize(groups.groupBy("doc_id").agg(F.min("component_id").alias("first"), F.count("*").alias("rows")), "groups")
    asked, plain = split_by_keys(docs, "doc_id", groups.where("first <> doc_id or rows > 1"))
    gone = groups.where("first <> doc_id").select("doc_id")
    kept = asked.join(gone, "doc_id", "left_anti")
    repeated = groups.where("first = doc_id and rows > 1").select("doc_id")
    if repeated.take(1):
        once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        kept = kept.join(repeated, "doc_id", "left_anti").unionByName(once)
    return plain.unionByName(kept.select(*docs.columns))


@in_small_batches
def cut_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages they share with benchmark items; documents that were nothing else go."""
    return fm_index.decontaminate(docs, table(spark, sf_dir, "benchmark")).where(F.col("text").rlike(r"\S"))


@in_small_batches
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the packed sequences."""
    return complement_packing.pack(docs)


STAGES = [
    ("language_id", keep_languages),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("benchmark_decontamination", cut_benchmark_passages),
    ("best_fit_packing", pack_sequences),
]

# No stage can be told in SQL whole (trained codes, edit-distance links, components, packing); tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
