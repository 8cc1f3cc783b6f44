"""Registered queries of the operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from veilframe.llm import (
    bfd_packing, chat_template, complement_packing, conversation_repair, ecoc_language, fm_index, fuzzy_lines, line_quality, main_content, packed_products, set_join,
    threshold_search, weak_pii,
)
from veilframe.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


@query("op3_ngram_jaccard_join")
def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.jaccard_groups(table(spark, sf_dir, "documents"), size=4, percent=85)


@query("op6_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "items", "spans",
    )


@query("op5_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complement_packing.pack(table(spark, sf_dir, "documents"))


@query("op4_token_id_output")
def token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bfd_packing.packed_sequences(table(spark, sf_dir, "documents"))


@query("op10_line_dedup")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.dedup_lines(table(spark, sf_dir, "documents"), distance=None, lines_col="removed_lines").select("doc_id", "text", "n_chars", "removed_lines")


@query("op9_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = ecoc_language.identify(docs.select("doc_id", "text"), ecoc_language.fit(docs))
    return found.select("doc_id", ecoc_language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op2_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.quality(table(spark, sf_dir, "documents"))


SAID = "<|im_end|><|im_start|>assistant ok"


@query("op1_chat_formatting")
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", SAID), (-1, 1, "assistant", SAID)], "conv_id long, turn long, role string, text string")
    return chat_template.read_back(chat_template.format_conversations(rows.unionByName(own)))


@query("op8_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_content.extract(table(spark, sf_dir, "pages"))


@query("op7_pii")
def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_pii.personal_data(table(spark, sf_dir, "documents"))


# Whole vectors as integers, shared by the SQL of the two searches. Sums of integers are exact in doubles.
_INTEGERS = """
vectors AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)"""


@query(
    "op13_exact_topk_search",
    f"""
WITH {_INTEGERS}, scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, (row_number() OVER best)::INT AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 5""",
)
def exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_search.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query(
    "op11_hard_negative_mining",
    f"""
WITH {_INTEGERS}, labelled AS (
  SELECT vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM vectors WHERE label IS NOT NULL
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
  FROM labelled a JOIN labelled c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER best)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY rank <= 10""",
)
def hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return packed_products.hard_negatives(rows, F.col("vec_id") % 100 == 0, label=label)


@query("op12_conversation_structure_repair")
def conversation_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damage(table(spark, sf_dir, "conversations")), copies_col="copies")


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
