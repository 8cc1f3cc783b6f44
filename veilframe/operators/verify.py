"""Checks on an anonymised copy: counts, residuals, injectivity, residue and leaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.operators import dictionary as D
from veilframe.plans.plan import ColumnPlan, enabled, filter_condition
from veilframe.sources.entity_map import clean
from veilframe.sources.tables import text_columns


def row_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """``source_rows, target_rows, matches``."""
    sides = source.select(F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(
        target.select(F.lit(0).alias("s"), F.lit(1).alias("t"))
    )
    return sides.agg(
        F.coalesce(F.sum("s"), F.lit(0)).cast("bigint").alias("source_rows"),
        F.coalesce(F.sum("t"), F.lit(0)).cast("bigint").alias("target_rows"),
    ).withColumn("matches", F.col("source_rows") == F.col("target_rows"))


def residual_rows(source: DataFrame, target: DataFrame, keys: list[str], plan: list[ColumnPlan]) -> DataFrame:
    """``column, type, mode, residual`` over all enabled columns in one join.

    A cell is residual where the same row still holds the original, the value is
    longer than one character and the row filter applies.
    """
    columns = enabled(plan)
    s = source.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        *[F.col(p.column).cast("string").alias(f"_s{i}") for i, p in enumerate(columns)],
        *[filter_condition(p, source.columns).alias(f"_f{i}") for i, p in enumerate(columns)],
    )
    t = target.select(
        *[F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)],
        *[F.col(p.column).cast("string").alias(f"_a{i}") for i, p in enumerate(columns)],
    )
    on = None
    for i in range(len(keys)):
        part = s[f"_k{i}"].eqNullSafe(t[f"_t{i}"])
        on = part if on is None else on & part
    counts = s.join(t, on).agg(
        *[
            F.struct(
                F.lit(p.column).alias("column"), F.lit(p.type).alias("type"), F.lit(p.mode).alias("mode"),
                F.count_if((F.length(f"_s{i}") > 1) & (F.col(f"_s{i}") == F.col(f"_a{i}")) & F.col(f"_f{i}")).alias("residual"),
            ).alias(f"c{i}")
            for i, p in enumerate(columns)
        ]
    )
    return counts.select(F.inline(F.array(*[F.col(f"c{i}") for i in range(len(columns))])))


def residual_values(source: DataFrame, target: DataFrame, plan: list[ColumnPlan]) -> DataFrame:
    """Without a usable key: distinct target values that some source row also has.

    An upper bound, since a fake may equal an unrelated original by chance.
    """
    parts: list[DataFrame] = []
    for p in enabled(plan):
        value = F.col(p.column).cast("string").alias("v")
        new = target.select(value).where(F.length("v") > 1).distinct()
        old = source.where(filter_condition(p, source.columns)).select(value)
        parts.append(
            new.join(old, "v", "left_semi").agg(F.count("*").alias("residual")).select(
                F.lit(p.column).alias("column"), F.lit(p.type).alias("type"), F.lit(p.mode).alias("mode"), "residual"
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def verdict(residuals: DataFrame, counts: DataFrame) -> DataFrame:
    """``residual_columns, verdict``: PASS when counts match and no structured column has residuals."""
    bad = residuals.agg(F.count_if((F.col("mode") == "structured") & (F.col("residual") > 0)).alias("residual_columns"))
    matches = counts.select("matches").scalar()
    return bad.select(
        "residual_columns", F.when((F.col("residual_columns") == 0) & matches, "PASS").otherwise("REVIEW").alias("verdict")
    )


def verify(source: DataFrame, target: DataFrame, plan: list[ColumnPlan], keys: list[str] | None = None) -> dict[str, DataFrame]:
    """All structural checks: ``counts``, ``residuals`` and ``verdict``."""
    counts = row_counts(source, target)
    residuals = residual_rows(source, target, keys, plan) if keys else residual_values(source, target, plan)
    return {"counts": counts, "residuals": residuals, "verdict": verdict(residuals, counts)}


def word_residue(df: DataFrame, words: list[str], columns: list[str] | None = None) -> DataFrame:
    """``column, word, cells``: cells that still hold a forced word, all columns in one scan."""
    columns = columns if columns is not None else text_columns(df)
    pairs = [(c, w) for c in columns for w in words]
    if not pairs:
        return df.sparkSession.createDataFrame([], "column string, word string, cells bigint")
    counts = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"), F.lit(w).alias("word"),
                F.count_if(F.contains(F.lower(F.col(f"`{c}`")), F.lit(w.lower()))).alias("cells"),
            ).alias(f"p{i}")
            for i, (c, w) in enumerate(pairs)
        ]
    )
    return counts.select(F.inline(F.array(*[F.col(f"p{i}") for i in range(len(pairs))])))


def text_cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """``rid, text, copies``: distinct texts of several columns, dealt by their digest, with the number of cells that hold each."""
    cells = df.select(F.explode(F.array(*[F.col(c).cast("string") for c in columns])).alias("text"))
    keyed = cells.where(F.col("text").isNotNull()).withColumn("rid", F.sha2("text", 256))
    return keyed.groupBy("rid").agg(F.min("text").alias("text"), F.count("*").alias("copies"))


def occurrences(cells: DataFrame, dictionary: DataFrame, match: D.Match = D.MAP_SCRUB) -> DataFrame:
    """``kind, occurrences`` of dictionary entries: whole cells and embedded ones."""
    prepared = D.prepare(dictionary, match)
    maps = D.entry_map(D.found_entries(cells, "rid", "text", prepared, match), "rid")
    hits = cells.join(maps, "rid")  # the cells lie by rid already and are not moved again
    whole = F.map_contains_key("entries", D.fold(F.trim("text"), match))
    counted = hits.select(
        F.when(whole, "whole_cell").otherwise("embedded").alias("kind"),
        (D.count_entries(F.col("text"), F.col("entries"), match) * F.col("copies")).alias("c"),
    )
    return counted.groupBy("kind").agg(F.sum("c").cast("bigint").alias("occurrences")).where("occurrences > 0")


def leak_report(source: DataFrame, target: DataFrame, columns: list[str], dictionary: DataFrame, match: D.Match = D.MAP_SCRUB) -> DataFrame:
    """``kind, pii, leaked, leak_rate``: originals that occur in the copy, against those in the source."""
    before = occurrences(text_cells(source, columns), dictionary, match).withColumnRenamed("occurrences", "pii")
    after = occurrences(text_cells(target, columns), dictionary, match).withColumnRenamed("occurrences", "leaked")
    both = before.join(after, "kind", "full")
    return both.select(
        "kind", F.coalesce("pii", F.lit(0)).alias("pii"), F.coalesce("leaked", F.lit(0)).alias("leaked"),
        (F.coalesce("leaked", F.lit(0)) / F.col("pii")).alias("leak_rate"),
    )


def leak_dictionary(entity_map: DataFrame, min_length: int = 3) -> DataFrame:
    """All originals of the map that have a different fake, as dictionary entries."""
    rows = clean(entity_map).where(
        ~F.col("excluded") & (F.col("fake_cf") != F.lower(F.trim("original"))) & (F.length("original") >= min_length)
    )
    return rows.select(F.col("original").alias("entry"), "fake")


def status(plan: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """``enabled_columns, rows_done``."""
    on = plan.agg(F.count_if("enabled").alias("enabled_columns"))
    done: Column = target.agg(F.count("*").alias("n")).scalar() if target is not None else F.lit(0).cast("bigint")
    return on.select("enabled_columns", done.alias("rows_done"))
