"""Profiling a table and proposing a column plan.

All text columns are profiled in one scan with one partial aggregate; the
result has one row per column. The rules then run over that small frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe import config as C
from veilframe.functions import text as X
from veilframe.plans.plan import is_amount_column
from veilframe.sources.tables import text_columns

MEASURES = ("n", "total_len", "emails", "phones", "idlike", "urllike")


def _measures(column: str) -> list[Column]:
    value = F.col(f"`{column}`")
    counted = value.isNotNull() & (F.length(value) > 1)

    def hits(condition: Column) -> Column:
        return F.count(F.when(counted & condition, 1))

    return [
        F.count(F.when(counted, 1)),
        F.coalesce(F.sum(F.when(counted, F.length(value))), F.lit(0)),
        hits(X.looks_like_email(value)),
        hits(X.looks_like_phone(value)),
        hits(X.looks_like_id(value)),
        hits(X.looks_like_url(value)),
    ]


def profile_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column, n, total_len, emails, phones, idlike, urllike`` over non-null values longer than 1."""
    columns = columns if columns is not None else text_columns(df)
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, " + ", ".join(f"{m} bigint" for m in MEASURES))
    wide = df.agg(
        *[
            F.struct(F.lit(c).alias("column"), *[m.cast("bigint").alias(n) for n, m in zip(MEASURES, _measures(c))]).alias(
                f"_{i}"
            )
            for i, c in enumerate(columns)
        ]
    )
    return wide.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(columns))])))


def sample_values(df: DataFrame, columns: list[str], count: int = 3, width: int = 60) -> DataFrame:
    """Up to ``count`` values per column, ``column, rank, value``.

    The same ones every time: those with the smallest digests. The rank filter
    keeps only ``count`` rows per column on each side of the shuffle.
    """
    cells = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
        ).alias("cell")
    ).select("cell.column", "cell.value")
    kept = cells.where(F.col("value").isNotNull() & (F.length("value") > 1))
    order = Window.partitionBy("column").orderBy(F.sha2("value", 256), "value")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
    return ranked.select("column", "rank", F.substring("value", 1, width).alias("value"))


def detector_majority(spans: DataFrame) -> DataFrame:
    """Most frequent span type per column, from ``column, type`` rows; ties go to the smaller name."""
    counted = spans.groupBy("column", "type").agg(F.count("*").alias("n"))
    return counted.groupBy("column").agg(F.min_by("type", F.struct(-F.col("n"), F.col("type"))).alias("majority"))


def _named(hint: str) -> Column:
    return F.col("column").rlike("(?i)" + C.HINTS[hint])


def propose(profile: DataFrame, detected: DataFrame | None = None) -> DataFrame:
    """Plan rows for profiled text columns: ordered rules over names and shares.

    ``detected`` optionally has ``column, hits, sampled, majority`` of a detector
    run on a sample; it confirms free text and types ambiguous columns.
    """
    rows = profile.where("n > 0")
    if detected is None:
        none = F.lit(None)
        rows = rows.withColumns(
            {"hits": none.cast("bigint"), "sampled": none.cast("bigint"), "majority": none.cast("string")}
        )
    else:
        rows = rows.join(detected, "column", "left")

    def share(measure: str) -> Column:
        return F.col(measure) / F.col("n")

    mean = F.col("total_len") / F.col("n")
    freetext_conf = F.when(
        F.col("hits").isNotNull(), F.least(F.lit(0.95), F.lit(0.4) + F.col("hits") / 20)
    ).otherwise(F.lit(0.5))
    guess = F.col("majority").isNotNull() & ~_named("skip")
    rules: list[tuple[Column, Column, str, Column, Column]] = [
        (_named("reference"), F.lit("skip"), "structured", F.lit(0.0), F.lit("reference or enum column, kept verbatim")),
        (_named("country"), F.lit("country"), "structured", F.lit(0.7), F.lit("country column")),
        (_named("location"), F.lit("location"), "structured", F.lit(0.6), F.lit("location or city column")),
        (
            _named("email") | (share("emails") > 0.3),
            F.lit("email"), "structured", F.greatest(F.lit(0.6), share("emails")), F.lit("e-mail name or shape"),
        ),
        (
            _named("phone") | (share("phones") > 0.3),
            F.lit("phone"), "structured", F.greatest(F.lit(0.6), share("phones")), F.lit("phone name or shape"),
        ),
        (share("idlike") > 0.5, F.lit("id"), "structured", F.lit(0.3), F.lit("opaque identifiers")),
        (share("urllike") > 0.5, F.lit("url"), "structured", F.lit(0.3), F.lit("URLs")),
        (mean > 80, F.lit("freetext"), "freetext", freetext_conf, F.lit("long text")),
        (_named("name"), F.lit("person"), "structured", F.lit(0.7), F.lit("name-like column")),
        (_named("org"), F.lit("org"), "structured", F.lit(0.6), F.lit("organisation-like column")),
        (guess, F.col("majority"), "structured", F.lit(0.5), F.lit("detector majority")),
        (_named("skip"), F.lit("skip"), "structured", F.lit(0.0), F.lit("identifier, code, number or date by name")),
    ]
    chain = None
    for condition, ptype, mode, confidence, reason in rules:
        decided = F.struct(
            ptype.alias("type"), F.lit(mode).alias("mode"), confidence.cast("double").alias("confidence"), reason.alias("reason")
        )
        chain = F.when(condition, decided) if chain is None else chain.when(condition, decided)
    otherwise = F.struct(
        F.lit("org").alias("type"),
        F.lit("structured").alias("mode"),
        F.lit(0.0).alias("confidence"),
        F.lit("no signal, for review").alias("reason"),
    )
    decided = rows.select("column", chain.otherwise(otherwise).alias("d"))
    return decided.select(
        "column",
        "d.type",
        "d.mode",
        (F.col("d.confidence") >= 0.55).alias("enabled"),
        F.round("d.confidence", 2).alias("confidence"),
        "d.reason",
    )


def amount_rows(df: DataFrame) -> DataFrame:
    """Numeric price or quantity columns: listed, but off until somebody enables them."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and is_amount_column(f.name)]
    rows = [(c, "amount", "structured", False, 0.5, "numeric amount or quantity") for c in numeric]
    return df.sparkSession.createDataFrame(
        rows, "column string, type string, mode string, enabled boolean, confidence double, reason string"
    )


def analyze(
    df: DataFrame,
    detected: DataFrame | None = None,
    sample_rows: int | None = None,
    samples: int = 3,
) -> DataFrame:
    """Proposed plan of a table, most confident columns first.

    Profiles the whole table unless ``sample_rows`` asks for a quick look.
    """
    texts = text_columns(df)
    looked = df if sample_rows is None else df.limit(sample_rows)
    plan = propose(profile_columns(looked, texts), detected).unionByName(amount_rows(df))
    if samples and texts:
        values = sample_values(looked, texts, samples)
        lists = values.groupBy("column").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("rank", "value"))), lambda s: s["value"]).alias("samples")
        )
        plan = plan.join(lists, "column", "left")
    else:
        plan = plan.withColumn("samples", F.lit(None).cast("array<string>"))
    return order_plan(
        plan.withColumn("row_filter", F.lit(None).cast("struct<column:string,values:array<string>>")).withColumn(
            "country_column", F.lit(None).cast("string")
        )
    )


def order_plan(plan: DataFrame) -> DataFrame:
    return plan.orderBy(F.col("confidence").desc(), F.col("column").asc())
