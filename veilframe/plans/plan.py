"""The column plan: what happens to each column of a table."""

from __future__ import annotations

import re
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe import config as C
from veilframe.config import DEFAULT, Config

PLAN_SCHEMA = (
    "column string, type string, mode string, enabled boolean, confidence double, reason string, "
    "samples array<string>, row_filter struct<column:string,values:array<string>>, country_column string"
)


@dataclass(frozen=True)
class RowFilter:
    """Anonymise a column only where another column has one of the values."""

    column: str
    values: tuple[str, ...]


@dataclass(frozen=True)
class ColumnPlan:
    column: str
    type: str
    mode: str = "structured"
    enabled: bool = True
    confidence: float = 1.0
    reason: str = ""
    samples: tuple[str, ...] = ()
    row_filter: RowFilter | None = None
    country_column: str | None = None


def plan_frame(spark: SparkSession, plan: list[ColumnPlan]) -> DataFrame:
    return spark.createDataFrame([T.Row(**_as_row(p)) for p in plan], PLAN_SCHEMA)


def _as_row(p: ColumnPlan) -> dict:
    row = asdict(p)
    row["samples"] = list(p.samples)
    row["row_filter"] = (p.row_filter.column, list(p.row_filter.values)) if p.row_filter else None
    return row


def plan_list(plan: DataFrame) -> list[ColumnPlan]:
    """A plan frame has one row per column of a table, so it may come to the driver."""
    out = []
    for r in plan.collect():
        d = r.asDict(recursive=True)
        rf = d.get("row_filter")
        out.append(
            ColumnPlan(
                d["column"], d["type"], d["mode"], d["enabled"], d["confidence"], d["reason"],
                tuple(d.get("samples") or ()),
                RowFilter(rf["column"], tuple(rf["values"])) if rf else None,
                d.get("country_column"),
            )
        )
    return out


def set_plan(plan: DataFrame, wanted: dict[str, str | None]) -> DataFrame:
    """Enable exactly the named columns with the given type (default ``org``); disable the rest."""
    rows = [(name.lower(), kind or "org") for name, kind in wanted.items()]
    asked = plan.sparkSession.createDataFrame(rows, "_asked string, _type string")
    hit = F.col("_asked").isNotNull()
    joined = plan.join(F.broadcast(asked), F.lower("column") == F.col("_asked"), "left")
    return (
        joined.withColumn("type", F.when(hit, F.col("_type")).otherwise(F.col("type")))
        .withColumn(
            "mode",
            F.when(hit & (F.col("_type") == "freetext"), "freetext").when(hit, "structured").otherwise(F.col("mode")),
        )
        .withColumn("enabled", hit)
        .drop("_asked", "_type")
    )


def unknown_columns(plan: DataFrame, wanted: dict[str, str | None]) -> list[str]:
    have = {r["c"] for r in plan.select(F.lower("column").alias("c")).collect()}
    return [name for name in wanted if name.lower() not in have]


def override(plan: list[ColumnPlan], columns: list[str]) -> list[ColumnPlan]:
    """Exactly the named columns, whatever their ``enabled`` says; unknown names are refused."""
    by_name = {p.column.lower(): p for p in plan}
    missing = [c for c in columns if c.lower() not in by_name]
    if missing:
        raise ValueError(f"not in the plan: {missing}")
    return [replace(by_name[c.lower()], enabled=True) for c in columns]


def enabled(plan: list[ColumnPlan]) -> list[ColumnPlan]:
    return [p for p in plan if p.enabled and p.type != "skip"]


def filter_condition(p: ColumnPlan, columns: list[str]) -> Column:
    """True where the column is to be anonymised. A missing filter column means everywhere."""
    if p.row_filter is None:
        return F.lit(True)
    names = {c.lower(): c for c in columns}
    source = names.get(p.row_filter.column.lower())
    if source is None:
        return F.lit(True)
    if not p.row_filter.values:
        return F.lit(False)
    return F.coalesce(F.col(f"`{source}`").cast("string").isin(*p.row_filter.values), F.lit(False))


def is_amount_column(name: str) -> bool:
    return bool(re.search(C.HINTS["amount"], name, re.I)) and not re.search(C.HINTS["amount_skip"], name, re.I)


def person_role(column: str | None) -> str:
    """``first``, ``last`` or ``full``, from the column name."""
    name = (column or "").lower()
    if any(w in name for w in ("first", "middle", "given", "nick")):
        return "first"
    if any(w in name for w in ("last", "surname", "family")):
        return "last"
    return "full"


def person_role_expr(column: Column) -> Column:
    name = F.lower(F.coalesce(column, F.lit("")))
    return (
        F.when(name.rlike("first|middle|given|nick"), "first").when(name.rlike("last|surname|family"), "last").otherwise("full")
    )


def table_domain(table: str, config: Config = DEFAULT) -> str:
    """``resume`` for listed tables, whatever the stage suffix; else ``general``."""
    base = table
    for suffix in config.stage_suffixes:
        if base.endswith(suffix):
            base = base[: -len(suffix)]
            break
    return "resume" if base in config.resume_tables else "general"
