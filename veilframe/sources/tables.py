"""Reading, introspecting, writing and exchanging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types with no usable order or equality for keys.
UNORDERED = (T.MapType, T.BinaryType, T.VariantType)


def scan(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    limit: int | str | None = None,
    order_by: list[str] | None = None,
    fmt: str = "parquet",
    spread: bool = False,
    tasks_per_split: int = 1,
    **options,
) -> DataFrame:
    """Table scan with projection and an optional row budget.

    ``spread`` redistributes the rows when the files give fewer splits than
    there are cores, which is what CPU-heavy work on a small table needs. A
    table with enough splits is never shuffled, unless ``tasks_per_split`` cuts
    each finer: a split may hold millions of rows, which is too much for one task
    where a row costs much.

    ``limit`` may be a number, or ``all``/``complete``/``full``/None for no
    budget. With ``order_by`` the budget takes the same rows every time, as a
    top-k rather than a full sort.
    """
    df = spark.read.format(fmt).options(**options).load(path)
    if columns:
        df = df.select(*columns)
    if spread:
        cores = spark.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
        if splits < cores or tasks_per_split > 1:
            df = df.repartition(max(cores, splits * tasks_per_split))
    return take(df, limit, order_by)


def row_budget(limit: int | str | None) -> int | None:
    if limit is None or str(limit).strip().lower() in ("all", "complete", "full"):
        return None
    count = int(limit)
    if count < 0:
        raise ValueError(f"row budget must not be negative: {limit}")
    return count


def take(df: DataFrame, limit: int | str | None, order_by: list[str] | None = None) -> DataFrame:
    count = row_budget(limit)
    if count is None:
        return df
    return (df.orderBy(*order_by) if order_by else df).limit(count)


def width_of(field: T.StructField) -> int | None:
    """Declared width of a text column: VARCHAR/CHAR or ``max_len`` metadata."""
    if "max_len" in field.metadata:
        return int(field.metadata["max_len"])
    declared = field.metadata.get("__CHAR_VARCHAR_TYPE_STRING", "")
    digits = "".join(c for c in declared if c.isdigit())
    if digits:
        return int(digits)
    return getattr(field.dataType, "length", None)


def describe(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, width, whether it can be part of a key."""
    rows = [
        (i, f.name, f.dataType.simpleString(), width_of(f), is_orderable(f.dataType))
        for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, column string, type string, max_len int, orderable boolean"
    )


def is_orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, UNORDERED):
        return False
    if isinstance(dtype, T.ArrayType):
        return is_orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(is_orderable(f.dataType) for f in dtype.fields)
    return True


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType))]


def empty_copy(df: DataFrame) -> DataFrame:
    """Same schema, no rows."""
    return df.sparkSession.createDataFrame([], df.schema)


def write_copy(df: DataFrame, path: str, like: T.StructType, fmt: str = "parquet") -> None:
    """Write a rebuilt table after checking that it has the columns of the source."""
    wanted = [(f.name, f.dataType) for f in like.fields]
    found = [(f.name, f.dataType) for f in df.schema.fields]
    if wanted != found:
        raise ValueError(f"the copy must keep the source schema; expected {wanted}, found {found}")
    df.write.mode("overwrite").format(fmt).save(path)


def same_value(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def merge_columns(existing: DataFrame, changed: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Replace only ``columns`` of an existing copy, matched by null-safe keys.

    Rows without a counterpart and all other columns are kept. The key must be
    unique in ``changed``; see :func:`veilframe.plans.keys.require_unique`.
    """
    new = changed.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.lit(True).alias("_hit"),
        *[F.col(c).alias(f"_n{i}") for i, c in enumerate(columns)],
    )
    matched = None
    for i, k in enumerate(keys):
        part = same_value(existing[k], new[f"_k{i}"])
        matched = part if matched is None else matched & part
    joined = existing.join(new, matched, "left")
    replaced = {c: F.when(F.col("_hit"), F.col(f"_n{i}")).otherwise(existing[c]).alias(c) for i, c in enumerate(columns)}
    return joined.select(*[replaced.get(c, existing[c]) for c in existing.columns])


def fetch_keys(df: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is in ``wanted``; keys may be null."""
    side = wanted.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    matched = None
    for i, k in enumerate(keys):
        part = same_value(df[k], side[f"_k{i}"])
        matched = part if matched is None else matched & part
    return df.join(side, matched, "left_semi")


def export_texts(df: DataFrame, key: str, column: str, path: str) -> None:
    """CSV of ``(row id, text)`` for cells that hold text; quotes and line breaks survive."""
    cells = df.select(F.col(key).cast("string").alias("row_id"), F.col(column).alias("text"))
    cells.where(F.length("text") > 0).write.mode("overwrite").csv(
        path, header=True, quoteAll=True, escape='"', emptyValue=""
    )


def import_texts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, multiLine=True, escape='"', schema="row_id string, text string")


def write_back(df: DataFrame, updates: DataFrame, key: str, column: str, width: int | None = None) -> DataFrame:
    """Put imported texts back by row id; a text wider than the column is skipped."""
    width = width if width is not None else width_of(df.schema[column])
    new = updates.select(F.col("row_id").alias("_id"), F.col("text").alias("_text"))
    joined = df.join(new, F.col(key).cast("string") == F.col("_id"), "left")
    fits = F.col("_text").isNotNull() & (F.length("_text") <= F.lit(width if width is not None else 2**31 - 1))
    return joined.withColumn(column, F.when(fits, F.col("_text")).otherwise(F.col(column))).select(*df.columns)


def restore_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give flattened text columns the types of a target schema back.

    Empty text becomes null for every type that is not text; nested types are
    read from JSON.
    """
    out = []
    for field in schema.fields:
        source = F.col(field.name)
        if df.schema[field.name].dataType == field.dataType or isinstance(field.dataType, T.StringType):
            value = source.cast(field.dataType)
        else:
            filled = F.when(F.trim(source.cast("string")) == "", None).otherwise(source)
            if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
                value = F.from_json(filled, field.dataType)
            elif isinstance(field.dataType, T.VariantType):
                value = F.try_parse_json(filled)
            else:
                value = filled.try_cast(field.dataType)
        out.append(value.alias(field.name))
    return df.select(*out)
