"""Choosing row keys and proving that they are unique."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.sources.tables import is_orderable

WHOLE_KEY = 12  # so many columns or fewer are taken together as they are; of more a key is searched
SKETCHES = 64  # sets of columns that one pass looks at
DEVIATION = 0.02  # of a sketch, relative
_NEAR = 1 - 8 * DEVIATION  # a set that identifies the rows is never sketched lower


class KeyNotUnique(ValueError):
    """No column set identifies the rows, so a keyed update is refused."""


def key_uniqueness(df: DataFrame, keys: list[str]) -> DataFrame:
    """``rows, keys, is_unique`` in one pass; null parts count as values, an empty table is unique.

    Grouped first, counted second: a key that repeats very often is combined
    before it is shuffled.
    """
    grouped = df.groupBy(*keys).agg(F.count("*").alias("_copies"))
    return grouped.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
        F.count("*").alias("keys"),
    ).withColumn("is_unique", F.col("rows") == F.col("keys"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def is_unique(df: DataFrame, keys: list[str]) -> bool:
    return key_uniqueness(df, keys).first()["is_unique"]


def choose_key(
    df: DataFrame,
    override: list[str] | None = None,
    declared: list[str] | None = None,
    source_key: list[str] | None = None,
) -> list[str]:
    """Override, declared key, verified source key, verified orderable columns; else refuse.

    Of a table with more orderable columns than ``WHOLE_KEY`` the smallest key
    found by ``find_key`` is taken.
    """
    if override:
        return override
    if declared:
        return declared
    if source_key and set(source_key) <= set(df.columns) and is_unique(df, source_key):
        return source_key
    candidates = [f.name for f in df.schema.fields if is_orderable(f.dataType)]
    if len(candidates) > WHOLE_KEY:
        found = find_key(df, candidates)
        if found:
            return found
    elif candidates and is_unique(df, candidates):
        return candidates
    raise KeyNotUnique(f"no unique key among {candidates}")


def sketched(df: DataFrame, sets: Sequence[Sequence[str]]) -> list[int]:
    """Estimated distinct rows of each set of columns, nulls being values; one pass for ``SKETCHES`` of them."""
    out: list[int] = []
    rest = iter(sets)
    while batch := list(islice(rest, SKETCHES)):
        row = df.agg(*[F.approx_count_distinct(F.xxhash64(*[f"`{c}`" for c in s]), DEVIATION).alias(str(i)) for i, s in enumerate(batch)]).first()
        out += list(row)
    return out


def find_key(df: DataFrame, columns: list[str] | None = None) -> list[str] | None:
    """A set of columns that identifies the rows and of which none can be left out; None if there is none.

    Level by level: the first single column, else the first pair, in the order of
    the columns. Sketches of the distinct counts rule out what cannot be unique;
    what is left is proven exactly. Beyond pairs a set grows by the column that
    tells most rows apart, then loses every column it does not need; so the key is
    minimal, though a smaller one of other columns may exist. Every pass reads the
    whole table, but only counts come back.
    """
    columns = [f.name for f in df.schema.fields if is_orderable(f.dataType)] if columns is None else columns
    if not columns or not is_unique(df, columns):
        return None
    rows = df.count()
    if rows <= 1:
        return columns[:1]
    counts = dict(zip(columns, sketched(df, [[c] for c in columns])))
    for c in columns:
        if counts[c] >= _NEAR * rows and is_unique(df, [c]):
            return [c]
    pairs = [p for p in combinations(columns, 2) if counts[p[0]] * counts[p[1]] >= _NEAR**2 * rows]
    for pair, n in zip(pairs, sketched(df, pairs)):
        if n >= _NEAR * rows and is_unique(df, list(pair)):
            return list(pair)
    chosen: list[str] = []
    while True:
        rest = [c for c in columns if c not in chosen]
        sizes = sketched(df, [[*chosen, c] for c in rest])
        best = max(range(len(rest)), key=lambda i: (sizes[i], -i))
        chosen.append(rest[best])
        if len(rest) == 1 or sizes[best] >= _NEAR * rows and is_unique(df, chosen):
            break
    for c in list(chosen):
        less = [x for x in chosen if x != c]
        if less and sketched(df, [less])[0] >= _NEAR * rows and is_unique(df, less):
            chosen = less
    return [c for c in columns if c in chosen]


def require_unique(df: DataFrame, keys: list[str]) -> list[str]:
    if not is_unique(df, keys):
        raise KeyNotUnique(f"{keys} does not identify the rows")
    return keys


def order_columns(df: DataFrame, unique_key: list[str] | None = None) -> list[str]:
    """Columns that order rows deterministically: the unique key, else all that can be ordered."""
    return unique_key or [f.name for f in df.schema.fields if is_orderable(f.dataType)]
