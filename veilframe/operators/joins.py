"""Lookup joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_ROWS = 1_000_000
HOT_KEYS = 1_000
SPREAD = 4096


def lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    weight: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left-join ``table`` (one row per key) to ``rows`` without a hot reducer.

    ``weight`` names the column of ``table`` that counts the rows behind each
    key, which the distinct step that built the table knows anyway. The keys
    above ``hot_rows`` (at most ``HOT_KEYS`` of them, so the broadcast is
    bounded) are answered map-side; their rows then travel under a spread
    stand-in key instead of the hot one. All other keys take the ordinary join,
    which adaptive execution turns into a broadcast when it measures a small
    table. Without a weight the join is left to adaptive skew handling. Rows
    without a first key match nothing; they are spread as well.
    """
    values = [c for c in table.columns if c not in keys and c not in (weight, "n", "copies")]
    if weight is None or weight not in table.columns:
        first = F.coalesce(F.col(keys[0]).cast("string"), _spread(rows))
        named = table.select(F.col(keys[0]).cast("string").alias("_first"), *keys[1:], *values)
        return rows.withColumn("_first", first).join(named, ["_first", *keys[1:]], "left").select(*rows.columns, *values)
    hot = (
        table.where(F.col(weight) >= hot_rows)
        .orderBy(F.col(weight).desc(), *keys)
        .limit(HOT_KEYS)
        .select(*keys, F.struct(*values).alias("_hot"))
    )
    first, rest = keys[0], keys[1:]
    marked = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "_first", F.when(F.col("_hot").isNull(), F.coalesce(F.col(first).cast("string"), _spread(rows))).otherwise(_spread(rows))
    )
    cold = table.select(
        F.col(first).cast("string").alias("_first"), *rest, F.struct(*values).alias("_cold")
    )
    joined = marked.join(cold, ["_first", *rest], "left")
    found = F.coalesce("_hot", "_cold")
    return joined.select(*rows.columns, *[found[v].alias(v) for v in values])


def _spread(rows: DataFrame) -> Column:
    """A stand-in key; depends on the row and its input split only, so a repeated task spreads alike."""
    plain = [f.name for f in rows.schema.fields if isinstance(f.dataType, (T.StringType, T.NumericType))]
    place = F.xxhash64(F.spark_partition_id(), *plain)
    return F.concat(F.lit("\u0000"), F.pmod(place, F.lit(SPREAD)).cast("string"))


def bucket_of(key: Column, buckets: int) -> Column:
    """Stable bucket number from the digest of a key."""
    return F.pmod(F.conv(F.substring(F.sha2(key, 256), 1, 13), 16, 10).cast("bigint"), F.lit(buckets)).cast("int")
