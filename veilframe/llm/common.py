"""Helpers the operators share: a bounded membership filter and connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilframe.session import materialize

EDGES = 1 << 17  # that a task links at once, about
EARLIER = 4  # keys that a posting remembers of its set
FILTER_BITS = 1 << 23  # one megabyte, whatever the input; more keys only let more rows through


def _slot(column: str) -> Column:
    return F.pmod(F.col(column).cast("long"), F.lit(FILTER_BITS)).cast("long")


def _pieces(keys: DataFrame, column: str) -> DataFrame:
    """(piece, bits) of the bitmap of these keys, 256 rows of 4 KB at most."""
    return (
        keys.select(_slot(column).alias("slot")).groupBy(F.expr("slot div 32768").alias("piece"))
        .agg(F.bitmap_construct_agg(F.expr("slot % 32768").cast("long")).alias("bits"))
    )


class KeyFilter:
    """A fixed-size bitmap of 64-bit keys: no key in it is ever missed, others may pass."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @classmethod
    def of(cls, keys: DataFrame, column: str) -> KeyFilter:
        """Built by Spark from any number of keys; 32 KB pieces, 1 MB in all, reach the driver."""
        out = np.zeros(FILTER_BITS // 8, np.uint8)
        for row in _pieces(keys, column).collect():
            out[row.piece * 4096 : (row.piece + 1) * 4096] = np.frombuffer(bytes(row.bits), np.uint8)
        return cls(out)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        slot = keys.astype(np.int64) % FILTER_BITS
        return (self.words[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def split_by_keys(rows: DataFrame, column: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key may be one of ``keys`` (all that are, and a few others), and the rest, null keys among them.

    The bitmap goes to the rows and is never more than a megabyte, so no row
    moves for it. ``rows`` are read once for each part.
    """
    bits = F.broadcast(_pieces(keys, column).withColumnsRenamed({"piece": "_piece", "bits": "_bits"}))
    met = rows.withColumn("_slot", _slot(column)).join(bits, F.expr("_slot div 32768 = _piece"), "left")
    byte = "cast(conv(hex(substring(_bits, cast(_slot % 32768 div 8 as int) + 1, 1)), 16, 10) as int)"
    held = F.coalesce(F.expr(f"shiftright({byte}, cast(_slot % 8 as int)) % 2 = 1"), F.lit(False))
    return met.where(held).select(*rows.columns), met.where(~held).select(*rows.columns)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node reachable) of every node of these edges but the smallest ones themselves."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    parent = np.arange(len(nodes))
    while True:
        low, high = np.minimum(parent[x], parent[y]), np.maximum(parent[x], parent[y])
        if (low == high).all():
            break
        np.minimum.at(parent, high, low)
        while (parent[parent] != parent).any():
            parent = parent[parent]
    led = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[led], nodes[parent[led]]


def _forests(most: int = 2 * EDGES):
    """Edges of a partition as trees of depth one, so many edges at once."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
            rows += batch.num_rows
            if rows >= most:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in forest(*[np.concatenate(c) for c in zip(*held)])], schema=schema)
                held, rows = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in forest(*[np.concatenate(c) for c in zip(*held)])], schema=schema)

    return run


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Large-star and small-star steps: each node sends its neighbours to the
    smallest one it knows. A node's neighbours are never gathered; minima are
    aggregated and joined back, so a hub of any degree is spread over tasks.
    Before each check every task links what it holds, a bounded number of edges
    at once, to the smallest node it sees, which saves most rounds. The edges
    of each round are a table in the shared folder.
    """

    def linked(df: DataFrame) -> DataFrame:
        trees = materialize(df.where("a <> b").mapInArrow(_forests(), "a long, b long"), name)
        tasks = 2 + trees.count() // EDGES  # again with full tasks, so that most of a group meets in one
        return materialize(trees.coalesce(tasks).mapInArrow(_forests(), "a long, b long"), name)

    current = linked(edges.select(F.col("a").cast("long"), F.col("b").cast("long")))
    while not _stars(current):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        current = linked(
            down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        )
    led = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return materialize(led.unionByName(roots).distinct(), f"{name}-found")  # plans that use it several times stay small


def _stars(edges: DataFrame) -> bool:
    """Whether every edge leads from a node of its own to a smaller one that has no edge further down."""
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("to"), (F.col("a") < F.col("b")).alias("fault"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(None).cast("long").alias("to"), F.lit(False).alias("fault")))
    # A node that has an edge down may not be the end of another, nor have two different ends.
    seen = ends.groupBy("node").agg(F.min("to").alias("low"), F.max("to").alias("high"), F.max("fault").alias("fault"), F.count(F.when(F.col("to").isNull(), 1)).alias("ends"))
    wrong = F.col("fault") | (F.col("low") != F.col("high")) | (F.col("low").isNotNull() & (F.col("ends") > 0))
    return not seen.agg(F.max(F.coalesce(wrong, F.lit(False)).cast("int")).alias("wrong")).first().wrong


def merged(groups: DataFrame, links: DataFrame, name: str = "components") -> DataFrame:
    """``groups`` (node, component) after further links (a, b); only what the links touch is worked out anew."""
    left = groups.select(F.col("node").alias("a"), F.col("component").alias("ga"))
    right = groups.select(F.col("node").alias("b"), F.col("component").alias("gb"))
    ends = links.join(left, "a", "left").join(right, "b", "left")
    roots = components(ends.select(F.coalesce("ga", "a").alias("a"), F.coalesce("gb", "b").alias("b")), name)
    new = roots.join(groups, "node", "left_anti")
    joined = groups.join(roots.select(F.col("node").alias("component"), F.col("component").alias("root")), "component", "left")
    return materialize(joined.select("node", F.coalesce("root", "component").alias("component")).unionByName(new), f"{name}-merged")


def with_earlier(rows: DataFrame, key: str, order: str, *owner: str) -> DataFrame:
    """``rows`` with ``earlier``: the keys of the ``EARLIER`` rows before, in an order of keys that all owners share."""
    before = Window.partitionBy(*owner).orderBy(order)
    return rows.withColumn("earlier", F.array(*[F.lag(key, i).over(before) for i in range(1, EARLIER + 1)]))


def met_before(left: str, right: str) -> Column:
    """Whether two rows of one key are known to share an earlier key, which gives the pair as well.

    The first key that two owners share has none before it, so each pair is still given.
    """
    return F.coalesce(F.arrays_overlap(left, right), F.lit(False))
