"""Query vectors against all vectors, in blocks.

The vectors are written once as *shards*: rows of a few thousand vectors each,
sorted by id, their components turned into integers. The queries are rows of
that table. A *cell* is a block of queries and a group of shards; Spark deals
both sides out to cells, so each cell holds its queries, streams its shards one
after the other and returns a bounded answer per query. Nothing of the queries
or the vectors reaches the driver, and no row is paired with another outside of
a cell. With ``Q`` queries and ``N`` vectors the exchange moves
``N * Q / BLOCK + Q * N / GROUP_ROWS`` vectors.

Rules for the input, for every operator built on it: a vector that is null or
holds a null or non-finite component takes no part, neither does a row without
an id; a shorter vector counts as padded with zeros; rows that repeat an id are
rows of their own, each a query and a candidate; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.session import materialize

BLOCK = 8192  # queries of a cell, about
SHARD_ROWS = 8192  # vectors of a shard at most
GROUP_SHARDS = 32  # shards of a cell at most
_LEAST_ROWS = 512  # smaller shards are not worth their overhead
OWN_BITS = 14  # of a row's key: its place in the shard

LONG = np.iinfo(np.int64)


@dataclass(frozen=True)
class Shape:
    """What all shards have in common: how many rows, components, and the largest component."""

    rows: int
    width: int
    top: int

    @property
    def stored(self) -> str:
        return "<i2" if self.top < 1 << 15 else "<i4" if self.top < 1 << 31 else "<f8"

    @property
    def exact(self) -> bool:
        """Whether every partial sum of an inner product is an integer that a double holds."""
        return self.width * self.top**2 < 1 << 53


@dataclass
class Shard:
    key: int
    ids: np.ndarray
    labels: np.ndarray
    values: np.ndarray  # rows by components

    def place(self, own: int) -> int:
        """Where the row of this key stands here; -1 if in another shard."""
        return own & ((1 << OWN_BITS) - 1) if own >> OWN_BITS == self.key else -1


def numbers(buffers: list[bytes], shape: Shape) -> np.ndarray:
    """Stored components as doubles, or as Python integers where doubles would not be exact."""
    flat = np.frombuffer(b"".join(buffers), shape.stored).astype(np.float64)
    out = flat if shape.exact else np.array([int(x) for x in flat], object)
    return out.reshape(-1, shape.width) if shape.width else out.reshape(len(buffers), 0)


def saturated(scores: np.ndarray) -> np.ndarray:
    """Exact scores as 64-bit integers; what is beyond them counts as the nearest."""
    if scores.dtype == object:
        scores = np.array([min(max(int(x), LONG.min), LONG.max) for x in scores.ravel()], np.int64).reshape(scores.shape)
    return scores.astype(np.int64)


def points(df: DataFrame, vector_col: str, id_col: str, query: Column, label: Column | None = None) -> DataFrame:
    """(id, vector, query, label) of the rows that take part."""
    vector = F.col(vector_col).cast("array<double>")
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    chosen = df.select(
        F.col(id_col).cast("long").alias("id"), vector.alias("vector"), F.coalesce(query, F.lit(False)).alias("query"),
        (F.lit(0) if label is None else label).cast("long").alias("label"),
    )
    return chosen.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & usable)


def shape_of(rows: DataFrame, scale: float) -> Shape:
    most = F.array_max(F.transform("vector", lambda x: F.abs(F.floor(x * scale).cast("double"))))
    # Floor of a double beyond the longs saturates in Spark, so large vectors are measured by their bare product.
    bare = F.array_max(F.transform("vector", lambda x: F.abs(x * scale))) + 1
    got = rows.agg(
        F.count("*").alias("n"), F.max(F.size("vector")).alias("width"), F.max(F.when(bare < 2.0**52, most).otherwise(bare)).alias("top")
    ).first()
    return Shape(got.n, max(got.width or 0, 0), int(got.top or 0))


def _pack(scale: float, shape: Shape, most: int):
    schema = pa.schema([("shard", pa.int64()), ("ids", pa.binary()), ("labels", pa.binary()), ("queries", pa.binary()), ("values", pa.binary())])

    def matrix(column: pa.Array) -> np.ndarray:
        lengths = np.diff(column.offsets.to_numpy())
        out = np.zeros((len(column), shape.width))
        at = np.arange(shape.width) < lengths[:, None]
        out[at] = np.floor(column.flatten().to_numpy(zero_copy_only=False) * scale)
        return out

    def run(batches):
        part, nth, held, rows = TaskContext.get().partitionId(), 0, [], 0

        def emit(table: pa.Table) -> pa.RecordBatch:
            ids = table.column("id").to_numpy()
            order = np.argsort(ids, kind="stable")
            values = np.concatenate([matrix(c) for c in table.column("vector").chunks])[order]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 16) + nth], pa.int64()), pa.array([ids[order].astype("<i8").tobytes()], pa.binary()),
                    pa.array([table.column("label").to_numpy()[order].astype("<i8").tobytes()], pa.binary()),
                    pa.array([np.asarray(table.column("query"), bool)[order].tobytes()], pa.binary()),
                    pa.array([values.astype(shape.stored).tobytes()], pa.binary()),
                ],
                schema=schema,
            )

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, most - rows)
                held.append(piece)
                rows, at = rows + piece.num_rows, at + piece.num_rows
                if rows == most:
                    yield emit(pa.Table.from_batches(held))
                    held, rows, nth = [], 0, nth + 1
        if rows:
            yield emit(pa.Table.from_batches(held))

    return run


def shards(rows: DataFrame, scale: float, name: str) -> tuple[DataFrame, Shape]:
    """The written table of shards of ``points``, and their shape."""
    shape = shape_of(rows, scale)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    wanted = min(SHARD_ROWS, max(_LEAST_ROWS, shape.rows // (4 * cores)))
    # Dealt in turn, so a frequent id, label or vector is spread like any other row.
    dealt = rows.repartition(max(1, -(-shape.rows // wanted)))
    packed = dealt.mapInArrow(_pack(scale, shape, SHARD_ROWS), "shard long, ids binary, labels binary, queries binary, values binary")
    return materialize(packed, name), shape


def queries_of(index: DataFrame, shape: Shape) -> DataFrame:
    """(own, id, label, vector) of the rows that ask; ``own`` is the row's key, the same in every run over the written index."""
    size = np.dtype(shape.stored).itemsize * shape.width

    def run(batches):
        for batch in batches:
            for shard, ids, labels, asks, values in zip(*[batch.column(n).to_pylist() for n in ("shard", "ids", "labels", "queries", "values")]):
                at = np.flatnonzero(np.frombuffer(asks, bool))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((shard << OWN_BITS) + at), pa.array(np.frombuffer(ids, "<i8")[at]), pa.array(np.frombuffer(labels, "<i8")[at]),
                        pa.array([values[i * size : (i + 1) * size] for i in at.tolist()], pa.binary()),
                    ],
                    names=["own", "id", "label", "vector"],
                )

    return index.mapInArrow(run, "own long, id long, label long, vector binary")


def search(queries: DataFrame, index: DataFrame, shape: Shape, start: Callable[[pa.Table], object], schema: str) -> DataFrame:
    """Every query against every shard.

    ``queries`` has at least the column ``own``. ``start(table)`` gets the queries
    of a cell and returns an object with ``add(shard)``, called once per shard of
    the cell, and ``result()``, which gives a record batch of ``schema``.
    """
    asked, there = queries.count(), index.count()
    cores = queries.sparkSession.sparkContext.defaultParallelism
    n_blocks = max(1, -(-asked // BLOCK))
    n_groups = max(1, -(-there // GROUP_SHARDS), min(there, -(-4 * cores // n_blocks)))
    names = queries.columns
    left = queries.withColumn("block", F.pmod(F.xxhash64("own"), F.lit(n_blocks))).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    # Shards are numbered by the task that wrote them, so these groups differ by one shard at most.
    right = index.drop("queries").withColumn("group", F.expr(f"(shard div 65536 + shard % 65536) % {n_groups}").cast("int"))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    cell = (F.col("block") * n_groups + F.col("group")).cast("int").alias("cell")
    both = left.select(cell, *[F.col(n).alias(f"q_{n}") for n in names]).unionByName(right.select(cell, "shard", "ids", "labels", "values"), allowMissingColumns=True)

    def run(batches):
        current, held, state = None, [], None
        for batch in batches:
            cells, shard = batch.column("cell").to_numpy(), batch.column("shard")
            for a, b in _runs(cells):
                if current != cells[a]:
                    if state is not None:
                        yield state.result()
                    current, held, state = cells[a], [], None
                asks = int(shard.slice(a, b - a).null_count)  # queries stand first
                if asks:
                    held.append(pa.RecordBatch.from_arrays([batch.column(f"q_{n}").slice(a, asks) for n in names], names=names))
                for i in range(a + asks, b):
                    if not held:
                        break
                    state = state or start(pa.Table.from_batches(held))
                    state.add(_shard(batch, i, shape))
        if state is not None:
            yield state.result()

    dealt = both.repartitionById(n_blocks * n_groups, F.col("cell")).sortWithinPartitions("cell", F.asc_nulls_first("shard"))
    return dealt.mapInArrow(run, schema)


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    if len(values):
        edges = np.flatnonzero(np.diff(values)) + 1
        yield from zip([0, *edges.tolist()], [*edges.tolist(), len(values)])


def _shard(batch: pa.RecordBatch, i: int, shape: Shape) -> Shard:
    ids = np.frombuffer(batch.column("ids")[i].as_py(), "<i8")
    values = numbers([batch.column("values")[i].as_py()], shape) if shape.width else np.zeros((len(ids), 0))
    return Shard(batch.column("shard")[i].as_py(), ids, np.frombuffer(batch.column("labels")[i].as_py(), "<i8"), values)
