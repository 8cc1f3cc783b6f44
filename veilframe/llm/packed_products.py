"""Hard negatives by Kronecker-packed inner products.

The components of several candidates are made non-negative by a bias and laid
side by side as fields of one wide integer. An anchor's biased component times
that integer multiplies all fields at once, and the sum over the components
carries all their inner products, since a field is wide enough for the largest
sum. The fields are cut out again and the biases taken off, which gives exact
scores. The wide integers live in the 53 bits that a double holds exactly, so a
block of anchors times a block of packed candidates is one matrix product; when
not even two fields fit there, they are Python integers of ``WIDE`` fields.

Positives come first (best rows of the anchor's label), then the negatives whose
score lies in the window that a positive sets. Both passes go over the shards of
``vector_grid`` in cells; what a cell returns is bounded per anchor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.llm import vector_grid as grid

DOUBLE_BITS = 53
WIDE = 16  # fields of a Python integer
ANCHORS = 128  # whose scores of a shard are held at once


class Packer:
    """Fields, width and bias that fit vectors of a shape."""

    def __init__(self, shape: grid.Shape):
        self.width, self.bias = shape.width, shape.top
        self.bits = max(1, (shape.width * (2 * shape.top) ** 2).bit_length())
        self.native = shape.exact and 2 * self.bits <= DOUBLE_BITS
        self.fields = DOUBLE_BITS // self.bits if self.native else WIDE

    def _biased(self, values: np.ndarray) -> np.ndarray:
        if self.native:
            return values.astype(np.float64) + self.bias
        return np.array([int(x) for x in values.ravel()], object).reshape(values.shape) + self.bias

    def pack(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(components by wide integers, sum of each candidate's biased components)."""
        biased = self._biased(values)
        sums = biased.sum(axis=1) if self.width else np.zeros(len(values), biased.dtype)
        short = -len(values) % self.fields
        if short:
            biased = np.concatenate([biased, np.zeros((short, self.width), biased.dtype)])
        words = np.zeros((len(biased) // self.fields, self.width), biased.dtype)
        for field in range(self.fields):
            words = words + biased[field :: self.fields] * 2 ** (self.bits * field)
        return words.T, sums

    def scores(self, anchors: np.ndarray, words: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """Exact inner products, anchors by candidates."""
        biased = self._biased(anchors)
        product = biased @ words if self.width else np.zeros((len(anchors), -(-len(sums) // self.fields)), biased.dtype)
        whole = product.astype(np.int64) if self.native else product
        out = np.empty((len(anchors), words.shape[1] * self.fields), whole.dtype)
        for field in range(self.fields):
            out[:, field :: self.fields] = (whole >> self.bits * field) & ((1 << self.bits) - 1)
        own = biased.sum(axis=1) if self.width else np.zeros(len(anchors), biased.dtype)
        out = out[:, : len(sums)]
        kind = np.int64 if self.native else object
        return grid.saturated(out - self.bias * (own.astype(kind)[:, None] + sums.astype(kind)[None, :]) + self.width * self.bias**2)


def _best(scores: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best scores, ties by place."""
    if len(scores) > k:
        able = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        scores, places = scores[able], places[able]
    else:
        able = np.arange(len(scores))
    return able[np.lexsort((places, -scores))[:k]]


class _Pass:
    """The anchors of one cell; subclasses say which candidates of a shard count and how many are kept."""

    def __init__(self, table: pa.Table, shape: grid.Shape, k: int):
        self.packer, self.k = Packer(shape), k
        self.own = table.column("own").to_pylist()
        self.labels = table.column("label").to_numpy()
        self.values = grid.numbers(table.column("vector").to_pylist(), shape)
        self.best: dict[tuple[int, int], tuple] = {}

    def wanted(self, i: int, own: int, same: np.ndarray, scores: np.ndarray):
        raise NotImplementedError

    def add(self, shard: grid.Shard) -> None:
        words, sums = self.packer.pack(shard.values)
        for a in range(0, len(self.own), ANCHORS):
            block = self.packer.scores(self.values[a : a + ANCHORS], words, sums)
            for i, scores in enumerate(block, a):
                for which, places in self.wanted(i, shard.place(self.own[i]), shard.labels == self.labels[i], scores):
                    self._keep((i, which), shard, places, scores[places])

    def _keep(self, key: tuple[int, int], shard: grid.Shard, places: np.ndarray, scores: np.ndarray) -> None:
        at = _best(scores, places, self.k)
        if not len(at):
            return
        new = scores[at], shard.ids[places[at]], (shard.key << grid.OWN_BITS) + places[at]
        if key in self.best:
            new = tuple(np.concatenate(pair) for pair in zip(self.best[key], new))
            order = np.lexsort((new[2], new[1], -new[0]))[: self.k]
            new = tuple(c[order] for c in new)
        self.best[key] = new

    def result(self) -> pa.RecordBatch:
        rows = [(self.own[i], which, *r) for (i, which), best in self.best.items() for r in zip(*[c.tolist() for c in best])]
        columns = list(zip(*rows)) if rows else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["own", "which", "score", "vec_id", "candidate"])


class _Positives(_Pass):
    def wanted(self, i, own, same, scores):
        if own >= 0:
            same[own] = False
        yield 0, np.flatnonzero(same)


class _Negatives(_Pass):
    def __init__(self, table: pa.Table, shape: grid.Shape, k: int):
        super().__init__(table, shape, k)
        self.windows = table.column("windows").to_pylist()

    def wanted(self, i, own, same, scores):
        other = np.flatnonzero(~same)
        those = scores[other]
        for w in self.windows[i]:
            yield w["which"], other[(those >= w["low"]) & (those <= w["high"])]


FOUND = "own long, which long, score long, vec_id long, candidate long"


def hard_negatives(df: DataFrame, anchors: Column, *, label: Column | str = "label", positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    An anchor is a row for which ``anchors`` holds; its positives are its best
    other rows of the same label. For each positive the best rows of another
    label are given whose score is from ``low`` to ``high`` percent of the
    positive's: ``low * positive <= 100 * negative <= high * positive``. Components
    become floor(scale * x); scores are exact inner products of these integers (at
    the limits of a long beyond them); higher ones come first, then smaller ids.

    Rows without a label or an id take no part, neither do null or non-finite
    vectors (``vector_grid``). Repeated ids are rows of their own: each is an
    anchor, and a positive or negative of its own. An anchor without positives,
    or a positive with an empty window, has no rows; an empty table has none.
    """
    if min(positives, negatives) < 1:
        raise ValueError("at least one positive and one negative must be asked for")
    label = F.col(label) if isinstance(label, str) else label
    index, shape = grid.shards(grid.points(df, vector_col, id_col, anchors, label), scale, "packed")
    asked = grid.queries_of(index, shape)
    found = grid.search(asked, index, shape, lambda table: _Positives(table, shape, positives), FOUND)
    order = Window.partitionBy("own").orderBy(F.desc("score"), "vec_id", "candidate")
    chosen = found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives)
    chosen = grid.materialize(chosen.select("own", "nth", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    exact = F.col("positive_score").cast("decimal(38,0)")
    ceiling, floor = F.ceil(exact * low / 100), F.floor(exact * high / 100)
    bounds = chosen.select("own", F.struct(F.col("nth").cast("long").alias("which"), ceiling.cast("long").alias("low"), floor.cast("long").alias("high")).alias("w"))
    bounds = bounds.where("w.low <= w.high").groupBy("own").agg(F.sort_array(F.collect_list("w")).alias("windows"))  # at most ``positives`` each
    again = asked.join(bounds, "own")
    found = grid.search(again, index, shape, lambda table: _Negatives(table, shape, negatives), FOUND)
    order = Window.partitionBy("own", "which").orderBy(F.desc("score"), "vec_id", "candidate")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    names = asked.select("own", F.col("id").alias("anchor_id"))
    return (
        ranked.join(chosen, (ranked["own"] == chosen["own"]) & (ranked["which"] == chosen["nth"])).drop(chosen["own"])
        .join(names, "own")
        .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
