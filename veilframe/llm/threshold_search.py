"""Exact top-k inner products by the threshold algorithm.

Every shard of the vectors has one list per dimension, sorted by that component.
A query reads the lists in step: those of its positive components from the top,
those of its negative ones from the bottom. Each row met is scored at once from
its whole vector. No row that was not met yet can score more than the sum, over
the dimensions, of the query's component times the last component read there;
the search of a shard stops when that bound is under the k-th best score. A tie
could still win by its id, so it goes on while the two are equal. The k best so
far go with the query from shard to shard of a cell, so later shards stop
earlier, many before the first read. Depths grow fourfold per round, which keeps
the work in NumPy; the bounds of all queries at all depths are one product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.llm import vector_grid as grid

FIRST_DEPTH = 8
FOUND = "own long, query_id long, vec_id long, candidate long, score long"


class _Lists:
    """Sorted lists of a shard: row places and components by depth, per dimension."""

    def __init__(self, shard: grid.Shard):
        self.shard = shard
        self.order = np.argsort(shard.values, axis=0, kind="stable")
        self.sorted = np.take_along_axis(shard.values, self.order, axis=0)
        n = len(shard.ids)
        self.depths = [0]
        depth = FIRST_DEPTH
        while self.depths[-1] < n:
            self.depths.append(min(depth, n))
            depth *= 4

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """By query and round: what a row not met after the round can score at most."""
        up, down = np.where(queries > 0, queries, 0), np.where(queries < 0, queries, 0)
        n = len(self.shard.ids)
        last = np.array([max(depth, 1) for depth in self.depths])
        return grid.saturated(up @ self.sorted[n - last].T + down @ self.sorted[last - 1].T)

    def read(self, since: int, to: int, up: np.ndarray, down: np.ndarray) -> np.ndarray:
        """Places at these depths, in the lists of these dimensions."""
        n = len(self.shard.ids)
        return np.concatenate([self.order[n - to : n - since, up].ravel(), self.order[since:to, down].ravel()])


class _Search:
    """The queries of one cell and the best rows each has met."""

    def __init__(self, table: pa.Table, shape: grid.Shape, k: int):
        self.own, self.ids, self.k = table.column("own").to_pylist(), table.column("id").to_pylist(), k
        self.queries = grid.numbers(table.column("vector").to_pylist(), shape)
        self.up = [np.flatnonzero(q > 0) for q in self.queries]
        self.down = [np.flatnonzero(q < 0) for q in self.queries]
        self.best = [(np.zeros(0, np.int64),) * 3] * len(self.own)  # scores, ids, keys; best first

    def add(self, shard: grid.Shard) -> None:
        lists = _Lists(shard)
        bounds = lists.bounds(self.queries)
        for i in range(len(self.own)):
            self._one(i, lists, bounds[i])

    def _one(self, i: int, lists: _Lists, bounds: np.ndarray) -> None:
        n, query = len(lists.shard.ids), self.queries[i]
        met, left = np.zeros(n, bool), n
        own = lists.shard.place(self.own[i])
        if own >= 0:
            met[own], left = True, n - 1
        if not len(self.up[i]) and not len(self.down[i]):  # all scores are 0: ids decide, and rows stand by id
            self._keep(i, lists.shard, np.flatnonzero(~met)[: self.k], query)
            return
        for turn, to in enumerate(lists.depths):
            if turn:
                fresh = np.zeros(n, bool)
                fresh[lists.read(lists.depths[turn - 1], to, self.up[i], self.down[i])] = True
                fresh &= ~met
                met |= fresh
                new = np.flatnonzero(fresh)
                left -= len(new)
                self._keep(i, lists.shard, new, query)
            if not left or len(self.best[i][0]) == self.k and bounds[turn] < self.best[i][0][-1]:
                return

    def _keep(self, i: int, shard: grid.Shard, places: np.ndarray, query: np.ndarray) -> None:
        scores = grid.saturated(shard.values[places] @ query)
        held = self.best[i]
        if len(held[0]) == self.k:  # rows under the k-th are out at once
            able = scores >= held[0][-1]
            places, scores = places[able], scores[able]
        if len(scores) > 4 * self.k:
            able = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            places, scores = places[able], scores[able]
        if not len(places):
            return
        scores = np.concatenate([held[0], scores])
        ids = np.concatenate([held[1], shard.ids[places]])
        keys = np.concatenate([held[2], (shard.key << grid.OWN_BITS) + places])
        order = np.lexsort((keys, ids, -scores))[: self.k]
        self.best[i] = scores[order], ids[order], keys[order]

    def result(self) -> pa.RecordBatch:
        sizes = [len(b[0]) for b in self.best]
        scores, ids, keys = (np.concatenate([b[j] for b in self.best]) for j in range(3))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array(self.own, np.int64), sizes)), pa.array(np.repeat(np.array(self.ids, np.int64), sizes)),
                pa.array(ids), pa.array(keys), pa.array(scores),
            ],
            names=["own", "query_id", "vec_id", "candidate", "score"],
        )


def nearest(df: DataFrame, asks: Column, *, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every row for which ``asks`` holds.

    Components become floor(scale * x); a score is the exact inner product of
    these integers (at the limits of a long beyond them). Higher scores come
    first, then smaller ids. Fewer than k other rows give all of them. Rows that
    take part are told in ``vector_grid``: null or non-finite vectors and null
    ids are out, repeated ids are rows of their own (each row that asks gets its
    own ranks), an empty table gives no rows, other columns are ignored.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    index, shape = grid.shards(grid.points(df, vector_col, id_col, asks), scale, "threshold")
    queries = grid.queries_of(index, shape)
    found = grid.search(queries, index, shape, lambda table: _Search(table, shape, k), FOUND)
    best = Window.partitionBy("own").orderBy(F.desc("score"), "vec_id", "candidate")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
