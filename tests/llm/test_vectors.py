"""The two vector searches against plain versions: every score, sorted."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veilframe.llm import packed_products, threshold_search, vector_grid

LONG = 2**63
SCHEMA = "vec_id long, embedding array<double>, label int, id long, query string, own long, score string"
NAN, INF = float("nan"), float("inf")


def integers(rows, scale=256):
    """(id, label, integers) of the rows that take part."""
    usable = [r for r in rows if r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    return [(r[0], r[2], [math.floor(scale * x) for x in r[1]]) for r in usable]


def product(a, b):
    return max(-LONG, min(LONG - 1, sum(x * y for x, y in zip(a, b))))


def ranked(rows, at, keep=lambda other: True):
    """(score, id) of the other rows, best first; repeated ids are rows of their own."""
    scored = [(-product(rows[at][2], r[2]), r[0]) for j, r in enumerate(rows) if j != at and keep(r)]
    return [(-s, i) for s, i in sorted(scored)]


def nearest(rows, asks, k):
    rows = integers(rows)
    return sorted((rows[i][0], rank, other, score) for i in range(len(rows)) if asks(rows[i][0]) for rank, (score, other) in enumerate(ranked(rows, i)[:k], 1))


def negatives(rows, anchors, k, most, low=30, high=90):
    rows, out = [r for r in integers(rows) if r[1] is not None], []
    for i, (own, label, _) in enumerate(rows):
        if anchors(own):
            other = ranked(rows, i, lambda r: r[1] != label)
            for ps, positive in ranked(rows, i, lambda r: r[1] == label)[:k]:
                fit = [x for x in other if low * ps <= 100 * x[0] <= high * ps][:most]
                out += [(own, positive, rank, n, ps, s) for rank, (s, n) in enumerate(fit, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 9, "q", 9, "s") for r in rows], SCHEMA)


def both(spark, rows, k=3, most=4):
    df = frame(spark, rows)
    got = sorted(tuple(r) for r in threshold_search.nearest(df, F.col("vec_id") % 5 == 0, k=k).collect())
    assert got == nearest(rows, lambda i: i % 5 == 0, k)
    got = sorted(tuple(r) for r in packed_products.hard_negatives(df, F.col("vec_id") % 5 == 0, positives=k, negatives=most).collect())
    assert got == negatives(rows, lambda i: i % 5 == 0, k, most)
    return got


@pytest.mark.parametrize("size", [0.6, 40.0, 3e5, 1e18])  # fields of two to a word, one, Python integers, scores beyond a long
def test_against_all_scores(spark, monkeypatch, size):
    monkeypatch.setattr(vector_grid, "SHARD_ROWS", 32)
    monkeypatch.setattr(vector_grid, "_LEAST_ROWS", 16)
    rng = random.Random(size)
    rows = [(i, [rng.uniform(-size, size) for _ in range(6)], rng.randrange(3)) for i in range(150)]
    assert both(spark, rows) or size == 1e18


def test_ties_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(vector_grid, "_LEAST_ROWS", 8)
    rng = random.Random(1)
    rows = [(i, [float(rng.randint(0, 1)) for _ in range(3)], rng.randrange(2)) for i in range(60)]
    rows += [rows[5]] * 3 + [(10, [1.0, 1.0, 1.0], 0)] + [(70 + i, [0.5, 0.25, 0.0], 1) for i in range(40)]
    both(spark, rows, k=7, most=9)


def test_odd_rows(spark):
    rows = [
        (0, None, 1), (5, [], 0), (10, [1.0, None], 0), (15, [NAN, 1.0], 0), (20, [INF, 0.0], 1), (25, [0.0, 0.0, 0.0], 0), (None, [1.0, 1.0, 1.0], 0),
        (30, [1.0, 2.0, 3.0], None), (35, [1.0], 0), (40, [-1.0, 2.0], 1), (41, [2.0, -0.5, 1.0], 0), (42, [1.0, 0.0, 0.0], 1), (45, [1.0, 1.0, 1.0], 0),
    ]
    both(spark, rows)
    both(spark, [(5, [1.0], 0)])
    both(spark, [(5, [], 0), (10, [], 1), (15, [], 0)])
    both(spark, [(i, None, 0) for i in range(3)])
    both(spark, [])


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(vector_grid, "BLOCK", 7)
    monkeypatch.setattr(vector_grid, "GROUP_SHARDS", 2)
    monkeypatch.setattr(vector_grid, "SHARD_ROWS", 16)
    rng = random.Random(4)
    both(spark, [(i, [rng.gauss(0, 0.2) for _ in range(8)], rng.randrange(2)) for i in range(200)])


def test_search_stops_early():
    """On vectors with a few large components most rows are never scored, and the answer is the same."""
    rng = np.random.default_rng(2)
    values = np.floor(256 * rng.pareto(1.5, (4000, 16)))
    shape = vector_grid.Shape(4000, 16, int(values.max()))
    assert shape.exact
    shard = vector_grid.Shard(1, np.arange(4000), np.zeros(4000, np.int64), values)
    query = values[:1].astype(shape.stored)
    table = pa.table({"own": pa.array([0]), "id": pa.array([-1]), "vector": pa.array([query.tobytes()], pa.binary())})
    search, scored = threshold_search._Search(table, shape, 5), []
    keep = search._keep
    search._keep = lambda i, shard, places, q: (scored.append(len(places)), keep(i, shard, places, q))
    search.add(shard)
    want = np.lexsort((np.arange(4000), -(values @ values[0])))[:5]
    assert search.best[0][1].tolist() == want.tolist() and sum(scored) < 2000


def test_fields_hold_the_largest_sums():
    for width, top in ((64, 160), (3, 1), (1, 0), (5, 30_000), (7, 1 << 40)):
        shape = vector_grid.Shape(0, width, top)
        packer, values = packed_products.Packer(shape), [[top] * width, [-top] * width, [(-1) ** i * top for i in range(width)], [0] * width]
        values = np.array(values, float) if shape.exact else np.array(values, object)
        words, sums = packer.pack(values)
        want = [[product(map(int, a), map(int, b)) for b in values] for a in values]
        assert packer.scores(values, words, sums).tolist() == want
        assert packer.fields > 1
