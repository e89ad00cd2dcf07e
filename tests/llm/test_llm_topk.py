"""Exact top-k search against all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reknit.llm import topk


def plain(rows, k):
    usable = {}
    for id, vector in rows:
        if id is None or vector is None or any(
                x is None or not math.isfinite(x) for x in vector):
            continue
        terms = [math.floor(256 * float(np.float32(x))) for x in vector]
        usable[id] = min(usable.get(id, terms), terms)
    out = []
    for q, one in usable.items():
        if q % 50:
            continue
        scores = sorted((-sum(a * b for a, b in zip(one, other)), id)
                        for id, other in usable.items() if id != q)
        out.extend((q, rank + 1, id, -score) for rank, (score, id) in enumerate(scores[:k]))
    return sorted(out)


def vectors(seed, count, width):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    rows = [(id, [c + draw.gauss(0, 0.3) for c in draw.choice(centres)]) for id in range(count)]
    return rows + [(count + n, [1.0] * width) for n in range(60)]


@pytest.mark.parametrize("block", [4, 256])
def test_as_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "search", lambda *a: search(*a, block_rows=block))
    monkeypatch.setattr(topk, "QUERY_COMPONENTS", 50)
    rows = vectors(block, 300, 8)
    rows += [(50, None), (1000, [None, 1.0]), (1050, [float("nan")]), (1100, [float("inf")]),
             (None, [1.0]), (1150, []), (1200, [0.5]), (1250, [2.0] * 12), (100, [9.0] * 8),
             (100, rows[100][1]), (-50, [-1.0] * 8), (1300, [0.0] * 8)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr(
        "*", "1 AS id", "2 AS score", "3 AS terms")
    found = topk.top_k(table, F.col("vec_id") % 50 == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == plain(rows, 5)


search = topk.search


def test_few_rows_and_none(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [2.0])],
                                  "vec_id long, embedding array<float>")
    found = topk.top_k(table, F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, found.collect())) == [(0, 1, 1, 131072), (0, 2, 2, 131072)]
    assert topk.top_k(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_k(table, F.col("vec_id") > 50).count() == 0


def test_blocks_below_the_bound_are_not_scored():
    rows = np.zeros((1000, 3), np.int64)
    rows[:, 0] = np.arange(1000)
    queries = np.array([[1, 0, 0], [-1, 0, 0]])
    best = topk.Best(2, 5)
    scored = topk.search(best, np.array([-1, -2]), queries, np.arange(1000), rows, block_rows=10)
    assert best.ids.tolist() == [[999, 998, 997, 996, 995], [0, 1, 2, 3, 4]]
    assert scored == 2


def test_large_products_are_exact():
    one = np.array([[2**40, 3]])
    assert topk.product(one, np.array([[2**20, 5]])).tolist() == [[2**60 + 15]]
    assert topk.product(one, np.array([[2**40, 5]])).tolist() == [[topk.LARGEST]]
    assert topk.product(np.zeros((2, 0), int), np.zeros((3, 4), int)).shape == (2, 3)
