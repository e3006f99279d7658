"""Exact nearest vectors against scoring every pair."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, dims string, score string"


def brute(rows, k):
    usable = {}
    for vec_id, v in rows:
        if vec_id is not None and v and all(x is not None and math.isfinite(x) for x in v):
            usable[vec_id, tuple(math.floor(64 * float(np.float32(x))) for x in v)] = None
    out = []
    for q, qv in usable:
        if q % 20 == 0:
            scored = {(-sum(a * b for a, b in zip(qv, cv, strict=True)), c) for c, cv in usable if c != q and len(cv) == len(qv)}
            out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def run(spark, rows, k=20):
    table = spark.createDataFrame([(i, v, 1, "d", "s") for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in topk.nearest(table, F.col("vec_id") % 20 == 0, k).collect())


@pytest.mark.parametrize("block", [8192, 37])
def test_random_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk, "FIRST_DEPTH", 4)
    draw = random.Random(block)
    rows = [(i, [draw.gauss(0, 0.2) for _ in range(6)]) for i in range(300)]
    rows += [(i, rows[i % 7][1]) for i in range(300, 340)]  # ties
    assert run(spark, rows) == brute(rows, 20)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, []), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (None, [1.0, 1.0]),
        (20, [0.0, 0.0]), (6, [1.0, 2.0]), (6, [1.0, 2.0]), (7, [-1.0, -0.001]), (8, [5.0]), (40, [3.0]), (9, [3e7, -3e7]), (60, [2e7, 1.0]), (100, [1.0, 1.0, 1.0]),
    ]
    assert run(spark, rows) == brute(rows, 20)


def test_components_too_large_to_score_take_no_part(spark):
    assert run(spark, [(0, [1.0]), (1, [3e38]), (2, [2.0])]) == [(0, 1, 2, 64 * 128)]


def test_large_components_are_scored_exactly(spark):
    rows = [(0, [1.0]), (1, [4e7]), (2, [2.0]), (20, [-4e7]), (3, [5e7]), (4, [1e17])]
    assert run(spark, rows[:5]) == brute(rows[:5], 20)
    assert [r for r in run(spark, rows) if r[2] == 4] == []  # 64 times 6.4e18 fits no long
    rows = [(0, [2e10, -2e10]), (1, [2e10, 2e10]), (2, [2e10, 1.0]), (3, [0.0, 1.0]), (5, [1.0, 0.0])]
    step = 64 * 2 * 10**10  # 2e10 is a float exactly
    assert run(spark, rows) == [(0, 1, 5, 64 * step), (0, 2, 1, 0), (0, 3, 3, -64 * step)]


def test_fewer_than_k_and_empty(spark):
    assert run(spark, [(0, [1.0]), (20, [2.0])], 3) == [(0, 1, 20, 64 * 128), (20, 1, 0, 64 * 128)]
    assert run(spark, []) == []


def test_threshold_stops_early():
    draw = np.random.default_rng(0)
    vectors = np.zeros((5000, 4), np.int64)
    vectors[:, 0] = draw.permutation(5000)
    vectors[:, 1:] = draw.integers(-3, 4, (5000, 3))
    lists = topk.SortedLists(np.arange(5000), vectors)
    touched = []
    original = lists.exact

    class Counting:
        def __getitem__(self, rows):
            touched.append(len(rows))
            return original[rows]

    lists.exact = Counting()
    ids, scores = lists.top(np.array([1000, 1, 0, -1]), -1, 10)
    every = vectors @ np.array([1000, 1, 0, -1])
    assert scores.tolist() == np.sort(every)[::-1][:10].tolist() and sum(touched) < 1000
