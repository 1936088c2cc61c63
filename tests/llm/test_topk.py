"""Exact top-k search against plain Python."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from plantmart.llm import topk

KIND = "vec_id long, embedding array<float>, row string, score string, rank string, lo string, whole string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], KIND)


def answer(rows, k, modulus, scale=64):
    held = []
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            held.append((i, [math.floor(scale * x) for x in v]))
    out = []
    for a, (i, q) in enumerate(held):
        if i is None or i % modulus:
            continue
        found = [(-sum(x * y for x, y in zip(q, v)), j is None, j or 0, j) for b, (j, v) in enumerate(held) if a != b]
        out += [(i, rank, j, -score) for rank, (score, _, _, j) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return out


def same(found, want):
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def vectors(n, width, seed, values):
    pick = random.Random(seed)
    return [(i, [pick.choice(values) for _ in range(width)]) for i in range(n)]


SMALL = [x / 64 for x in range(-3, 4)]


@pytest.mark.parametrize("block", [4096, 7])
def test_top_k(ready, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    # Few different values, so that most ranks are ties; then a copy that a third of all rows have, and scores far apart.
    rows = vectors(60, 4, 1, SMALL) + [(100 + i, [3 / 64] * 4) for i in range(30)] + vectors(9, 4, 2, [-900.0, 0.1, 700.0])
    found = topk.top_k(frame(ready, rows), F.col("vec_id") % 5 == 0, k=6)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    same(found, answer(rows, 6, 5))


def test_odd_rows(ready):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.25]), (0, [0.5, -0.25]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, []), (6, [1.0]),
        (None, [0.5, -0.25]), (None, None), (-3, [-0.001, 0.0]), (9, [2.0, 2.0, 2.0]), (12, [-inf, 0.0]),
    ]
    for k in (1, 3, 50):
        same(topk.top_k(frame(ready, rows), F.col("vec_id") % 3 == 0, k=k), answer(rows, k, 3))
    assert topk.top_k(frame(ready, []), F.col("vec_id") % 3 == 0).collect() == []
    assert topk.top_k(frame(ready, rows[:1]), F.col("vec_id") % 3 == 0).collect() == []
    assert topk.top_k(frame(ready, [(1, [1.0]), (2, [1.0])]), F.col("vec_id") % 3 == 0).collect() == []


def test_scores_beyond_53_bits(ready):
    rows = [(0, [2.0**24, 1.0]), (1, [2.0**24, 1.0]), (2, [2.0**24, 2.0]), (3, [-(2.0**24), 3.0]), (6, [1.0, 2.0**23])]
    same(topk.top_k(frame(ready, rows), F.col("vec_id") % 3 == 0, k=3), answer(rows, 3, 3))


def test_wide_ranges_take_several_rounds(ready, monkeypatch):
    monkeypatch.setattr(topk, "BINS", 4)
    rows = vectors(40, 6, 3, [x / 10 for x in range(-30, 30)])
    same(topk.top_k(frame(ready, rows), F.col("vec_id") % 4 == 0, k=5), answer(rows, 5, 4))
