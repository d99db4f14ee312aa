"""Hard negatives and their scoring against plain products and sorting."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripleframe.llm import negatives


@pytest.mark.parametrize("dimensions", [1, 7, 8, 9, 64])
@pytest.mark.parametrize("low, high", [(-256, 257), (-(1 << 31) + 1, 1 << 31), (0, 1), (-1, 1), (5, 900)])
def test_scores_are_inner_products(dimensions, low, high):
    rng = np.random.default_rng(dimensions)
    numbers, anchors = rng.integers(low, high, (200, dimensions)), rng.integers(low, high, (70, dimensions)) >> 3
    planes = negatives.bit_planes(numbers)
    assert (negatives.scores(anchors, planes) == anchors @ numbers.T).all()
    row = {"planes": planes.tobytes(), "depth": planes.shape[0], "groups": planes.shape[1]}
    assert (negatives._unpacked(row)[:, :dimensions] == numbers).all()


def test_subset_sums():
    sums = negatives.subset_sums(np.array([[1, 10, 100, 0, 0, 0, 0, 5], [2, 0, 0, 0, 0, 0, 0, -7]]), 1)
    assert sums[0, 0b10000011].tolist() == [16, -5] and sums[0, 0].tolist() == [0, 0]


def brute(rows, positives=5, negatives_=3):
    usable = [(i, v, lab, [int(np.floor(256 * float(x))) for x in e]) for i, (v, lab, e) in enumerate(rows) if lab is not None and e and all(x is not None and np.isfinite(x) for x in e)]
    first = lambda row: (-row[0], row[1] is None, row[1] or 0, row[2])
    out = []
    for i, v, lab, q in usable:
        if v is None or v % 50:
            continue
        scored = [(sum(x * y for x, y in zip(q, p, strict=False)), w, j, m) for j, w, m, p in usable if j != i]
        near = sorted((s for s in scored if s[3] == lab), key=first)[:positives]
        for p, w, _, _ in near:
            far = sorted((s for s in scored if s[3] != lab and 50 * p <= 100 * s[0] <= 95 * p), key=first)[:negatives_]
            out += [(v, w, k + 1, s[1], p, s[0]) for k, s in enumerate(far)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("anchors, block", [(256, 4096), (3, 20)])
def test_against_sorting(spark, monkeypatch, anchors, block):
    monkeypatch.setattr(negatives, "ANCHORS", anchors)
    monkeypatch.setattr(negatives, "ROWS", block)
    rnd = random.Random(2)
    vector = lambda n: [rnd.gauss(0.3, 1) for _ in range(n)]
    rows = [(5 * k, rnd.choice([0, 1, 2, None]), vector(9)) for k in range(160)]
    hot = vector(9)
    rows += [(1000 + k, k % 3, hot) for k in range(60)] + [(1000, 1, hot), (1000, 0, hot)]  # ties and a repeated anchor
    rows += [(None, 1, hot), (50, 1, None), (100, 1, []), (150, 0, [None] * 9), (200, 2, [float("nan")] * 9), (250, 1, [float("inf")] * 9)]
    rows += [(300, 1, vector(4)), (350, 2, vector(20)), (400, 0, [0.0] * 9), (-50, 1, [1e5] * 9)]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "vec_id long, label int, embedding array<double>, number int, block string").repartition(4)
    got = negatives.mine(df, F.col("vec_id") % 50 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_no_rows(spark):
    schema = "vec_id long, label int, embedding array<float>"
    for rows in ([], [(50, 1, [1.0])], [(1, 1, [1.0]), (2, 2, [1.0])], [(50, None, [1.0])]):
        assert negatives.mine(spark.createDataFrame(rows, schema), F.col("vec_id") % 50 == 0).collect() == []
