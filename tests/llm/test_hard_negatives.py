"""Searches of the tree against brute force, and awkward rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vanewatch.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"
rng = random.Random(8)


def slow(rows, anchor, positives=5, negatives=5, near=80):
    once = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        # as a 32-bit number, which the column holds
        row = label, [math.floor(256 * float(np.float32(x))) for x in v]
        once[i] = min(once.get(i, row), row)
    out = []
    for a, (own, va) in once.items():
        if not anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, label) for i, (label, v) in once.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == own][:positives]:
            fit = [x for x in scored if x[2] != own and near * -s <= 100 * -x[0] <= 100 * -s][:negatives]
            out += [(a, p, r, i, -s, -t) for r, (t, i, _) in enumerate(fit, 1)]
    return sorted(out)


def clouds(n, size, labels=4):
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(6)]
    return [(i, [c + rng.gauss(0, 0.3) for c in rng.choice(centres)], rng.randrange(labels)) for i in range(n)]


def mined(spark, rows, **how):
    found = hn.mine_negatives(spark.createDataFrame(rows, SCHEMA), F.col("id") % 10 == 0, **how)
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("how", [{}, {"positives": 2, "negatives": 9, "near": 50}])
def test_equals_brute_force(spark, monkeypatch, how):
    """A tree of several levels, and blocks of few rows and anchors."""
    for name, value in {"LEAF_SAMPLE": 8, "SPLIT_POINTS": 4, "BLOCK_ROWS": 10, "BLOCK_ANCHORS": 7, "CELLS": 50}.items():
        monkeypatch.setattr(hn, name, value)
    rows = clouds(400, 5)
    got = mined(spark, rows, **how)
    assert got == slow(rows, lambda i: i % 10 == 0, **how) and got


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [1.0, 2.0], 2), (3, [1.0, 1.9], 2), (4, [1.0, 2.0], None)]
    rows += [(5, None, 1), (6, [nan, 1.0], 2), (7, [inf, 1.0], 2), (8, [None, 1.0], 2), (None, [1.0, 2.0], 2), (10, [], 3)]
    rows += [(20, [-1.0], 3), (21, [1.0, 0.5, 9.0], 3), (30, [0.0, 0.0], 4), (31, [5.0, 5.0], 4), (32, [7.0], 5)]
    rows += [(40, [9.0, 1.0], 6), (40, [9.0, 0.5], 6)] + [(100 + i, [1.0, 2.0], 2) for i in range(20)]
    want = slow(rows, lambda i: i % 10 == 0)
    assert mined(spark, rows) == want and want
    clash = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("id", "v", "leaf", "anchor", "score")})
    assert sorted(map(tuple, hn.mine_negatives(clash, F.col("id") % 10 == 0).collect())) == want
    assert mined(spark, []) == []
    assert mined(spark, [(i, [1.0], 1) for i in range(20)]) == []


def test_subtrees_left_out_hold_no_row():
    own = np.random.default_rng(4)
    points = own.normal(size=(1500, 4)) + own.integers(0, 4, (1500, 1)) * 5
    tree = hn.Tree(points[:400])
    leaf, ranges = tree.place_rows(points)
    tree.set_ranges(ranges)
    anchors = own.normal(size=(60, 4)) + own.integers(0, 4, (60, 1)) * 5
    inner = own.random(60) * 3
    outer = inner + 0.5
    met = {(int(a), n) for at, n in tree.leaves_met(anchors, inner, outer) for a in at}
    apart = hn.distances(anchors, points)
    inside = (apart >= inner[:, None]) & (apart <= outer[:, None])
    assert {(int(a), int(leaf[b])) for a, b in zip(*np.nonzero(inside))} <= met
    # and some are left out
    assert len(met) < 0.6 * 60 * tree.leaves


def test_large_components_stay_exact():
    big = np.array([[2**30, 2**30 + 1], [3, -(2**31)]], np.int64)
    want = [[sum(int(x) * int(y) for x, y in zip(a, b)) for b in big] for a in big]
    assert hn.products(big, big).tolist() == want
