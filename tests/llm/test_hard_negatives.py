from __future__ import annotations

import math
import random

import numpy as np
import pytest

from plumbline.llm import hard_negatives as H

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows, every, positives=5, negatives=3, window=(50, 95)):
    clean = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        clean[i, label, tuple(math.floor(256 * x) for x in v)] = None
    out = set()
    for a, la, va in clean:
        if a % every:
            continue
        scores = {(b, lb, sum(x * y for x, y in zip(va, vb, strict=True))) for b, lb, vb in clean if b != a}
        best = lambda some, n: sorted({(-s, b) for b, _, s in some})[:n]
        for p, i in best([x for x in scores if x[1] == la], positives):
            near = [x for x in scores if x[1] != la and window[0] * -p <= 100 * x[2] <= window[1] * -p]
            out |= {(a, i, rank, j, -p, -s) for rank, (s, j) in enumerate(best(near, negatives), 1)}
    return out


def mined(spark, rows, every, **more):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "label slot", "vec_id anchor", "'x' vec", "1 cluster")
    found = [
        tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
        for r in H.hard_negatives(df, every=every, **more).collect()
    ]
    assert len(found) == len(set(found))
    return set(found)


def table(seed, n, dim=6):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(5)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        rows.append((i, [x + rng.gauss(0, 0.4) for x in c], rng.randrange(3)))
    common = [0.5] * dim  # a third has one vector: all scores of these rows tie
    rows += [(1000 + i, common, rng.randrange(3)) for i in range(n // 2)]
    rows += [(2000, [0.0] * dim, 1), (2001, [0.0] * dim, 1), (2002, [0.0] * dim, 2), (2010, [-x for x in common], 2)]
    bad = [(None, common, 1), (5000, None, 1), (5010, common, None), (5020, [math.nan] * dim, 1), (5030, [math.inf] * dim, 1)]
    bad += [(5040, [None] * dim, 1), (5050, [], 1), (5060, [1.0], 1)]
    return rows, [*rows, *rows[:9], *bad]


@pytest.mark.parametrize(
    ("seed", "block", "step", "more"),
    [(1, 40, 4, {"portion": 16, "cluster_size": 3}), (2, 32768, 512, {}), (3, 100, 7, {"fitted": 2, "cluster_size": 1})],
)
def test_equals_brute_force(spark, monkeypatch, seed, block, step, more):
    """Small blocks, steps and portions; ties, repeated rows, and rows that take no part."""
    monkeypatch.setattr(H, "BLOCK", block)
    monkeypatch.setattr(H, "STEP", step)
    monkeypatch.setattr(H, "SHARE", 4)
    good, rows = table(seed, 160)
    expected = brute(good, 10)
    assert len(expected) > 100
    assert mined(spark, rows, 10, **more) == expected


def test_few_rows_and_empty_table(spark):
    assert mined(spark, [], 50) == set()
    assert mined(spark, [(0, [1.0, 2.0], 1)], 50) == set()
    rows = [(50, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, [0.6, 0.5], 2), (3, [1.0, 0.0], 2), (50, [1.0, 0.0], 2)]
    assert mined(spark, rows[:4], 50) == brute(rows[:4], 50) == {(50, 1, 1, 2, 58880, 39168)}
    assert mined(spark, rows, 50) == brute(rows, 50)  # one id with two labels


def test_scores_beyond_doubles_are_exact():
    a = np.array([[2.0**40, 1.0], [2.0**70, -3.0]])
    assert H.products(a, np.array([[2.0**20, 1.0]])).tolist() == [[2**60 + 1], [2**63 - 1]]
    assert H.products(-a, a[1:]).tolist()[1] == [-(2**63)]


def test_a_walk_ends_before_the_list_does():
    """What the bound rules out is not looked at."""
    rng = np.random.default_rng(3)
    rows = np.floor(256 * np.concatenate([rng.normal(0, 0.05, (50, 8)) + 1, rng.normal(0, 0.05, (5000, 8)) - 1]))
    look = H.Slots(np.arange(1), np.arange(1), np.full(1, H._LOW), np.full(1, H._HIGH))
    anchors = {"vec_id": np.array([9999]), "label": np.array([0]), "cluster": np.array([0]), "angle": np.array([0.0]), "vectors": rows[:1]}
    portion = H.Portion(anchors, H.directions(rows[:1]), look, True, 5)
    met = []
    whole = H.Portion._meet
    portion._meet = lambda best, active, ids, *x: (met.append(len(ids)), whole(portion, best, active, ids, *x))
    best = H.Best(look, 5)
    portion.search(best, np.arange(len(rows)), np.zeros(len(rows), np.int64), rows)
    score = (rows @ rows[0]).astype(int)
    assert sum(met) == H.STEP
    assert best.other.tolist() == sorted(range(len(rows)), key=lambda i: (-score[i], i))[:5]
