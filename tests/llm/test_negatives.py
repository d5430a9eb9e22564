"""Hard negatives against brute force over all pairs."""

import math
import random

import numpy as np
import pytest

from vaultscope.llm import negatives
from vaultscope.llm.negatives import hard_negatives, indexed, reaching

SCHEMA = "vec_id long, embedding array<double>, label int, id long, v string, goals int"


def brute(rows, asked, positives=5, count=5, low=80):
    kept = {}
    for k, v, label in rows:
        if k is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        own = (label, [math.floor(256 * x) for x in v])
        kept[k] = min(kept.get(k, own), own)
    out = []
    for a in {x for x in asked if x in kept}:
        label, v = kept[a]
        score = {k: sum(x * y for x, y in zip(v, w)) for k, (_, w) in kept.items() if k != a}
        near = sorted(score, key=lambda k: (-score[k], k))
        for p in [k for k in near if kept[k][0] == label][:positives]:
            window = [k for k in near if kept[k][0] != label and low * score[p] <= 100 * score[k] <= 100 * score[p]]
            out += [(a, p, r + 1, k, score[p], score[k]) for r, k in enumerate(window[:count])]
    return sorted(out)


def got(spark, rows, asked, **kw):
    df = spark.createDataFrame([(k, v, label, 1, "x", 2) for k, v, label in rows], SCHEMA)
    anchors = spark.createDataFrame([(k,) for k in asked], "vec_id long")
    return sorted(map(tuple, hard_negatives(df, anchors, **kw).collect()))


def cloud(rng, n, width, labels):
    middle = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    return [(k, [c + rng.gauss(0, 0.4) for c in rng.choice(middle)], rng.choice(labels)) for k in range(n)]


def test_threshold_pairs_against_all_pairs():
    rng = np.random.default_rng(1)
    for width in (1, 7, 8, 30):
        strong = 2.0 ** -np.arange(width)
        x, y = (np.round(rng.normal(size=(n, width)) * strong * 500).astype(np.int32) for n in (40, 300))
        x[3] = 0
        y[5] = 0
        exact = x.astype(int) @ y.astype(int).T
        for share in (0.5, 0.9, 0.99, 1):
            limit = np.quantile(exact, share, axis=1).astype(np.int64)
            parts = list(reaching(x, limit, indexed(y)))
            have = {(int(a), int(b), int(s)) for p in parts for a, b, s in zip(*p)}
            assert have == {(a, b, int(exact[a, b])) for a, b in zip(*np.nonzero(exact >= limit[:, None]))}
            assert sum(len(p[0]) for p in parts) == len(have)


@pytest.mark.parametrize("labels", [[0, 1, 2], list(range(40)), [1] * 20 + [2]])
def test_clouds(spark, labels):
    rows = cloud(random.Random(len(labels)), 400, 12, labels)
    asked = list(range(0, 400, 10))
    want = brute(rows, asked)
    assert got(spark, rows, asked) == want and want


def test_many_blocks_and_rounds(spark, monkeypatch):
    """Small blocks, and first guesses that find too little: thresholds have to come down."""
    monkeypatch.setattr(negatives, "ROWS", (64, 64))
    monkeypatch.setattr(negatives, "ANCHORS", 10)
    monkeypatch.setattr(negatives, "WANT", 1)
    rows = cloud(random.Random(8), 300, 6, [0, 1, 2, 3])
    assert got(spark, rows, range(0, 300, 7)) == brute(rows, range(0, 300, 7))
    assert got(spark, rows, range(0, 300, 7), positives=2, negatives=9, low=30) == brute(rows, range(0, 300, 7), 2, 9, 30)


def test_hot_vector_and_ties(spark, monkeypatch):
    """A third of all rows with one vector, half of them with one label: ties go to smaller ids."""
    monkeypatch.setattr(negatives, "ROWS", (100, 100))
    rng = random.Random(3)
    rows = cloud(rng, 400, 8, [0, 1, 2])
    rows += [(1000 + k, [0.5] * 8, rng.choice([0, 0, 1])) for k in range(200)]
    asked = [*range(0, 400, 40), *range(1000, 1200, 20)]
    assert got(spark, rows, asked) == brute(rows, asked)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(None, [1.0, 2.0], 0), (0, [1.0, 0.5], 0), (1, None, 0), (2, [1.0, None], 0), (3, [nan, 1.0], 0), (4, [inf, 1.0], 1),
            (5, [1.0, 0.4], None), (6, [0.9, 0.5], 0), (6, [0.9, 0.5], 0), (6, [0.1, 0.5], 3), (7, [], 0), (8, [0.0, 0.0], 1), (9, [1.0], 1),
            (10, [0.95, 0.5], 1), (11, [-1.0, -1.0], 0), (12, [0.8, 0.5], 2), (13, [], 1)]
    asked = [0, 1, 3, 7, 8, 9, 11, 99]
    assert got(spark, rows, asked) == brute(rows, asked) != []
    assert got(spark, rows[:1], asked) == got(spark, [], asked) == got(spark, rows, []) == []
    with pytest.raises(Exception, match="too large"):
        got(spark, [(0, [1e300], 1), (1, [1.0], 1)], [0])
