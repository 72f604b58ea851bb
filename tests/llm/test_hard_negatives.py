"""Hard negatives against a plain double loop."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import hard_negatives as hn

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def table(spark, rows):
    """Rows of (vec_id, embedding, label), with columns of names that the steps use, too."""
    full = [(*row, "x", "x", "x", "x") for row in rows]
    return spark.createDataFrame(
        full, "vec_id long, embedding array<double>, label int, score string, block string, opened string, dim string"
    )


def brute(rows, is_anchor=lambda i: True):
    """The first of rows that share an id counts (the smallest label, then vector)."""
    best = {}
    for i, x, label in rows:
        if i is None or x is None or label is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        v = [math.floor(256 * c) for c in x]
        best[i] = min(best.get(i, (label, v)), (label, v))
    out = []
    for a, (label, v) in best.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w)), b, m) for b, (m, w) in best.items() if b != a and len(w) == len(v))
        for score, p, _ in [s for s in scored if s[2] == label][:5]:
            inside = [s for s in scored if s[2] != label and 80 * -score <= 100 * -s[0] <= 100 * -score]
            out += [(a, p, n + 1, q, -score, -other) for n, (other, q, _) in enumerate(inside[:5])]
    return sorted(out)


def made(seed, n, labels=3, size=4, grid=None):
    rng = random.Random(seed)
    draw = (lambda: rng.choice(grid)) if grid else (lambda: rng.gauss(0.4, 0.5))
    return [(i - n // 3, [draw() for _ in range(size)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("grid", [None, [0.0, 0.25, 0.5]])  # the second one is full of ties and copies
def test_equals_double_loop(spark, rows, grid):
    data = made(1, 150, grid=grid)
    found = hn.mine(table(spark, data), rows_a_block=40, anchors_a_block=16)
    assert rows(found, *COLUMNS) == sorted(brute(data), key=repr)


def test_anchors_and_labels(spark, rows):
    data = made(2, 120)
    found = hn.mine(table(spark, data), F.col("vec_id") % 10 == 0, F.when(F.col("vec_id") % 7 == 0, 0).otherwise(F.col("label")))
    moved = [(i, x, 0 if i % 7 == 0 else label) for i, x, label in data]
    assert rows(found, *COLUMNS) == sorted(brute(moved, lambda i: i % 10 == 0), key=repr)


def test_unusable_repeated_and_hot_rows(spark, rows):
    nan, inf = float("nan"), float("inf")
    odd = [
        (None, [1.0, 0.0], 0), (900, None, 0), (901, [1.0, None], 0), (902, [nan, 1.0], 1), (903, [1.0, inf], 1),
        (904, [1.0, 1.0], None), (905, [], 0), (906, [], 1), (907, [0.5], 0), (908, [0.25], 1), (909, [0.5], 0),
        (5, [0.9, 0.1], 1), (5, [0.9, 0.1], 1), (5, [0.1, 0.9], 0), (910, [-1.0, -1.0], 0), (911, [1e30, -1e30], 0),
    ]
    hot = [(i, [0.5, 0.5], 2) for i in range(1000, 1060)]  # a third of all rows are one vector
    data = odd[:-1] + made(3, 80, size=2) + hot
    assert rows(hn.mine(table(spark, data), rows_a_block=32), *COLUMNS) == sorted(brute(data), key=repr)
    assert hn.mine(table(spark, [odd[-1], (1, [1.0, 1.0], 0), (2, [1.0, 1.0], 1)])).count() >= 0  # limited, no overflow


def test_empty_and_single(spark):
    assert hn.mine(table(spark, [])).count() == 0
    assert hn.mine(table(spark, [(1, [1.0], 0)])).count() == 0


def test_keys_sort_as_stated():
    rng = random.Random(4)
    draws = [(rng.randrange(-3, 3), rng.randrange(-(1 << 40), 1 << 40), rng.random() < 0.5, rng.randrange(-9, 9)) for _ in range(500)]
    wanted = sorted(draws, key=lambda d: (d[0], -d[1], d[2], d[3]))
    assert [hn.unpack_key(k) for k in sorted(hn.pack_key(*d) for d in draws)] == wanted


def test_products_are_exact_at_any_size():
    a = np.array([[1 << 26, -(1 << 26)], [3, 5]])
    assert hn.products(a, a).tolist() == [[1 << 53, (3 << 26) - (5 << 26)], [(3 << 26) - (5 << 26), 34]]
