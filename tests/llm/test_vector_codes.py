"""Codes by adaptive bounds against assignments that look at every entry."""

import hashlib
import math
import random

import numpy as np
import pytest

from tradewind.llm import vector_codes as vc

COLUMNS = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def table(spark, rows):
    full = [(*row, "x", "x", "x") for row in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<double>, label int, code string, v string, error string")


def brute(rows, parts=16, entries=64, rounds=2):
    kept = [
        (i, [math.floor(256 * c) for c in x], label)
        for i, x, label in rows if x is not None and all(c is not None and math.isfinite(c) for c in x)
    ]
    first = sorted((i, v) for i, v, _ in kept if i is not None)[:entries]
    length = len(first[0][1]) if first else 0
    if not length or length % parts:
        empty = hashlib.sha256(b"").hexdigest()
        return [(i, None, None, None, empty) for i, _, _ in kept]
    w = length // parts
    books = [[v[p * w : (p + 1) * w] for _, v in first if len(v) == length] for p in range(parts)]
    fit = [(i, v, label) for i, v, label in kept if len(v) == length]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(books[p]))

    for turn in range(rounds + 1):
        found = [[nearest(p, v[p * w : (p + 1) * w]) for p in range(parts)] for _, v, _ in fit]
        if turn == rounds:
            break
        for p in range(parts):
            for n in range(len(books[p])):
                mine = [v[p * w : (p + 1) * w] for f, (_, v, _) in zip(found, fit) if f[p][1] == n]
                if mine:
                    books[p][n] = [sum(c) // len(mine) for c in zip(*mine)]
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, label), error in zip(fit, errors):
        by_label[label] = by_label.get(label, 0) + error
    out = [(i, "".join(f"{n:02x}" for _, n in f), e, by_label[label], digest) for (i, _, label), f, e in zip(fit, found, errors)]
    return out + [(i, None, None, by_label.get(label), digest) for i, v, label in kept if len(v) != length]


@pytest.mark.parametrize("draw", [lambda r: r.gauss(0, 0.4), lambda r: r.choice([0.0, 0.004, 0.008])])
def test_equals_full_assignments(spark, rows, draw):
    """The second draw has few values, so nearly every distance is tied."""
    rng = random.Random(5)
    data = [(i * 3 - 50, [draw(rng) for _ in range(32)], rng.choice([0, 1, None])) for i in range(300)]
    assert rows(vc.code_report(table(spark, data)), *COLUMNS) == sorted(brute(data), key=repr)


def test_odd_rows(spark, rows):
    nan, inf, rng = float("nan"), float("inf"), random.Random(6)
    good = [(i, [rng.random() for _ in range(16)], 1) for i in range(20)]
    odd = [
        (None, [0.5] * 16, None), (100, None, 1), (101, [nan] * 16, 1), (102, [inf] * 16, 1), (103, [None] * 16, 1),
        (104, [0.1] * 8, 1), (105, [], 7), (7, [0.3] * 16, 2), (7, [0.3] * 16, 2),
    ]
    assert rows(vc.code_report(table(spark, good + odd)), *COLUMNS) == sorted(brute(good + odd), key=repr)


def test_fewer_rows_than_entries_and_hot_vectors(spark, rows):
    one = [(1, [0.25] * 16, 3)]
    assert rows(vc.code_report(table(spark, one)), *COLUMNS) == sorted(brute(one), key=repr)
    hot = [(i, [0.25] * 16 if i % 3 else [i / 90] * 16, 3) for i in range(90)]
    assert rows(vc.code_report(table(spark, hot)), *COLUMNS) == sorted(brute(hot), key=repr)


def test_length_that_is_no_multiple_and_empty(spark, rows):
    data = [(1, [0.5] * 5, 1), (2, [0.5] * 16, 1)]
    assert rows(vc.code_report(table(spark, data)), *COLUMNS) == sorted(brute(data), key=repr)
    assert vc.code_report(table(spark, [])).count() == 0


@pytest.mark.parametrize("scale", [3, 1000, 1 << 25])
@pytest.mark.parametrize("b", [1, 4, 30])
def test_moves_never_miss(scale, b):
    """Codes after moves of every size are those of a full look, whatever ``b``."""
    rng = np.random.default_rng(b)
    x, old = rng.integers(-scale, scale, (400, 3)), rng.integers(-scale, scale, (24, 3))
    state = vc.State.full(x, old, b)
    for step in (1, scale // 9 + 1, scale):
        new = np.clip(old + rng.integers(-step, step + 1, old.shape), -scale, scale)
        depth = state.moved(x, old, new)
        assert (state.code == vc.squares(x, new).argmin(axis=1)).all()
        assert depth.max() <= state.near.shape[1] + 1
        old = new
        state = state.cut(max(1, b // 2))


def test_width_adapts():
    assert vc.next_width({0: 9000, 1: 990, 12: 10}, 16, 64) == 8  # an eighth at least
    assert vc.next_width({0: 900, 12: 100}, 16, 64) == 12
    assert vc.next_width({0: 900, 17: 100}, 16, 64) == 8  # beyond the outer bound more bounds would not tell
