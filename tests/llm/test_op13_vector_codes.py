import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from tallyhouse.llm import op13_vector_codes as op
from tallyhouse.llm.op13_vector_codes import product_codes

SCHEMA = "vec_id long, embedding array<float>, label string, code int, error string"


def brute(rows, entries=256, rounds=4):
    """Every distance measured, in Python whole numbers."""
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], g) for i, v, g in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = -(-max(len(v) for _, v, _ in kept) // 4)
    kept = [(i, v + [0] * (4 * width - len(v)), g) for i, v, g in kept]
    cut = lambda v, p: tuple(v[p * width : (p + 1) * width])
    first = sorted((i, v) for i, v, _ in kept if i is not None)[:entries]
    books = [[cut(v, p) for _, v in first] for p in range(4)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            held = {}
            for _, v, _ in kept:
                held.setdefault(nearest(cut(v, p), books[p])[1], []).append(cut(v, p))
            for j, xs in held.items():
                books[p][j] = tuple(sum(c) // len(xs) for c in zip(*xs, strict=True))
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    coded, errors = [], Counter()
    for i, v, g in kept:
        near = [nearest(cut(v, p), books[p]) for p in range(4)]
        coded.append((i, "".join(f"{j:02x}" for _, j in near), sum(d for d, _ in near), g))
        errors[g] += coded[-1][2]
    return sorted(((i, c, e, errors[g], digest) for i, c, e, g in coded), key=str)


def made(seed, n, width, spread=1.0):
    r = random.Random(seed)
    centres = [[r.gauss(0, spread) for _ in range(width)] for _ in range(9)]
    rows = [(i * 3 - 5, [c + r.gauss(0, 0.2) for c in r.choice(centres)], r.choice(["a", "b", None])) for i in range(n)]
    return rows + [(4, rows[3][1], "a"), rows[7], rows[7], (None, rows[5][1], "b")]


def got(spark, rows, **more):
    table = spark.createDataFrame([(*row, 1, "x") for row in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, product_codes(table, **more).collect()), key=str)


@pytest.mark.parametrize(("n", "entries"), [(300, 70), (40, 256), (500, 256)])
def test_equals_all_distances(spark, n, entries):
    rows = made(n, n, 8)
    r = random.Random(1)
    r.shuffle(rows)
    assert got(spark, rows, entries=entries) == brute(rows, entries)


def test_bad_vectors_and_ties(spark):
    rows = [(1, None, "a"), (2, [1.0, None, 0.0, 0.0], "a"), (3, [float("nan")] * 4, "b"), (4, [float("inf"), 0.0, 0.0, 0.0], None)]
    rows += [(i, [float(i % 2), 0.0, -0.5, 0.25], None) for i in range(10, 20)] + [(30, [], "a"), (31, [0.5], "a"), (32, [1e-9, -1e-9] * 3, "c")]
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows[:4]) == [] and got(spark, []) == []


def test_too_large(spark):
    with pytest.raises(ValueError, match="too large"):
        got(spark, [(1, [1e9, 0.0, 0.0, 0.0], "a")])
    rows = made(5, 60, 4, spread=2000.0)  # whole numbers past what doubles add up exactly
    assert got(spark, rows, entries=40) == brute(rows, 40)


def test_bounds_skip_and_never_change_the_answer():
    """Round by round against all distances; net moves skip at least as much as added-up drifts would."""
    r = np.random.default_rng(3)
    centres = r.integers(-2000, 2000, (64, 6))
    x = centres[r.integers(0, 64, 3000)] + r.integers(-90, 90, (3000, 6))
    history = [np.repeat(x[None, :128], op.PARTS, axis=0)]
    groups = 128 // op.GROUP
    code, bounds, stamps = None, np.zeros((len(x), groups)), np.zeros((len(x), groups), np.uint8)
    measured = []
    for t in range(6):
        moves = op.net_moves(history)[0]
        if t > 1:
            drifts = sum(op.net_moves(history[k - 1 : k + 1])[0][0] for k in range(1, t + 1))
            assert (moves[0] <= drifts + 1e-6).all() and (moves[0] < drifts - 1e-3).any()
        code, best, asked = op.assign(x.astype(float), history[-1][0].astype(float), moves, code, bounds, stamps)
        measured.append(asked)
        d = ((x[:, None, :] - history[-1][0][None]) ** 2).sum(axis=2)
        assert (code == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
        book = history[-1].copy()
        for j in range(128):
            if (code == j).any():
                book[:, j] = x[code == j].sum(axis=0) // (code == j).sum()
        history.append(book)
    assert measured[0] == len(x) * groups and measured[-1] < 0.6 * measured[0]
