"""Hard negatives against brute force, bounds that lose nothing, and edge cases."""

from __future__ import annotations

import numpy as np
import pytest

from triagegrid.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, score string, row int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, "s", 0) for i, v, y in rows], SCHEMA)


def brute(rows, positives=5, negatives=5, every=100, share=80):
    kept = [
        (i, (y + 1) % 10 if i % 7 == 0 else y, np.floor(256 * np.array(v, float)).astype(np.int64))
        for i, v, y in rows
        if i is not None and y is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all()
    ]
    out = []
    for n, (i, y, v) in enumerate(kept):
        if i % every:
            continue
        scored = sorted((-int(w @ v), j, z) for m, (j, z, w) in enumerate(kept) if m != n and len(w) == len(v))
        for p, pid, _ in [s for s in scored if s[2] == y][:positives]:
            hard = [s for s in scored if s[2] != y and -share * p <= -100 * s[0] <= -100 * p][:negatives]
            out += [(i, pid, k, j, -p, -s) for k, (s, j, _) in enumerate(hard, 1)]
    return sorted(out)


def got(spark, rows, **options):
    return sorted(tuple(r) for r in hard_negatives.mine(frame(spark, rows), **options).collect())


def vectors(n, seed=0, dim=6):
    random = np.random.default_rng(seed)
    centres = random.normal(0, 1, (5, dim))
    return [(i, (centres[i % 5] + random.normal(0, 0.5, dim)).tolist(), int(random.integers(0, 4))) for i in range(n)]


def test_equal_to_brute_force_over_many_blocks(spark, monkeypatch):
    rows = vectors(700)
    monkeypatch.setattr(hard_negatives, "BLOCK", 90)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", 9)
    monkeypatch.setattr(hard_negatives, "SAMPLE", 60)
    want = brute(rows, every=20)
    assert len(want) > 300 and got(spark, rows, every=20) == want


def test_odd_rows(spark):
    rows = vectors(120, 3)
    rows += [(200, None, 1), (300, [float("nan")] * 6, 1), (400, [None] * 6, 1), (500, [0.5] * 6, None), (None, [0.5] * 6, 1), (600, [1.0, 2.0], 3), (601, [1.0, 1.5], 3), (603, [1.0, 1.4], 2), (700, [0.0] * 6, 2), (800, [float("inf")] * 6, 2)]
    rows += [rows[0], rows[0], rows[5], (5, rows[6][1], 1), (900, [-1.0] * 6, 9), (901, [1.0] * 6, 9)]
    want = brute(rows)
    assert got(spark, rows) == want and {r[0] for r in want} >= {0, 600, 700}
    assert got(spark, []) == [] and got(spark, rows[120:125]) == [] and got(spark, [rows[0]]) == []


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, [1.0, 0.5], 3) for i in (100, 1, 2, 3)] + [(i, [1.0, 0.5], 4) for i in range(8, 40)]
    want = brute(rows)
    assert [r[3] for r in want if r[1] == 1] == [8, 9, 10, 11, 12] and got(spark, rows) == want


@pytest.mark.parametrize("size", [1, 40, 10_000_000])
def test_bounds_hold_every_score(size):
    random = np.random.default_rng(size)
    x = random.integers(-size, size + 1, (300, 7))
    x[0] = 0
    x[1] = x[2]
    x[3] = -x[4]
    references = hard_negatives.spread_directions(x[:100], 8)
    far, length = hard_negatives.angles(x, references), hard_negatives.unit(x)[1]
    low, high = hard_negatives.pair_bounds(far, length, far, length)
    scores = x @ x.T
    assert (low <= scores).all() and (scores <= high).all()
    assert (np.diag(high) - np.diag(scores) <= 2 + 2e-6 * length**2).all()
