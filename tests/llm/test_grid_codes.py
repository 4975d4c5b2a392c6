from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from reviewmill.llm import grid_codes as gc

SCHEMA = "vec_id long, label int, embedding array<double>, code string, digest long, copies int"


def _brute(rows):
    """Plain loops over Python integers."""
    kept = [r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    longest = max((len(r[2]) for r in kept), default=0)
    size = -(-longest // 8) * 8
    vectors = []
    for r in kept:
        x = [math.floor(4096 * min(max(v, -8192.0), 8192.0)) for v in r[2]]
        vectors.append(x + [0] * (size - len(x)))
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, vectors[i]))
    width = size // 8
    cut = [[x[p * width : (p + 1) * width] for p in range(8)] for x in vectors]
    books = [[list(cut[i][p]) for i in order[:16]] for p in range(8)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(6):
        fresh = []
        for p in range(8):
            chosen = [nearest(p, c[p])[1] for c in cut]
            entries = []
            for k, old in enumerate(books[p]):
                own = [c[p] for c, e in zip(cut, chosen, strict=True) if e == k]
                entries.append([sum(v) // len(own) for v in zip(*own, strict=True)] if own else old)
            fresh.append(entries)
        books = fresh
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    found = []
    for r, c in zip(kept, cut, strict=True):
        best = [nearest(p, c[p]) for p in range(8)]
        found.append((r[0], "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), r[1]))
    totals = {}
    for _, _, error, label in found:
        totals[label] = totals.get(label, 0) + error
    return sorted(((i, c, e, totals[l], digest) for i, c, e, l in found), key=str)


def _got(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in gc.compressed(frame).collect()), key=str)


def test_equals_plain_loops(spark):
    draw = np.random.default_rng(3)
    rows = [(i, int(draw.integers(3)) or None, (draw.standard_normal(24) / 8).tolist()) for i in range(90)]
    rows += [(200 + i, 1, rows[i % 5][2]) for i in range(20)] + [rows[0], rows[0]]
    assert _got(spark, rows) == _brute(rows)


def test_odd_rows(spark):
    draw = np.random.default_rng(4)
    rows = [(i, 0, draw.standard_normal(16).tolist()) for i in range(20)]
    rows += [
        (30, 0, None),
        (31, 0, [None] + [0.0] * 15),
        (32, 0, [float("nan")] * 16),
        (33, 0, [float("inf")] * 16),
        (34, None, []),
        (35, None, [1.5, -2.5]),
        (36, 2, [1e300, -1e300] * 8),
        (None, 2, [0.25] * 16),
        (37, 2, [0.5] * 13),
    ]
    assert _got(spark, rows) == _brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, 1, None)], [(5, None, [])], [(5, 1, [0.1] * 3), (4, 1, [0.2])]])
def test_few_rows(spark, rows):
    assert _got(spark, rows) == _brute(rows)


@pytest.mark.parametrize("side", [1, 7, 64, 1024])
def test_cells_leave_out_no_nearest_entry(side):
    draw = np.random.default_rng(side)
    entries = draw.integers(-300, 300, (16, 4))
    entries[9] = entries[2]
    points = draw.integers(-400, 400, (3_000, 4))
    cells = gc.Cells(entries, side)
    index, far = cells.nearest(points)
    every = ((points[:, None] - entries) ** 2).sum(2)
    assert (index == every.argmin(1)).all() and (far == every.min(1)).all()
    evaluated, known = cells.evaluated, len(cells.known)
    again = cells.nearest(points)
    assert (again[0] == index).all() and len(cells.known) == known
    assert cells.evaluated == 2 * evaluated
    if side <= 64:
        assert evaluated < len(points) * 16 * 0.7


def test_cache_is_emptied(monkeypatch):
    monkeypatch.setattr(gc, "MOST_CELLS", 50)
    draw = np.random.default_rng(1)
    entries, points = draw.integers(-99, 99, (16, 3)), draw.integers(-99, 99, (400, 3))
    cells = gc.Cells(entries, 64)
    for a in range(0, 400, 20):
        index, _ = cells.nearest(points[a : a + 20])
        assert (index == ((points[a : a + 20, None] - entries) ** 2).sum(2).argmin(1)).all()
        assert len(cells.known) <= 50
