from __future__ import annotations

import tracemalloc

import numpy as np
import pandas as pd

from reviewmill.llm import rotation_codes as rc

SCHEMA = "vec_id long, label int, embedding array<float>, links long"


def _brute(rows):
    good = {
        i: np.array(e, float)
        for i, l, e, _ in rows
        if i is not None and l is not None and e is not None and None not in e and np.isfinite(e).all() and np.any(e)
    }
    labels = {i: l for i, l, _, _ in rows}
    near = {i: set() for i, *_ in rows}
    ids = sorted(good)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = good[i], good[j]
            if labels[i] == labels[j] and len(a) == len(b) and a @ b >= 0.98 * np.sqrt((a @ a) * (b @ b)):
                near[i].add(j)
                near[j].add(i)
    reach = {}
    for i in sorted(near, key=lambda x: (x is None, x)):
        if i in reach:
            continue
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in reach:
                reach[x] = i
                todo += near[x]
    return {i: (len(near[i]), reach[i], reach[i] == i) for i in near}


def _got(spark, rows):
    found = rc.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found}


def _rows(count, seed):
    draw = np.random.default_rng(seed)
    rows, size = [], 32
    for i in range(count):
        if rows and draw.random() < 0.5:
            base = np.array(rows[draw.integers(len(rows))][2])
            vector = base + draw.standard_normal(size) * draw.choice([0, 0.02, 0.12, 0.2]) * np.linalg.norm(base) / size**0.5
        else:
            vector = draw.standard_normal(size)
        rows.append((7 * i, int(draw.integers(2)), vector.astype(np.float32).tolist(), 0))
    return rows


def test_against_brute_force(spark, monkeypatch):
    rows = _rows(700, 1)
    assert _got(spark, rows) == _brute(rows)


def test_estimate_is_unbiased_and_bounds_hold():
    draw = np.random.default_rng(3)
    unit = rc.units(list(draw.standard_normal((400, 64))))
    near = rc.units(list(unit + 0.2 * draw.standard_normal((400, 64)) / 8))
    codes, factors = rc.encode(unit)
    turned = near @ rc.rotation(64, 0).T
    estimate = ((np.where(codes, 1, -1) / 8) * turned).sum(1) / factors
    exact = (unit * near).sum(1)
    assert abs((estimate - exact).mean()) < 0.01
    passed = rc.candidates(codes, factors, near)
    links = unit @ near.T >= rc.COSINE
    assert (passed | ~links).all()
    assert passed.mean() < 0.05


def test_bands_find_pairs_at_the_threshold():
    draw = np.random.default_rng(9)
    unit = rc.units(list(draw.standard_normal((3_000, 48))))
    aside = draw.standard_normal((3_000, 48))
    aside -= (aside * unit).sum(1, keepdims=True) * unit
    aside = rc.units(list(aside))
    pair = rc.COSINE * unit + (1 - rc.COSINE**2) ** 0.5 * aside
    for rows in (100, 10_000, 10_000_000):
        bits, bands = rc.bits_for(rows)
        shared = (rc.band_keys(unit, bits, bands) == rc.band_keys(pair, bits, bands)).any(axis=1)
        assert shared.mean() >= 0.999, rows


def test_tiles_cover_every_pair_once(spark, monkeypatch):
    draw = np.random.default_rng(5)
    base = draw.standard_normal(16)
    rows = [(i, 1, (base + 0.03 * draw.standard_normal(16)).astype(np.float32).tolist(), 0) for i in range(120)]
    want = _brute(rows)
    monkeypatch.setattr(rc, "TILE_ROWS", 25)
    assert _got(spark, rows) == want


def test_odd_rows(spark):
    rows = [(1, 1, None, 0), (2, 1, [0.0, 0.0], 0), (3, 1, [1.0, None], 0), (4, 1, [float("nan"), 1.0], 0), (5, 1, [float("inf"), 1.0], 0)]
    rows += [(6, None, [1.0, 1.0], 0), (7, 1, [1.0, 1.0], 0), (8, 1, [2.0, 2.0], 0), (9, 1, [1.0, 1.0], 0), (10, 2, [1.0, 1.0], 0)]
    rows += [(11, 1, [1.0, 1.0, 1.0], 0), (12, 1, [3e38, 3e38], 0), (13, 1, [], 0), (14, 1, [1e-40, 1e-40], 0)]
    assert _got(spark, rows) == _brute(rows)
    twice = spark.createDataFrame([(1, 1, [1.0, 2.0], 0)] * 2 + [(None, 1, [1.0, 2.0], 0)], SCHEMA)
    got = sorted(map(str, rc.near_duplicates(twice).collect()))
    assert len(got) == 3 and "n_links=1" in got[0] and "n_links=0" in got[2]
    assert rc.near_duplicates(twice.limit(0)).count() == 0


def test_one_id_with_two_vectors(spark):
    rows = [(5, 1, [1.0, 0.0], 0), (5, 1, [0.0, 1.0], 0), (3, 1, [0.0, 1.01], 0), (9, 1, [1.0, 0.01], 0)]
    found = rc.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found)
    assert got == [(3, 1, 3, True), (5, 1, 3, False), (5, 1, 5, True), (9, 1, 5, False)]


def test_a_tile_of_near_copies_stays_small():
    draw, count, size = np.random.default_rng(2), 4_000, 384
    vectors = draw.standard_normal(size) + 0.02 * draw.standard_normal((count, size))
    unit = rc.units(list(vectors))
    codes, factors = rc.encode(unit)
    rows = pd.DataFrame(
        {
            "rep": np.arange(count),
            "copies": 1,
            "embedding": list(vectors),
            "code": [c.tobytes() for c in np.packbits(codes, axis=1)],
            "factor": factors,
            "keys": list(np.zeros((count, 1), np.int64)),
            "block": np.arange(count) % 2,
        }
    )
    tracemalloc.start()
    found = rc._tile(("g", 0, 0, 0, 1), rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500e6
    assert (found.loc[found["links"] > 0, "links"] == count // 2).all()
    assert (found["links"] == 0).sum() == count - 1
