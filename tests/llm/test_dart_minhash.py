from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from reviewmill.llm import dart_minhash as dm


def _runs(text):
    words = (text or "").encode().split()
    n = min(5, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else Counter()


def _classes(rows, similarity=0.8):
    """Connected components by comparing every pair."""
    parent = {i: i for i, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [(i, (t or "").encode().split(), _runs(t)) for i, t in rows]
    for n, (i, words, a) in enumerate(sets):
        for j, other, b in sets[:n]:
            union = sum((a | b).values())
            if words == other or (union and sum((a & b).values()) / union >= similarity):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i, _ in rows}


def _texts(seed, groups, spare):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3_000)]
    rows = []
    passage = draw.choices(vocabulary, k=60)
    for g in range(groups):
        base = draw.choices(vocabulary, k=draw.choice([8, 40, 200, 600]))
        for _ in range(draw.choice([2, 3, 12])):
            copy = [draw.choice(vocabulary) if draw.random() < 0.01 else w for w in base]
            rows.append(copy + (base[:30] if draw.random() < 0.1 else []))
        if g % 3 == 0:
            rows.append(base)
            rows.append(base)
    rows += [draw.choices(vocabulary, k=draw.randrange(1, 300)) + passage for _ in range(spare)]
    draw.shuffle(rows)
    return [(10 * i + 3, " ".join(r)) for i, r in enumerate(rows)]


def test_signatures_estimate_weighted_similarity():
    gaps = []
    for seed in range(30):
        draw = np.random.default_rng(seed)
        elements = np.sort(draw.integers(0, 2**63, 200).astype(np.uint64))
        a = draw.uniform(0.1, 9, 200)
        b = a * draw.uniform(0.4, 1.6, 200)
        one, two = dm.signatures([(elements, a), (elements, b)])
        gaps.append((one == two).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(gaps)) < 0.02
    assert np.std(gaps) < 2 * (0.25 / dm.COORDINATES) ** 0.5


def test_signature_does_not_depend_on_company():
    draw = np.random.default_rng(5)
    sets = [(np.unique(draw.integers(0, 2**63, n).astype(np.uint64)), np.ones(n)) for n in (1, 3, 400, 9_000)]
    together = dm.signatures(sets)
    assert (together == np.vstack([dm.signatures([s]) for s in sets])).all()
    assert (together != 0).all()


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_against_all_pairs(spark, seed):
    rows = _texts(seed, 40, 60)
    docs = spark.createDataFrame([(i, t, 0, 0) for i, t in rows], "doc_id long, text string, node int, bucket int")
    got = {r.doc_id: r for r in dm.near_duplicates(docs).collect()}
    want = _classes(rows)
    assert {i: r.class_id for i, r in got.items()} == want
    assert all(r.kept == (i == r.class_id) for i, r in got.items())
    assert docs.columns == dm.kept_documents(docs).columns


def test_tile_links_span_the_components():
    draw = np.random.default_rng(4)
    for _ in range(20):
        base = draw.integers(0, 2**62, 60)
        sets = [np.unique(np.where(draw.random(60) < 0.12, draw.integers(0, 2**62, 60), base)) for _ in range(40)]
        component = draw.integers(0, 15, 40)
        links = dm.tile_links(sets, component, 0.8)
        parent = {int(c): int(c) for c in component}

        def find(c, parent=parent):
            while parent[c] != c:
                c = parent[c]
            return c

        want = dict(parent)
        for i in range(40):
            for j in range(i):
                shared = len(np.intersect1d(sets[i], sets[j]))
                if shared >= 0.8 * (len(sets[i]) + len(sets[j]) - shared) and component[i] != component[j]:
                    x, y = sorted((find(int(component[i]), want), find(int(component[j]), want)))
                    want[y] = x
        for i, j in links:
            x, y = sorted((find(int(component[i])), find(int(component[j]))))
            assert x != y
            parent[y] = x
        assert [find(c) for c in parent] == [find(c, want) for c in want]


@pytest.mark.parametrize("limits", [{}, {"PAIRED_NODES": 2}, {"PAIRED_NODES": 2, "TILE_NODES": 4}])
def test_links_that_miss_the_pivot(spark, monkeypatch, limits):
    """A chain: neighbours are alike, the ends are not, so one star cannot hold it."""
    for name, value in limits.items():
        monkeypatch.setattr(dm, name, value)
    words = [f"w{i}" for i in range(400)]
    rows = [(100 - i, " ".join(words[6 * i : 6 * i + 200])) for i in range(20)]
    got = dm.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == _classes(rows)
    assert {r.class_id for r in got} == {81}


def test_odd_rows(spark):
    rows = [(4, None), (2, ""), (9, " \n"), (5, "a b"), (7, "a\tb"), (7, "a\tb"), (None, "a b"), (1, "a c"), (8, "x " * 50_000), (3, "x " * 50_001)]
    got = dm.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    classes = {r.doc_id: r.class_id for r in got}
    assert classes == {4: 2, 2: 2, 9: 2, 5: 5, 7: 5, None: None, 1: 1, 8: 3, 3: 3}
    assert dm.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_one_id_with_several_texts(spark):
    base = [f"w{i}" for i in range(200)]
    near = base[:195] + ["x1", "x2", "x3", "x4", "x5"]
    rows = [(1, " ".join(base)), (5, " ".join(near)), (5, "quite another text under the same id"), (None, " ".join(base))]
    docs = spark.createDataFrame([(*r, "g", "d", 7) for r in rows], "doc_id long, text string, _gone string, digest string, row int")
    got = sorted(((r.doc_id, r.class_id, r.kept) for r in dm.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 1, True), (5, 1, False), (5, 5, True), (None, None, True)], key=str)
    kept = dm.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(kept.collect(), key=str) == sorted((r for r in docs.collect() if r.text != rows[1][1]), key=str)


def test_digest_is_that_of_the_sketch(spark):
    texts = [None, "", " \n", "a  b", " a\tb ", "é\u00a0x \x1f y", "long " * 30_000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    sketched = {r.doc_id: r.digest for r in dm.sketches(docs).collect()}
    assert {r.doc_id: r.d for r in docs.select("doc_id", dm.text_digest("text").alias("d")).collect()} == sketched
