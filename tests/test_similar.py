"""Similar groups by rare words, against plain loops."""

from __future__ import annotations

import math
import random

import pytest

from reviewmill.operators import similar


def _brute(rows):
    vectors = {}
    for g, word, n in rows:
        if None not in (g, word, n):
            own = vectors.setdefault(g, {})
            own[word] = own.get(word, 0) + n
    vectors = {g: {w: n for w, n in v.items() if n} for g, v in vectors.items()}
    length = {g: math.sqrt(sum(n * n for n in v.values())) for g, v in vectors.items()}
    found = {}
    for a, one in vectors.items():
        for b, two in vectors.items():
            if a != b and one.keys() & two.keys():
                found[a, b] = sum(n * two.get(w, 0) for w, n in one.items()) / (length[a] * length[b])
    return found


def _rows(groups, seed):
    draw = random.Random(seed)
    rows = [(f"g{i:03}", "common", draw.randrange(1, 3)) for i in range(groups)]
    for i in range(groups):
        for _ in range(draw.randrange(1, 9)):
            rows.append((f"g{i:03}", f"w{int(draw.paretovariate(0.6)) % 60}", draw.randrange(1, 9)))
    odd = [("one", "w1", 3), ("one", "w1", 2), ("copy", "w1", 5), ("none", "w2", 0), (None, "w1", 2), ("x", None, 1), ("y", "w3", None)]
    return rows + odd


@pytest.mark.parametrize("word_groups", [5, 4096])
@pytest.mark.parametrize("at_least", [0.2, 0.75, 1.0])
def test_all_pairs_above(spark, at_least, word_groups):
    rows = _rows(60, 3)
    frame = spark.createDataFrame(rows, "shop string, word string, n long")
    got = {(r.g1, r.g2): r.cosine for r in similar.similar_groups(frame, "shop", at_least, word_groups=word_groups).collect()}
    every = {p: c for p, c in _brute(rows).items() if p[0] < p[1]}
    assert all(c >= at_least - 1e-9 for c in got.values())
    assert {p for p, c in every.items() if c >= at_least + 1e-9} <= got.keys() <= every.keys()
    assert all(c == pytest.approx(every[p]) for p, c in got.items())


@pytest.mark.parametrize("k", [1, 4, 200])
def test_nearest_of_each(spark, k):
    rows = _rows(50, 4)
    frame = spark.createDataFrame(rows, "shop string, word string, n long")
    got = {}
    for r in similar.most_similar_groups(frame, "shop", k, word_groups=7).collect():
        got.setdefault(r.g1, {})[r.rank] = (r.g2, r.cosine)
    every = {}
    for (a, b), c in _brute(rows).items():
        every.setdefault(a, {})[b] = c
    assert got.keys() == every.keys()
    for g, own in got.items():
        want = sorted(every[g].values(), reverse=True)[:k]
        assert sorted(own) == list(range(1, len(want) + 1))
        assert [own[r][1] for r in sorted(own)] == pytest.approx(want)
        assert all(every[g][b] == pytest.approx(c) for b, c in own.values())
        assert len({b for b, _ in own.values()}) == len(own)


def test_a_common_word_makes_no_pairs(spark):
    """300 groups that share one word of little weight: no candidate meets in it."""
    rows = [(f"g{i}", w, n) for i in range(300) for w, n in (("common", 1), (f"own{i // 2}", 9))]
    entries = similar.weighted_entries(spark.createDataFrame(rows, "g string, word string, n long"), "g")
    assert similar.candidates(entries, entries, 0.75, once=True).count() == 150


def test_empty_and_bad_threshold(spark):
    empty = spark.createDataFrame([], "g string, word string, n long")
    assert similar.similar_groups(empty, "g", 0.5).collect() == []
    assert similar.most_similar_groups(empty, "g", 2).collect() == []
    with pytest.raises(ValueError, match="above 0"):
        similar.similar_groups(empty, "g", 0)
