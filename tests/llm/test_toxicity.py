from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest

from reviewmill.llm import toxicity
from reviewmill.llm.toxicity import Network, Scorer


def test_windows_cover_every_word_and_overlap():
    for count in (0, 1, 47, 48, 49, 84, 85, 500):
        starts = list(toxicity.window_starts(count))
        covered = {w for s in starts for w in range(s, min(s + toxicity.WINDOW, count))}
        assert covered == set(range(count))
        assert len(starts) == len(set(starts)) and all(s < count for s in starts)


def test_gradient_by_differences():
    draw = np.random.default_rng(2)
    network = Network({"a": 1, "b": 2})
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    words = ["a", "b", "cdef", "gh"]
    documents = [draw.integers(0, 4, 60), draw.integers(0, 4, 5)]
    windows, owner = toxicity.window_index(documents)
    labels = np.array([1, 0])

    def loss():
        gates = network.gates(network.features(words)[0])
        return toxicity.document_loss(network.run(gates, windows)[0], owner, labels)[0]

    inputs = network.features(words)[0]
    logits, kept = network.run(network.gates(inputs), windows, keep=True)
    slope = toxicity.document_loss(logits, owner, labels)[1]
    d_rows, by = network.gradient(windows, len(words), slope, kept)
    by["input"] = inputs.T @ d_rows
    for name in ("forward", "backward", "attend", "output", "offset", "input"):
        values = network.p[name].reshape(-1)
        for i in draw.integers(0, values.size, 4):
            step = 1e-2
            values[i] += step
            up = loss()
            values[i] -= 2 * step
            down = loss()
            values[i] += step
            assert by[name].reshape(-1)[i] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=2e-4), name


def _corpus(count, seed):
    draw = random.Random(seed)
    syllables = ["ba", "ko", "ti", "ren", "sul", "mi", "dor"]
    rows = []
    for i in range(count):
        words = ["".join(draw.choices(syllables, k=draw.randint(1, 3))) for _ in range(draw.randint(5, 120))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                words.insert(draw.randrange(len(words)), "vexu" + draw.choice(syllables))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_unseen_endings_in_long_documents(spark):
    rows = _corpus(1_200, 1)
    rows.append((5_000, " ".join(["ba ko"] * 3_000 + ["vexuzzz"] + ["ti"] * 3_000), 1))
    rows.append((5_001, " ".join(["ba ko"] * 6_000), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = docs.selectExpr("doc_id", "score AS toxic").filter("doc_id < 5000")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == len(rows)
    unseen = [(got[i].predicted, y) for i, _, y in rows if got[i].held_out or i >= 5_000]
    assert np.mean([p == y for p, y in unseen]) >= 0.97
    assert (got[5_000].predicted, got[5_001].predicted) == (1, 0)
    assert got[5_000].windows == len(toxicity.window_starts(9_001))
    assert {got[i].held_out for i in range(50) if zlib.crc32(str(i).encode()) % 4 == 2} == {True}


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "ba"), (4, "x" * 200_000), (4, "x" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train([r[1] for r in _corpus(60, 3)], [r[2] for r in _corpus(60, 3)], epochs=1).dump()
    got = toxicity.score_documents(docs, model).collect()
    assert [r.score for r in got if r.doc_id in (1, 2, 3)] == [0, 0, 0]
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score_documents(docs.limit(0), model).count() == 0
    nothing = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.toxicity(docs, nothing).collect()} == {0}


def test_forgotten_words_score_alike(monkeypatch):
    rows = _corpus(120, 4)
    network = toxicity.train([r[1] for r in rows], [r[2] for r in rows], epochs=1)
    texts = [r[1] for r in rows]
    want = Scorer(network).score(texts)[0]
    monkeypatch.setattr(toxicity, "CACHED_WORDS", 10)
    scorer = Scorer(network)
    got = np.concatenate([scorer.score([t])[0] for t in texts])
    assert got == pytest.approx(want, abs=1e-5)


def test_long_documents_are_learned_from(spark):
    rows = [(i, t + " ba ko ti" * 300 if y or i % 3 == 0 else t, y) for i, t, y in _corpus(1_200, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = docs.selectExpr("doc_id", "score AS toxic")
    sample = toxicity.training_rows(docs, labels, "doc_id", "text", "toxic").collect()
    learnable = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    assert sorted(r.text for r in sample) == sorted(t for i, t, _ in rows if i in learnable)
    got = toxicity.toxicity(docs, labels).collect()
    truth = {i: y for i, _, y in rows}
    assert np.mean([r.predicted == truth[r.doc_id] for r in got if r.held_out]) >= 0.9


def test_sample_is_bounded_whole_and_not_starved(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MOST_TOXIC", 3)
    monkeypatch.setattr(toxicity, "TOXIC_CHARS", 1)
    monkeypatch.setattr(toxicity, "MOST_CLEAN", 5)
    rows = [(i, "" if i % 10 else f"w{i} " * 2_000, int(i % 20 == 0)) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = docs.select("doc_id", "toxic")
    sample = toxicity.training_rows(docs.unionByName(docs), labels, "doc_id", "text", "toxic").collect()
    assert sorted(r.toxic for r in sample) == [0] * 5 + [1]
    assert {r.text for r in sample} <= {t for _, t, _ in rows if t}


def test_gradient_in_parts(monkeypatch):
    draw = np.random.default_rng(3)
    network = Network({"a": 1})
    inputs = network.features(["a", "b", "cd"])[0]
    windows, owner = toxicity.window_index([draw.integers(0, 3, n) for n in (400, 7, 90)])
    labels = np.array([1, 0, 1])
    want = toxicity.batch_gradient(network, inputs, windows, owner, labels)
    monkeypatch.setattr(toxicity, "WINDOW_BATCH", 4)
    got = toxicity.batch_gradient(network, inputs, windows, owner, labels)
    assert np.allclose(got[0], want[0], atol=1e-5)
    assert all(np.allclose(got[1][k], want[1][k], atol=1e-5) for k in want[1])


def test_passages_at_every_offset_to_a_window_edge():
    for size in range(20, 41):
        for at in range(3 * toxicity.WINDOW):
            starts = toxicity.window_starts(at + size + 100)
            seen = max(min(at + size, s + toxicity.WINDOW) - max(at, s) for s in starts)
            assert seen >= (size if size <= 25 else 25 + (size - 25) // 2), (size, at)


def _plain_score(network, text):
    """Highest window of a text: hashes, gates, states and attention by loops over numbers."""
    h, p = toxicity.HIDDEN, {k: v.astype(float) for k, v in network.p.items()}

    def inputs(word):
        grams, marked = [], [ord(c) for c in f"<{word}>"]
        for size in toxicity.GRAM_SIZES:
            for a in range(len(marked) - size + 1):
                mixed = 0
                for n in range(size):
                    mixed = (mixed * 0x100000001B3 + marked[a + n] + n + 1) % 2**64
                grams.append((mixed * 0x9E3779B97F4A7C15 % 2**64 >> 40) % toxicity.GRAMS)
        own = list(p["word"][network.vocabulary.get(word, 0)])
        total = [sum(p["gram"][g][i] for g in grams) / math.sqrt(max(1, len(grams))) for i in range(toxicity.GRAM_DIM)]
        return own + total

    def run(rows, name, first):
        state, states = [0.0] * h, []
        for x in rows:
            given = [p["bias"][first + j] + sum(v * p["input"][i][first + j] for i, v in enumerate(x)) for j in range(3 * h)]
            mixed = [sum(state[i] * p[name][i][j] for i in range(h)) for j in range(3 * h)]
            update, reset = ([1 / (1 + math.exp(-given[k + j] - mixed[k + j])) for j in range(h)] for k in (0, h))
            new = [math.tanh(given[2 * h + j] + reset[j] * mixed[2 * h + j]) for j in range(h)]
            state = [s + u * (n - s) for s, u, n in zip(state, update, new, strict=True)]
            states.append(state)
        return states

    words, best = toxicity.words_of(text), 0.0
    for start in toxicity.window_starts(len(words)):
        rows = [inputs(w) for w in words[start : start + toxicity.WINDOW]]
        ahead, back = run(rows, "forward", 0), run(rows[::-1], "backward", 3 * h)[::-1]
        states = [a + b for a, b in zip(ahead, back, strict=True)]
        weights = [math.exp(sum(s * a for s, a in zip(state, p["attend"], strict=True))) for state in states]
        pooled = [sum(w * s[j] for w, s in zip(weights, states, strict=True)) / sum(weights) for j in range(2 * h)]
        logit = p["offset"][0] + sum(x * o for x, o in zip(pooled, p["output"], strict=True))
        best = max(best, 1 / (1 + math.exp(-logit)))
    return best


def test_scores_against_plain_loops():
    rows = _corpus(120, 4)
    network = toxicity.train([r[1] for r in rows], [r[2] for r in rows], epochs=2)
    long = " ".join(r[1] for r in rows[:12])
    texts = [rows[0][1], rows[1][1], "a", "Ünseen wörds 日本 x", "", None, " ".join(long.split()[:130])]
    got = Scorer(network).score(texts)[0]
    assert got == pytest.approx([_plain_score(network, t) for t in texts], abs=1e-4)
    assert len(set(got.round(6))) > 4
