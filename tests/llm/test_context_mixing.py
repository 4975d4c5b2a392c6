from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from reviewmill.llm import context_mixing as cm

SCHEMA = "doc_id long, text string, mark string, held int, id string, tokens string"
WORDS = ["the", "cat", "sat", "on", "mats", "dog", "Été", "runs", "far"]


def _held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def _text(draw, n):
    return " ".join(draw.choice(WORDS, n))


def _rows(count, seed):
    draw = np.random.default_rng(seed)
    return [(i, _text(draw, int(draw.integers(1, 40)))) for i in range(count)]


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "m", 1, "x", "y") for r in rows], SCHEMA)


def _base(rows):
    def tokens(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return [*re.findall(r"[^\x20\x09-\x0D]+", low), " "]

    count = Counter(t for i, text in rows if not _held(i) for t in tokens(text))
    total, size = sum(count.values()), len(count)
    found = []
    for i, text in rows:
        own = tokens(text)
        score = sum(math.log10((count[t] + 1) / (total + size + 1)) for t in own)
        found.append((i, _held(i), len(own), sum(count[t] > 0 for t in own), total, round(score, 8)))
    return sorted(found, key=str)


def _plain_counts(texts):
    """Bit counts by order, context and node in plain loops, at the places of the tables."""
    table = np.zeros((2, cm.PLACES), np.int64)
    for text in texts:
        for _, bit, places in _plain_decisions(text):
            for place in places:
                table[bit, place] += 1
    return table


def _plain_decisions(text):
    whole = bytes(5) + text + b"\xff"
    for at in range(5, len(whole)):
        byte = whole[at]
        for j in range(8):
            node = (1 << j) | (byte >> (8 - j))
            places = []
            for k in range(6):
                key = int.from_bytes(whole[at - k : at], "big") << 8 | node
                if k >= 2:
                    key = (key * 0x9E3779B97F4A7C15 % 2**64) >> (64 - cm.TABLE_BITS)
                places.append(key + int(cm.OFFSETS[k]))
            yield (j, whole[at - 1]), (byte >> (7 - j)) & 1, places


def _plain_score(table, weights, refined, text):
    """Sequential scoring of one text, a bit at a time."""
    blocks, sums = [], None
    for n, ((j, previous), bit, places) in enumerate(_plain_decisions(text)):
        if n % (8 * cm.TRACK_BYTES) == 0:
            sums = [0.0, 0.0]
            blocks.append(sums)
        push, level = [], []
        for place in places:
            zeros, ones = table[0, place], table[1, place]
            chance = (ones + 0.4) / (zeros + ones + 0.8)
            push.append(np.float32(min(max(math.log(chance / (1 - chance)), -8.0), 8.0)))
            level.append(sum(zeros + ones >= x for x in (1, 2, 4, 16)))
        longest = max([k for k in range(6) if level[k]], default=5)
        gate = (longest * 4 + max(level[longest], 1) - 1) * 8 + j
        mixed = sum(float(w) * float(x) for w, x in zip(weights[gate], push, strict=True))
        bucket = round((min(max(mixed, -8.0), 8.0) + 8) * 2)
        one = [1 / (1 + math.exp(-mixed)), refined[(j * 256 + previous) * 33 + bucket]]
        for way in range(2):
            p = min(max(one[way], 1e-6), 1 - 1e-6)
            sums[way] += math.log(p if bit else 1 - p)
    share, total = 0.5, 0.0
    for a, b in blocks:
        both = np.logaddexp(math.log(share) + a, math.log(1 - share) + b)
        total += both
        share = math.exp(math.log(share) + a - both) * 0.98 + 0.01
    return total


def _trained(texts):
    counter = cm.Counter()
    counter.add(texts)
    blocks = list(counter.blocks())
    mixer = cm.Mixer()
    table = cm.read_counts(blocks)
    for text in texts:
        mixer.learn(table, text, refine=True)
    return blocks, mixer.weights, mixer.refined()


@pytest.fixture(scope="module")
def trained():
    return _trained([text.encode() for _, text in _rows(60, 1)])


def test_counts_equal_plain_loops(monkeypatch):
    texts = [text.encode() for _, text in _rows(12, 2)] + [b"", b"\0\0", "é".encode() * 50]
    plain = _plain_counts(texts)
    assert (cm.read_counts(list(_counted(texts).blocks())) == plain).all()
    monkeypatch.setattr(cm, "CACHE_BITS", 3)  # nearly every gram goes past the cache
    monkeypatch.setattr(cm, "PIECE_BYTES", 7)
    monkeypatch.setattr(cm, "PACK_BYTES", 50)
    assert (cm.read_counts(list(_counted(texts).blocks())) == plain).all()


def _counted(texts):
    counter = cm.Counter()
    counter.add(texts)
    return counter


def test_scores_equal_plain_loops(trained):
    blocks, weights, refined = trained
    table = cm.read_counts(blocks)
    texts = [text.encode() for _, text in _rows(8, 3)] + [b"", b"unseen 123", "日本".encode(), b"the cat " * 40]
    got = cm.Model(blocks, weights, refined).score(texts)
    for text, score in zip(texts, got, strict=True):
        assert score == pytest.approx(_plain_score(table, weights, refined, text), rel=1e-9)


def test_scores_do_not_depend_on_neighbours(trained, monkeypatch):
    texts = [text.encode() for _, text in _rows(30, 4)] + [b"a long one " * 300]
    whole = cm.Model(*trained).score(texts)
    alone = [cm.Model(*trained).score([t])[0] for t in texts[::7]]
    assert (whole[::7] == alone).all()
    monkeypatch.setattr(cm, "PIECE_BYTES", 2 * cm.TRACK_BYTES)
    monkeypatch.setattr(cm, "PACK_BYTES", 300)
    monkeypatch.setattr(cm, "CACHE_BITS", 6)
    assert (cm.Model(*trained).score(texts) == whole).all()


def test_next_byte_probabilities_sum_to_one(trained):
    model = cm.Model(*trained)
    for before in (b"", b"the c", "É".encode()):
        context = int.from_bytes(before[-5:], "big") << 8
        found = np.arange(256, dtype=np.uint64) | np.uint64(context)
        assert np.exp(model.evaluate(found)).sum(1) == pytest.approx([1, 1])


def test_learns_the_language():
    rows = _rows(300, 5)
    texts = [text.encode() for _, text in rows]
    model = cm.Model(*_trained(texts[:200]))
    bits = -model.score(texts[200:]).sum() / math.log(2) / sum(len(t) + 1 for t in texts[200:])
    counts = Counter(b for t in texts for b in t)
    total = sum(counts.values())
    order0 = -sum(n / total * math.log2(n / total) for n in counts.values())
    assert bits < order0 / 2
    draw = np.random.default_rng(1)
    noise = bytes(draw.choice(list(counts), 200).astype(np.uint8))
    assert model.score([noise])[0] < 3 * model.score([b" ".join(texts[201:])[:200]])[0]


def test_base_equals_plain_loops(spark):
    rows = _rows(50, 6)
    rows += [(900, None), (901, ""), (902, "never seen words"), (None, "the cat"), (903, " \t\n"), (904, "a" * 200_000)]
    rows += [rows[0], rows[0], (None, None), (None, None), (rows[3][0], "another text")]
    found = cm.scores(_frame(spark, rows)).collect()
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 8)) for r in found]
    assert sorted(got, key=str) == _base(rows)
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    assert len({r.score for r in found if r.doc_id is None and r.n_bytes == 0}) == 1


def test_spark_scores_equal_one_process(spark):
    rows = _rows(40, 7)
    got = {r.doc_id: r.score for r in cm.scores(_frame(spark, rows).repartition(5)).collect()}
    again = {r.doc_id: r.score for r in cm.scores(_frame(spark, rows).repartition(2)).collect()}
    assert got == again
    seen = cm.context_counts(_frame(spark, [r for r in rows if not _held(r[0])]).repartition(3), "text")
    assert (cm.read_counts(seen) == _plain_counts([t.encode() for i, t in rows if not _held(i)])).all()


def test_few_rows(spark):
    assert cm.scores(_frame(spark, [])).collect() == []
    held = next(i for i in range(100) if _held(i))
    (row,) = cm.scores(_frame(spark, [(held, "only held out")])).collect()
    assert row.held_out and row.n_known == 0 and row.train_tokens == 0 and row.base_score == 0
    assert row.score == pytest.approx(-8 * (row.n_bytes + 1) * math.log10(2))


def test_mixing_weights_learn_from_every_training_document(spark, monkeypatch):
    rows = [r for r in _rows(1400, 8) if not _held(r[0])]
    frame = _frame(spark, [(i, f"{text} d{i}") for i, text in rows])
    docs = frame.select("doc_id", "text", cm.F.lit(False).alias("held"), cm.F.xxhash64("text").alias("mark"))
    monkeypatch.setattr(cm, "SLICE_BYTES", 20_000)
    slices, _ = cm.training_slices(docs)
    found = slices.collect()
    assert len({r.slice for r in found}) > 2  # more than 500 documents, in more than one slice
    assert sorted(bytes(r.text).decode() for r in found) == sorted(f"{text} d{i}" for i, text in rows)
    _, weights, refined = cm.pickle.loads(cm.fit(docs))
    _, again, other = cm.pickle.loads(cm.fit(docs.repartition(3)))
    assert (weights == again).all() and (refined == other).all()


def test_each_sequence_of_the_corpus_is_learned_once(spark, monkeypatch):
    """Before, a sequence was learned again in every pack of documents that held it."""
    rows = [r for r in _rows(300, 9) if not _held(r[0])]
    rows += [(-1, rows[0][1]), (-2, rows[0][1]), (-3, ""), (-4, "é" * 50)]
    frame = _frame(spark, rows)
    docs = frame.select("doc_id", "text", cm.F.lit(False).alias("held"), cm.F.xxhash64("text").alias("mark"))
    monkeypatch.setattr(cm, "SLICE_BYTES", 5_000)
    monkeypatch.setattr(cm, "WAITING_GRAMS", 1_000)  # tasks give up what they hold more than once
    dealt, parts = cm.training_slices(docs)
    slice_of = {bytes(r.text).decode(): {s.slice for s in dealt.collect() if s.text == r.text} for r in dealt.collect()}
    times, held = Counter(), {}
    for _, text in rows:
        (own,) = slice_of[text]  # copies are in one slice
        whole = bytes(5) + text.encode() + b"\xff"
        for at in range(5, len(whole)):
            gram = int.from_bytes(whole[at - 5 : at + 1], "big")
            times[gram] += 1
            held[gram] = held.get(gram, 0) | 1 << own
    for spread in (dealt, dealt.repartition(3)):
        got = [g for b in cm.corpus_grams(spread, parts).toArrow().to_batches() for g in cm.grams_in(b)]
        assert parts > 2 and len({part for part, _ in got}) == len(got)
        found, n, bits = (np.concatenate(x).tolist() for x in zip(*[g for _, g in got], strict=True))
        assert len(set(found)) == len(found)
        assert dict(zip(found, n, strict=True)) == times and dict(zip(found, bits, strict=True)) == held


def test_own_slices_are_no_evidence():
    """What all documents of the only slice say is taken out, what other slices say stays."""
    counter = cm.Counter()
    counter.add([b"abcdefg"] * 3)
    table = cm.read_counts(list(counter.blocks()))
    (found, times, _), = cm.distinct_grams([b"abcdefg"], np.zeros(1, np.int64))
    for own, left in ((3 * times, 0), (times, 2)):
        for _, bit, places in cm.decisions(found):
            zeros = np.maximum(table[0, places[5]] - own * (1 - bit), 0)
            ones = np.maximum(table[1, places[5]] - own * bit, 0)
            inputs, levels = cm.Mixer._without(table, places, bit, own)
            assert (inputs[5] == cm.evidence(zeros, ones)[0]).all()
            assert (levels[5] == np.searchsorted(cm.LEVELS, left, side="right")).all()
