from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

from reviewmill.llm import hyper_langid as hl

SF = "/root/testdata/sf0.01"


def test_bundle_against_the_definition():
    text = "Ab ça-b!"
    total = np.zeros(hl.DIMENSIONS)
    padded = "\0ab\0ça\0b\0"
    for a, b, c in zip(padded, padded[1:], padded[2:], strict=False):
        if b != "\0":
            x, y, z = (hl.letter_vector(ord(v)).astype(int) for v in (a, b, c))
            total += np.roll(x, 2) * np.roll(y, 1) * z
    assert (hl.Encoder().vector(text) == total).all()


def test_forgetting_changes_nothing(monkeypatch):
    texts = ["the quick brown fox " * 3, "über den wolken", "niño señor", "abc" * 50]
    want = [hl.Encoder().vector(t) for t in texts]
    monkeypatch.setattr(hl, "KNOWN_TRIGRAMS", 12)
    encoder = hl.Encoder()
    for _ in range(2):
        for text, vector in zip(texts, want, strict=True):
            assert encoder.vector(text) == pytest.approx(vector)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: (r.lang, r.text) for r in docs.select("doc_id", "lang", "text").collect()}
    got = hl.language(docs).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    unseen = [r for r in got if r.held_out and truth[r.doc_id][0] and len(truth[r.doc_id][1] or "") > 100]
    assert np.mean([r.lang_pred == truth[r.doc_id][0] for r in unseen]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_predictions_use_the_text_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(100)
    prototypes = hl.learn(docs)
    changed = docs.selectExpr("doc_id", "text", "'xx' AS lang", "'y' AS source", "1 AS score")
    key = lambda frame: sorted((r.doc_id, r.lang_pred, r.score) for r in frame.collect())
    assert key(hl.identify(docs, prototypes)) == key(hl.identify(changed, prototypes))


def test_odd_rows(spark):
    rows = [(0, None, "en"), (1, "", "en"), (2, "12 !?", "en"), (None, "the the", "en"), (3, "the of and", "en"), (4, "le la des", None), (4, "le la des", None), (5, "the " * 100_000, "en"), (6, None, "fr")]
    rows += [(i, "the of and", "en") for i in range(10, 16)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = hl.language(docs).collect()
    assert Counter(r.lang_pred for r in got) == {"und": 4, "en": 11}
    assert {r.score for r in got if r.lang_pred == "und"} == {0}
    assert hl.language(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in hl.language(docs.withColumn("lang", docs.lang.substr(9, 1)).replace("", None)).collect()} == {"und"}


def _plain_bundle(text):
    padded = "\0" + "".join(c.lower() if c.isalpha() else "\0" for c in text) + "\0"
    total = np.zeros(hl.DIMENSIONS)
    for a, b, c in zip(padded, padded[1:], padded[2:], strict=False):
        if b != "\0":
            x, y, z = (hl.letter_vector(ord(v)).astype(int) for v in (a, b, c))
            total += np.roll(x, 2) * np.roll(y, 1) * z
    return total


def test_prototypes_and_choice_by_definition(spark):
    """Prototypes are the sums of unit bundles of the learnable documents, the answer is the nearest
    by cosine; documents without a letter, first in hash order or not, don't use up the sample."""
    words = {"en": "the of and house water", "de": "der und haus wasser über", "fr": "le la maison niño eau"}
    draw = np.random.default_rng(3)
    rows = [(i, " ".join(draw.choice(w.split(), 6)), lang) for i, (lang, w) in enumerate([*words.items()] * 9)]
    rows += [(100 + i, "12 34 !?", "de") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in hl.identify(docs, hl.learn(docs, sample=30)).collect()}
    learned = [r for r in rows if r[0] < 100 and zlib.crc32(str(r[0]).encode()) % 3 != 1]
    prototypes = {}
    for _, text, lang in learned:
        bundle = _plain_bundle(text)
        prototypes[lang] = prototypes.get(lang, 0) + bundle / np.linalg.norm(bundle)
    assert hl.learn(docs, sample=30).keys() == prototypes.keys()
    for doc_id, text, _ in rows:
        if doc_id >= 100:
            assert (got[doc_id].lang_pred, got[doc_id].score) == ("und", 0.0)
            continue
        bundle = _plain_bundle(text)
        cosines = {n: bundle @ p / np.linalg.norm(bundle) / np.linalg.norm(p) for n, p in prototypes.items()}
        best = max(cosines, key=cosines.get)
        assert got[doc_id].lang_pred == best and got[doc_id].score == pytest.approx(cosines[best], abs=1e-5)
