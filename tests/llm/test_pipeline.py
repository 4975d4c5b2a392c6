"""The pipeline against the operators' own decisions, on a small table."""

from __future__ import annotations

import hashlib
import re
import sys

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    sys.path.insert(0, ".")
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        seen.append(stage(spark, seen[-1], SF).cache())
    return [*seen, corpus_pipeline.STAGES[-1][1](spark, seen[-1], SF).cache()]


def test_columns_and_decisions(spark, stages):
    docs, clean, single, distinct, mixed, encoded = stages
    assert all(s.columns == docs.columns for s in stages[:-1])
    ids = [[r.doc_id for r in s.select("doc_id").collect()] for s in stages]
    assert all(set(b) <= set(a) for a, b in zip(ids, ids[1:], strict=False))
    assert len(ids[2]) == len(set(ids[2])) and len(ids[3]) == len(set(ids[3]))
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in single.collect()]
    assert len(texts) == len(set(texts))
    assert sorted(ids[4]) == sorted(ids[5])
    copies = {i: ids[4].count(i) for i in set(ids[4])}
    assert max(copies.values()) <= 3
    by_id = {r.doc_id: r.text for r in mixed.collect()}
    for row in encoded.collect():
        assert row.decoded_sha256 == hashlib.sha256((by_id[row.doc_id] or "").encode()).hexdigest()


def test_near_copies_against_all_pairs(stages):
    from test_dart_minhash import _classes

    single, distinct = stages[2], stages[3]
    classes = _classes([(r.doc_id, r.text) for r in single.collect()])
    assert sorted(r.doc_id for r in distinct.collect()) == sorted(set(classes.values()))


ODD = "doc_id long, text string, lang string, source string, n_chars long, _rank string, _digest string, _gone int, size int, doc int, row int, digest string"


@pytest.mark.parametrize("rows", [
    [],
    [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n", "en", None, 2), (4, "one two", "en", "a", 7),
        (4, "one  two", "en", "a", 8), (4, "another text", "en", "b", 12), (None, "no id", "en", "b", 5),
        (None, "no id", "en", "b", 5), (7, "word " * 60_000, "en", "c", 300_000), (8, "one two", None, "c", 7),
    ],
])
def test_odd_rows_through_all_stages(spark, rows):
    import corpus_pipeline

    docs = spark.createDataFrame([(*r, "mine", "m2", 1, 2, 3, 4, "d") for r in rows], ODD)
    given = {tuple(r) for r in docs.collect()}
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen = stage(spark, seen, SF)
        assert seen.columns == docs.columns, name
        found = [tuple(r) for r in seen.collect()]
        assert set(found) <= given, name
        seen = spark.createDataFrame(found, ODD)
    texts = {r[1] for r in found}
    if rows:
        assert {"another text", "word " * 60_000} <= texts
    encoded = corpus_pipeline.STAGES[-1][1](spark, seen, SF).collect()
    assert len(encoded) == len(found)
