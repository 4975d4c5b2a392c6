from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from reviewmill.llm import cuckoo_dedup
from reviewmill.llm.cuckoo_dedup import CuckooFilter, CuckooIndex


def _digest(i: int) -> str:
    return hashlib.sha256(str(i).encode()).hexdigest()


def test_filter_against_a_dictionary():
    draw, table, live = random.Random(3), CuckooFilter(2), {}
    for step in range(30_000):
        digest = _digest(draw.randrange(4_000))
        if draw.random() < 0.3:
            assert table.delete(digest) == (live.pop(digest, None) is not None)
        else:
            keep, copies = live.get(digest, (step, 0))
            live[digest] = (min(keep, step), copies + 1)
            table.insert(digest, step, 1)
    entries = {e[0]: (e[1], e[2]) for e in table.entries if e is not None}
    assert entries == live
    assert table.buckets > 2


def test_equal_fingerprints_are_verified():
    table = CuckooFilter()
    same = [f"{7:012x}{9:04x}" + f"{i:048x}" for i in range(20)]
    for i, digest in enumerate(same[:8]):
        table.insert(digest, i, 1)
    assert all(table.find(d) is not None for d in same[:8])
    assert all(table.find(d) is None for d in same[8:])


def test_index_versions(spark):
    def rows(ids):
        return spark.createDataFrame([(i, _digest(i % 50)) for i in ids], "doc_id long, digest string")

    first = CuckooIndex.build(rows(range(100)), 3)
    second = first.delete(rows(range(10)))
    third = second.insert(rows(range(1_000, 1_005)))
    assert first.entries.count() == 50 and second.entries.count() == 40
    got = {r.digest: (r.keep_id, r.copies) for r in third.entries.collect()}
    assert got[_digest(0)] == (1_000, 1) and got[_digest(20)] == (20, 2) and len(got) == 45




def test_dedup_with_odd_rows(spark):
    rows = [
        (5, "a  b\n", 1), (3, "a b ", 1), (3, "a b ", 1), (9, "a b", 1), (1, None, 1), (0, "", 1),
        (None, "only", 1), (None, "only", 1), (None, "z", 1), (7, "z", 1), (8, "é" * 100_000, 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest int")
    got = cuckoo_dedup.dedup(docs).collect()
    assert len(got) == len(rows)
    by_digest = {}
    for r in got:
        by_digest.setdefault(r.text_sha256, []).append(r)
    for group in by_digest.values():
        assert sum(r.kept for r in group) == 1 and {r.group_size for r in group} == {len(group)}
        ids = [r.doc_id for r in group if r.doc_id is not None]
        assert {r.keep_id for r in group} == {min(ids, default=None)}
    assert hashlib.sha256(b"a b ").hexdigest() in by_digest
    kept = cuckoo_dedup.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, [r.doc_id for r in kept.collect()])) == ["0", "3", "7", "8", "9", "None"]


def test_hot_text(spark):
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text")
    )
    got = cuckoo_dedup.dedup(docs)
    assert got.filter("kept").count() == 20_001 and got.agg(F.max("group_size")).first()[0] == 10_000


def test_empty_table(spark):
    assert cuckoo_dedup.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_columns_with_clashing_names(spark):
    rows = [(1, "a b", "mine", "m2", 3), (2, "a  b", "x", "y", 4), (2, "c", "x", "z", 5), (None, "c", "n", "n", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _rank string, _digest string, digest int")
    kept = cuckoo_dedup.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted([rows[0], rows[2]], key=str)
