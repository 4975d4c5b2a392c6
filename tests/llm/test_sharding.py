from __future__ import annotations

import random
import struct
import zlib

import xxhash

from reviewmill.llm import sharding
from reviewmill.llm.sharding import SlotMap


def test_shards_are_level_and_numbered(spark):
    rows = [(i, "x" * (37 * i % 501), 0) for i in range(5_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    got = sharding.shard_documents(docs, 6).collect()
    loads, numbers = [0] * 6, [[] for _ in range(6)]
    for r in got:
        assert r.size == len(rows[r.doc_id][1]) + 8
        assert r.text_crc32 == zlib.crc32(rows[r.doc_id][1].encode())
        loads[r.shard] += r.size
        numbers[r.shard].append(r.slot)
    assert max(loads) - min(loads) <= 0.002 * sum(loads)
    assert all(sorted(n) == list(range(len(n))) for n in numbers)


def test_edits_move_little_and_versions_survive(spark, tmp_path):
    sizes = [100 + s % 13 for s in range(512)]
    first = SlotMap.first(4, 512).rebalanced(sizes, 4)
    grown = first.rebalanced(sizes, 5)
    # nearly all moves fill the new shard; the last few level the others
    between_old = sum(a != b != 4 for a, b in zip(first.current, grown.current, strict=True))
    assert between_old <= 5
    assert 512 / 5 - 8 <= grown.moved() <= 512 / 5 + 8
    loaded = SlotMap.load(spark, grown.save(spark, str(tmp_path / "map")))
    assert loaded.versions == grown.versions and len(loaded.versions) == 3


def test_odd_rows(spark):
    rows = [(1, None), (1, None), (None, ""), (2, "é"), (3, "y" * 100_000)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 24).collect()
    assert sorted((r.size, r.text_crc32) for r in got)[:3] == [(8, 0)] * 3
    assert sum(r.size for r in got) == 5 * 8 + 2 + 100_000
    assert sharding.shard_documents(spark.createDataFrame([], "doc_id long, text string"), 24).count() == 0


def test_shards_against_plain_loops(spark):
    """Hash, map, shard and number of every row, by loops."""
    draw = random.Random(3)
    rows = [(i * 7, "xé"[i % 2] * draw.randrange(0, 3_000)) for i in range(800)] + [(14, "again"), (14, None), (None, None)]
    slots, shards = 64, 5

    def slot_of(doc_id):
        if doc_id is None:
            return 42 % slots  # Spark's seed
        value = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed=42)
        return (value - (value >> 63 << 64)) % slots

    sizes = [0] * slots
    for doc_id, text in rows:
        sizes[slot_of(doc_id)] += len((text or "").encode()) + 8
    shard_of = [s % shards for s in range(slots)]
    while True:
        load = [sum(sizes[s] for s in range(slots) if shard_of[s] == k) for k in range(shards)]
        full, least = load.index(max(load)), load.index(min(load))
        gap = load[full] - load[least]
        fitting = [(abs(2 * sizes[s] - gap), s) for s in range(slots) if shard_of[s] == full and 0 < sizes[s] < gap]
        if not fitting:
            break
        shard_of[min(fitting)[1]] = least
    want = {}
    for doc_id, text in rows:
        whole = (text or "").encode()
        order = (slot_of(doc_id), doc_id is not None, doc_id or 0, zlib.crc32(whole), len(whole) + 8)
        want.setdefault(shard_of[order[0]], []).append((order, doc_id))
    want = [(doc_id, o[3], o[4], shard, n) for shard, own in want.items() for n, (o, doc_id) in enumerate(sorted(own))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [(r.doc_id, r.text_crc32, r.size, r.shard, r.slot) for r in sharding.shard_documents(docs, shards, slots).collect()]
    assert sorted(got, key=lambda r: r[3:]) == sorted(want, key=lambda r: r[3:])
