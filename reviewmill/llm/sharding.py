"""Sharding over fixed virtual slots.

A record's slot is a hash of its id, among SLOTS slots for good. A versioned map says which
shard holds each slot. Version 1 deals the slots round; every later version is an edit of the
one before that moves as few slots as it needs to level the bytes of the shards, or to fill
new shards. Only slot totals (SLOTS rows, whatever the input) reach the driver.

Defined results: a null text has no bytes and checksum 0; rows that repeat an id share its
slot; a shard may stay empty if there are fewer filled slots than shards; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewmill.llm.common import stored
from reviewmill.operators.skew import scratch_path

SLOTS = 8192
ROW_BYTES = 8
MAP_SCHEMA = "version int, slot int, shard int"


def records(docs: DataFrame, slots: int = SLOTS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``doc_id, size, text_crc32, virtual_slot``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(whole) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(F.col(doc_id)), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def slot_totals(rows: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of every slot; at most ``slots`` rows come to the driver."""
    sizes, counts = [0] * slots, [0] * slots
    totals = rows.groupBy("virtual_slot").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    for slot, size, n in totals.collect():
        sizes[slot], counts[slot] = size, n
    return sizes, counts


@dataclass
class SlotMap:
    """Slot to shard, with all earlier versions."""

    versions: list[list[int]]

    @staticmethod
    def first(shards: int, slots: int = SLOTS) -> SlotMap:
        return SlotMap([[slot % shards for slot in range(slots)]])

    @property
    def current(self) -> list[int]:
        return self.versions[-1]

    def moved(self) -> int:
        """Slots that the last edit moved."""
        before, after = self.versions[-2:]
        return sum(a != b for a, b in zip(before, after, strict=True))

    def rebalanced(self, sizes: list[int], shards: int) -> SlotMap:
        """The next version: slots go from the fullest to the emptiest shard while that brings
        the two closer. Each move takes the slot whose size is nearest half the difference."""
        at = list(self.current)
        held = [[] for _ in range(shards)]
        for slot in sorted(range(len(at)), key=lambda s: (sizes[s], s)):
            held[at[slot]].append(slot)
        load = [sum(sizes[s] for s in slots) for slots in held]
        while True:
            full = max(range(shards), key=lambda s: (load[s], -s))
            least = min(range(shards), key=lambda s: (load[s], s))
            gap = load[full] - load[least]
            fitting = [s for s in held[full] if 0 < sizes[s] < gap]
            if not fitting:
                break
            slot = min(fitting, key=lambda s: (abs(2 * sizes[s] - gap), s))
            held[full].remove(slot)
            held[least].append(slot)
            at[slot] = least
            load[full] -= sizes[slot]
            load[least] += sizes[slot]
        return SlotMap([*self.versions, at])

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (version, slot, shard)
            for version, at in enumerate(self.versions, 1)
            for slot, shard in enumerate(at)
        ]
        return spark.createDataFrame(rows, MAP_SCHEMA)

    def save(self, spark: SparkSession, path: str | None = None) -> str:
        """Write every version, one folder each, and return where."""
        path = path or scratch_path(spark, "slot-map")
        self.table(spark).repartition("version").write.partitionBy("version").parquet(path)
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> SlotMap:
        found = spark.read.schema(MAP_SCHEMA).parquet(path).orderBy("version", "slot").collect()
        versions: dict[int, list[int]] = {}
        for row in found:
            versions.setdefault(row.version, []).append(row.shard)
        return SlotMap([versions[v] for v in sorted(versions)])


def shard_documents(
    docs: DataFrame, shards: int, slots: int = SLOTS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Rows ``doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot``, shards of
    nearly equal bytes. ``slot`` counts the rows of a shard from 0 without gaps: virtual slots
    in order, ids within each."""
    spark = docs.sparkSession
    rows = stored(records(docs, slots, doc_id, text), "shard-records")
    sizes, counts = slot_totals(rows, slots)
    path = SlotMap.first(shards, slots).rebalanced(sizes, shards).save(spark)
    current = SlotMap.load(spark, path).current
    filled, begins = [0] * shards, []
    for slot, shard in enumerate(current):
        begins.append((slot, shard, filled[shard]))
        filled[shard] += counts[slot]
    places = spark.createDataFrame(begins, "virtual_slot int, shard int, _begin long")
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    placed = rows.join(F.broadcast(places), "virtual_slot").withColumn("_row", F.row_number().over(inside))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_begin") + F.col("_row") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )
