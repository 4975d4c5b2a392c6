"""Exact dedup through a sharded cuckoo-filter index of live digests.

Digests are dealt to shards by hash. A shard is a cuckoo filter: buckets of four slots with a
16-bit fingerprint each, and beside every slot the stored entry (digest, smallest id, number
of rows) it stands for. A lookup that finds no fingerprint proves the digest new; a hit is
verified against the entry in that bucket, so false positives never merge two texts. Deletion
clears the slot of the verified entry. When an insertion finds no room after MAX_KICKS moves,
the table doubles and is filled anew from the stored digests.

Copies meet before the shuffle: rows of one digest are combined per task and salt, so a text
that holds a third of all rows reaches its shard as a few rows.

Defined results: null counts as the empty text; of equal texts the row with the smallest id
stays, null ids after all others; if that very row is repeated, one of the repetitions stays;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewmill.llm.common import join_classes, normal_text, stored

SLOTS = 4
FINGERPRINT_BITS = 16
MAX_KICKS = 500
FIRST_BUCKETS = 64
SHARD_ROWS = 500_000
SALTS = 8
NO_ID = (1 << 63) - 1

ENTRIES = (
    "shard int, buckets int, bucket int, slot int, fingerprint int, digest string, keep_id long, copies long"
)


class CuckooFilter:
    """One shard: fingerprints in buckets, each next to the entry it stands for."""

    def __init__(self, buckets: int = FIRST_BUCKETS) -> None:
        self.clear(buckets)

    def clear(self, buckets: int) -> None:
        self.buckets = buckets
        self.prints = [0] * (buckets * SLOTS)
        self.entries: list[list | None] = [None] * (buckets * SLOTS)

    @staticmethod
    def _hashes(digest: str) -> tuple[int, int]:
        """Where a digest starts, and its fingerprint, which is never 0."""
        return int(digest[:12], 16), int(digest[12:16], 16) or 1

    def _other(self, bucket: int, fingerprint: int) -> int:
        return (bucket ^ (fingerprint * 0x5BD1E995)) & (self.buckets - 1)

    def find(self, digest: str) -> int | None:
        """Slot of a live digest; a fingerprint hit counts only if the stored digest agrees."""
        start, fingerprint = self._hashes(digest)
        first = start & (self.buckets - 1)
        for bucket in (first, self._other(first, fingerprint)):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.prints[slot] == fingerprint and self.entries[slot][0] == digest:
                    return slot
        return None

    def insert(self, digest: str, keep_id: int, copies: int) -> None:
        slot = self.find(digest)
        if slot is None:
            self._place([digest, keep_id, copies])
            return
        entry = self.entries[slot]
        entry[1] = min(entry[1], keep_id)
        entry[2] += copies

    def delete(self, digest: str) -> bool:
        slot = self.find(digest)
        if slot is None:
            return False
        self.prints[slot], self.entries[slot] = 0, None
        return True

    def _place(self, entry: list) -> None:
        start, fingerprint = self._hashes(entry[0])
        bucket = start & (self.buckets - 1)
        for kick in range(MAX_KICKS):
            for candidate in (bucket, self._other(bucket, fingerprint)):
                for slot in range(candidate * SLOTS, candidate * SLOTS + SLOTS):
                    if not self.prints[slot]:
                        self.prints[slot], self.entries[slot] = fingerprint, entry
                        return
            # full: take the place of an entry, which moves on to its other bucket
            bucket = self._other(bucket, fingerprint)
            slot = bucket * SLOTS + kick % SLOTS
            fingerprint, self.prints[slot] = self.prints[slot], fingerprint
            entry, self.entries[slot] = self.entries[slot], entry
        self._grow(entry)

    def _grow(self, homeless: list) -> None:
        stored_entries = [e for e in self.entries if e is not None] + [homeless]
        self.clear(self.buckets * 2)
        for entry in stored_entries:
            self._place(entry)

    def load(self, frame: pd.DataFrame) -> None:
        """Take over a stored shard slot by slot."""
        self.clear(int(frame["buckets"].iloc[0]))
        for row in frame.itertuples(index=False):
            at = row.bucket * SLOTS + row.slot
            self.prints[at] = row.fingerprint
            self.entries[at] = [row.digest, row.keep_id, row.copies]

    def frame(self, shard: int) -> pd.DataFrame:
        rows = [
            (shard, self.buckets, at // SLOTS, at % SLOTS, self.prints[at], *entry)
            for at, entry in enumerate(self.entries)
            if entry is not None
        ]
        names = [field.split()[0] for field in ENTRIES.split(", ")]
        return pd.DataFrame(rows, columns=names)


def _build(key: tuple, changes: pd.DataFrame) -> pd.DataFrame:
    return _change(key, pd.DataFrame(), changes)


def _change(key: tuple, entries: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
    """Apply a shard's deletions, then its insertions."""
    table = CuckooFilter()
    if len(entries):
        table.load(entries)
    for digest in changes.loc[changes["copies"] == 0, "digest"]:
        table.delete(digest)
    added = changes[changes["copies"] > 0]
    for row in zip(added["digest"], added["keep_id"], added["copies"], strict=True):
        table.insert(*row)
    return table.frame(key[0])


@dataclass(frozen=True)
class CuckooIndex:
    """A version of the index: its entries as a table, dealt to ``shards`` shards.

    ``insert`` and ``delete`` give the next version; each version is a written table.
    """

    entries: DataFrame
    shards: int

    @staticmethod
    def build(digests: DataFrame, shards: int) -> CuckooIndex:
        """From rows ``doc_id, digest``; a shard should get SHARD_ROWS digests or fewer."""
        changes = _combined(digests, shards)
        return CuckooIndex(stored(changes.groupBy("shard").applyInPandas(_build, ENTRIES), "cuckoo"), shards)

    def insert(self, digests: DataFrame) -> CuckooIndex:
        return self._changed(_combined(digests, self.shards))

    def delete(self, digests: DataFrame) -> CuckooIndex:
        """Forget digests with all their rows; unknown ones are passed over."""
        gone = digests.select("digest").distinct().select(
            _shard(self.shards), "digest", F.lit(NO_ID).alias("keep_id"), F.lit(0).cast("long").alias("copies")
        )
        return self._changed(gone)

    def _changed(self, changes: DataFrame) -> CuckooIndex:
        pairs = self.entries.groupBy("shard").cogroup(changes.groupBy("shard"))
        return CuckooIndex(stored(pairs.applyInPandas(_change, ENTRIES), "cuckoo"), self.shards)


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int").alias("shard")


def _combined(digests: DataFrame, shards: int) -> DataFrame:
    salted = digests.groupBy("digest", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt")).agg(
        F.coalesce(F.min("doc_id"), F.lit(NO_ID)).alias("keep_id"), F.count(F.lit(1)).alias("copies")
    )
    return salted.select(_shard(shards), "digest", "keep_id", "copies")


def digest_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``doc_id, digest``: SHA-256 of the text after white space is made uniform."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.sha2(normal_text(text), 256).alias("digest"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``doc_id, keep_id, group_size, kept, text_sha256``, one per document."""
    spark = docs.sparkSession
    rows = stored(digest_rows(docs, doc_id, text), "digests")
    total = rows.count()
    index = CuckooIndex.build(rows, _shards(spark, total))
    entries = index.entries.select("digest", "keep_id", "copies")
    rank = F.coalesce("doc_id", F.lit(NO_ID))
    repeated = Window.partitionBy("digest", rank).orderBy("keep_id")
    found = join_classes(rows, entries, total).withColumn("_copy", F.row_number().over(repeated))
    return found.select(
        "doc_id",
        F.when(F.col("keep_id") < NO_ID, F.col("keep_id")).alias("keep_id"),
        F.col("copies").alias("group_size"),
        ((rank == F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def _shards(spark: SparkSession, rows: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // SHARD_ROWS + 1)


def kept_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names."""
    rank = F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("rank")
    stay = dedup(docs, doc_id, text).filter("kept").select(rank, F.col("text_sha256").alias("digest"))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("rank"),
        F.sha2(normal_text(text), 256).alias("digest"),
    )
    # repeated rows share rank and digest; the join has brought them together already
    return rows.join(stay, ["rank", "digest"], "left_semi").dropDuplicates(["rank", "digest"]).select("row.*")


SQL = r"""
WITH normal AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM normal
"""
