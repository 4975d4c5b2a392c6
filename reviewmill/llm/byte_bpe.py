"""Byte-level BPE encoding and decoding with a rank queue over hierarchical bitmaps.

Texts are cut by the published pattern; every piece is merged by itself. Open merges wait in
one bucket per rank. Two bitmap levels say which buckets are filled, so the next rank is two
find-first-set steps away however long the piece is; a merge pushes at most two entries, and
entries that a later merge made stale are skipped when they come up. A piece of n bytes costs
O(n log n) at worst, where scanning for the lowest pair would cost O(n^2).

Defined results: null counts as the empty text; the empty text has no ids and decodes to no
bytes; repeated rows are encoded each by itself; other columns are ignored.
"""

from __future__ import annotations

import base64
import gc
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The published splitting pattern that boundaries() knows without a regular expression.
KNOWN_PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
CACHE_BYTES = 48 << 20
PIECE_BYTES = 250  # of a short piece, its ids and its place in the cache
BULK_PIECES = 1_000
CHUNK_CHARS = 1 << 20
SCHEMA = "doc_id long, token_ids array<int>, decoded binary"

_OTHER, _LETTER, _NUMBER, _SPACE = range(4)


class ByteBpe:
    def __init__(self, rank_lines: bytes) -> None:
        pairs = (line.split() for line in rank_lines.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.forget()
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        made = [
            (self.ranks[token[:i]] << 32 | self.ranks[token[i:]], rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        made.sort()
        self.pair_keys, self.pair_values = map(np.array, zip(*made, strict=True))

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece.

        ``buckets`` holds the left ends waiting for each rank, leftmost first; ``low`` has one
        bit per filled bucket, 256 to a block, and ``high`` one bit per filled block.
        """
        rank_of = self.ranks.get
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        size = len(piece)
        after = list(range(1, size + 2))
        before = list(range(-1, size))
        waiting: list[int | None] = [rank_of(piece[i : i + 2]) for i in range(size - 1)]
        waiting += (None, None)
        buckets: dict[int, list[int]] = {}
        low: dict[int, int] = {}
        high = 0
        fresh = [(i, rank) for i, rank in enumerate(waiting) if rank is not None]
        while True:
            for position, rank in fresh:
                if rank in buckets:
                    heappush(buckets[rank], position)
                else:
                    buckets[rank] = [position]
                    block = rank >> 8
                    low[block] = low.get(block, 0) | 1 << (rank & 255)
                    high |= 1 << block
            if not high:
                break
            block = (high & -high).bit_length() - 1
            bits = low[block]
            lowest = bits & -bits
            rank = block << 8 | lowest.bit_length() - 1
            bucket = buckets[rank]
            left = heappop(bucket) if len(bucket) > 1 else bucket.pop()
            if not bucket:
                del buckets[rank]
                low[block] = bits = bits ^ lowest
                if not bits:
                    high ^= 1 << block
            fresh = []
            if waiting[left] != rank:
                continue  # stale: one of the two parts has been merged since
            right = after[left]
            after[left] = end = after[right]
            before[end] = left
            waiting[right] = None
            waiting[left] = rank = rank_of(piece[left : after[end]]) if end < size else None
            if rank is not None:
                fresh.append((left, rank))
            left = before[left]
            if left >= 0:
                waiting[left] = rank = rank_of(piece[left:end])
                if rank is not None:
                    fresh.append((left, rank))
        ids, i = [], 0
        while i < size:
            ids.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return ids

    def merge_all(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of many pieces with one queue over all of them.

        The pieces lie one after another and no pair crosses a border, so the lowest rank of
        the whole queue is also the lowest of every piece that waits for it, and a bucket can
        be merged at once: in a run of overlapping pairs every second one, from the left. Only
        if a merge opens a pair of lower rank, the order inside its piece matters; such a
        piece is left to merge().
        """
        firsts = np.cumsum([0] + [len(p) for p in pieces])
        size = int(firsts[-1])
        data = np.frombuffer(b"".join(pieces), np.uint8)
        part = self.byte_ids[data]
        after = np.arange(1, size + 2)
        before = np.arange(-1, size)
        is_first = np.zeros(size + 1, bool)
        is_first[firsts] = True
        waiting = np.full(size + 1, -1)
        inside = np.flatnonzero(~is_first[1:size])
        waiting[inside] = self.pair_ranks(part[inside], part[inside + 1])
        apart = np.zeros(len(pieces), bool)
        buckets: dict[int, list[np.ndarray]] = {}
        low: dict[int, int] = {}
        high = 0
        fresh = inside[waiting[inside] >= 0]
        while True:
            if len(fresh):
                ranks = waiting[fresh]
                order = np.argsort(ranks, kind="stable")
                fresh, ranks = fresh[order], ranks[order]
                cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
                for rank, places in zip(
                    ranks[np.append(0, cuts)].tolist(), np.split(fresh, cuts), strict=True
                ):
                    if rank in buckets:
                        buckets[rank].append(places)
                    else:
                        buckets[rank] = [places]
                        block = rank >> 8
                        low[block] = low.get(block, 0) | 1 << (rank & 255)
                        high |= 1 << block
            if not high:
                break
            block = (high & -high).bit_length() - 1
            lowest = low[block] & -low[block]
            rank = block << 8 | lowest.bit_length() - 1
            places = buckets.pop(rank)
            low[block] ^= lowest
            if not low[block]:
                high ^= 1 << block
            left = places[0] if len(places) == 1 else np.unique(np.concatenate(places))
            left = left[waiting[left] == rank]  # the others are stale
            fresh = left[:0]
            if not len(left):
                continue
            if len(left) > 1:
                begins = np.append(True, after[left[:-1]] != left[1:])
                index = np.arange(len(left))
                left = left[(index - np.maximum.accumulate(np.where(begins, index, 0))) % 2 == 0]
            right = after[left]
            end = after[right]
            after[left] = end
            before[end] = left
            part[left] = rank
            waiting[right] = waiting[left] = -1
            follow = left[~is_first[end]]
            waiting[follow] = self.pair_ranks(part[follow], part[after[follow]])
            lead = before[left[~is_first[left]]]
            waiting[lead] = self.pair_ranks(part[lead], part[after[lead]])
            fresh = np.unique(np.concatenate([follow, lead]))
            fresh = fresh[waiting[fresh] >= 0]
            back = fresh[waiting[fresh] < rank]
            if len(back):
                apart[np.searchsorted(firsts, back, "right") - 1] = True
        after = after.tolist()
        ids = part.tolist()
        result = []
        for piece, first, last, alone in zip(
            pieces, firsts.tolist(), firsts[1:].tolist(), apart.tolist(), strict=False
        ):
            if alone:
                result.append(tuple(self.merge(piece)))
                continue
            whole = self.ranks.get(piece)
            if whole is not None:
                result.append((whole,))
                continue
            found, i = [], first
            while i < last:
                found.append(ids[i])
                i = after[i]
            result.append(tuple(found))
        return result

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that two neighbouring tokens make, or -1."""
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_values[at], -1)

    def forget(self) -> None:
        """Drop all pieces seen so far."""
        self.recent: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.held = 0

    def learn(self, pieces: set[str]) -> None:
        """Remember the ids of pieces, in two generations of about CACHE_BYTES each."""
        if self.held >= CACHE_BYTES:
            self.older, self.recent, self.held = self.recent, {}, 0
        unknown = []
        for piece in pieces.difference(self.recent):
            ids = self.older.get(piece)
            if ids is None:
                unknown.append(piece)
            else:
                self.recent[piece] = ids
                self.held += PIECE_BYTES + len(piece) + 8 * len(ids)
        data = [piece.encode() for piece in unknown]
        found = self.merge_all(data) if len(data) >= BULK_PIECES else map(tuple, map(self.merge, data))
        for piece, ids in zip(unknown, found, strict=True):
            self.recent[piece] = ids
            self.held += PIECE_BYTES + len(piece) + 8 * len(ids)

    def encode_all(self, texts: list[str], pattern: str = KNOWN_PATTERN) -> list[list[int]]:
        pieces = [split(text, pattern) for text in texts]
        self.learn(set(chain.from_iterable(pieces)))
        ids_of = self.recent.__getitem__
        return [list(chain.from_iterable(map(ids_of, p))) for p in pieces]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of every code point, as the pattern's own engine sees it."""
    table = np.zeros(0x110000, np.uint8)
    everything = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    for mark, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        for match in regex.finditer(pattern, everything):
            table[ord(match[0][0]) : ord(match[0][-1]) + 1] = mark
    table[0xD800:0xE000] = _OTHER
    return table


def boundaries(text: str) -> np.ndarray:
    """Start of every match of KNOWN_PATTERN, and the end of the text.

    The matches tile the text. One starts where the class changes, except that a single blank
    joins a following run that is no white space, and a run of white space before such a run
    gives up its last character. A contraction is cut out where its apostrophe starts a match.
    """
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    size = len(points)
    kind = _classes()[points]
    start = np.ones(size + 1, bool)
    start[1:size] = kind[1:] != kind[:-1]
    space = kind == _SPACE
    blank = points == 32
    # last white space before other characters: a match of its own or the head of the next
    last = np.flatnonzero(space[:-1] & ~space[1:])
    start[last] = True
    start[last[blank[last]] + 1] = False
    marks = np.flatnonzero(points == 39)
    if len(marks):
        marks = marks[start[marks]]
        for i in marks.tolist():
            tail = text[i + 1 : i + 3]
            if tail in ("re", "ve", "ll"):
                start[i + 1], start[i + 3] = False, True
            elif tail[:1] in ("s", "t", "m", "d") and tail:
                start[i + 1], start[i + 2] = False, True
    return np.flatnonzero(start)


def split(text: str, pattern: str = KNOWN_PATTERN) -> list[str]:
    if not text:
        return []
    if pattern != KNOWN_PATTERN:
        return regex.findall(pattern, text)
    cuts = boundaries(text).tolist()
    return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def encode_documents(
    docs: DataFrame, rank_file: str, pattern: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Rows ``doc_id, token_ids, decoded``: ids of the whole text, and the bytes that decoding
    those ids gives back.

    ``rank_file`` lies on the driver; its lines (one per token of the vocabulary) are sent to
    the tasks, so executors need no copy. No shuffle: each row is encoded where it is read.
    """
    with open(rank_file, "rb") as file:
        lines = docs.sparkSession.sparkContext.broadcast(file.read())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(lines.value)
        gc.disable()  # nothing here makes cycles, and the cache would be walked again and again
        try:
            for part in _chunks(batches):
                ids = coder.encode_all([t or "" for t in part.column(1).to_pylist()], pattern)
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(i) for i in ids], out=offsets[1:])
                flat = np.fromiter(chain.from_iterable(ids), np.int32, int(offsets[-1]))
                columns = [
                    part.column(0),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    pa.array([coder.decode(i) for i in ids], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "token_ids", "decoded"])
        finally:  # also when the reader stops early: workers serve other tasks later
            coder.forget()
            gc.enable()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(encode, SCHEMA)


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of about CHUNK_CHARS of text, at least one row each."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < batch.num_rows:
            done = sizes[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(sizes, done + CHUNK_CHARS)))
            yield batch.slice(first, last - first)
            first = last


@lru_cache(2)
def _coder(lines: bytes) -> ByteBpe:
    return ByteBpe(lines)


def token_digests(encoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of encoded documents."""
    return encoded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
