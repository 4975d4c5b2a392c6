"""Language-model scores by online logistic context mixing, beside a smoothed word model.

A text is its UTF-8 bytes and one end byte (0xFF, which UTF-8 never holds), eight binary decisions
a byte. For each of the orders 0 to 5 a table says how often the next bit was 0 or 1 after the last
bytes and the bits of the byte so far; contexts of order 2 and above are hashed into
``2 ** TABLE_BITS`` places. These counts come from every training document. Each order predicts
the bit; the predictions meet in the logistic domain under weights that a gate chooses (the
longest order with evidence, how much it has, and the number of the bit). The weights are learned
online from every training document: each distinct sequence of six bytes of the whole corpus is
learned once, weighted by how often it occurs. Documents are dealt into ``DOC_SLICES`` slices by a
hash of the text (copies stay together), and a sequence sees the counts without what a slice that
holds it has added on average, rounded up: what only one document says is no evidence. Sequences are dealt by
a hash into at most ``MOST_GROUPS`` groups that learn apart, and their weights are averaged. The same pass learns a
refinement of the mixed probability by the last byte. A text is scored under the mixed and the refined model at once, with a share
that follows, block by block, whichever has predicted this text better so far.

What a byte costs depends on it and the five before it alone, so a task evaluates a sequence of six
bytes once and keeps it in a table of ``2 ** CACHE_BITS`` places. Distinct sequences of a task, with
their numbers, meet those of other tasks in parts by a hash, as many as the corpus has
``SLICE_BYTES``, so a part holds no more of them than that; no text is shuffled to learn. Counts leave a task as
compressed blocks of the tables, and a task that merges them reads one block after the other.

The word model counts lower-cased (A to Z) words and an end token per document; the distinct words
of a slice of documents meet their counts by a join.

Defined results: a null text counts as empty (one token, one byte: the end); a null ``doc_id`` is
learned from; rows that repeat count as often as they occur and get a score each; without any
training document every bit has probability one half and every base score is 0; an empty table gives an
empty result. Scores do not depend on how rows are dealt out.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import byte_table, stored, text_slices, tokens_of

ORDERS = 6
TABLE_BITS = 20
SIZES = (1 << 8, 1 << 16, *([1 << TABLE_BITS] * (ORDERS - 2)))
OFFSETS = np.cumsum((0, *SIZES))
PLACES = int(OFFSETS[-1])
BLOCK_PLACES = 1 << 14
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
CACHE_BITS = 20
NO_GRAM = np.uint64((1 << 64) - 1)

END = b"\xff"
PACK_BYTES = 1 << 20
WORD_BYTES = 1 << 23
PIECE_BYTES = 1 << 20
TRACK_BYTES = 64
TRACK_SHARE = 0.02

LEVELS = np.array([1, 2, 4, 16])
PRIOR = 0.4
STEEPEST = 8.0
LEAST_CHANCE = 1e-6
BUCKETS = 33
REFINED_PRIOR = 32.0
RATE = 0.02
STEP_GRAMS, LEARN_GRAMS = 1 << 12, 1 << 17
SLICE_BYTES, DOC_SLICES = 8_000_000, 64
MOST_GROUPS, GROUP_GRAMS = 96, 1 << 20
WAITING_GRAMS = 1 << 20

WORD = r"[^\x20\x09-\x0D]+"
IN_WORD = byte_table([*range(9, 14), 32])
END_TOKEN = " "  # no word holds a space


def held_out(doc_id: str) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


# ---------------------------------------------------------------------------------------------
# sequences of six bytes


def pieces(texts: Iterable[bytes]) -> Iterator[tuple[int, bytes, bytes]]:
    """Number of the text, the bytes before the piece, and the piece: texts with their end byte, cut
    so that no piece is longer than PIECE_BYTES."""
    for number, text in enumerate(texts):
        whole = text + END
        for a in range(0, len(whole), PIECE_BYTES):
            yield number, whole[max(0, a - ORDERS + 1) : a], whole[a : a + PIECE_BYTES]


def packs(texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Grams of some pieces, the pieces' lengths, and the number of each piece's text."""
    parts, sizes, numbers, total = [], [], [], 0
    for number, before, piece in pieces(texts):
        parts.append((before, piece))
        sizes.append(len(piece))
        numbers.append(number)
        total += len(piece)
        if total >= PACK_BYTES:
            yield grams(parts), np.array(sizes), np.array(numbers)
            parts, sizes, numbers, total = [], [], [], 0
    if parts:
        yield grams(parts), np.array(sizes), np.array(numbers)


def grams(parts: list[tuple[bytes, bytes]]) -> np.ndarray:
    """For every byte of the pieces: it and the five before it as one number, zeros at the start."""
    back = ORDERS - 1
    data = b"\0\0" + b"".join(before.rjust(back, b"\0") + piece for before, piece in parts)
    count = len(data) - 7
    read = np.ndarray((count,), dtype=">u8", buffer=data, strides=(1,)).astype(np.uint64)
    sizes = np.array([len(piece) for _, piece in parts])
    own = np.ones(count + back, bool)
    begins = np.cumsum(sizes + back) - (sizes + back)
    own[begins[:, None] + np.arange(back)] = False
    return read[own[back:]] & np.uint64((1 << 8 * ORDERS) - 1)


def hashed(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys * MULTIPLIER) >> np.uint64(64 - bits)).astype(np.int64)


def decisions(found: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each bit of the last byte: its number, its value, and a place in each order's table."""
    byte = found & np.uint64(255)
    for j in range(8):
        node = (byte >> np.uint64(8 - j)) | np.uint64(1 << j)
        bit = ((byte >> np.uint64(7 - j)) & np.uint64(1)).astype(np.int64)
        places = np.empty((ORDERS, len(found)), np.int64)
        places[0] = node
        for k in range(1, ORDERS):
            context = (found >> np.uint64(8)) & np.uint64((1 << 8 * k) - 1)
            key = (context << np.uint64(8)) | node
            places[k] = (key if k == 1 else hashed(key, TABLE_BITS)).astype(np.int64) + OFFSETS[k]
        yield j, bit, places


Grams = tuple[np.ndarray, np.ndarray, np.ndarray]


def distinct_grams(texts: list[bytes], slices: np.ndarray) -> Iterator[Grams]:
    """Distinct sequences of a pack, ascending, how often they occur, and a bit for each slice of
    documents that holds them."""
    for keys, sizes, numbers in packs(texts):
        keys = (keys << np.uint64(6)) | np.repeat(slices[numbers].astype(np.uint64), sizes)
        keys.sort()
        found = keys >> np.uint64(6)
        begins = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
        times = np.diff(np.append(begins, len(keys)))
        yield found[begins], times, np.bitwise_or.reduceat(np.uint64(1) << (keys & np.uint64(63)), begins)


def added_up(some: list[Grams]) -> Grams:
    found, times, held = (np.concatenate(x) for x in zip(*some, strict=True))
    order = np.argsort(found, kind="stable")  # runs in order merge
    found = found[order]
    begins = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
    return found[begins], np.add.reduceat(times[order], begins), np.bitwise_or.reduceat(held[order], begins)


class Gatherer:
    """Adds up distinct sequences; what waits is bounded, or by what is added up already."""

    def __init__(self) -> None:
        self.some: list[Grams] = []
        self.waiting = 0

    def add(self, more: Grams) -> None:
        self.some.append(more)
        self.waiting += len(more[0])
        if self.waiting >= max(WAITING_GRAMS, len(self.some[0][0])):
            self.some, self.waiting = [added_up(self.some)], 0

    def total(self) -> Grams:
        return added_up(self.some) if len(self.some) > 1 else self.some[0]


def gram_batch(part: int, grams: Grams) -> pa.RecordBatch:
    """A row of sequences in order: their differences, numbers and slices, compressed."""
    found, times, held = grams
    packed = [zlib.compress(x.tobytes(), 1) for x in (np.diff(found, prepend=np.uint64(0)), times, held)]
    columns = [pa.array([part], pa.int32()), pa.array([len(found)], pa.int64()), *[pa.array([x], pa.binary()) for x in packed]]
    return pa.RecordBatch.from_arrays(columns, ["part", "size", "grams", "times", "held"])


def grams_in(batch: pa.RecordBatch) -> Iterator[tuple[int, Grams]]:
    for n, part in enumerate(batch.column("part").to_pylist()):
        packed = [zlib.decompress(batch.column(c)[n].as_py()) for c in ("grams", "times", "held")]
        found, times, held = (np.frombuffer(x, t) for x, t in zip(packed, (np.uint64, np.int64, np.uint64), strict=True))
        yield part, (np.cumsum(found, dtype=np.uint64), times, held)


GRAMS = "part int, size long, grams binary, times binary, held binary"


def corpus_grams(rows: DataFrame, parts: int) -> DataFrame:
    """The distinct sequences of all ``slice, text`` (binary), a row for each part by their hash."""

    def leave(grams: Grams) -> Iterator[pa.RecordBatch]:
        dealt = hashed(grams[0], 32) % parts
        order = np.argsort(dealt, kind="stable")
        ends = np.cumsum(np.bincount(dealt, minlength=parts))
        for part in np.unique(dealt).tolist():
            own = order[ends[part - 1] if part else 0 : ends[part]]
            yield gram_batch(part, tuple(x[own] for x in grams))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Gatherer()
        for batch in text_slices(batches, PACK_BYTES):
            texts, slices = batch.column("text").to_pylist(), batch.column("slice").to_numpy()
            for grams in distinct_grams(texts, slices):
                held.add(grams)
                if len(held.some) == 1 and len(held.some[0][0]) >= WAITING_GRAMS:
                    yield from leave(held.total())
                    held = Gatherer()
        if held.some:
            yield from leave(held.total())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = Gatherer(), None
        for batch in batches:
            for part, grams in grams_in(batch):
                if held.some and part != number:
                    yield gram_batch(number, held.total())
                    held = Gatherer()
                number = part
                held.add(grams)
        if held.some:
            yield gram_batch(number, held.total())

    gathered = rows.select("slice", "text").mapInArrow(gather, GRAMS)
    return gathered.repartition("part").sortWithinPartitions("part").mapInArrow(merge, GRAMS)


# ---------------------------------------------------------------------------------------------
# counts


class Counter:
    """Bit counts of all orders."""

    def __init__(self) -> None:
        self.counts = np.zeros(2 * PLACES, np.int64)

    def add(self, texts: Iterable[bytes]) -> None:
        texts = list(texts)
        for found, times, _ in distinct_grams(texts, np.zeros(len(texts), np.int64)):
            self.add_grams(found, times)

    def add_grams(self, keys: np.ndarray, n: np.ndarray) -> None:
        step = 1 << 17
        for a in range(0, len(keys), step):
            for _, bit, places in decisions(keys[a : a + step]):
                for own in places:
                    np.add.at(self.counts, bit * PLACES + own, n[a : a + step])

    def blocks(self) -> Iterator[tuple[int, bytes]]:
        table = self.counts.reshape(2, PLACES)
        for number in range(-(-PLACES // BLOCK_PLACES)):
            block = table[:, number * BLOCK_PLACES : (number + 1) * BLOCK_PLACES]
            if block.any():
                yield number, zlib.compress(block.tobytes(), 1)


BLOCKS = "block int, numbers binary"


def _block_batch(found: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([b for b, _ in found], pa.int32()), pa.array([n for _, n in found], pa.binary())], ["block", "numbers"]
    )


def _texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    return [(value.as_py() or "").encode() for value in batch.column(column)]


def context_counts(docs: DataFrame, text: str) -> list[tuple[int, bytes]]:
    """Blocks of the tables over all rows of ``docs``, compressed."""
    rows = docs.select(F.lit(0).alias("slice"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    return gram_counts(corpus_grams(rows, 1))


def gram_counts(grams: DataFrame) -> list[tuple[int, bytes]]:
    """Blocks of the tables over all rows of ``corpus_grams``, compressed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, some = Counter(), False
        for batch in batches:
            for _, (found, times, _) in grams_in(batch):
                counter.add_grams(found, times)
                some = True
        if some:
            yield _block_batch(list(counter.blocks()))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, numbers in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                more = np.frombuffer(zlib.decompress(numbers.as_py()), np.int64)
                sums[block] = sums[block] + more if block in sums else more
        if sums:
            yield _block_batch([(block, zlib.compress(total.tobytes(), 6)) for block, total in sorted(sums.items())])

    counted = grams.mapInArrow(count, BLOCKS)
    merged = counted.repartition("block").mapInArrow(merge, BLOCKS)
    return sorted((r.block, bytes(r.numbers)) for r in merged.collect())


def read_counts(blocks: list[tuple[int, bytes]]) -> np.ndarray:
    table = np.zeros((2, PLACES), np.int64)
    for number, numbers in blocks:
        own = np.frombuffer(zlib.decompress(numbers), np.int64).reshape(2, -1)
        table[:, number * BLOCK_PLACES : number * BLOCK_PLACES + own.shape[1]] = own
    return table


# ---------------------------------------------------------------------------------------------
# prediction


def evidence(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logistic prediction of a one, and how much stands behind it (0: nothing, to 4)."""
    total = zeros + ones
    chance = (ones + PRIOR) / (total + 2 * PRIOR)
    push = np.clip(np.log(chance / (1 - chance)), -STEEPEST, STEEPEST).astype(np.float32)
    return push, np.searchsorted(LEVELS, total, side="right").astype(np.uint8)


def gate_of(levels: np.ndarray, j: int) -> np.ndarray:
    """Number of the weight set: the longest order with evidence, its level, the bit."""
    longest = ORDERS - 1 - (levels[::-1] > 0).argmax(0)
    level = np.maximum(levels[longest, np.arange(levels.shape[1])].astype(np.int64), 1) - 1
    return (longest * len(LEVELS) + level) * 8 + j


def cell_of(mixed: np.ndarray, previous: np.ndarray, j: int) -> np.ndarray:
    """Place of the refined probability: bit, byte before, bucket of the mixed prediction."""
    bucket = np.rint((np.clip(mixed, -STEEPEST, STEEPEST) + STEEPEST) * ((BUCKETS - 1) / (2 * STEEPEST)))
    return (j * 256 + previous) * BUCKETS + bucket.astype(np.int64)


def chance_of(push: np.ndarray) -> np.ndarray:
    return np.clip(1 / (1 + np.exp(-push)), LEAST_CHANCE, 1 - LEAST_CHANCE)


class Mixer:
    """Weights and refinement; learns from one set of sequences after the other."""

    def __init__(self) -> None:
        self.weights = np.full((ORDERS * len(LEVELS) * 8, ORDERS), 0.25)
        self.steps = np.full(self.weights.shape, 1e-8)
        middle = np.linspace(-STEEPEST, STEEPEST, BUCKETS)
        start = np.tile(chance_of(middle), 8 * 256)
        self.cells = np.stack([REFINED_PRIOR * start, np.full(len(start), REFINED_PRIOR)])
        self.seen = np.zeros(len(self.weights))

    def learn(self, table: np.ndarray, text: bytes, refine: bool) -> None:
        """Learn from a text, whose sequences see no evidence that it has added itself."""
        for found, times, _ in distinct_grams([text], np.zeros(1, np.int64)):
            self.learn_grams(table, found, times, times, refine)

    def learn_grams(self, table: np.ndarray, grams: np.ndarray, times: np.ndarray, own: np.ndarray, refine: bool = True) -> None:
        """Learn from distinct sequences that occur ``times`` times, a step per STEP_GRAMS of them,
        with ``own`` taken out of the counts."""
        parts = -(-len(grams) // LEARN_GRAMS)
        for part in range(parts):  # every part and step sees sequences of all kinds
            found, n, less = (x[part::parts] for x in (grams, times, own))
            steps = max(1, len(found) // STEP_GRAMS)
            previous = ((found >> np.uint64(8)) & np.uint64(255)).astype(np.int64)
            for j, bit, places in decisions(found):
                inputs, levels = self._without(table, places, bit, less)
                gate = gate_of(levels, j)
                for first in range(steps):
                    some = slice(first, None, steps)
                    mixed = self._step(gate[some], inputs[:, some], bit[some], n[some])
                if steps > 1:
                    mixed = self._mixed(gate, inputs)
                if refine:
                    cell = cell_of(mixed, previous, j)
                    self.cells[0] += np.bincount(cell, bit * n, len(self.cells[0]))
                    self.cells[1] += np.bincount(cell, n, len(self.cells[1]))

    def _mixed(self, gate: np.ndarray, inputs: np.ndarray) -> np.ndarray:
        mixed = np.zeros(len(gate))
        for k in range(ORDERS):
            mixed += self.weights[gate, k] * inputs[k]
        return mixed

    def _step(self, gate: np.ndarray, inputs: np.ndarray, bit: np.ndarray, n: np.ndarray) -> np.ndarray:
        mixed = self._mixed(gate, inputs)
        missed = (bit - chance_of(mixed)) * n
        seen = np.bincount(gate, n, len(self.weights))
        slope = np.stack([np.bincount(gate, missed * one, len(self.weights)) for one in inputs], axis=1)
        some = seen > 0
        slope = slope[some] / seen[some, None]
        self.steps[some] += slope * slope
        self.weights[some] += RATE * slope / np.sqrt(self.steps[some])
        self.seen += seen
        return mixed

    @staticmethod
    def _without(table: np.ndarray, places: np.ndarray, bit: np.ndarray, less: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Evidence of each order, without what the sequences' own slices have added to the counts."""
        inputs, levels = np.empty(places.shape, np.float32), np.empty(places.shape, np.uint8)
        for k, own in enumerate(places):
            zeros = np.maximum(table[0, own] - less * (1 - bit), 0)
            inputs[k], levels[k] = evidence(zeros, np.maximum(table[1, own] - less * bit, 0))
        return inputs, levels

    def refined(self) -> np.ndarray:
        return np.clip(self.cells[0] / self.cells[1], LEAST_CHANCE, 1 - LEAST_CHANCE)


class Model:
    """Counts, weights and refinement, ready to score."""

    def __init__(self, blocks: list[tuple[int, bytes]], weights: np.ndarray, refined: np.ndarray) -> None:
        self.push, self.level = np.zeros(PLACES, np.float32), np.zeros(PLACES, np.uint8)
        for number, numbers in blocks:
            zeros, ones = np.frombuffer(zlib.decompress(numbers), np.int64).reshape(2, -1)
            own = slice(number * BLOCK_PLACES, number * BLOCK_PLACES + len(ones))
            self.push[own], self.level[own] = evidence(zeros, ones)
        self.weights, self.refined = weights, refined
        self.known = np.full(1 << CACHE_BITS, NO_GRAM)
        self.costs = np.zeros((2, 1 << CACHE_BITS))

    def evaluate(self, found: np.ndarray) -> np.ndarray:
        """Natural logarithm of the last byte's probability, mixed and refined."""
        costs = np.zeros((2, len(found)))
        step = 1 << 15
        for a in range(0, len(found), step):
            some = found[a : a + step]
            previous = ((some >> np.uint64(8)) & np.uint64(255)).astype(np.int64)
            for j, bit, places in decisions(some):
                mixed = np.zeros(len(some))
                gate = gate_of(self.level[places], j)
                for k in range(ORDERS):
                    mixed += self.weights[gate, k] * self.push[places[k]]
                for way, one in enumerate((chance_of(mixed), self.refined[cell_of(mixed, previous, j)])):
                    costs[way, a : a + step] += np.log(np.where(bit == 1, one, 1 - one))
        return costs

    def costs_of(self, keys: np.ndarray) -> np.ndarray:
        at = hashed(keys, CACHE_BITS)
        costs = self.costs[:, at]
        missed = np.flatnonzero(self.known[at] != keys)
        if len(missed):
            found, place = np.unique(keys[missed], return_inverse=True)
            fresh = self.evaluate(found)
            costs[:, missed] = fresh[:, place.ravel()]
            at = hashed(found, CACHE_BITS)
            at, last = np.unique(at[::-1], return_index=True)
            self.known[at] = found[::-1][last]
            self.costs[:, at] = fresh[:, ::-1][:, last]
        return costs

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Natural logarithm of each text's probability."""
        sums, lengths = [], np.zeros(len(texts), np.int64)
        for keys, sizes, numbers in packs(texts):
            costs = self.costs_of(keys)
            blocks = -(-sizes // TRACK_BYTES)
            np.add.at(lengths, numbers, blocks)
            piece = np.repeat(np.cumsum(sizes) - sizes, blocks)
            within = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            sums.append(np.add.reduceat(costs, piece + within * TRACK_BYTES, axis=1))
        return track(np.concatenate(sums, axis=1), lengths) if sums else np.zeros(0)


def track(sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Logarithm of each text's probability from the two models' blocks: the share of a model is
    its posterior after every block, moved a little towards one half."""
    order = np.argsort(-lengths, kind="stable")
    begins = (np.cumsum(lengths) - lengths)[order]
    ranked = lengths[order]
    total, share = np.zeros(len(lengths)), np.full(len(lengths), 0.5)
    for b in range(int(ranked.max(initial=0))):
        active = int(np.searchsorted(-ranked, -b, side="left"))
        one = np.log(share[:active]) + sums[0, begins[:active] + b]
        two = np.log1p(-share[:active]) + sums[1, begins[:active] + b]
        both = np.logaddexp(one, two)
        total[:active] += both
        share[:active] = np.exp(one - both) * (1 - TRACK_SHARE) + TRACK_SHARE / 2
    result = np.empty(len(lengths))
    result[order] = total
    return result


# ---------------------------------------------------------------------------------------------
# Spark jobs


def training_slices(docs: DataFrame) -> tuple[DataFrame, int]:
    """Every training document as ``slice, text``, and the parts its sequences are dealt into. Slices
    follow from the texts alone, not from how rows are dealt; equal texts are in one slice."""
    rows = docs.filter("NOT held").select(
        F.pmod(F.col("mark"), F.lit(DOC_SLICES)).cast("int").alias("slice"), F.col("text").cast("binary").alias("text")
    )
    total = rows.agg(F.coalesce(F.sum(F.length("text").cast("long")), F.lit(0))).first()[0]
    return rows, max(1, -(-total // SLICE_BYTES))


def fit(docs: DataFrame) -> bytes:
    """A model of ``doc_id, text, mark, held``, learned from all rows that are not held out.

    Each group of sequences is learned online from the same start; the weights of a gate are
    averaged by what the groups saw of it, the refinement's counts add up."""
    spark = docs.sparkSession
    grams = stored(corpus_grams(*training_slices(docs)), "lm-grams")
    blocks = gram_counts(grams)
    sent = spark.sparkContext.broadcast(blocks)
    total = grams.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    groups = min(MOST_GROUPS, max(1, -(-total // GROUP_GRAMS)))
    group = F.pmod(F.col("part"), F.lit(groups)).alias("slice")
    dealt = grams.select(group, "part", "grams", "times", "held").repartition(groups, "slice")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, mixer, number = None, Mixer(), None

        def learned() -> pa.RecordBatch:
            found = [zlib.compress(x.tobytes(), 1) for x in (mixer.weights, mixer.seen, mixer.cells - Mixer().cells)]
            columns = [pa.array([number], pa.int32()), *[pa.array([x], pa.binary()) for x in found]]
            return pa.RecordBatch.from_arrays(columns, ["slice", "weights", "seen", "cells"])

        for batch in batches:
            for own, (_, (found, times, held)) in zip(batch.column("slice").to_pylist(), grams_in(batch), strict=True):
                if own != number:
                    if number is not None:
                        yield learned()
                    table = read_counts(sent.value) if table is None else table
                    mixer, number = Mixer(), own
                mixer.learn_grams(table, found, times, -(-times // np.bitwise_count(held)))
        if number is not None:
            yield learned()

    ordered = dealt.sortWithinPartitions("slice", "part")
    found = ordered.mapInArrow(learn, "slice int, weights binary, seen binary, cells binary").collect()
    mixer = Mixer()
    start, weighted, seen = mixer.weights, np.zeros(mixer.weights.shape), np.zeros(len(mixer.weights))
    for row in sorted(found, key=lambda r: r.slice):
        weights, own, cells = (np.frombuffer(zlib.decompress(x)) for x in (row.weights, row.seen, row.cells))
        weighted += own[:, None] * weights.reshape(start.shape)
        seen += own
        mixer.cells += cells.reshape(mixer.cells.shape)
    weights = np.where(seen[:, None] > 0, weighted / np.maximum(seen, 1)[:, None], start)
    refined = mixer.refined()
    return pickle.dumps((blocks, weights, refined))


def score_texts(docs: DataFrame, model: bytes) -> DataFrame:
    """Rows ``doc_id, mark, held, tokens, n_bytes, score``: one per row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, mark long, held boolean, tokens long, n_bytes long, score double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Model(*pickle.loads(sent.value))
        for part in text_slices(batches, PACK_BYTES):
            texts = _texts(part)
            score = scorer.score(texts) / np.log(10)
            columns = [part.column(c) for c in ("doc_id", "mark", "held", "tokens")]
            lengths = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*columns, lengths, pa.array(score)], ["doc_id", "mark", "held", "tokens", "n_bytes", "score"]
            )

    return docs.mapInArrow(score, schema)


def word_rows(docs: DataFrame) -> DataFrame:
    """Rows ``slice, token, trained, rows, times, ids, marks``: the distinct words of a slice of the
    documents, with the numbers of the rows that hold one and how often; ``trained`` adds up the
    rows that are learned from. The end token of a slice also lists ``doc_id`` and ``mark`` of each
    row. A slice is named after its task and place, which a repeated task gives again."""
    schema = pa.schema(
        [("slice", pa.int64()), ("token", pa.string()), ("trained", pa.int64()), ("rows", pa.list_(pa.int32()))]
        + [("times", pa.list_(pa.int32())), ("ids", pa.list_(pa.int64())), ("marks", pa.list_(pa.int64()))]
    )

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(text_slices(batches, WORD_BYTES)):
            count, learned = batch.num_rows, ~batch.column("held").to_numpy(zero_copy_only=False)
            found, begins = tokens_of(batch.column("text"), IN_WORD)
            coded = found.dictionary_encode()
            key = coded.indices.to_numpy().astype(np.int64) * count + np.repeat(np.arange(count), np.diff(begins))
            own, times = np.unique(key, return_counts=True)
            word, row = own // count, own % count
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(own) else np.zeros(0, np.int64)
            trained = np.add.reduceat(times * learned[row], starts) if len(own) else np.zeros(0, np.int64)
            ends = pa.array(np.append(starts, len(own)), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (row, times)]
            nothing = pa.ListArray.from_arrays(pa.array(np.zeros(len(starts) + 1), pa.int32()), pa.array([], pa.int64()))
            columns = [pa.array(np.full(len(starts), first + number)), coded.dictionary, pa.array(trained), *lists]
            yield pa.RecordBatch.from_arrays([*columns, nothing, nothing], schema=schema)
            end = {"slice": first + number, "token": END_TOKEN, "trained": int(learned.sum()), "rows": range(count)}
            end |= {"times": [1] * count, "ids": batch.column("doc_id").to_pylist(), "marks": batch.column("mark").to_pylist()}
            yield pa.RecordBatch.from_pylist([end], schema)

    columns = "slice long, token string, trained long, rows array<int>, times array<int>, ids array<long>, marks array<long>"
    return docs.select("doc_id", "mark", "held", "text").mapInArrow(words, columns)


def known_words(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """``doc_id, mark, known, logs`` (words with a count, the logarithms of the counts plus one), once
    for equal rows, and the numbers of training tokens and of distinct ones.

    Words meet their counts once per slice, however many of its documents hold them, so a word
    has few rows and no key is hot. The smaller side, one row per distinct word, is hashed."""
    rows = word_rows(docs)
    counts = rows.filter("trained > 0").groupBy("token").agg(F.sum("trained").alias("count"))
    counts = stored(counts, "lm-words")
    total, distinct = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count(F.lit(1))).first()
    ends = F.col("token") == END_TOKEN  # keeps its rows without any training document too
    met = rows.drop("trained").join(counts.hint("shuffle_hash"), "token", "left").filter(F.col("count").isNotNull() | ends)
    each = F.arrays_zip("rows", "times", "ids", "marks")
    met = met.select("slice", "count", F.explode(each).alias("e")).select(
        "slice", "count", "e.rows", "e.times", "e.ids", "e.marks"
    )
    times = F.when(F.col("count").isNotNull(), F.col("times")).otherwise(0)
    met = met.groupBy("slice", "rows").agg(
        F.max("ids").alias("doc_id"),
        F.max("marks").alias("mark"),
        F.sum(times).alias("known"),
        F.sum(F.col("times") * F.log10(F.coalesce("count", F.lit(0)) + 1)).alias("logs"),
    )
    return met.drop("slice", "rows").dropDuplicates(["doc_id", "mark"]), total, distinct


def scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes,
    bits_per_byte``."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        held_out(doc_id).alias("held"),
    ).withColumn("mark", F.xxhash64("text"))
    model = fit(rows)
    words = F.regexp_count("text", F.lit(WORD)).cast("long") + 1
    scored = stored(score_texts(rows.withColumn("tokens", words), model), "lm-scores")
    met, total, distinct = known_words(rows)
    met = met.select(F.col("doc_id").alias("id"), F.col("mark").alias("own"), "known", "logs")
    both = scored.join(met, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("own")), "left")
    known = F.coalesce("known", F.lit(0))
    below = F.log10(F.lit(float(total + distinct + 1)))
    base = F.coalesce("logs", F.lit(0.0)) - F.col("tokens") * below
    bits = -F.col("score") * float(np.log2(10)) / (F.col("n_bytes") + 1)
    return both.select(
        "doc_id",
        F.col("held").alias("held_out"),
        F.col("tokens").alias("n_tokens"),
        known.alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
        "n_bytes",
        bits.alias("bits_per_byte"),
    )
