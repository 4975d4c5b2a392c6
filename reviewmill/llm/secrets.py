"""Secret scans: fixed patterns, and a battery of randomness tests on everything token-like.

Patterns find assignments to secret-sounding names, access keys and hexadecimal digests; these
spans are always kept. The method adds tokens that look drawn at random. A candidate is a run
of 20 or more token characters outside the pattern spans. Its encoding is inferred from its
characters (decimal, hexadecimal, base32, base36, base62, base64), and three tests ask whether
it could be uniform over that alphabet: chi-squared of the symbol counts (with its exact mean
and variance, as short tokens have few counts per symbol), runs above and below the middle of
the alphabet, and serial correlation of neighbours. Fisher's method combines them.

Being random is no proof: the alternative is text, which passes the battery at times if it is
short. So the combined statistic is held against its distribution over the text of all documents:
the token characters of each document's ordinary words, cut into stretches of the least length of
each class of lengths. The share of stretches that look at least as random is a candidate's p-value
for "this is text". Benjamini and Hochberg's rule is applied to these within classes of length, so
the many short candidates don't pay for the few long ones and the other way round: a span is
added if text is rejected at FALSE_SHARE. A token whose character pairs are those of the corpus
(at PAIR_LEVEL) is not added, whatever the battery says. A share below one of the stretches can't be
told, so a corpus of a few texts adds little, and short candidates are added only where many are.

Pair counts and the histograms cover all documents and have a fixed size.

Defined results: null counts as the empty text, which has no spans; spans count code points,
the end is exclusive; repeated rows are scanned each by itself; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import stored, text_slices

KINDS = ("assign", "access", "hex", "random")
LEAST_CHARS = 20
LENGTHS = (20, 28, 40, 64, 128)
FALSE_SHARE = 0.01
PAIR_LEVEL = 0.001
RANDOM_BINS = 1_000
TEXT_BYTES = 1 << 20
STEP = 1 << 18
BINS = 1_200
BINS_PER_DECADE = 20

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ASSIGN_HINTS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}")

_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = {
    "decimal": _DIGITS,
    "hex": _DIGITS + "abcdef",
    "hex_upper": _DIGITS + "ABCDEF",
    "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER,
    "base36_upper": _DIGITS + _UPPER,
    "base62": _UPPER + _LOWER + _DIGITS,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
    "any": _UPPER + _LOWER + _DIGITS + "+/-_",
}
_PLACES = {name: {c: i for i, c in enumerate(letters)} for name, letters in ENCODINGS.items()}
_SETS = {name: frozenset(letters) for name, letters in ENCODINGS.items()}

SYMBOLS = ENCODINGS["any"]
OTHER = len(SYMBOLS)
SPAN = "array<struct<kind:string,start:int,end:int,p_text:double,p_random:double>>"


def infer_encoding(token: str) -> str:
    """The smallest alphabet that holds the token."""
    used = set(token)
    return next(name for name, letters in _SETS.items() if used <= letters)


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def uniformity(values: np.ndarray, size: int) -> float:
    """p-value of the chi-squared statistic, standardized by its exact moments."""
    n = len(values)
    counts = np.bincount(values, minlength=size)
    statistic = float((counts * counts).sum()) * size / n - n
    spread = math.sqrt(2 * (size - 1) * (n - 1) / n)
    return _two_sided((statistic - (size - 1)) / spread)


def runs(values: np.ndarray, size: int) -> float:
    """p-value of the number of runs in the upper and lower half of the alphabet."""
    upper = values * 2 >= size
    n, ups = len(values), int(upper.sum())
    downs = n - ups
    if not ups or not downs:
        return 2.0 ** (1 - n)
    count = 1 + int((upper[1:] != upper[:-1]).sum())
    mean = 2 * ups * downs / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    return _two_sided((count - mean) / math.sqrt(variance)) if variance > 0 else 1.0


def serial_correlation(values: np.ndarray) -> float:
    """p-value of the correlation of neighbours."""
    n = len(values)
    centred = values - values.mean()
    power = float((centred * centred).sum())
    if not power:
        return 2.0 ** (1 - n)
    correlation = float((centred[1:] * centred[:-1]).sum()) / power
    return _two_sided((correlation + 1 / n) * math.sqrt(n))


def randomness(token: str) -> float:
    """Combined p-value of the three tests in the token's encoding."""
    name = infer_encoding(token)
    places = _PLACES[name]
    values = np.array([places[c] for c in token])
    tests = (uniformity(values, len(places)), runs(values, len(places)), serial_correlation(values))
    half = -sum(math.log(max(p, 1e-300)) for p in tests)
    return math.exp(-half) * (1 + half + half * half / 2)


# of each symbol: a bit per encoding that holds it, and its place in each
_HOLDERS = np.array([sum(1 << i for i, letters in enumerate(_SETS.values()) if c in letters) for c in SYMBOLS], np.int16)
_PLACE_OF = [np.array([places.get(c, 0) for c in SYMBOLS], np.int16) for places in _PLACES.values()]


def _two_sided_of(z: np.ndarray) -> np.ndarray:
    return np.array([math.erfc(x) for x in (np.abs(z) / math.sqrt(2)).tolist()])


def randomness_of(codes: np.ndarray) -> np.ndarray:
    """``randomness`` of many tokens of one length: rows of symbol numbers."""
    holders = np.bitwise_and.reduce(_HOLDERS[codes], axis=1)
    found = np.ones(len(codes))
    n = codes.shape[1]
    for at, place in enumerate(_PLACE_OF):
        rows = np.flatnonzero((holders & -holders) == 1 << at)
        if not len(rows):
            continue
        values, size = place[codes[rows]], len(list(_PLACES.values())[at])
        counts = np.bincount((np.arange(len(rows))[:, None] * size + values).ravel(), minlength=len(rows) * size)
        statistic = (counts.reshape(-1, size) ** 2).sum(1) * size / n - n
        even = _two_sided_of((statistic - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n))
        upper = values * 2 >= size
        ups = upper.sum(1)
        mean = 2 * ups * (n - ups) / n + 1
        variance = (mean - 1) * (mean - 2) / (n - 1)
        z = (1 + (upper[:, 1:] != upper[:, :-1]).sum(1) - mean) / np.sqrt(np.where(variance > 0, variance, 1))
        turns = np.where(variance > 0, _two_sided_of(z), 1.0)
        turns[(ups == 0) | (ups == n)] = 2.0 ** (1 - n)
        centred = values - values.mean(1, keepdims=True)
        power = (centred * centred).sum(1)
        correlation = (centred[:, 1:] * centred[:, :-1]).sum(1) / np.where(power > 0, power, 1)
        serial = np.where(power > 0, _two_sided_of((correlation + 1 / n) * math.sqrt(n)), 2.0 ** (1 - n))
        half = -sum(np.log(np.maximum(p, 1e-300)) for p in (even, turns, serial))
        found[rows] = np.exp(-half) * (1 + half + half * half / 2)
    return found


def random_bin(p_random: np.ndarray | float) -> np.ndarray:
    return np.minimum(np.asarray(np.asarray(p_random) * RANDOM_BINS, np.int64), RANDOM_BINS - 1)


def length_class(length: int) -> int:
    return sum(length >= n for n in LENGTHS[1:])


_codes = np.full(256, OTHER, np.int64)
_codes[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(OTHER)


def pair_counts(texts: list[str | None]) -> np.ndarray:
    """How often each symbol follows each, over whole texts."""
    codes = _codes[np.frombuffer("\n".join([t or "" for t in texts]).encode(), np.uint8)]
    side = OTHER + 1
    return np.bincount(codes[:-1] * side + codes[1:], minlength=side * side)


def text_randomness(texts: list[str | None]) -> np.ndarray:
    """How random stretches of text look: per class of lengths a histogram of the battery's
    p-value over all stretches of its least length. Runs that could be candidates are no text; what
    remains of a document at its end is shorter than a stretch."""
    encoded = [(t or "").encode() for t in texts]
    codes = _codes[np.frombuffer(b"\n".join([*encoded, b""]), np.uint8)].astype(np.int8)
    inside = codes < OTHER
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    long = edges[1::2] - edges[::2] >= LEAST_CHARS
    within = np.zeros(len(codes) + 1, np.int8)
    within[edges[::2][long]], within[edges[1::2][long]] = 1, -1
    inside &= np.cumsum(within, dtype=np.int8)[:-1] == 0
    ends = np.cumsum([len(t) + 1 for t in encoded])
    kept = np.searchsorted(np.flatnonzero(inside), np.append(0, ends))
    codes, first, sizes = codes[inside], kept[:-1], np.diff(kept)
    total = np.zeros((len(LENGTHS), RANDOM_BINS), np.int64)
    for i, n in enumerate(LENGTHS):
        many = sizes // n
        earlier = np.cumsum(many) - many
        starts = np.repeat(first - earlier * n, many) + np.arange(many.sum()) * n
        step = max(1, STEP // n)
        for a in range(0, len(starts), step):
            p_random = randomness_of(codes[starts[a : a + step, None] + np.arange(n)])
            total[i] += np.bincount(random_bin(p_random), minlength=RANDOM_BINS)
    return total


class TextModel:
    """What text looks like: log probability of a symbol after another, its mean and spread; and
    per class of lengths the share of text that looks at least as random as each bin."""

    def __init__(self, counts: np.ndarray, stretches: np.ndarray) -> None:
        square = counts.reshape(OTHER + 1, OTHER + 1)[:OTHER, :OTHER].astype(np.float64)
        smooth = square + 0.5
        self.log = np.log(smooth / smooth.sum(axis=1, keepdims=True))
        share = square / max(square.sum(), 1)
        self.mean = float((share * self.log).sum())
        # neighbouring pairs share a symbol: their covariance is covered by doubling
        self.spread = math.sqrt(max(2 * float((share * (self.log - self.mean) ** 2).sum()), 1e-9))
        as_random = stretches[:, ::-1].cumsum(axis=1)[:, ::-1]
        self.as_random = (1 + as_random) / (1 + stretches.sum(axis=1, keepdims=True))

    def p_text(self, token: str, p_random: float) -> float:
        """How likely text of this length looks as random; 1 if its pairs are those of text."""
        if self.p_value(token) > PAIR_LEVEL:
            return 1.0
        return float(self.as_random[length_class(len(token)), random_bin(p_random)])

    def p_value(self, token: str) -> float:
        """How likely text of this length is to be as unlikely as the token."""
        codes = _codes[np.frombuffer(token.encode(), np.uint8)]
        steps = self.log[codes[:-1], codes[1:]]
        z = (float(steps.mean()) - self.mean) * math.sqrt(len(steps)) / self.spread
        return 0.5 * math.erfc(-z / math.sqrt(2))


def base_spans(text: str, tokens: list[re.Match]) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the patterns."""
    found = []
    small = text.lower()
    if any(hint in small for hint in _ASSIGN_HINTS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    for token in tokens:  # 32 hexadecimal characters always lie within a token
        found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text, token.start(), token.end())]
    return sorted(found)


def uncovered(first: int, last: int, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The pieces of a stretch that no span ``(start, kind, end)`` covers; spans come by start."""
    pieces = []
    for start, _, end in spans:
        if end > first and start < last:
            if start > first:
                pieces.append((first, start))
            first = max(first, end)
    return [*pieces, (first, last)] if first < last else pieces


def scan(text: str | None, model: TextModel) -> tuple[list[tuple], list[tuple]]:
    """Pattern spans, and candidates outside of them, each as ``(kind, start, end, p_text, p_random)``."""
    text = text or ""
    tokens = list(_TOKEN.finditer(text))
    base = base_spans(text, tokens)
    candidates = []
    for match in tokens:
        for first, last in uncovered(*match.span(), base):
            piece = text[first:last]
            if len(piece) >= LEAST_CHARS:
                p_random = randomness(piece)
                candidates.append(("random", first, last, model.p_text(piece, p_random), p_random))
    return [(KINDS[kind], start, end, None, None) for start, kind, end in base], candidates


def corpus_counts(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """``pair_counts`` and ``text_randomness`` of all documents: each task adds up its own, tables of
    a fixed size."""
    pairs, cells = (OTHER + 1) ** 2, len(LENGTHS) * RANDOM_BINS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(pairs + cells, np.int64)
        for batch in text_slices(batches, TEXT_BYTES):
            texts = batch.column("text").to_pylist()
            total[:pairs] += pair_counts(texts)
            total[pairs:] += text_randomness(texts).ravel()
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(total[filled])], ["cell", "n"])

    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    parts = texts.mapInArrow(count, "cell long, n long")
    total = np.zeros(pairs + cells, np.int64)
    for cell, n in parts.groupBy("cell").agg(F.sum("n")).collect():
        total[cell] = n
    return total[:pairs], total[pairs:].reshape(len(LENGTHS), RANDOM_BINS)


def find_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``doc_id, base, candidates`` with spans as structs; one scan, no shuffle."""
    counts = docs.sparkSession.sparkContext.broadcast(corpus_counts(docs, text))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = TextModel(*counts.value)
        names = ("kind", "start", "end", "p_text", "p_random")
        types = (pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
        kind = pa.list_(pa.struct(list(zip(names, types, strict=True))))
        for batch in batches:
            found = [scan(t.as_py(), model) for t in batch.column(1)]
            columns = [
                pa.array([[dict(zip(names, s, strict=True)) for s in part[i]] for part in found], kind) for i in (0, 1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "base", "candidates"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(find, f"doc_id long, base {SPAN}, candidates {SPAN}")


def _length_class(length: Column) -> Column:
    passed = [F.when(length >= n, 1).otherwise(0) for n in LENGTHS[1:]]
    return sum(passed, F.lit(0))


def _bin(p_value: Column) -> Column:
    return F.least(F.lit(BINS - 1), F.floor(-F.log10(F.greatest(p_value, F.lit(1e-300))) * BINS_PER_DECADE)).cast("int")


def cut_bins(counts: np.ndarray, share: float) -> list[int]:
    """Per length class the first bin (bins hold falling p-values) from which on Benjamini and
    Hochberg's rule rejects; a bin counts with its largest p-value."""
    cuts = []
    for row in counts:
        as_small = row[::-1].cumsum()[::-1]
        largest = 10.0 ** (-np.arange(BINS) / BINS_PER_DECADE)
        passing = np.flatnonzero(largest * row.sum() <= share * as_small)
        cuts.append(int(passing[0]) if len(passing) else BINS)
    return cuts


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``doc_id, base, spans``: the pattern spans, and those with the added ones, by start."""
    found = stored(find_spans(docs, doc_id, text), "secret-spans")
    one = found.select(F.explode("candidates").alias("c"))
    histogram = one.groupBy(_length_class(F.col("c.end") - F.col("c.start")).alias("class"), _bin(F.col("c.p_text")).alias("bin"))
    counts = np.zeros((len(LENGTHS), BINS), np.int64)
    for row in histogram.count().collect():
        counts[row["class"], row["bin"]] = row["count"]
    cuts = F.array(*[F.lit(c) for c in cut_bins(counts, FALSE_SHARE)])
    added = F.filter(
        "candidates",
        lambda c: _bin(c["p_text"]) >= F.get(cuts, _length_class(c["end"] - c["start"])),
    )
    # candidates lie outside the pattern spans, so starts differ between the two
    order = F.array(*[F.lit(k) for k in KINDS])

    def before(a: Column, b: Column) -> Column:
        by_kind = F.array_position(order, a["kind"]) - F.array_position(order, b["kind"])
        return F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(by_kind).cast("int")

    return found.select("doc_id", "base", F.array_sort(F.concat("base", added), before).alias("spans"))


def span_text(spans: str) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def span_digests(found: DataFrame) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS[:3]]
    return found.select(
        "doc_id", *counts, F.sha2(span_text("base"), 256).alias("base_sha256"), span_text("spans").alias("spans")
    )
