"""Language identification with hyperdimensional profiles.

Every letter has a random vector of DIMENSIONS signs, drawn from the letter itself, so that
all tasks agree. A trigram (word ends count as a letter) binds three of them: the first
permuted twice, the second once, the third as it is, multiplied place by place. A text bundles
its trigrams by adding their vectors. A language's prototype bundles the unit vectors of at
most SAMPLE learned documents with a letter, the first in hash order; a text gets the language of the
prototype with the largest cosine.

The model is one vector per language. Scoring has no shuffle and reads whole texts.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every
text if nothing could be learned; equal cosines go to the first language by name; repeated
rows score alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.common import stored
from reviewmill.operators.skew import lookup_join

DIMENSIONS = 1_024
SAMPLE = 400
PARTS = 64
KNOWN_TRIGRAMS = 20_000
UNKNOWN = "und"
_SEED = 20_011
_SHIFT = 21


@lru_cache(1)
def _lower_letters() -> np.ndarray:
    """The lower-case letter of every code point, 0 for all others."""
    table = np.zeros(0x110000, np.int64)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            small = letter.lower()
            table[point] = ord(small) if len(small) == 1 else point
    return table


@lru_cache(50_000)
def letter_vector(letter: int) -> np.ndarray:
    draw = np.random.default_rng([_SEED, letter])
    return (2 * draw.integers(0, 2, DIMENSIONS) - 1).astype(np.int8)


def trigram_vector(code: int) -> np.ndarray:
    first, second, third = code >> 2 * _SHIFT, code >> _SHIFT & (1 << _SHIFT) - 1, code & (1 << _SHIFT) - 1
    return np.roll(letter_vector(first), 2) * np.roll(letter_vector(second), 1) * letter_vector(third)


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct trigrams around each letter, as numbers, and their counts."""
    points = np.frombuffer((text or "").encode("utf-32-le"), np.uint32)
    letters = np.zeros(len(points) + 2, np.int64)
    letters[1:-1] = _lower_letters()[points]
    middle = np.flatnonzero(letters[1:-1])
    codes = (letters[middle] << 2 * _SHIFT) | (letters[middle + 1] << _SHIFT) | letters[middle + 2]
    return np.unique(codes, return_counts=True)


class Encoder:
    """Texts to bundled vectors; vectors of at most KNOWN_TRIGRAMS trigrams are kept."""

    def __init__(self) -> None:
        self._forget()

    def _forget(self) -> None:
        self.codes = np.zeros(0, np.int64)
        self.rows = np.zeros(0, np.int64)
        self.table = np.zeros((KNOWN_TRIGRAMS, DIMENSIONS), np.float32)

    def _learn(self, codes: np.ndarray) -> None:
        first = len(self.codes)
        self.table[first : first + len(codes)] = [trigram_vector(c) for c in codes.tolist()]
        joined = np.concatenate([self.codes, codes])
        rows = np.concatenate([self.rows, np.arange(first, first + len(codes))])
        order = np.argsort(joined)
        self.codes, self.rows = joined[order], rows[order]

    def vector(self, text: str | None) -> np.ndarray | None:
        """The bundle of a text, or None if it has no letter."""
        codes, counts = trigrams(text)
        if not len(codes):
            return None
        total = np.zeros(DIMENSIONS, np.float32)
        # a text may hold more trigrams than are kept at a time
        for first in range(0, len(codes), KNOWN_TRIGRAMS // 2):
            part = slice(first, first + KNOWN_TRIGRAMS // 2)
            rows = self._found(codes[part])  # may replace the table
            total += counts[part].astype(np.float32) @ self.table[rows]
        return total

    def _found(self, codes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.codes, codes)
        inside = at < len(self.codes)
        known = np.zeros(len(codes), bool)
        known[inside] = self.codes[at[inside]] == codes[inside]
        if not known.all():
            if len(self.codes) + int((~known).sum()) > KNOWN_TRIGRAMS:
                self._forget()
                known[:] = False
            self._learn(codes[~known])
            at = np.searchsorted(self.codes, codes)
        return self.rows[at]


def _unit(vector: np.ndarray) -> np.ndarray:
    length = float(np.linalg.norm(vector))
    return vector / length if length else vector


def held_out(doc_id: str) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(
    docs: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> dict[str, np.ndarray]:
    """Prototype of each language, from ``sample`` documents each at most, all with a letter."""
    lettered = docs.filter(F.col(text).rlike(r"\p{L}"))
    ids = lettered.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"))
    usable = ids.filter(~held_out("doc_id") & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
    chosen = usable.withColumn("place", F.xxhash64("doc_id"))
    # first within parts of a language, so that the last step sees PARTS * sample rows of one
    for part in (F.pmod("place", F.lit(PARTS)), F.lit(0)):
        in_order = Window.partitionBy("lang", "part").orderBy("place", "doc_id")
        ranked = chosen.withColumn("part", part).withColumn("rank", F.row_number().over(in_order))
        chosen = ranked.filter(F.col("rank") <= sample).select("doc_id", "lang", "place")
    wanted = stored(chosen.select("doc_id", "lang").distinct(), "language-sample")  # grows with the languages
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    texts = lookup_join(texts, wanted, ["doc_id", "lang"], "left_semi").select("lang", "text")

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, sums = Encoder(), {}
        for batch in batches:
            for name, value in zip(batch["lang"], batch["text"], strict=True):
                vector = encoder.vector(value)
                if vector is not None:
                    sums[name] = sums.get(name, 0) + _unit(vector)
        if sums:
            yield pd.DataFrame({"lang": list(sums), "vector": [v.tolist() for v in sums.values()]})

    # at most one row per task and language, and no more rows than documents in the sample
    parts = texts.mapInPandas(bundle, "lang string, vector array<double>")
    places = parts.select("lang", F.posexplode("vector").alias("place", "value"))
    sums = places.groupBy("lang", "place").agg(F.sum("value").alias("value"))
    vectors = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("v"))
    found = vectors.select("lang", F.transform("v", lambda p: p["value"]).alias("v")).orderBy("lang").collect()
    return {row.lang: _unit(np.array(row.v)) for row in found}


def identify(
    docs: DataFrame, prototypes: dict[str, np.ndarray], doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Rows ``doc_id, lang_pred, score``: the nearest prototype and its cosine (at least 0)."""
    names = list(prototypes)
    matrix = np.array([prototypes[n] for n in names], np.float32).reshape(len(names), DIMENSIONS)
    sent = docs.sparkSession.sparkContext.broadcast(matrix)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for batch in batches:
            langs, scores = [], []
            for value in batch.column(1):
                vector = encoder.vector(value.as_py()) if names else None
                if vector is None:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                cosines = sent.value @ _unit(vector)
                best = int(cosines.argmax())
                langs.append(names[best])
                scores.append(min(1.0, max(0.0, float(cosines[best]))))
            columns = [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(score, "doc_id long, lang_pred string, score double")


def language(docs: DataFrame) -> DataFrame:
    """Rows ``doc_id, held_out, lang_pred, score``."""
    found = identify(docs, learn(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
