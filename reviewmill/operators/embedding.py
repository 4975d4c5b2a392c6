"""Text embeddings: a hashing default, or any encoder in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, FloatType, StructType

VALUES_AT_ONCE = 1 << 20
CHARS_AT_ONCE = 1 << 24
SPACE = re.compile(r"\s")

Encoder = Callable[[list[str]], np.ndarray]


def _places(texts: pa.Array, dimensions: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For some of the words at a time their texts (positions) and places. The MD5 of a word is
    computed once in CHARS_AT_ONCE characters; a longer text comes in parts, cut at white space."""
    for first, part in _parts(texts):
        split = pc.utf8_split_whitespace(part)
        words = split.flatten().dictionary_encode()
        known = words.dictionary.cast(pa.binary()).to_pylist()
        heads = np.frombuffer(b"".join([md5(word).digest()[:4] for word in known]), ">u4")
        text = first + np.repeat(np.arange(len(part)), pc.list_value_length(split).to_numpy())
        codes = words.indices.to_numpy()
        empty = np.array([not word for word in known], dtype=bool)
        some = ~empty[codes]
        yield text[some], (heads.astype("int64") % dimensions)[codes[some]]


def _parts(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Slices of some CHARS_AT_ONCE bytes of text, and where they begin."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(), dtype="int64")
    first = 0
    while first < len(texts):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + CHARS_AT_ONCE, side="right")))
        if ends[last - 1] - done <= CHARS_AT_ONCE:
            yield first, texts.slice(first, last - first)
        else:
            yield from ((first, pa.array([piece])) for piece in _pieces(texts[first].as_py()))
        first = last


def _pieces(text: str) -> Iterator[str]:
    start = 0
    while start < len(text):
        gap = SPACE.search(text, start + CHARS_AT_ONCE) if len(text) - start > CHARS_AT_ONCE else None
        end = gap.start() if gap else len(text)
        yield text[start:end]
        start = end


def embed_hashing(
    df: DataFrame, text: str, row_id: str, dimensions: int = 256, output: str = "embedding"
) -> DataFrame:
    """Unit-length hashed term frequencies; missing text is embedded as empty.

    A token's place is its MD5 modulo ``dimensions``, which any engine can compute. No token is
    a row: the task that reads a text counts its places, so a row with at most ``dimensions``
    counts per text is shuffled. Rows of one ``row_id`` are one text.
    """
    texts = df.select(F.col(row_id), F.make_valid_utf8(F.coalesce(text, F.lit(""))).alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, VALUES_AT_ONCE // dimensions)
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                ids, held = whole.slice(start, step).columns
                n = np.zeros(len(ids) * dimensions, dtype="int64")
                for text, place in _places(held, dimensions):
                    n += np.bincount(text * dimensions + place, minlength=len(n))
                n = n.reshape(len(ids), dimensions)
                row, place = np.nonzero(n)
                pairs = np.stack([place, n[row, place]], axis=1).astype("int32").tobytes()
                ends = np.append(0, np.cumsum(np.count_nonzero(n, axis=1))) * 8
                counts = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(ends.astype("int32")), pa.py_buffer(pairs)])
                yield pa.RecordBatch.from_arrays([ids, counts], [row_id, "_counts"])

    counted_schema = StructType([df.schema[row_id]]).add("_counts", BinaryType())
    counts = texts.mapInArrow(count, counted_schema)
    filled = counts.groupBy(row_id).agg(F.collect_list("_counts").alias("_counts"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, VALUES_AT_ONCE // dimensions)
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                ids, counted = whole.slice(start, step).columns
                texts = np.repeat(np.arange(len(counted)), counted.value_lengths().to_numpy(zero_copy_only=False))
                held = counted.flatten()
                sizes = pc.binary_length(held).to_numpy(zero_copy_only=False) // 8
                place, n = np.frombuffer(b"".join(held.to_pylist()), "int32").reshape(-1, 2).T
                at = np.repeat(texts, sizes) * dimensions + place
                n = np.bincount(at, n, len(counted) * dimensions).reshape(len(counted), dimensions)
                unit = (n / np.maximum(np.sqrt((n * n).sum(axis=1)), 1.0)[:, None]).astype("float32")
                ends = pa.array(np.arange(len(counted) + 1) * dimensions, pa.int32())
                vectors = pa.ListArray.from_arrays(ends, pa.array(unit.ravel()))
                yield pa.RecordBatch.from_arrays([ids, vectors], [row_id, output])

    schema = StructType([df.schema[row_id]]).add(output, ArrayType(FloatType()))
    return filled.mapInArrow(fill, schema)


def embed_batches(
    df: DataFrame,
    text: str,
    row_id: str,
    load_encoder: Callable[[], Encoder],
    batch_size: int = 32,
    output: str = "embedding",
) -> DataFrame:
    """Embed with a model that each task loads once and feeds ``batch_size`` texts at a time."""
    source = df.select(F.col(row_id).cast("long").alias("id"), F.coalesce(text, F.lit("")).alias("t"))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = load_encoder()
        for batch in batches:
            for start in range(0, len(batch), batch_size):
                piece = batch.iloc[start : start + batch_size]
                vectors = np.asarray(encoder(piece["t"].tolist()), dtype="float32")
                yield pd.DataFrame({"id": piece["id"].to_numpy(), output: list(vectors)})

    return source.mapInPandas(encode, f"id long, {output} array<float>").withColumnRenamed(
        "id", row_id
    )
