"""Hooks for code that Spark functions cannot express: taggers, mappers, reducers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Tagger = Callable[[str], list[tuple[str, str, str]]]

TAG_ROWS = 1024
TAG_TOKENS = 1 << 15


def tag_with(
    df: DataFrame, text: str, row_id: str, load_tagger: Callable[[], Tagger]
) -> DataFrame:
    """Token rows ``row_id, token_no, surface, lemma, pos`` from an external tagger that each
    task loads once. Null texts give no tokens. A worker holds the tokens of one text and one
    batch of at most TAG_TOKENS tokens, however many texts an Arrow batch has."""
    source = df.select(F.col(row_id).cast("long").alias("id"), F.col(text).alias("t")).dropna()
    schema = "id long, token_no int, surface string, lemma string, pos string"
    types = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = load_tagger()
        for batch in batches:
            for a in range(0, batch.num_rows, TAG_ROWS):
                yield from _token_batches(tagger, batch.slice(a, TAG_ROWS), types)

    return source.mapInArrow(run, schema).withColumnRenamed("id", row_id)


def _token_batches(tagger: Tagger, batch: pa.RecordBatch, types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Tokens of some texts, at most TAG_TOKENS a batch; beside them only one text's list is held."""
    names = ["id", "token_no", "surface", "lemma", "pos"]
    held: list[list] = [[] for _ in names]
    for row_id, text in zip(batch.column(0), batch.column(1), strict=True):
        tokens = tagger(text.as_py())
        done = 0
        while done < len(tokens):
            part = tokens[done : done + TAG_TOKENS - len(held[0])]
            held[0].extend([row_id.as_py()] * len(part))
            held[1].extend(range(done, done + len(part)))
            for column, values in zip(held[2:], zip(*part, strict=True), strict=True):
                column.extend(values)
            done += len(part)
            if len(held[0]) >= TAG_TOKENS:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(held, types, strict=True)], names)
                held = [[] for _ in names]
    if held[0]:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(held, types, strict=True)], names)


def text_function(load: Callable[[], Callable[[str], str]]) -> Callable[[str], Column]:
    """Text-to-text column function over Arrow batches; null becomes ``''``. For code with no
    Spark equivalent: everything in ``functions.text`` is faster."""

    @F.pandas_udf("string")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        function = load()
        for texts in batches:
            yield texts.map(lambda t: function(t) if isinstance(t, str) else "")

    return apply


def map_records(
    df: DataFrame, mapper: Callable[[pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """Record batch in, any number of records out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield mapper(batch)

    return df.mapInPandas(run, schema)


def combine_by_key(
    df: DataFrame,
    keys: list[str],
    combine: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """Grouped reduction with a map-side combiner.

    ``combine`` takes rows of ``schema`` with possibly many rows per key and returns one row
    per key; it must be associative. Before the shuffle it runs over each Arrow batch of a task,
    whose rows come sorted by key: a key that ends inside a batch leaves at once, only the last
    one is carried on. So a task holds one batch and one key's row however many keys it has, and
    a reducer gets at most one row per map task, however hot its key is.
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for batch in batches:
            if batch.empty:
                continue
            last = batch[keys].iloc[-1]
            merged = combine(batch if held is None else pd.concat([held, batch], ignore_index=True))
            same = np.logical_and.reduce([(merged[k] == last[k]) | (merged[k].isna() & pd.isna(last[k])) for k in keys])
            yield merged[~same]
            held = merged[same]
        if held is not None:
            yield held

    partial = df.sortWithinPartitions(*keys).mapInPandas(fold, schema)
    return partial.groupBy(*keys).applyInPandas(combine, schema)
