"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewmill.operators.skew import scratch_path

HOT_SHARE = 1_000
SPACE = r"[\x20\x09-\x0D]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage, keeps
    columns prunable and survives the loss of any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def normal_text(text: str) -> Column:
    """The text with every run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE + "+", " ")


def words_in(text: str) -> Column:
    """Number of words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def components(edges: DataFrame, left: str, right: str, name: str = "components") -> DataFrame:
    """Connected components of an undirected graph: rows ``node, component`` for every node
    that has an edge to another node; the component is its smallest node.

    Alternates two star contractions until nothing changes; a chain of n nodes needs about
    log n rounds. Minima are combined before the shuffle, so a node with very many edges
    costs one row per task, and each round is written to the shared folder.
    """
    links = edges.select(
        F.greatest(left, right).cast("long").alias("u"), F.least(left, right).cast("long").alias("v")
    )
    links = stored(links.filter("u > v").distinct(), name)
    while not _all_stars(links):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u > v").distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stored(small.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct(), name)
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def join_classes(rows: DataFrame, classes: DataFrame, total: int, key: str = "digest") -> DataFrame:
    """Inner join of ``rows`` with one row per key that knows its number of rows (``copies``).

    Keys that hold more than one in HOT_SHARE of all ``total`` rows are met by a broadcast of at
    most HOT_SHARE classes, so they stay spread; the rest is an ordinary join.
    """
    is_hot = F.col("copies") * HOT_SHARE > total
    hot = F.broadcast(classes.filter(is_hot))
    often = rows.join(hot, key)
    seldom = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(classes.filter(~is_hot), key)
    return often.unionByName(seldom)


def _all_stars(links: DataFrame) -> bool:
    """Whether every left node has one right node, and no right node is a left one."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("left"), F.lit(0).alias("right"))
    ends = ends.unionByName(links.select(F.col("v").alias("node"), F.lit(0).alias("left"), F.lit(1).alias("right")))
    seen = ends.groupBy("node").agg(F.sum("left").alias("left"), F.max("right").alias("right"))
    return seen.filter((F.col("left") > 1) | ((F.col("left") == 1) & (F.col("right") == 1))).isEmpty()


def with_running_sums(df: DataFrame, order: list[Column], sums: dict[str, str], name: str) -> DataFrame:
    """Add ``new = sum of the column over all rows before this one`` for ``new: column`` in
    ``sums``, and ``row_index`` from 0, in a global order of unique rows.

    Rows are range-sorted into partitions and written; one row per partition and sum meets in
    a single task, so a table of any size never does.
    """
    parts = stored(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name)
    values = {"row_index": F.lit(1).cast("long")} | {new: F.col(old) for new, old in sums.items()}
    totals = parts.groupBy("_part").agg(*[F.sum(v).alias(f"_{k}") for k, v in values.items()])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part", *[F.coalesce(F.sum(f"_{k}").over(earlier), F.lit(0)).alias(f"_{k}") for k in values]
    )
    before = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.join(offsets, "_part")
    return placed.select(
        *df.columns,
        *[(F.col(f"_{k}") + F.coalesce(F.sum(v).over(before), F.lit(0))).alias(k) for k, v in values.items()],
    )


def text_slices(batches: Iterator[pa.RecordBatch], size: int, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of about ``size`` bytes of text, at least one row each."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False), dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            done = sizes[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(sizes, done + size)))
            yield batch.slice(first, last - first)
            first = last


def byte_table(outside: list[int]) -> np.ndarray:
    """For each byte its form in a token: A to Z in lower case, 0 for the bytes ``outside``."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[outside] = 0
    return table


def tokens_of(text: pa.Array, table: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All runs of bytes that ``table`` keeps, in its form, and where each text's runs begin (and
    the last ones end). Null counts as empty; a text that holds NUL is cut there if 0 is outside."""
    rows = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    held = text.buffers()[2]
    data = np.frombuffer(held, np.uint8)[rows[0] : rows[-1]] if held is not None else np.zeros(0, np.uint8)
    rows -= rows[0]
    low = table[data]
    inside = low > 0
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    first = rows[:-1][rows[:-1] < rows[1:]]
    opens[first] = inside[first]  # a run ends with its text
    starts = np.flatnonzero(opens)
    kept = low[inside]
    offsets = np.append(np.cumsum(inside)[starts] - 1, len(kept)).astype(np.int32)
    found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(kept))
    return found, np.searchsorted(starts, rows)
