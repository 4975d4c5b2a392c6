"""Top-k per group. ``row_number() <= k`` lets Spark keep only k rows per group and task
before the shuffle, so a hot group never travels whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.operators.skew import fits_broadcast


def top_k(
    df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The first k rows of each group under a total order, with their rank."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def top_words(counts: DataFrame, keys: list[str], k: int, count: str = "n") -> DataFrame:
    """Most frequent words per group; equal counts go alphabetically."""
    return top_k(counts, keys, [F.desc(count), F.asc("word")], k)


def ranked_list(value: str, condition: Column, rank: str = "rank") -> Column:
    """Aggregate: values in rank order where the condition holds. Use on top-k rows only."""
    pair = F.when(condition, F.struct(F.col(rank), F.col(value)))
    return F.transform(F.array_sort(F.collect_list(pair)), lambda s: s[value])


def first_rows(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """First row of every key by ``order``, which is unique within a key.

    Only keys and smallest order values are aggregated; the rows are found again by a semi
    join on both, so a hot key is neither sorted nor gathered. Null keys are keys of their own.
    """
    # every key has a row: one whose order values are all null is found by a null
    firsts = df.groupBy(*keys).agg(F.min(order).alias("_first"))
    renamed = firsts.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], "_first")
    same = df[order].eqNullSafe(renamed["_first"])
    for i, key in enumerate(keys):
        same = same & df[key].eqNullSafe(renamed[f"_key_{i}"])
    small = F.broadcast(renamed) if fits_broadcast(renamed) else renamed
    return df.join(small, same, "left_semi")
