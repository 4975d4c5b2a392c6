"""Global order as data: the place of every row, so that a sorted result can be stored and checked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.operators.skew import cut_lineage


def _sorted_by(name: str) -> Column:
    column = F.col(f"row.`{name.removeprefix('-')}`")
    return column.desc() if name.startswith("-") else column.asc()


def with_place(df: DataFrame, order: list[str], name: str = "place") -> DataFrame:
    """``df`` with the row's place from 1 in the order of some columns, ``-column`` for falling ones.

    Nulls are the smallest values. Rows that are equal in all of ``order`` have places next to each
    other in any order, and are numbered by one task: name columns that tell rows apart. Rows are
    dealt into ranges and written; a task numbers its range, and one count per range meets in a
    single task, so no task sees all rows.
    """
    keys = [_sorted_by(c) for c in order]
    dealt = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")).repartitionByRange(*keys)
    dealt = cut_lineage(dealt.withColumn("range", F.spark_partition_id()))
    counts = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("range").orderBy(*keys))
    placed = dealt.withColumn("within", within).join(before, "range")
    return placed.select("row.*", (F.col("before") + F.col("within")).alias(name))
