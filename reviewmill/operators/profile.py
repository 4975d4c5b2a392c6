"""Data profile, default filling, distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.scoring import sign_class_ko


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: type, nulls, empty strings, rows. A single aggregate pass."""
    fields = df.schema.fields

    def empties(f):
        if f.dataType.typeName() != "string":
            return F.lit(0).cast("long")
        return F.count_if(F.col(f.name) == "")

    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.array(*[F.count_if(F.col(f.name).isNull()) for f in fields]).alias("nulls"),
        F.array(*[empties(f) for f in fields]).alias("empties"),
    )
    names = F.array(*[F.lit(f.name) for f in fields])
    types = F.array(*[F.lit(f.dataType.simpleString()) for f in fields])
    zipped = F.arrays_zip(
        names.alias("column_name"),
        types.alias("data_type"),
        F.col("nulls").alias("null_count"),
        F.col("empties").alias("empty_count"),
    )
    return counts.select("row_count", F.explode(zipped).alias("c")).select(
        "c.column_name",
        "c.data_type",
        "c.null_count",
        "c.empty_count",
        "row_count",
    )


def class_distribution(scored: DataFrame, score: str = "sent_score") -> DataFrame:
    return (
        scored.groupBy(sign_class_ko(score).alias("sentiment"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc("sentiment"))
    )


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over min..max, the last bin closed. Empty bins are listed too."""
    span = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    position = F.floor((F.col(column) - lo) / (hi - lo) * bins)
    index = F.when(hi == lo, F.lit(0)).otherwise(F.least(position, F.lit(bins - 1)))
    filled = (
        df.filter(F.col(column).isNotNull())
        .select(index.cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(filled, "bin", "left").select(
        "bin",
        (lo + F.col("bin") * (hi - lo) / bins).alias("lower"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
