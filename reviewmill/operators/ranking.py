"""Café ranking: one aggregate, eight sort orders, one shuffle for all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.constants import RANKING_CATEGORIES
from reviewmill.operators.keywords import top_k


def aggregate_cafes(core: DataFrame, keys: tuple[str, str] = ("university", "cafeName")) -> DataFrame:
    """Mean rating, total reviewers and total visits per (university, café).

    Ratings are single-precision before the mean, as the input schema declares them.
    """
    return core.groupBy(*keys).agg(
        F.avg(F.col("avgRating").cast("float")).alias("avgRating"),
        F.sum("reviewerCount").alias("totalReviewerCount"),
        F.sum("visitCount").alias("totalVisitCount"),
    )


def _directed(value: str, direction: Column) -> list[Column]:
    """Sort keys for one column: direction 1 descends with nulls last, -1 ascends with
    nulls first."""
    missing = F.when(F.col(value).isNull(), direction).otherwise(F.lit(0))
    return [missing.asc(), (F.col(value) * -direction).asc()]


def rank_cafes(
    core: DataFrame,
    k: int = 10,
    categories: list[tuple[str, tuple[int, int, int]]] = RANKING_CATEGORIES,
) -> DataFrame:
    """Top-k cafés per university for every category, in long form.

    Each café is copied once per category with signed sort keys; ``rank <= k`` then trims
    every (category, university) to k rows inside each task before the shuffle.
    """
    cafes = aggregate_cafes(core)
    orders = F.array(
        *[
            F.struct(
                F.lit(name).alias("category"),
                *[F.lit(d).alias(f"d{i}") for i, d in enumerate(directions)],
            )
            for name, directions in categories
        ]
    )
    copies = cafes.select("*", F.explode(orders).alias("o"))
    order = [
        *_directed("avgRating", F.col("o.d0")),
        *_directed("totalVisitCount", F.col("o.d1")),
        *_directed("totalReviewerCount", F.col("o.d2")),
        F.asc("cafeName"),
    ]
    ranked = top_k(
        copies.withColumn("category", F.col("o.category")), ["category", "university"], order, k
    )
    return ranked.select(
        "category",
        "university",
        "rank",
        "cafeName",
        "avgRating",
        "totalReviewerCount",
        "totalVisitCount",
    )
