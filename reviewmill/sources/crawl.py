"""Nested crawl documents to flat review rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions import text as tx

# fixed values: field names of the crawl documents
CRAWL_SCHEMA = (
    "`가게이름` string, `가게 평균 평점` string, "
    "`가게 리뷰` array<struct<`리뷰어 리뷰수`: string, `리뷰 텍스트`: string, "
    "`리뷰 날짜`: string, `가게 방문수`: string, `태그들`: array<string>>>"
)


def read_crawl(spark: SparkSession, path: str) -> DataFrame:
    """Crawl files, each one JSON array of shops; the file name carries the university."""
    return (
        spark.read.schema(CRAWL_SCHEMA)
        .option("multiLine", True)
        .json(path)
        .withColumn("university_name", F.regexp_extract("_metadata.file_name", "^(.*)_reviews_", 1))
    )


def flatten_crawl(shops: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per review, typed; shops without reviews stay with null review fields.

    Labels around numbers are removed; text in place of a number ("no rating", "no visit
    information") becomes null.
    """
    rows = shops.select(
        *(keep or []), "`가게이름`", "`가게 평균 평점`", F.explode_outer("`가게 리뷰`").alias("r")
    )
    return rows.select(
        *(keep or []),
        F.col("`가게이름`").alias("shop_name"),
        tx.last_line("`가게 평균 평점`").try_cast("float").alias("shop_avg_rating"),
        tx.without("r.`리뷰어 리뷰수`", "리뷰 ").try_cast("int").alias("reviewer_review_count"),
        F.col("r.`리뷰 텍스트`").alias("review_text"),
        F.col("r.`리뷰 날짜`").alias("review_date"),
        tx.without("r.`가게 방문수`", "번째 방문").try_cast("int").alias("shop_visit_count"),
        F.array_join("r.`태그들`", " ").alias("tags"),
    )
