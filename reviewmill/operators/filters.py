"""Row filters. University and header filters are plain comparisons, so they reach the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions import text as tx
from reviewmill.functions.constants import HEADER_MARK

BYTE_ORDER_MARK = "\ufeff"


def of_university(df: DataFrame, name: str, column: str = "university_name") -> DataFrame:
    return df.filter(F.col(column) == name)


def keyword_match(column: str, keyword: str, regex: bool = True) -> Column:
    """Regular-expression or literal match; a null text does not match."""
    found = F.col(column).rlike(keyword) if regex else F.col(column).contains(keyword)
    return F.coalesce(found, F.lit(False))


def without_header(
    df: DataFrame, column: str = "university_name", mark: str = HEADER_MARK
) -> DataFrame:
    """Drop header rows that were read as data, with or without a byte-order mark."""
    value = F.col(column)
    return df.filter(value.isNull() | ~value.isin(mark, BYTE_ORDER_MARK + mark))


def with_emoji(df: DataFrame, column: str) -> DataFrame:
    return df.filter(tx.has_emoji(column))


def not_blank(df: DataFrame, column: str) -> DataFrame:
    return df.filter(tx.strip(column) != "")


def non_zero(df: DataFrame, column: str = "sent_score") -> DataFrame:
    return df.filter(F.col(column) != 0)


def split_errors(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows as ``key = 'Error'`` with the reason (null means good)."""
    marked = df.withColumn("_reason", reason)
    good = marked.filter("_reason IS NULL").drop("_reason")
    bad = marked.filter("_reason IS NOT NULL").select(
        F.lit("Error").alias("key"), F.col("_reason").alias("message")
    )
    return good, bad


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Raise early when there is nothing to work on."""
    if df.isEmpty():
        raise ValueError(message)
    return df
