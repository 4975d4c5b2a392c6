"""Word counts: whole corpus, per group, per ranking category; topics and clouds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions.constants import FOOD_TOPICS, OTHER_TOPIC
from reviewmill.operators.keywords import top_words
from reviewmill.operators.skew import lookup_join
from reviewmill.session import local_table


def count_words(tokens: DataFrame, keys: list[str] | None = None, output: str = "n") -> DataFrame:
    return tokens.groupBy(*(keys or []), "word").agg(F.count(F.lit(1)).alias(output))


def top_words_by_group(tokens: DataFrame, keys: list[str], k: int = 50) -> DataFrame:
    """``keys, word, n, rank`` of the k most frequent words of every group."""
    return top_words(count_words(tokens, keys), keys, k)


def term_cloud(tokens: DataFrame, k: int = 200) -> DataFrame:
    """Most frequent words with their weight relative to the most frequent one."""
    counts = count_words(tokens)
    top = counts.orderBy(F.desc("n"), F.asc("word")).limit(k)
    # at most k rows are left, so one task for the maximum is fine
    return top.withColumn("weight", F.col("n") / F.max("n").over(Window.partitionBy(F.lit(0))))


def vocabulary(top: DataFrame) -> DataFrame:
    return top.select("word").distinct()


def topic_table(topics: list[tuple[str, list[str]]] = FOOD_TOPICS) -> list[tuple[str, str]]:
    """(word, topic) pairs; a word listed under several topics belongs to the first."""
    first: dict[str, str] = {}
    for topic, words in topics:
        for word in words:
            first.setdefault(word, topic)
    return list(first.items())


def topic_profile(
    top: DataFrame,
    key: str,
    topics: list[tuple[str, list[str]]] = FOOD_TOPICS,
    other: str = OTHER_TOPIC,
) -> DataFrame:
    """Summed frequency of each topic among the top words, one column per topic."""
    table = local_table(top.sparkSession, topic_table(topics), "word string, topic string")
    assigned = lookup_join(top, table, ["word"], "left").withColumn(
        "topic", F.coalesce("topic", F.lit(other))
    )
    names = [*[name for name, _ in topics], other]
    return assigned.groupBy(key).pivot("topic", names).agg(F.sum("n").cast("long")).fillna(0)


def category_words(ranked: DataFrame, cafe_words: DataFrame) -> DataFrame:
    """``category, word, n`` from the ranking and the word counts per café.

    ``cafe_words`` holds ``university, cafeName, word, n``: text is tokenized and counted
    once per café, however many categories list the café.
    """
    listed = ranked.select("category", "university", "cafeName").distinct()
    joined = lookup_join(cafe_words, listed, ["university", "cafeName"])
    return joined.groupBy("category", "word").agg(F.sum("n").alias("count"))


__all__ = [
    "category_words",
    "count_words",
    "term_cloud",
    "top_words_by_group",
    "topic_profile",
    "topic_table",
    "vocabulary",
]
