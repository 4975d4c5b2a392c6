"""Stand-in inputs: driver tables in review shape, and small word lists given both as
DataFrames and as SQL values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.session import local_table
from reviewmill.sources import readers

LEXICON = [
    ("the", 1), ("of", -1), ("in", 0), ("and", 1), ("to", -1), ("is", 2), ("that", -2),
    ("for", 1), ("it", -1), ("on", 0), ("was", -2), ("with", 1), ("be", 2), ("as", 0),
    ("by", -1), ("de", 1), ("la", -1), ("der", 0), ("en", 1), ("die", -1), ("que", 1),
    ("le", -1), ("des", 0), ("und", 1), ("et", 1), ("les", -1), ("er", 1), ("th", 0),
    ("re", -1), ("an", 1), ("un", -1),
]

STOP = ["the", "of", "de", "la", "der", "und", "que", "th", "in"]
MORE_STOP = ["and", "et", "en", "the", "die"]

DICTIONARY = [
    ("is", "be", "Verb"), ("was", "be", "Verb"), ("are", "be", "Verb"), ("be", "be", "Verb"),
    ("the", "the", "Determiner"), ("this", "this", "Determiner"), ("la", "le", "Determiner"),
    ("le", "le", "Determiner"), ("les", "le", "Determiner"), ("der", "der", "Determiner"),
    ("die", "der", "Determiner"), ("das", "der", "Determiner"), ("of", "of", "Josa"),
    ("to", "to", "Josa"), ("in", "in", "Josa"), ("on", "on", "Josa"), ("de", "de", "Josa"),
    ("and", "and", "Conjunction"), ("und", "und", "Conjunction"), ("et", "et", "Conjunction"),
    ("que", "que", "Conjunction"), ("that", "that", "Adverb"), ("for", "for", "Adverb"),
    ("with", "with", "Adverb"), ("by", "by", "Adverb"), ("en", "en", "Adverb"),
    ("un", "un", "Adjective"), ("une", "un", "Adjective"), ("nd", "nd", "Adjective"),
    ("ing", "ing", "Adjective"), ("er", "er", "Adjective"), ("th", "th", "Exclamation"),
    ("re", "re", "Exclamation"), ("ou", "ou", "Exclamation"), ("it", "it", "Noun"),
]

TOPICS = [
    ("article", ["the", "la", "der", "le", "el"]),
    ("link", ["and", "und", "et", "of", "de"]),
    ("verb", ["is", "was", "the", "de"]),
]


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def values(rows: list[tuple]) -> str:
    cells = [
        "(" + ", ".join(quoted(v) if isinstance(v, str) else str(v) for v in row) + ")"
        for row in rows
    ]
    return "VALUES " + ", ".join(cells)


LEXICON_SQL = f"lexicon(word, polarity) AS ({values(LEXICON)})"
STOP_SQL = f"stop(word) AS ({values([(w,) for w in STOP])})"
DICTIONARY_SQL = f"dictionary(surface, lemma, pos) AS ({values(DICTIONARY)})"

REVIEWS_SQL = (
    "reviews AS (SELECT doc_id AS review_id, lang AS university_name, source AS shop_name, "
    '"text" AS review_text, n_chars FROM documents)'
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.spread(table(spark, sf_dir, "documents"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("review_id"),
        F.col("lang").alias("university_name"),
        F.col("source").alias("shop_name"),
        F.col("text").alias("review_text"),
        "n_chars",
    )


def lexicon(spark: SparkSession) -> DataFrame:
    return local_table(spark, LEXICON, "word string, polarity int")


def stop_words(spark: SparkSession) -> DataFrame:
    return local_table(spark, [(w,) for w in STOP], "word string")


def dictionary(spark: SparkSession) -> DataFrame:
    return local_table(spark, DICTIONARY, "surface string, lemma string, pos string")


def core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Café measures: nation as university, brand as café, quantities as ratings."""
    item = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    part = table(spark, sf_dir, "part")
    return (
        item.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("n_name").alias("university"),
            F.col("p_brand").alias("cafeName"),
            F.col("l_quantity").cast("float").alias("avgRating"),
            F.col("l_linenumber").cast("int").alias("reviewerCount"),
            F.col("l_quantity").cast("int").alias("visitCount"),
        )
    )


CORE_SQL = (
    "core AS (SELECT n_name AS university, p_brand AS cafe, CAST(l_quantity AS FLOAT) AS rating, "
    "l_linenumber AS reviewers, CAST(l_quantity AS INTEGER) AS visits "
    "FROM lineitem JOIN supplier ON l_suppkey = s_suppkey "
    "JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey)"
)


def cafe_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents dealt to (nation, brand), so that they join the café ranking."""
    docs = documents(spark, sf_dir)
    return docs.select(
        F.col("doc_id").alias("review_id"),
        F.concat(F.lit("NATION_"), F.col("doc_id") % 25).alias("university"),
        F.concat(
            F.lit("Brand#"), F.floor(F.col("doc_id") / 25) % 25 + 1
        ).alias("cafeName"),
        F.col("text").alias("review_text"),
    )


CAFE_REVIEWS_SQL = (
    "cafe_reviews AS (SELECT doc_id AS review_id, 'NATION_' || (doc_id % 25) AS university, "
    "'Brand#' || ((doc_id // 25) % 25 + 1) AS cafe, \"text\" AS review_text FROM documents)"
)
