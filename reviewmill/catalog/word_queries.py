"""Ranking and word counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewmill.catalog import inputs as inp
from reviewmill.catalog import sql_parts as sq
from reviewmill.catalog.registry import register
from reviewmill.functions.constants import CUSTOM_STOP_WORDS, RANKING_CATEGORIES
from reviewmill.operators import ordering
from reviewmill.operators import tokens as tk
from reviewmill.operators import words as wd
from reviewmill.operators.ranking import rank_cafes
from reviewmill.plans import jobs
from reviewmill.sources import readers

_CAFES = """cafes AS (
  SELECT university, cafe, avg(rating) AS r, sum(reviewers) AS c, sum(visits) AS v
  FROM core GROUP BY university, cafe)"""


def _category_sql(name: str, directions: tuple[int, int, int]) -> str:
    order = ", ".join(
        f"{c} {'DESC' if d > 0 else 'ASC'}" for c, d in zip("rvc", directions, strict=True)
    )
    return (
        f"SELECT '{name}' AS category, university, "
        f"row_number() OVER (PARTITION BY university ORDER BY {order}, cafe) AS rank, cafe, r, c, v "
        "FROM cafes QUALIFY rank <= 10"
    )


_RANKED = (
    f"{inp.CORE_SQL}, {_CAFES}, ranked AS ("
    + " UNION ALL ".join(_category_sql(n, d) for n, d in RANKING_CATEGORIES)
    + ")"
)


@register(
    "rank_cafes_8",
    f"""WITH {_RANKED}
SELECT category, university, CAST(rank AS INTEGER) AS rank, cafe AS "cafeName", r AS "avgRating",
       CAST(c AS BIGINT) AS "totalReviewerCount", CAST(v AS BIGINT) AS "totalVisitCount" FROM ranked""",
)
def rank_cafes_8(spark, sf_dir):
    return rank_cafes(inp.core(spark, sf_dir), 10)


@register(
    "category_word_counts",
    f"""WITH {_RANKED}, {inp.CAFE_REVIEWS_SQL}, {inp.DICTIONARY_SQL}, {inp.STOP_SQL},
joined AS (
  SELECT r.category, r.university, r.cafe, string_agg(t.review_text, ' ' ORDER BY review_id) AS txt
  FROM ranked r JOIN cafe_reviews t USING (university, cafe) GROUP BY ALL),
cleaned AS (SELECT category, {sq.clean('txt')} AS txt FROM joined),
{sq.tagged('cleaned', ['category'], 'txt')}
SELECT category, surface AS word, count(*) AS count FROM tagged
WHERE pos IN ('Adjective', 'Verb', 'Exclamation', 'Adverb') AND length(surface) > 1
  AND surface NOT IN (SELECT word FROM stop)
GROUP BY category, surface""",
)
def category_word_counts(spark, sf_dir):
    return jobs.category_word_counts(
        inp.core(spark, sf_dir),
        inp.cafe_reviews(spark, sf_dir),
        inp.dictionary(spark),
        inp.stop_words(spark),
        default_pos="Noun",
    )


@register(
    "word_counts",
    f"""WITH {inp.REVIEWS_SQL},
toks AS (
  SELECT unnest(list_filter(string_split_regex(review_text, '[ ",()*]+'), lambda t: length(t) > 1)) AS word
  FROM reviews)
SELECT word, count(*) AS count FROM toks GROUP BY word""",
)
def word_counts(spark, sf_dir):
    tokens = tk.explode_tokens(
        inp.reviews(spark, sf_dir), "review_text", [], "delimiters", min_length=2
    )
    return wd.count_words(tokens, output="count").orderBy(F.desc("count"), F.asc("word"))


@register(
    "word_counts_placed",
    f"""WITH {inp.REVIEWS_SQL},
toks AS (
  SELECT unnest(list_filter(string_split_regex(review_text, '[ ",()*]+'), lambda t: length(t) > 1)) AS word
  FROM reviews),
counts AS (SELECT word, count(*) AS count FROM toks GROUP BY word)
SELECT word, count, row_number() OVER (ORDER BY count DESC, word) AS place FROM counts""",
)
def word_counts_placed(spark, sf_dir):
    """The global order as a column."""
    tokens = tk.explode_tokens(inp.reviews(spark, sf_dir), "review_text", [], "delimiters", min_length=2)
    return ordering.with_place(wd.count_words(tokens, output="count"), ["-count", "word"])


_STOP_BOTH = sorted({*inp.STOP, *inp.MORE_STOP})
_ALL_STOP_SQL = f"stop(word) AS ({inp.values([(w,) for w in _STOP_BOTH])})"
_NOUNS = f"""
WITH {inp.REVIEWS_SQL}, {inp.DICTIONARY_SQL}, {_ALL_STOP_SQL},
{sq.tagged('reviews', ['university_name', 'shop_name', 'review_id'], 'review_text')},
nouns AS (
  SELECT university_name, shop_name, review_id, token_no, surface AS word FROM tagged
  WHERE pos = 'Noun' AND length(surface) > 1 AND surface NOT IN (SELECT word FROM stop)),
counts AS (SELECT university_name, word, count(*) AS n FROM nouns GROUP BY ALL),
top AS (
  SELECT *, row_number() OVER (PARTITION BY university_name ORDER BY n DESC, word) AS rk FROM counts)
"""


def _stop(spark):
    return readers.join_word_lists(
        inp.stop_words(spark), readers.word_list(spark, inp.MORE_STOP)
    )


def _top_words(spark, sf_dir, k=50):
    return jobs.top_words_by_university(
        inp.reviews(spark, sf_dir), inp.dictionary(spark), _stop(spark), k, default_pos="Noun"
    )


@register(
    "top_words_university",
    f"{_NOUNS} SELECT university_name, word, n, CAST(rk AS INTEGER) AS rank FROM top WHERE rk <= 50",
)
def top_words_university(spark, sf_dir):
    return _top_words(spark, sf_dir)


@register(
    "top_words_custom_stop",
    f"""{_NOUNS},
fewer AS (
  SELECT *, row_number() OVER (PARTITION BY university_name ORDER BY n DESC, word) AS rank_no FROM counts
  WHERE word NOT IN ({", ".join(inp.quoted(w) for w in [*CUSTOM_STOP_WORDS, "this", "le"])}))
SELECT university_name, word, n, CAST(rank_no AS INTEGER) AS rank FROM fewer WHERE rank_no <= 20""",
)
def top_words_custom_stop(spark, sf_dir):
    """The report's rerun: its extra stop words on top of the given ones."""
    extra = readers.word_list(spark, [*CUSTOM_STOP_WORDS, "this", "le"])
    stop = readers.join_word_lists(_stop(spark), extra)
    return jobs.top_words_by_university(
        inp.reviews(spark, sf_dir), inp.dictionary(spark), stop, 20, default_pos="Noun"
    )


@register("vocabulary", f"{_NOUNS} SELECT DISTINCT word FROM top WHERE rk <= 10")
def vocabulary(spark, sf_dir):
    return wd.vocabulary(_top_words(spark, sf_dir, 10))


@register(
    "noun_lists_university",
    f"""{_NOUNS},
per_review AS (
  SELECT university_name, review_id, string_agg(word, '|' ORDER BY token_no) AS words
  FROM nouns GROUP BY ALL),
numbered AS (
  SELECT *, CAST(floor((sum(length(words) + 1) OVER (PARTITION BY university_name ORDER BY review_id
             ROWS UNBOUNDED PRECEDING) - length(words) - 1) / 200000) AS BIGINT) AS part_no FROM per_review)
SELECT university_name, part_no, string_agg(words, '|' ORDER BY review_id) AS words
FROM numbered GROUP BY ALL""",
)
def noun_lists_university(spark, sf_dir):
    return jobs.noun_lists(
        inp.reviews(spark, sf_dir),
        inp.dictionary(spark),
        _stop(spark),
        default_pos="Noun",
        slice_rows=16,
        part_chars=200_000,
    )


@register(
    "top_words_from_lists",
    f"""{_NOUNS}
SELECT university_name, word, n, CAST(rk AS INTEGER) AS rank FROM top WHERE rk <= 50""",
)
def top_words_from_lists(spark, sf_dir):
    lists = noun_lists_university(spark, sf_dir)
    tokens = tk.explode_tokens(lists, "words", ["university_name"], "pipe")
    return wd.top_words_by_group(tokens, ["university_name"], 50)


@register(
    "topic_profile",
    f"""
WITH {inp.REVIEWS_SQL},
toks AS (SELECT university_name, unnest({sq.split_space('review_text')}) AS word FROM reviews),
counts AS (SELECT university_name, word, count(*) AS n FROM toks WHERE length(word) > 1 GROUP BY ALL),
top AS (SELECT * FROM counts
  QUALIFY row_number() OVER (PARTITION BY university_name ORDER BY n DESC, word) <= 10),
topics(word, topic) AS ({inp.values(wd.topic_table(inp.TOPICS))}),
assigned AS (
  SELECT university_name, coalesce(topic, 'other') AS topic, n FROM top LEFT JOIN topics USING (word))
SELECT university_name, CAST(coalesce(sum(n) FILTER (topic = 'article'), 0) AS BIGINT) AS article,
       CAST(coalesce(sum(n) FILTER (topic = 'link'), 0) AS BIGINT) AS link,
       CAST(coalesce(sum(n) FILTER (topic = 'verb'), 0) AS BIGINT) AS verb,
       CAST(coalesce(sum(n) FILTER (topic = 'other'), 0) AS BIGINT) AS other
FROM assigned GROUP BY university_name""",
)
def topic_profile(spark, sf_dir):
    tokens = tk.explode_tokens(
        inp.reviews(spark, sf_dir), "review_text", ["university_name"], min_length=2
    )
    top = wd.top_words_by_group(tokens, ["university_name"], 10)
    return wd.topic_profile(top, "university_name", inp.TOPICS, "other")


@register(
    "term_cloud",
    f"""WITH {inp.REVIEWS_SQL},
toks AS (SELECT unnest({sq.split_whitespace('review_text')}) AS word FROM reviews),
top AS (SELECT word, count(*) AS n FROM toks GROUP BY word ORDER BY n DESC, word LIMIT 200)
SELECT word, n, round(n / max(n) OVER (), 9) AS weight FROM top""",
)
def term_cloud(spark, sf_dir):
    tokens = tk.explode_tokens(inp.reviews(spark, sf_dir), "review_text", [], "whitespace")
    return wd.term_cloud(tokens, 200).withColumn("weight", F.round("weight", 9))
