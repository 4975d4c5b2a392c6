"""Sentiment reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewmill.catalog import inputs as inp
from reviewmill.catalog import sql_parts as sq
from reviewmill.catalog.registry import register
from reviewmill.operators import ordering, profile
from reviewmill.operators import sentiment as st
from reviewmill.operators import tokens as tk
from reviewmill.plans import jobs
from reviewmill.session import local_table

REPORT = "positive_pct, neutral_pct, negative_pct, top_positive, top_neutral, top_negative"


def _tokens_sql(keys: str, split: str) -> str:
    return f"toks AS (SELECT {keys}, unnest({split}) AS word FROM reviews)"


_NEUTRAL = f"""
WITH {inp.LEXICON_SQL}, {inp.REVIEWS_SQL},
{_tokens_sql('shop_name', sq.split_space('review_text'))},
counts AS (
  SELECT shop_name, {sq.sign('coalesce(polarity, 0)')} AS sentiment, word, count(*) AS n
  FROM toks LEFT JOIN lexicon USING (word) GROUP BY ALL),
{sq.word_report(['shop_name'], 5, None)}
"""


@register("sentiment_token_all", f"{_NEUTRAL} SELECT * FROM report")
def sentiment_token_all(spark, sf_dir):
    return jobs.sentiment_report(
        inp.reviews(spark, sf_dir), "review_text", inp.lexicon(spark), "token"
    )


def _matched(split: str, keys: list[str], k: int, digits: int | None) -> str:
    cols = ", ".join(keys)
    return f"""
WITH {inp.LEXICON_SQL}, {inp.REVIEWS_SQL}, {_tokens_sql(cols, split)},
counts AS (
  SELECT {cols}, {sq.sign('polarity')} AS sentiment, word, count(*) AS n
  FROM toks JOIN lexicon USING (word) GROUP BY ALL),
{sq.word_report(keys, k, digits)}
SELECT * FROM report"""


@register(
    "sentiment_token_matched",
    _matched(sq.split_whitespace("review_text"), ["shop_name"], 6, 2),
)
def sentiment_token_matched(spark, sf_dir):
    return jobs.sentiment_report(
        inp.reviews(spark, sf_dir),
        "review_text",
        inp.lexicon(spark),
        "token",
        unmatched="drop",
        k=6,
        digits=2,
        splitter="whitespace",
    )


@register(
    "sentiment_token_percentages",
    _matched(sq.split_space("review_text"), ["shop_name"], 3, None).replace(
        "SELECT * FROM report", "SELECT shop_name, positive_pct, negative_pct, neutral_pct FROM report"
    ),
)
def sentiment_token_percentages(spark, sf_dir):
    tokens = tk.explode_tokens(inp.reviews(spark, sf_dir), "review_text", ["shop_name"])
    counts = st.count_class_words(tokens, inp.lexicon(spark), ["shop_name"], "drop")
    totals = st.class_totals(counts, ["shop_name"])
    return totals.select("shop_name", *st.percentages()).select(
        "shop_name", "positive_pct", "negative_pct", "neutral_pct"
    )


def _review(keys: list[str], k: int = 3, tie: str = "reference", pure: bool = False) -> str:
    cols = ", ".join(keys)
    tokens = sq.split_whitespace("review_text")
    return f"""
WITH {inp.LEXICON_SQL}, {inp.REVIEWS_SQL},
toks AS (
  SELECT {cols}, review_id,
         unnest(CASE WHEN len({tokens}) = 0 THEN [NULL] ELSE {tokens} END) AS word FROM reviews),
{sq.review_report(keys, k, 2, tie, pure)}"""


def _filtered(keys: list[str], test: str) -> str:
    cols = ", ".join(keys)
    tokens = sq.split_whitespace("processed_review")
    return f"""
WITH {inp.LEXICON_SQL}, {inp.REVIEWS_SQL}, {inp.DICTIONARY_SQL},
{sq.tagged('reviews', ['review_id', 'university_name', 'shop_name'], 'review_text')},
processed AS (
  SELECT review_id, university_name, shop_name, coalesce(string_agg(lemma, ' ' ORDER BY token_no)
         FILTER (pos IN ('Noun', 'Verb', 'Adjective', 'Adverb')), '') AS processed_review
  FROM tagged GROUP BY ALL),
toks AS (
  SELECT {cols}, review_id,
         unnest(CASE WHEN len({tokens}) = 0 THEN [NULL] ELSE {tokens} END) AS word
  FROM processed WHERE university_name = 'en' AND {test}),
{sq.review_report(keys, 3, 2, 'reference', False)}"""


def _filtered_report(spark, sf_dir, keyword, regex, keys):
    return jobs.filtered_sentiment(
        inp.reviews(spark, sf_dir),
        "en",
        keyword,
        inp.dictionary(spark),
        inp.lexicon(spark),
        keys,
        regex,
        default_pos="Noun",
    )


@register(
    "filtered_sentiment_shop",
    _filtered(["shop_name"], "regexp_matches(processed_review, 'with|tion$')"),
)
def filtered_sentiment_shop(spark, sf_dir):
    return _filtered_report(spark, sf_dir, "with|tion$", True, ("shop_name",))


@register(
    "filtered_sentiment_university",
    _filtered(["university_name"], "contains(processed_review, 'that')"),
)
def filtered_sentiment_university(spark, sf_dir):
    return _filtered_report(spark, sf_dir, "that", False, ("university_name",))


def _by_review(spark, sf_dir, keys, **options):
    return jobs.sentiment_report(
        inp.reviews(spark, sf_dir),
        "review_text",
        inp.lexicon(spark),
        "review",
        keys,
        k=3,
        digits=2,
        splitter="whitespace",
        **options,
    )


@register("sentiment_review_level", _review(["shop_name"]))
def sentiment_review_level(spark, sf_dir):
    return _by_review(spark, sf_dir, ("shop_name",))


@register("sentiment_review_neutral_tie", _review(["shop_name", "university_name"], tie="neutral"))
def sentiment_review_neutral_tie(spark, sf_dir):
    return _by_review(spark, sf_dir, ("shop_name", "university_name"), tie="neutral")


@register("sentiment_review_pure", _review(["shop_name", "university_name"], pure=True))
def sentiment_review_pure(spark, sf_dir):
    return _by_review(spark, sf_dir, ("shop_name", "university_name"), suppress_pure=True)


@register("sentiment_by_university", _review(["university_name"]))
def sentiment_by_university(spark, sf_dir):
    return _by_review(spark, sf_dir, ("university_name",))


_MERGED_KEYS = ["university_name", "shop_name"]


@register(
    "sentiment_merged_text",
    f"""
WITH {inp.LEXICON_SQL}, {inp.REVIEWS_SQL},
merged AS (
  SELECT university_name, shop_name, string_agg(review_text, ' ' ORDER BY review_id) AS txt
  FROM reviews GROUP BY ALL),
toks AS (SELECT university_name, shop_name, unnest({sq.split_whitespace('txt')}) AS word FROM merged),
found AS (
  SELECT university_name, shop_name, {sq.sign('polarity')} AS sentiment,
         CASE WHEN polarity IS NOT NULL THEN word END AS word
  FROM toks LEFT JOIN lexicon USING (word)),
counts AS (SELECT *, count(*) AS n FROM found GROUP BY ALL),
{sq.word_report(_MERGED_KEYS, 3, 2)}
SELECT * FROM report""",
)
def sentiment_merged_text(spark, sf_dir):
    return jobs.sentiment_report(
        inp.reviews(spark, sf_dir),
        "review_text",
        inp.lexicon(spark),
        "merged",
        tuple(_MERGED_KEYS),
        k=3,
        digits=2,
        splitter="whitespace",
    )


@register(
    "polarity_counts",
    f"""
WITH {inp.LEXICON_SQL}, {inp.REVIEWS_SQL},
toks AS (
  SELECT shop_name, unnest(list_filter(string_split_regex(review_text, '[ ",()*]+'), lambda t: t <> '')) AS word
  FROM reviews)
SELECT shop_name, count(*) FILTER (polarity > 0) AS positive_count,
       count(*) FILTER (polarity < 0) AS negative_count,
       count(*) FILTER (polarity = 0) AS neutral_count
FROM toks JOIN lexicon USING (word) GROUP BY shop_name""",
)
def polarity_counts(spark, sf_dir):
    tokens = tk.explode_tokens(
        inp.reviews(spark, sf_dir), "review_text", ["shop_name"], "delimiters"
    )
    return st.polarity_counts(tokens, inp.lexicon(spark), ["shop_name"])


@register(
    "class_pivot",
    f"""{_NEUTRAL}
SELECT shop_name, CAST(p AS BIGINT) AS "Positive", CAST(u AS BIGINT) AS "Neutral",
       CAST(n AS BIGINT) AS "Negative" FROM totals""",
)
def class_pivot(spark, sf_dir):
    tokens = tk.explode_tokens(inp.reviews(spark, sf_dir), "review_text", ["shop_name"])
    counts = st.count_class_words(tokens, inp.lexicon(spark), ["shop_name"], "neutral")
    return st.class_pivot(counts, ["shop_name"])


@register(
    "keyword_table_outer",
    f"""
WITH {inp.LEXICON_SQL}, {inp.REVIEWS_SQL},
{_tokens_sql('shop_name, university_name', sq.split_space('review_text'))},
counts AS (
  SELECT shop_name, university_name, {sq.sign('polarity')} AS sentiment, word, count(*) AS n
  FROM toks JOIN lexicon USING (word) GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY shop_name, university_name, sentiment ORDER BY n DESC, word) AS rk
  FROM counts),
lists AS (
  SELECT shop_name, university_name, sentiment, string_agg(word, ', ' ORDER BY rk) AS words
  FROM ranked WHERE rk <= 5 GROUP BY ALL)
SELECT shop_name, university_name, max(words) FILTER (sentiment = 'Positive') AS top_positive,
       max(words) FILTER (sentiment = 'Negative') AS top_negative,
       max(words) FILTER (sentiment = 'Neutral') AS top_neutral
FROM lists GROUP BY ALL""",
)
def keyword_table_outer(spark, sf_dir):
    keys = ["shop_name", "university_name"]
    tokens = tk.explode_tokens(inp.reviews(spark, sf_dir), "review_text", keys)
    counts = st.count_class_words(tokens, inp.lexicon(spark), keys, "drop")
    return st.keyword_table_outer(counts, keys)


@register(
    "retagged_sentiment",
    f"""
WITH {inp.LEXICON_SQL}, {inp.REVIEWS_SQL}, {inp.DICTIONARY_SQL},
{sq.tagged('reviews', ['shop_name'], 'review_text')},
counts AS (
  SELECT shop_name, {sq.sign('polarity')} AS sentiment, word, count(*) AS n
  FROM (SELECT shop_name, lemma AS word FROM tagged) JOIN lexicon USING (word) GROUP BY ALL),
{sq.word_report(['shop_name'], 6, 2)}
SELECT * FROM report""",
)
def retagged_sentiment(spark, sf_dir):
    return jobs.tagged_sentiment(
        inp.reviews(spark, sf_dir), inp.lexicon(spark), inp.dictionary(spark), default_pos="Noun"
    )


_SCORES = f"""
WITH {inp.LEXICON_SQL}, {inp.REVIEWS_SQL}, {inp.DICTIONARY_SQL},
{sq.tagged('reviews', ['review_id'], 'review_text')},
worded AS (
  SELECT *, CASE WHEN pos IN ('Adjective', 'Verb')
                 THEN CASE WHEN suffix(lemma, '다') THEN lemma ELSE lemma || '다' END
                 WHEN pos = 'Noun' THEN lemma END AS word FROM tagged),
predicates AS (SELECT word, polarity FROM lexicon
  UNION ALL SELECT 'be다', 2 UNION ALL SELECT 'un다', -1 UNION ALL SELECT 'er다', 1),
per_review AS (
  SELECT review_id,
         coalesce(string_agg(lemma, ' ' ORDER BY token_no) FILTER (pos = 'Noun'), '') AS nouns,
         coalesce(string_agg(lemma, ' ' ORDER BY token_no) FILTER (pos = 'Adjective'), '') AS adjectives,
         coalesce(string_agg(w.word, ' ' ORDER BY token_no) FILTER (w.word IS NOT NULL), '') AS words,
         coalesce(avg(CASE WHEN length(w.word) >= 2 THEN CAST(polarity AS DOUBLE) END), 0) AS sent_score
  FROM worded w LEFT JOIN predicates p ON w.word = p.word GROUP BY review_id),
scored AS (SELECT * FROM per_review),
classed AS (
  SELECT *, CASE WHEN sent_score > 0 THEN '긍정' WHEN sent_score < 0 THEN '부정' ELSE '중립' END
            AS sentiment FROM scored)
"""

_PREDICATES = [("be다", 2), ("un다", -1), ("er다", 1)]


def _scored(spark, sf_dir):
    lexicon = inp.lexicon(spark).union(
        local_table(spark, _PREDICATES, "word string, polarity int")
    )
    return jobs.review_scores(
        inp.reviews(spark, sf_dir),
        lexicon,
        inp.dictionary(spark),
        clean=F.col,
        with_text=False,
        default_pos="Noun",
    )


@register(
    "review_scores",
    f"""{_SCORES}
SELECT review_id, nouns, adjectives, words, round(sent_score, 9) AS sent_score, sentiment
FROM classed WHERE sent_score <> 0""",
)
def review_scores(spark, sf_dir):
    return _scored(spark, sf_dir).select(
        "review_id",
        "nouns",
        "adjectives",
        "words",
        F.round("sent_score", 9).alias("sent_score"),
        "sentiment",
    )


_MEAN = f"""
WITH {inp.LEXICON_SQL}, {inp.REVIEWS_SQL},
{_tokens_sql('review_id', sq.split_space('review_text'))},
scores AS (
  SELECT review_id,
         coalesce(avg(CASE WHEN length(word) >= 2 THEN CAST(polarity AS DOUBLE) END), 0) AS s
  FROM toks LEFT JOIN lexicon USING (word) GROUP BY review_id)
"""


def _mean_scores(spark, sf_dir):
    return st.review_scores(
        inp.reviews(spark, sf_dir), "review_text", "review_id", inp.lexicon(spark)
    )


@register(
    "class_distribution",
    f"""{_MEAN}
SELECT CASE WHEN s > 0 THEN '긍정' WHEN s < 0 THEN '부정' ELSE '중립' END AS sentiment,
       count(*) AS n FROM scores GROUP BY 1""",
)
def class_distribution(spark, sf_dir):
    return profile.class_distribution(_mean_scores(spark, sf_dir))


@register(
    "score_histogram",
    f"""{_MEAN},
span AS (SELECT min(s) AS lo, max(s) AS hi FROM scores),
binned AS (
  SELECT least(CAST(floor((s - lo) / (hi - lo) * 20) AS INTEGER), 19) AS bin, count(*) AS n
  FROM scores, span GROUP BY 1)
SELECT CAST(r.bin AS INTEGER) AS bin, round(lo + r.bin * (hi - lo) / 20, 9) AS lower,
       coalesce(n, 0) AS n
FROM range(20) AS r(bin) CROSS JOIN span LEFT JOIN binned ON binned.bin = r.bin""",
)
def score_histogram(spark, sf_dir):
    bins = profile.histogram(_mean_scores(spark, sf_dir), "sent_score", 20)
    return bins.withColumn("lower", F.round("lower", 9))


@register(
    "report_text",
    f"""{_NEUTRAL}
SELECT substr(shop_name, 1, 20) AS shop_name, printf('%.2f', positive_pct) AS positive_pct,
       printf('%.2f', neutral_pct) AS neutral_pct, printf('%.2f', negative_pct) AS negative_pct,
       array_to_string(string_split(top_positive, ', ')[1:3], ', ') AS top_positive,
       array_to_string(string_split(top_neutral, ', ')[1:3], ', ') AS top_neutral,
       array_to_string(string_split(top_negative, ', ')[1:3], ', ') AS top_negative
FROM report""",
)
def report_text(spark, sf_dir):
    return st.report_table(sentiment_token_all(spark, sf_dir), "shop_name")


@register(
    "report_places",
    f"""{_NEUTRAL}
SELECT shop_name, row_number() OVER (ORDER BY coalesce(positive_pct, 0) DESC, shop_name) AS place,
       row_number() OVER (ORDER BY coalesce(positive_pct, 0), shop_name) AS place_rising FROM report""",
)
def report_places(spark, sf_dir):
    """Places of the shops in both orders of the report table."""
    report = sentiment_token_all(spark, sf_dir).select("shop_name", F.coalesce("positive_pct", F.lit(0.0)).alias("share"))
    falling = ordering.with_place(report, ["-share", "shop_name"])
    return ordering.with_place(falling, ["share", "shop_name"], "place_rising").drop("share")


@register(
    "report_headings",
    _review(["shop_name"]).replace(
        "SELECT t.shop_name, positive_pct", 'SELECT t.shop_name AS "Shop Name", positive_pct AS "Positive (%)"'
    )
    .replace(' "Positive (%)", neutral_pct, negative_pct,',
             ' "Positive (%)", neutral_pct AS "Neutral (%)", negative_pct AS "Negative (%)",')
    .replace("coalesce(top_positive, '') AS top_positive", "coalesce(top_positive, '') AS \"Top Positive Keywords\"")
    .replace("coalesce(top_neutral, '') AS top_neutral", "coalesce(top_neutral, '') AS \"Top Neutral Keywords\"")
    .replace("coalesce(top_negative, '') AS top_negative", "coalesce(top_negative, '') AS \"Top Negative Keywords\""),
)
def report_headings(spark, sf_dir):
    return st.headed_report(_by_review(spark, sf_dir, ("shop_name",)), "shop_name")


@register(
    "result_record",
    _matched(sq.split_whitespace("review_text"), ["shop_name"], 6, 2).replace(
        "SELECT * FROM report",
        "SELECT shop_name, positive_pct AS positive, neutral_pct AS neutral, negative_pct AS negative, "
        "string_split(top_positive, ', ')[1] AS first_positive FROM report",
    ),
)
def result_record(spark, sf_dir):
    nested = st.result_record(sentiment_token_matched(spark, sf_dir), ["shop_name"])
    return nested.select(
        "shop_name",
        *[
            F.col("sentiment_ratios")[name].alias(name.lower())
            for name in ("Positive", "Neutral", "Negative")
        ],
        F.get(F.col("top_keywords")["Positive"], F.lit(0)).alias("first_positive"),
    )
