"""Cleaning, tokenizing, tagging, parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewmill.catalog import inputs as inp
from reviewmill.catalog import sql_parts as sq
from reviewmill.catalog.registry import register
from reviewmill.functions import text as tx
from reviewmill.functions.constants import PUNCTUATION_PAIRS, TAG_REPLACEMENTS
from reviewmill.operators import filters, keywords, merging, profile
from reviewmill.operators import tokens as tk
from reviewmill.plans import jobs
from reviewmill.sources import crawl, readers

# ---- cleaning -------------------------------------------------------------

_DECORATED = "review_text || ' ☕ 맛있어요😀! 100점_a'"


def _decorated():
    return F.concat(F.col("review_text"), F.lit(" ☕ 맛있어요😀! 100점_a"))


@register(
    "clean_text",
    f"""WITH {inp.REVIEWS_SQL}
SELECT review_id, {sq.clean(_DECORATED)} AS cleaned,
       trim(regexp_replace(review_text, '{sq.WS}+', ' ', 'g')) AS collapsed FROM reviews""",
)
def clean_text(spark, sf_dir):
    return inp.reviews(spark, sf_dir).select(
        "review_id",
        jobs.clean_review_text(_decorated()).alias("cleaned"),
        tx.collapse_whitespace("review_text").alias("collapsed"),
    )


_LINKED = "shop_name || '@home http://a.b/' || shop_name || ' ' || review_text"


@register(
    "strip_links_mentions",
    f"""WITH {inp.REVIEWS_SQL}
SELECT review_id, regexp_replace(regexp_replace({_LINKED}, 'http{sq.NOT_WS}+', '', 'g'),
       '@{sq.NOT_WS}+', '', 'g') AS cleaned FROM reviews""",
)
def strip_links_mentions(spark, sf_dir):
    linked = F.concat(
        "shop_name", F.lit("@home http://a.b/"), "shop_name", F.lit(" "), "review_text"
    )
    return inp.reviews(spark, sf_dir).select(
        "review_id", tx.remove_mentions(tx.remove_links(linked)).alias("cleaned")
    )


def _unify_sql(x: str) -> str:
    for a, b in PUNCTUATION_PAIRS:
        x = f"replace({x}, {inp.quoted(a)}, {inp.quoted(b)})"
    return x


@register(
    "unify_punct",
    f"""WITH {inp.REVIEWS_SQL}
SELECT review_id, {_unify_sql("'「' || shop_name || '」·“' || review_text || '”～'")} AS cleaned
FROM reviews""",
)
def unify_punct(spark, sf_dir):
    text = F.concat(
        F.lit("「"), "shop_name", F.lit("」·“"), "review_text", F.lit("”～")
    )
    return inp.reviews(spark, sf_dir).select(
        "review_id", tx.unify_punctuation(text).alias("cleaned")
    )


@register(
    "hangul_only",
    f"""WITH {inp.REVIEWS_SQL}
SELECT review_id, {sq.strip("regexp_replace('맛있어요 ' || review_text || ' ㅋㅋ 좋아요!', "
    "'[^ㄱ-ㅎㅏ-ㅣ가-힣" + sq.WS[1:-1] + "]', '', 'g')")} AS cleaned FROM reviews""",
)
def hangul_only(spark, sf_dir):
    text = F.concat(F.lit("맛있어요 "), "review_text", F.lit(" ㅋㅋ 좋아요!"))
    return inp.reviews(spark, sf_dir).select("review_id", tx.hangul_only(text).alias("cleaned"))


_EMOJI_TEXT = "CASE WHEN n_chars % 2 = 1 THEN review_text || '☀' ELSE review_text END"


@register(
    "emoji_filter",
    f"""WITH {inp.REVIEWS_SQL}, marked AS (SELECT review_id, {_EMOJI_TEXT} AS txt FROM reviews)
SELECT review_id, regexp_replace(txt, '{sq.EMOJI}+', '', 'g') AS cleaned FROM marked
WHERE regexp_matches(txt, '{sq.EMOJI}')""",
)
def emoji_filter(spark, sf_dir):
    text = F.when(F.col("n_chars") % 2 == 1, F.concat("review_text", F.lit("☀"))).otherwise(
        F.col("review_text")
    )
    marked = inp.reviews(spark, sf_dir).select("review_id", text.alias("txt"))
    return filters.with_emoji(marked, "txt").select(
        "review_id", tx.remove_emojis("txt").alias("cleaned")
    )


_PHRASES = [
    "매장이 청결해요 특별한 메뉴가 있어요",
    "커피가 맛있어요  친절해요",
    "디저트가 맛있어요 사진이 잘 나와요 아늑해요",
    "화장실이 깨끗해요 가성비가 좋아요 ",
    "빵이 맛있어요 집중하기 좋아요",
]


def _tags():
    phrases = F.array(*[F.lit(p) for p in _PHRASES])
    picked = F.element_at(phrases, (F.col("n_chars") % 5 + 1).cast("int"))
    return F.when(
        F.col("shop_name") != "src0", F.concat(picked, F.lit(" "), F.col("shop_name"))
    )


_TAGS_SQL = (
    "CASE WHEN shop_name <> 'src0' THEN ["
    + ", ".join(inp.quoted(p) for p in _PHRASES)
    + "][n_chars % 5 + 1] || ' ' || shop_name END"
)


def _replace_sql(x: str) -> str:
    for a, b in TAG_REPLACEMENTS:
        x = f"replace({x}, {inp.quoted(a)}, {inp.quoted(b)})"
    return x


_NORMAL_TAGS = f"coalesce(trim(regexp_replace({_replace_sql(_TAGS_SQL)}, '{sq.WS}+', ' ', 'g')), '')"


@register(
    "normalize_tags",
    f"WITH {inp.REVIEWS_SQL} SELECT review_id, {_NORMAL_TAGS} AS tags FROM reviews",
)
def normalize_tags(spark, sf_dir):
    return inp.reviews(spark, sf_dir).select("review_id", tx.normalize_tags(_tags()).alias("tags"))


@register(
    "tag_frequencies",
    f"""WITH {inp.REVIEWS_SQL}, t AS (SELECT {_NORMAL_TAGS} AS tags FROM reviews),
words AS (SELECT unnest({sq.split_whitespace('tags')}) AS word FROM t),
top AS (SELECT word, count(*) AS n FROM words GROUP BY word ORDER BY n DESC, word LIMIT 200)
SELECT word, n, round(n / max(n) OVER (), 9) AS weight FROM top""",
)
def tag_frequencies(spark, sf_dir):
    tagged = inp.reviews(spark, sf_dir).withColumn("tags", _tags())
    return jobs.tag_frequencies(tagged).withColumn("weight", F.round("weight", 9))


def _gappy(spark, sf_dir):
    docs = inp.reviews(spark, sf_dir)
    return docs.select(
        "review_id",
        F.when(F.col("university_name") != "en", F.col("university_name")).alias("university_name"),
        F.when(F.col("shop_name") == "src0", F.lit(""))
        .when(F.col("shop_name") != "src1", F.col("review_text"))
        .alias("review_text"),
        F.when(F.col("n_chars") % 3 != 0, F.col("shop_name")).alias("tags"),
    )


_GAPPY_SQL = f"""{inp.REVIEWS_SQL},
gappy AS (
  SELECT review_id, CASE WHEN university_name <> 'en' THEN university_name END AS university_name,
         CASE WHEN shop_name = 'src0' THEN '' WHEN shop_name <> 'src1' THEN review_text END AS review_text,
         CASE WHEN n_chars % 3 <> 0 THEN shop_name END AS tags FROM reviews)"""


def _profile_row(name: str, kind: str) -> str:
    empty = f"count(*) FILTER ({name} = '')" if kind == "string" else "0"
    return (
        f"SELECT '{name}' AS column_name, '{kind}' AS data_type, "
        f"count(*) FILTER ({name} IS NULL) AS null_count, {empty} AS empty_count, "
        "count(*) AS row_count FROM gappy"
    )


@register(
    "null_profile",
    f"WITH {_GAPPY_SQL} "
    + " UNION ALL ".join(
        _profile_row(n, k)
        for n, k in [
            ("review_id", "bigint"),
            ("university_name", "string"),
            ("review_text", "string"),
            ("tags", "string"),
        ]
    ),
)
def null_profile(spark, sf_dir):
    return profile.null_profile(_gappy(spark, sf_dir))


@register(
    "fill_defaults",
    f"""WITH {_GAPPY_SQL}
SELECT review_id, university_name,
       CASE WHEN coalesce(review_text, '') = '' THEN '리뷰 없음'
            ELSE regexp_replace(review_text, '{sq.EMOJI}+', '', 'g') END AS review_text,
       coalesce(tags, '태그 없음') AS tags FROM gappy""",
)
def fill_defaults(spark, sf_dir):
    return jobs.clean_reviews(_gappy(spark, sf_dir))


# ---- tagging --------------------------------------------------------------

_TAGGED = f"WITH {inp.REVIEWS_SQL}, {inp.DICTIONARY_SQL}, {sq.tagged('reviews', ['review_id'], 'review_text')}"
_TAGGED_LOWER = (
    f"WITH {inp.REVIEWS_SQL}, {inp.DICTIONARY_SQL}, "
    f"{sq.tagged('reviews', ['review_id'], 'review_text', 'lower(tok)')}"
)


def _joined(value: str, condition: str) -> str:
    return f"coalesce(string_agg({value}, ' ' ORDER BY token_no) FILTER ({condition}), '')"


@register(
    "pos_filter",
    f"""{_TAGGED}
SELECT review_id, {_joined('lemma', "pos IN ('Noun', 'Verb', 'Adjective', 'Adverb')")} AS processed_review
FROM tagged GROUP BY review_id""",
)
def pos_filter(spark, sf_dir):
    processed = tk.content_text(
        inp.reviews(spark, sf_dir),
        "review_text",
        "review_id",
        inp.dictionary(spark),
        default_pos="Noun",
    )
    return processed.select("review_id", "processed_review")


@register(
    "pos_columns",
    f"""{_TAGGED}
SELECT review_id, {_joined('lemma', "pos = 'Noun'")} AS nouns,
       {_joined('lemma', "pos = 'Adjective'")} AS adjectives
FROM tagged GROUP BY review_id""",
)
def pos_columns(spark, sf_dir):
    result = tk.pos_columns(
        inp.reviews(spark, sf_dir),
        "review_text",
        "review_id",
        inp.dictionary(spark),
        {"nouns": ["Noun"], "adjectives": ["Adjective"]},
        "Noun",
    )
    return result.select("review_id", "nouns", "adjectives")


@register(
    "expressive_words",
    f"""{_TAGGED}, {inp.STOP_SQL}
SELECT review_id, token_no, surface AS word FROM tagged
WHERE pos IN ('Adjective', 'Verb', 'Exclamation', 'Adverb')
  AND surface NOT IN (SELECT word FROM stop)""",
)
def expressive_words(spark, sf_dir):
    return tk.class_words(
        inp.reviews(spark, sf_dir),
        "review_text",
        ["review_id"],
        inp.dictionary(spark),
        ["Adjective", "Verb", "Exclamation", "Adverb"],
        inp.stop_words(spark),
        "surface",
        default_pos="Noun",
    ).withColumn("token_no", F.col("token_no").cast("long"))


@register(
    "lemmatize",
    f"""{_TAGGED},
worded AS (
  SELECT *, CASE WHEN pos IN ('Adjective', 'Verb')
                 THEN CASE WHEN suffix(lemma, '다') THEN lemma ELSE lemma || '다' END
                 WHEN pos = 'Noun' THEN lemma END AS word FROM tagged)
SELECT review_id, {_joined('word', 'word IS NOT NULL')} AS words FROM worded GROUP BY review_id""",
)
def lemmatize(spark, sf_dir):
    result = tk.lemmatize(
        inp.reviews(spark, sf_dir), "review_text", "review_id", inp.dictionary(spark), "Noun"
    )
    return result.select("review_id", "words")


@register(
    "morphemes",
    f"""{_TAGGED_LOWER}
SELECT review_id, {_joined('lemma', 'TRUE')} AS morphs,
       {_joined("lemma || '/' || pos", 'TRUE')} AS tagged FROM tagged GROUP BY review_id""",
)
def morphemes(spark, sf_dir):
    tokens = tk.tag_tokens(
        inp.reviews(spark, sf_dir),
        "review_text",
        ["review_id"],
        inp.dictionary(spark),
        "Noun",
        F.lower,
        listed=True,
    )
    return tk.regroup(
        tokens,
        ["review_id"],
        {"morphs": lambda t: t["lemma"], "tagged": lambda t: F.concat_ws("/", t["lemma"], t["pos"])},
    )


# ---- preprocessing --------------------------------------------------------


def _preprocess_sql(test: str, keyword: str) -> str:
    return f"""{_TAGGED},
processed AS (
  SELECT review_id, {_joined('lemma', "pos IN ('Noun', 'Verb', 'Adjective', 'Adverb')")} AS processed_review
  FROM tagged GROUP BY review_id)
SELECT review_id, university_name, shop_name, processed_review, {inp.quoted(keyword)} AS keyword
FROM reviews JOIN processed USING (review_id)
WHERE university_name = 'en' AND {test}"""


def _preprocess(spark, sf_dir, keyword, regex):
    return jobs.preprocess_reviews(
        inp.reviews(spark, sf_dir), "en", keyword, inp.dictionary(spark), regex, "Noun"
    )


@register(
    "preprocess_filter_regex",
    _preprocess_sql("regexp_matches(processed_review, 'th(in|or)e?a')", "th(in|or)e?a"),
)
def preprocess_filter_regex(spark, sf_dir):
    return _preprocess(spark, sf_dir, "th(in|or)e?a", True)


@register("preprocess_filter_literal", _preprocess_sql("contains(processed_review, 'be ')", "be "))
def preprocess_filter_literal(spark, sf_dir):
    return _preprocess(spark, sf_dir, "be ", False)


# small bounds on purpose, so that groups really are cut into several parts
_BOUNDS = {"slice_rows": 16, "part_chars": 50_000}


def _parts_sql(source: str, where: str = "TRUE") -> str:
    return f"""
numbered AS (
  SELECT *, CAST(floor((sum(length(review_text) + 1) OVER (
             PARTITION BY university_name, shop_name ORDER BY review_id ROWS UNBOUNDED PRECEDING)
             - length(review_text) - 1) / 50000) AS BIGINT) AS part_no FROM {source} WHERE {where}),
parts AS (
  SELECT university_name, shop_name, part_no, string_agg(review_text, ' ' ORDER BY review_id) AS merged_text
  FROM numbered GROUP BY ALL)"""


@register(
    "merge_shop_text",
    f"WITH {inp.REVIEWS_SQL}, {_parts_sql('reviews')} SELECT * FROM parts",
)
def merge_shop_text(spark, sf_dir):
    return jobs.merge_shop_text(inp.reviews(spark, sf_dir), "review_text", **_BOUNDS)


@register(
    "review_level_filter",
    f"""WITH {inp.REVIEWS_SQL}, {_parts_sql('reviews', "contains(review_text, 'that')")}
SELECT * FROM parts""",
)
def review_level_filter(spark, sf_dir):
    return jobs.merge_shop_text(
        inp.reviews(spark, sf_dir), "review_text", "that", "review", regex=False, **_BOUNDS
    )


def _shops_sql(test: str) -> str:
    return f"""WITH {inp.REVIEWS_SQL}, {_parts_sql('reviews')},
whole AS (SELECT university_name, shop_name FROM reviews GROUP BY ALL HAVING {test})
SELECT parts.* FROM parts JOIN whole USING (university_name, shop_name)"""


def _shops(spark, sf_dir, keyword, regex=True):
    return jobs.merge_shop_text(
        inp.reviews(spark, sf_dir), "review_text", keyword, "shop", regex, **_BOUNDS
    )


@register("shop_level_filter", _shops_sql("bool_or(regexp_matches(review_text, '[.] Th[a-z]+ing'))"))
def shop_level_filter(spark, sf_dir):
    return _shops(spark, sf_dir, "[.] Th[a-z]+ing")


@register(
    "shop_level_literal",
    _shops_sql("contains(string_agg(review_text, ' ' ORDER BY review_id), 'er. Re')"),
)
def shop_level_literal(spark, sf_dir):
    """The literal also matches where one review ends and the next begins."""
    return _shops(spark, sf_dir, "er. Re", False)


@register("shop_level_anchor", _shops_sql("bool_or(regexp_matches(review_text, '^Th.*ed[.]$', 's'))"))
def shop_level_anchor(spark, sf_dir):
    return _shops(spark, sf_dir, "(?s)^Th.*ed[.]$")


@register(
    "merged_part_offsets",
    f"""WITH {inp.REVIEWS_SQL},
begun AS (
  SELECT *, CAST(sum(length(review_text) + 1) OVER (
             PARTITION BY university_name, shop_name ORDER BY review_id ROWS UNBOUNDED PRECEDING)
             - length(review_text) - 1 AS BIGINT) AS begin_at FROM reviews
  WHERE university_name IS NOT NULL AND shop_name IS NOT NULL AND review_text IS NOT NULL)
SELECT university_name, shop_name, begin_at // 50000 AS part_no, min(begin_at) AS "begin",
       CAST(max(begin_at + length(review_text)) - min(begin_at) AS BIGINT) AS n_chars,
       md5(string_agg(review_text, ' ' ORDER BY review_id)) AS digest FROM begun GROUP BY ALL""",
)
def merged_part_offsets(spark, sf_dir):
    """Parts laid end to end are the whole text of a group: each begins where its first review does."""
    parts = jobs.merge_shop_text(inp.reviews(spark, sf_dir), "review_text", **_BOUNDS)
    return merging.part_offsets(parts, ["university_name", "shop_name"], "merged_text")


@register(
    "merge_text_window",
    f"""WITH {inp.REVIEWS_SQL}, {_parts_sql('reviews')},
firsts AS (
  SELECT university_name, shop_name, min(review_id) AS review_id,
         arg_min(n_chars, review_id) AS n_chars FROM reviews GROUP BY ALL)
SELECT p.university_name, p.shop_name, p.part_no, p.merged_text, f.review_id, f.n_chars
FROM parts p JOIN firsts f USING (university_name, shop_name)""",
)
def merge_text_window(spark, sf_dir):
    return jobs.merged_first_rows(
        inp.reviews(spark, sf_dir),
        ["university_name", "shop_name"],
        "review_text",
        "review_id",
        **_BOUNDS,
    )


@register(
    "dedup_first",
    f"""WITH {inp.REVIEWS_SQL}
SELECT review_id, university_name, shop_name, review_text, n_chars FROM reviews
QUALIFY row_number() OVER (PARTITION BY university_name, shop_name ORDER BY review_id) = 1""",
)
def dedup_first(spark, sf_dir):
    return keywords.first_rows(
        inp.reviews(spark, sf_dir), ["university_name", "shop_name"], "review_id"
    )


# ---- context and sentences ------------------------------------------------


@register(
    "kwic",
    f"""WITH {inp.REVIEWS_SQL},
terms AS (SELECT review_id, {sq.split_whitespace('review_text')} AS t FROM reviews),
spots AS (SELECT review_id, t, unnest(t) AS term, generate_subscripts(t, 1) AS i FROM terms)
SELECT review_id, CAST(i - 1 AS INTEGER) AS index,
       array_to_string(t[greatest(1, i - 3):i + 2], ' ') AS context
FROM spots WHERE contains(term, 'tion')""",
)
def kwic(spark, sf_dir):
    return tk.keyword_contexts(
        inp.reviews(spark, sf_dir), "review_text", ["review_id"], "tion"
    )


@register(
    "sentence_split",
    f"""WITH {inp.REVIEWS_SQL},
found AS (
  SELECT review_id, list_filter(list_transform(regexp_extract_all(review_text, '[^.!?]+[.!?]*'),
         lambda s: {sq.strip('s')}), lambda s: s <> '') AS s FROM reviews)
SELECT review_id, CAST(generate_subscripts(s, 1) - 1 AS INTEGER) AS sentence_no, unnest(s) AS sentence
FROM found""",
)
def sentence_split(spark, sf_dir):
    return tk.split_sentences(inp.reviews(spark, sf_dir), "review_text", ["review_id"])


# ---- records and errors ---------------------------------------------------


def _lexicon_lines(spark, sf_dir):
    kind = F.col("review_id") % 4
    n = F.col("n_chars").cast("string")
    line = (
        F.when(kind == 0, F.concat_ws("\t", "shop_name", n))
        .when(kind == 1, F.col("shop_name"))
        .when(kind == 2, F.concat_ws("\t", "shop_name", F.lit("good")))
        .otherwise(F.concat_ws("\t", "shop_name", (F.col("n_chars") % 5 - 2).cast("string")))
    )
    return inp.reviews(spark, sf_dir).select(line.alias("value"), F.col("review_id").alias("at"))


@register(
    "lexicon_lenient",
    f"""WITH {inp.REVIEWS_SQL},
lines AS (
  SELECT review_id, CASE review_id % 4 WHEN 0 THEN shop_name || chr(9) || n_chars
         WHEN 1 THEN shop_name WHEN 2 THEN shop_name || chr(9) || 'good'
         ELSE shop_name || chr(9) || (n_chars % 5 - 2) END AS value FROM reviews),
parsed AS (
  SELECT *, string_split(value, chr(9)) AS f,
         TRY_CAST(string_split(value, chr(9))[2] AS INTEGER) AS polarity FROM lines)
SELECT f[1] AS word, arg_max(polarity, review_id) AS polarity, 'entry' AS kind, 1 AS n FROM parsed
WHERE len(f) = 2 AND polarity IS NOT NULL GROUP BY f[1]
UNION ALL
SELECT value, NULL, 'reject', count(*) FROM parsed
WHERE len(f) <> 2 OR polarity IS NULL GROUP BY value""",
)
def lexicon_lenient(spark, sf_dir):
    entries, rejects = readers.split_lexicon_lines(_lexicon_lines(spark, sf_dir))
    good = readers.last_wins(entries).select(
        "word", "polarity", F.lit("entry").alias("kind"), F.lit(1).cast("long").alias("n")
    )
    bad = rejects.groupBy(F.col("value").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return good.unionByName(
        bad.select("word", F.lit(None).cast("int").alias("polarity"), F.lit("reject").alias("kind"), "n")
    )


@register(
    "record_parse",
    f"""WITH {inp.REVIEWS_SQL},
comma AS (SELECT review_id, string_split({sq.strip('review_text')}, ',') AS f FROM reviews),
tab AS (SELECT review_id, string_split(shop_name || chr(9) || university_name
        || CASE WHEN n_chars % 2 = 0 THEN chr(9) || n_chars ELSE '' END, chr(9)) AS f FROM reviews)
SELECT review_id, 'comma' AS kind, f[2] AS shop, f[3] AS review FROM comma WHERE len(f) >= 4
UNION ALL SELECT review_id, 'tab', f[1], f[3] FROM tab WHERE len(f) = 3""",
)
def record_parse(spark, sf_dir):
    docs = inp.reviews(spark, sf_dir)
    lines = docs.select("review_id", F.col("review_text").alias("value"))
    comma = readers.comma_records(lines, 4, {1: "shop", 2: "review"}, ["review_id"])
    extra = F.when(F.col("n_chars") % 2 == 0, F.col("n_chars").cast("string"))
    tabbed = docs.select(
        "review_id", F.concat_ws("\t", "shop_name", "university_name", extra).alias("value")
    )
    tab = readers.tab_records(tabbed, ["shop", "university", "review"], ["review_id"])
    return comma.select("review_id", F.lit("comma").alias("kind"), "shop", "review").unionByName(
        tab.select("review_id", F.lit("tab").alias("kind"), "shop", "review")
    )


@register(
    "error_split",
    f"""WITH {inp.REVIEWS_SQL},
parsed AS (SELECT university_name, len(string_split(review_text, ',')) AS n FROM reviews)
SELECT CASE WHEN n < 5 THEN 'Error' ELSE university_name END AS key,
       CASE WHEN n < 5 THEN 'only ' || n || ' fields' END AS message, count(*) AS n
FROM parsed GROUP BY 1, 2""",
)
def error_split(spark, sf_dir):
    arity = F.size(F.split("review_text", ","))
    reason = F.when(arity < 5, F.concat(F.lit("only "), arity, F.lit(" fields")))
    good, bad = filters.split_errors(inp.reviews(spark, sf_dir), reason)
    keyed = good.select(
        F.col("university_name").alias("key"), F.lit(None).cast("string").alias("message")
    )
    return keyed.unionByName(bad).groupBy("key", "message").agg(F.count(F.lit(1)).alias("n"))


# ---- nested crawl ---------------------------------------------------------


@register(
    "flatten_crawl",
    """WITH lines AS (
  SELECT conv_id, turn, role, unnest(string_split("text", chr(10))) AS line FROM conversations)
SELECT 'shop' || conv_id AS shop_name,
       CASE WHEN role = 'user' THEN CAST(turn + 0.5 AS DOUBLE) END AS shop_avg_rating,
       CAST(length(line) AS INTEGER) AS reviewer_review_count, line AS review_text,
       '2023.12.' || turn || '.' AS review_date,
       CASE WHEN length(line) % 3 <> 0 THEN CAST(length(line) % 7 AS INTEGER) END AS shop_visit_count,
       role || ' turn' || turn AS tags FROM lines""",
)
def flatten_crawl(spark, sf_dir):
    talk = inp.table(spark, sf_dir, "conversations")
    turn = F.col("turn").cast("string")

    def review(line):
        n = F.length(line)
        visits = F.when(n % 3 != 0, F.concat((n % 7).cast("string"), F.lit("번째 방문"))).otherwise(
            F.lit("방문 정보 없음")
        )
        return F.struct(
            F.concat(F.lit("리뷰 "), n.cast("string")).alias("리뷰어 리뷰수"),
            line.alias("리뷰 텍스트"),
            F.concat(F.lit("2023.12."), turn, F.lit(".")).alias("리뷰 날짜"),
            visits.alias("가게 방문수"),
            F.array(F.col("role"), F.concat(F.lit("turn"), turn)).alias("태그들"),
        )

    rating = F.when(
        F.col("role") == "user", F.concat(F.lit("별점\n"), turn, F.lit(".5"))
    ).otherwise(F.lit("평점 없음"))
    shop = F.struct(
        F.concat(F.lit("shop"), F.col("conv_id").cast("string")).alias("가게이름"),
        rating.alias("가게 평균 평점"),
        F.transform(F.split("text", "\n"), review).alias("가게 리뷰"),
    )
    documents = talk.select(F.to_json(shop).alias("json"))
    shops = documents.select(F.from_json("json", crawl.CRAWL_SCHEMA).alias("s")).select("s.*")
    return crawl.flatten_crawl(shops).withColumn(
        "shop_avg_rating", F.col("shop_avg_rating").cast("double")
    )


@register(
    "blank_reviews_skipped",
    f"""WITH {inp.REVIEWS_SQL}
SELECT review_id FROM reviews WHERE review_id % 3 <> 0 AND trim(review_text) <> ''""",
)
def blank_reviews_skipped(spark, sf_dir):
    """Reviews that are null or white space only don't reach a report."""
    blanked = inp.reviews(spark, sf_dir).withColumn(
        "review_text", F.when(F.col("review_id") % 3 != 0, F.col("review_text")).otherwise(" \t")
    )
    return filters.not_blank(blanked, "review_text").select("review_id")


@register(
    "nonzero_scores",
    f"""WITH {inp.REVIEWS_SQL}
SELECT review_id, CAST(n_chars % 3 AS DOUBLE) - 1 AS sent_score FROM reviews WHERE n_chars % 3 <> 1""",
)
def nonzero_scores(spark, sf_dir):
    scored = inp.reviews(spark, sf_dir).select(
        "review_id", ((F.col("n_chars") % 3).cast("double") - 1).alias("sent_score")
    )
    return filters.non_zero(scored)


@register(
    "first_items_and_lookups",
    f"""WITH {inp.REVIEWS_SQL},
words AS (SELECT review_id, string_split(review_text, ' ') AS w, university_name AS u FROM reviews)
SELECT review_id, array_to_string(w[1:3], ' ') AS head, CASE WHEN u = 'en' THEN len(w) ELSE -1 END AS n_en FROM words""",
)
def first_items_and_lookups(spark, sf_dir):
    """The first items of a list, and a map entry with a default."""
    words = inp.reviews(spark, sf_dir).withColumn("w", tx.split_space("review_text"))
    by_language = F.create_map(F.col("university_name"), F.size("w").cast("long"))
    return words.select(
        "review_id",
        F.array_join(tx.first_items("w", 3), " ").alias("head"),
        tx.map_get(by_language, "en", -1).alias("n_en"),
    )


# every distinct word is folded from its end, with the best rests of all later starts in a list
@register(
    "compound_pieces",
    f"""WITH RECURSIVE {inp.DICTIONARY_SQL}, {inp.REVIEWS_SQL},
toks AS (SELECT university_name, unnest(regexp_extract_all(review_text, '{sq.WORD_TOKEN}')) AS word FROM reviews),
counts AS MATERIALIZED (SELECT university_name, word, count(*) AS n FROM toks GROUP BY ALL),
cuttable AS MATERIALIZED (SELECT DISTINCT word FROM counts WHERE regexp_matches(word, '^[\\p{{L}}\\p{{M}}]')),
starts AS (SELECT word, unnest(range(1, length(word) + 1)) AS start FROM cuttable),
edges AS MATERIALIZED (
  SELECT word, start, list(length(surface)) AS sizes
  FROM starts JOIN dictionary ON substr(word, start, length(surface)) = surface GROUP BY ALL),
fold(word, start, rests) AS (
  SELECT word, length(word) + 1, [{{'cost': 0::BIGINT, 'steps': []::INTEGER[]}}] FROM cuttable
  UNION ALL
  SELECT fold.word, fold.start - 1, list_prepend(list_sort(list_concat(
      list_transform(coalesce(sizes, []), lambda s: {{
        'cost': rests[s].cost + 1, 'steps': list_prepend((-s)::INTEGER, rests[s].steps)}}),
      [{{'cost': rests[1].cost + 1000001, 'steps': list_prepend(0::INTEGER, rests[1].steps)}}]))[1], rests)
  FROM fold LEFT JOIN edges ON edges.word = fold.word AND edges.start = fold.start - 1 WHERE fold.start > 1),
steps AS (SELECT word, unnest(rests[1].steps) AS step, generate_subscripts(rests[1].steps, 1) AS no FROM fold WHERE start = 1),
placed AS (
  SELECT word, no, step, 1 + coalesce(sum(CASE WHEN step = 0 THEN 1 ELSE -step END) OVER (
    PARTITION BY word ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM steps),
runs AS (
  SELECT *, sum(CASE WHEN step = 0 AND before = 0 THEN 0 ELSE 1 END) OVER (PARTITION BY word ORDER BY no) AS run
  FROM (SELECT *, lag(step, 1, 1) OVER (PARTITION BY word ORDER BY no) AS before FROM placed)),
pieces AS (
  SELECT word, string_agg(substr(word, start::BIGINT, CASE WHEN step = 0 THEN 1 ELSE -step END), '' ORDER BY no) AS piece
  FROM runs GROUP BY word, run
  UNION ALL
  SELECT word, word FROM (SELECT DISTINCT word FROM counts) WHERE NOT regexp_matches(word, '^[\\p{{L}}\\p{{M}}]'))
SELECT university_name, piece, coalesce(lemma, piece) AS lemma,
       coalesce(pos, CASE WHEN regexp_matches(piece, '^\\p{{N}}') THEN 'Number'
                          WHEN regexp_matches(piece, '^[\\p{{L}}\\p{{M}}]') THEN 'Unknown' ELSE 'Punctuation' END) AS pos,
       sum(n)::BIGINT AS n
FROM counts JOIN pieces USING (word) LEFT JOIN dictionary ON piece = surface GROUP BY ALL""",
)
def compound_pieces(spark, sf_dir):
    """Pieces of unspaced words by university: words are counted first, then cut once each."""
    return jobs.compound_counts(
        inp.reviews(spark, sf_dir), "review_text", ["university_name"], inp.dictionary(spark)
    )
