"""Round trips through the sinks and sources, and the Python hooks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from reviewmill.catalog import inputs as inp
from reviewmill.catalog import sql_parts as sq
from reviewmill.catalog.registry import register
from reviewmill.catalog.word_queries import _RANKED
from reviewmill.operators import hooks
from reviewmill.operators.ranking import rank_cafes
from reviewmill.operators.skew import scratch_path
from reviewmill.sources import readers, writers


def _eight_columns(spark, sf_dir):
    return inp.reviews(spark, sf_dir).select(
        "university_name",
        "shop_name",
        (F.col("n_chars") % 5).cast("float").alias("shop_avg_rating"),
        F.col("n_chars").cast("int").alias("reviewer_review_count"),
        "review_text",
        F.lit("2023.12.20.").alias("review_date"),
        F.col("review_id").cast("int").alias("shop_visit_count"),
        F.lit(None).cast("string").alias("tags"),
    )


@register(
    "io_csv",
    f"""WITH {inp.REVIEWS_SQL}
SELECT university_name, shop_name, CAST(n_chars % 5 AS DOUBLE) AS shop_avg_rating,
       CAST(n_chars AS INTEGER) AS reviewer_review_count, review_text,
       CAST(review_id AS INTEGER) AS shop_visit_count FROM reviews""",
)
def io_csv(spark, sf_dir):
    path = scratch_path(spark, "reviews-csv")
    writers.write_csv(_eight_columns(spark, sf_dir), path)
    back = readers.read_reviews(spark, path, add_id=False)
    return back.select(
        "university_name",
        "shop_name",
        F.col("shop_avg_rating").cast("double").alias("shop_avg_rating"),
        "reviewer_review_count",
        "review_text",
        "shop_visit_count",
    )


@register(
    "io_stable_ids",
    f"""WITH {inp.REVIEWS_SQL}
SELECT row_number() OVER (ORDER BY review_id) - 1 AS review_id, CAST(review_id AS INTEGER) AS shop_visit_count,
       md5(review_text) AS review_text FROM reviews""",
)
def io_stable_ids(spark, sf_dir):
    """Files written in the order of the ids; rows get their numbers back however files are split."""
    path = scratch_path(spark, "ordered-csv")
    rows = _eight_columns(spark, sf_dir).withColumn("review_text", F.md5("review_text"))
    rows = rows.repartitionByRange("shop_visit_count").sortWithinPartitions("shop_visit_count")
    writers.write_csv(rows, path)
    back = readers.read_reviews(spark, path, multiline=False)
    return back.select("review_id", "shop_visit_count", "review_text")


@register(
    "io_lexicon",
    f"""WITH {inp.REVIEWS_SQL}
SELECT shop_name AS word, CAST(arg_max(n_chars % 5 - 2, review_id) AS INTEGER) AS polarity
FROM reviews WHERE shop_name IS NOT NULL AND n_chars IS NOT NULL GROUP BY shop_name""",
)
def io_lexicon(spark, sf_dir):
    """A lexicon file with a line per review, read strictly: of a word's lines the last counts."""
    path = scratch_path(spark, "lexicon")
    rows = inp.reviews(spark, sf_dir).dropna(subset=["shop_name", "n_chars"])
    rows = rows.repartitionByRange("review_id").sortWithinPartitions("review_id")
    line = F.concat_ws("\t", "shop_name", (F.col("n_chars") % 5 - 2).cast("int"))
    rows.select(line.alias("value")).write.text(path)
    return readers.read_lexicon(spark, path)


@register(
    "io_word_list",
    f"""WITH {inp.REVIEWS_SQL}
SELECT DISTINCT word FROM (SELECT unnest(regexp_extract_all(review_text, '[a-z]+')) AS word FROM reviews)""",
)
def io_word_list(spark, sf_dir):
    """A word per line, empty lines and repeated words among them, read as a table of words."""
    path = scratch_path(spark, "words")
    words = F.explode(F.split("review_text", "[^a-z]+")).alias("value")
    inp.reviews(spark, sf_dir).select(words).write.text(path)
    return readers.read_words(spark, path)


@register(
    "io_text",
    f"""WITH {inp.REVIEWS_SQL}
SELECT unnest(string_split(review_text, chr(10))) AS value FROM reviews""",
)
def io_text(spark, sf_dir):
    path = scratch_path(spark, "lines")
    writers.write_text_lines(inp.reviews(spark, sf_dir), "review_text", path)
    return readers.read_lines(spark, path)


@register(
    "io_parts",
    f"""WITH {_RANKED}
SELECT category, university, cafe AS "cafeName", r AS "avgRating", CAST(c AS BIGINT) AS "totalReviewerCount",
       CAST(v AS BIGINT) AS "totalVisitCount" FROM ranked""",
)
def io_parts(spark, sf_dir):
    """One partitioned write for all categories, read back as headerless parts."""
    root = scratch_path(spark, "ranking")
    ranked = rank_cafes(inp.core(spark, sf_dir), 10).drop("rank")
    columns = ["university", "cafeName", "avgRating", "totalReviewerCount", "totalVisitCount"]
    ranked.select("category", *columns).write.partitionBy("category").csv(root)
    return readers.read_result_parts(spark, [root, root + "-missing"])


@register(
    "io_delimited",
    f"""WITH {inp.CORE_SQL}
SELECT university, cafe AS "cafeName", CAST(rating AS DOUBLE) AS "avgRating",
       CAST(reviewers AS INTEGER) AS "reviewerCount", visits AS "visitCount" FROM core""",
)
def io_delimited(spark, sf_dir):
    path = scratch_path(spark, "core")
    writers.store_delimited(inp.core(spark, sf_dir), path)
    return readers.read_core(spark, path).withColumn(
        "avgRating", F.col("avgRating").cast("double")
    )


@register(
    "io_corpus",
    f"""WITH {inp.REVIEWS_SQL},
lines AS (SELECT shop_name, unnest(string_split(review_text, chr(10))) AS line FROM reviews)
SELECT shop_name, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars FROM lines
GROUP BY shop_name""",
)
def io_corpus(spark, sf_dir):
    """Text files in one folder per shop, read back one row per file."""
    path = scratch_path(spark, "corpus")
    docs = inp.reviews(spark, sf_dir)
    docs.select("shop_name", "review_text").write.partitionBy("shop_name").text(path)
    whole = readers.read_corpus(spark, path + "/*")
    folder = F.regexp_extract("file_id", "shop_name=([^/]+)/", 1)
    files = whole.select(folder.alias("shop_name"), F.split("text", "\n").alias("l"))
    lines = files.select("shop_name", F.explode(F.slice("l", F.lit(1), F.size("l") - 1)).alias("line"))
    return lines.groupBy("shop_name").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.length("line")).alias("chars")
    )


@register(
    "io_materialize",
    f"WITH {inp.REVIEWS_SQL} SELECT university_name, count(*) AS n FROM reviews GROUP BY ALL",
)
def io_materialize(spark, sf_dir):
    path = scratch_path(spark, "counts")
    counts = inp.reviews(spark, sf_dir).groupBy("university_name").agg(
        F.count(F.lit(1)).alias("n")
    )
    writers.materialize(counts, path)
    return writers.materialize(counts.filter("false"), path)


@register(
    "io_embeddings",
    """SELECT vec_id AS id, len(embedding) AS d, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS s
FROM embeddings""",
)
def io_embeddings(spark, sf_dir):
    path = scratch_path(spark, "vectors")
    vectors = inp.table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "id")
    writers.write_embeddings(vectors, path)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return readers.read_embeddings(spark, path).select(
        "id", F.size("embedding").cast("long").alias("d"), F.round(total, 6).alias("s")
    )


# ---- hooks ----------------------------------------------------------------


def _load_toy_tagger():
    def tag(text: str) -> list[tuple[str, str, str]]:
        return [(w, w.lower(), "Noun" if len(w) % 2 else "Verb") for w in text.split(" ") if w]

    return tag


@register(
    "udf_hooks",
    f"""WITH {inp.REVIEWS_SQL},
toks AS (SELECT review_id, unnest({sq.split_space('review_text')}) AS w FROM reviews)
SELECT review_id, count(*) FILTER (length(w) % 2 = 1) AS nouns,
       count(*) FILTER (length(w) % 2 = 0) AS verbs FROM toks WHERE w <> '' GROUP BY ALL""",
)
def udf_hooks(spark, sf_dir):
    tagged = hooks.tag_with(
        inp.reviews(spark, sf_dir), "review_text", "review_id", _load_toy_tagger
    )
    return tagged.groupBy("review_id").agg(
        F.count_if(F.col("pos") == "Noun").alias("nouns"),
        F.count_if(F.col("pos") == "Verb").alias("verbs"),
    )


def _load_joiner():
    return lambda text: text.replace(" ", "_")


@register(
    "udf_text",
    f"""WITH {inp.REVIEWS_SQL}
SELECT review_id, replace(review_text, ' ', '_') AS joined FROM reviews""",
)
def udf_text(spark, sf_dir):
    join = hooks.text_function(_load_joiner)
    return inp.reviews(spark, sf_dir).select("review_id", join("review_text").alias("joined"))


@register(
    "udf_map_reduce",
    f"""WITH {inp.REVIEWS_SQL}
SELECT shop_name, count(*) AS reviews, CAST(sum(len(string_split(review_text, ' '))) AS BIGINT) AS words
FROM reviews GROUP BY shop_name""",
)
def udf_map_reduce(spark, sf_dir):
    def measure(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "shop_name": batch["shop_name"],
                "reviews": 1,
                "words": batch["review_text"].str.split(" ").str.len(),
            }
        )

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.groupby("shop_name", as_index=False)[["reviews", "words"]].sum()

    schema = "shop_name string, reviews long, words long"
    pairs = hooks.map_records(
        inp.reviews(spark, sf_dir).select("shop_name", "review_text"), measure, schema
    )
    return hooks.combine_by_key(pairs, ["shop_name"], total, schema)


@register(
    "io_partitioned",
    f"""WITH {inp.REVIEWS_SQL}
SELECT university_name, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM reviews GROUP BY ALL""",
)
def io_partitioned(spark, sf_dir):
    """One folder per university, read back as a table."""
    path = scratch_path(spark, "by-university")
    rows = inp.reviews(spark, sf_dir).select("review_id", "university_name", "n_chars")
    writers.write_partitioned(rows, path, ["university_name"])
    return spark.read.parquet(path).groupBy("university_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars")
    )


@register(
    "io_single_file",
    f"""WITH {inp.REVIEWS_SQL} SELECT review_id, n_chars, 1 AS files FROM reviews""",
)
def io_single_file(spark, sf_dir):
    path = scratch_path(spark, "one-file")
    writers.write_csv(inp.reviews(spark, sf_dir).select("review_id", "n_chars"), path, single_file=True)
    back = spark.read.option("header", True).schema("review_id long, n_chars long").csv(path)
    files = back.select(F.col("_metadata.file_path").alias("f")).distinct().count()
    return back.select("review_id", "n_chars", F.lit(files).alias("files"))
