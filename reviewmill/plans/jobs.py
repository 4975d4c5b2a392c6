"""The composite jobs: reviews and word lists in, report tables out.

Filters on plain columns come first, so they reach the scan; text work starts on what is
left. A job runs while a plan is built only where a table that is not local has to be
measured before it may be broadcast, or an iteration written out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions import text as tx
from reviewmill.functions.constants import (
    CONTENT_POS,
    EXPRESSIVE_POS,
    NO_REVIEW,
    NO_TAGS,
)
from reviewmill.functions.scoring import sign_class_ko
from reviewmill.operators import compare, density, embedding, filters, lattice, merging, words
from reviewmill.operators import sentiment as st
from reviewmill.operators import tokens as tk
from reviewmill.operators.keywords import first_rows
from reviewmill.operators.profile import null_profile
from reviewmill.operators.ranking import rank_cafes
from reviewmill.operators.skew import cut_lineage, list_lookup, lookup_join
from reviewmill.sources.crawl import flatten_crawl

UNIVERSITY, SHOP, TEXT, ROW = "university_name", "shop_name", "review_text", "review_id"


def preprocess_reviews(
    reviews: DataFrame,
    university: str,
    keyword: str,
    dictionary: DataFrame,
    regex: bool = True,
    default_pos: str = "Unknown",
    required: bool = False,
) -> DataFrame:
    """Reviews of one university whose content words match the keyword:
    ``university_name, shop_name, processed_review, keyword``. With ``required`` it raises when the
    university has no review, or none that matches; each is one look for a first row."""
    mine = filters.of_university(reviews, university)
    if required:
        filters.require_rows(mine, f"no reviews of {university}")
    processed = tk.content_text(
        mine, TEXT, ROW, dictionary, CONTENT_POS, "lemma", default_pos, keep=[UNIVERSITY, SHOP]
    )
    kept = processed.filter(filters.keyword_match("processed_review", keyword, regex))
    if required:
        filters.require_rows(kept, f"no reviews of {university} with {keyword}")
    return kept.select(
        ROW, UNIVERSITY, SHOP, "processed_review", F.lit(keyword).alias("keyword")
    )


def merge_shop_text(
    reviews: DataFrame,
    text: str = "processed_review",
    keyword: str | None = None,
    level: str = "shop",
    regex: bool = True,
    keys: tuple[str, ...] = (UNIVERSITY, SHOP),
    row_id: str = ROW,
    **bounds: int,
) -> DataFrame:
    """Merged text per shop, in bounded parts (see ``operators.merging``).

    ``level='review'`` drops reviews without the keyword before merging. ``'shop'`` keeps a
    shop whole: for a regular expression when one of its reviews matches, so ``^`` and ``$``
    are the ends of a review; for a literal when it stands anywhere in the merged text, also
    across reviews. Neither depends on how much text a shop has or how it is cut into parts.
    """
    if level not in ("review", "shop"):
        raise ValueError(f"level must be 'review' or 'shop', not {level!r}")
    groups = list(keys)
    source = reviews
    if keyword is not None and (level == "review" or regex):
        match = filters.keyword_match(text, keyword, regex)
        if level == "review":
            source = source.filter(match)
        else:
            shops = merging.groups_with_matching_row(source, groups, match)
            source = merging.keep_groups(source, shops, groups)
    parts = merging.merge_text(source, groups, text, row_id, **bounds)
    if keyword is None or level == "review" or regex:
        return parts
    shops = merging.groups_with_literal(parts, groups, "merged_text", keyword)
    return merging.keep_groups(parts, shops, groups)


def sentiment_report(
    reviews: DataFrame,
    text: str,
    lexicon: DataFrame,
    mode: str = "token",
    keys: tuple[str, ...] = (SHOP,),
    row_id: str = ROW,
    unmatched: str = "neutral",
    k: int = 5,
    digits: int | None = None,
    splitter: str = "space",
    tie: str = "reference",
    suppress_pure: bool = False,
) -> DataFrame:
    """One report under any of the scoring definitions (see ``operators.sentiment``)."""
    groups = list(keys)
    if mode == "token":
        tokens = tk.explode_tokens(reviews, text, groups, splitter)
        return st.sentiment_by_token(tokens, lexicon, groups, unmatched, k, digits)
    if mode == "review":
        return st.sentiment_by_review(
            reviews, text, row_id, lexicon, groups, k, digits, splitter, tie, suppress_pure
        )
    if mode == "merged":
        return st.sentiment_by_merged_text(reviews, text, lexicon, groups, k, digits, splitter)
    raise ValueError(f"mode must be token, review or merged, not {mode!r}")


def filtered_sentiment(
    reviews: DataFrame,
    university: str,
    keyword: str,
    dictionary: DataFrame,
    lexicon: DataFrame,
    keys: tuple[str, ...] = (SHOP,),
    regex: bool = True,
    k: int = 3,
    tie: str = "reference",
    suppress_pure: bool = False,
    default_pos: str = "Unknown",
) -> DataFrame:
    """Review-level report over the content words of one university's reviews that match the
    keyword: preprocessing and scoring in one plan, nothing is stored in between."""
    processed = preprocess_reviews(reviews, university, keyword, dictionary, regex, default_pos)
    return sentiment_report(
        processed,
        "processed_review",
        lexicon,
        "review",
        keys,
        k=k,
        digits=2,
        splitter="whitespace",
        tie=tie,
        suppress_pure=suppress_pure,
    )


def tagged_sentiment(
    reviews: DataFrame,
    lexicon: DataFrame,
    dictionary: DataFrame,
    keys: tuple[str, ...] = (SHOP,),
    text: str = TEXT,
    retag: bool = True,
    k: int = 6,
    digits: int | None = 2,
    default_pos: str = "Unknown",
) -> DataFrame:
    """Token-level report over lemmas of every class (``retag``) or of content words only."""
    groups = list(keys)
    tagged = tk.tag_tokens(reviews, text, groups, dictionary, default_pos)
    if not retag:
        tagged = tagged.filter(F.col("pos").isin(CONTENT_POS))
    lemmas = tagged.select(*groups, F.col("lemma").alias("word"))
    return st.sentiment_by_token(lemmas, lexicon, groups, "drop", k, digits)


def clean_review_text(text: str | Column) -> Column:
    """Emoji, special characters and digits removed."""
    return tx.remove_digits(tx.remove_special(tx.remove_emojis(text)))


def category_word_counts(
    core: DataFrame,
    reviews: DataFrame,
    dictionary: DataFrame,
    stop: DataFrame,
    k: int = 10,
    text: str = TEXT,
    default_pos: str = "Unknown",
    min_length: int = 2,
) -> DataFrame:
    """Words of the reviews of the ranked cafés, counted per ranking category.

    ``reviews`` has ``university, cafeName`` and the text. Only reviews of listed cafés are
    tokenized, and each once. Cleaning and tokenizing act within a review, so the merged
    text per café is not needed.
    """
    keys = ["university", "cafeName"]
    # a few rows per university and category; written once, so its size can be measured and
    # the reviews need not be shuffled to find the listed cafés
    ranked = cut_lineage(rank_cafes(core, k))
    cafes = ranked.select(*keys).distinct()
    listed = lookup_join(reviews, cafes, keys, "left_semi").withColumn(
        "_clean", clean_review_text(text)
    )
    found = tk.class_words(
        listed, "_clean", keys, dictionary, EXPRESSIVE_POS, stop, "surface", min_length, default_pos
    )
    return words.category_words(ranked, words.count_words(found, keys))


def top_words_by_university(
    reviews: DataFrame,
    dictionary: DataFrame,
    stop: DataFrame,
    k: int = 50,
    key: str = UNIVERSITY,
    text: str = TEXT,
    default_pos: str = "Unknown",
) -> DataFrame:
    """Most frequent nouns of each university: ``university_name, word, n, rank``."""
    nouns = tk.class_words(
        reviews, text, [key], dictionary, ["Noun"], stop, "surface", 2, default_pos
    )
    return words.top_words_by_group(nouns, [key], k)


def noun_lists(
    reviews: DataFrame,
    dictionary: DataFrame,
    stop: DataFrame,
    key: str = UNIVERSITY,
    text: str = TEXT,
    row_id: str = ROW,
    default_pos: str = "Unknown",
    **bounds: int,
) -> DataFrame:
    """All nouns of each university joined by ``|``, in bounded parts."""
    nouns = tk.class_words(
        reviews, text, [key, row_id], dictionary, ["Noun"], stop, "surface", 2, default_pos, listed=True
    )
    return merging.merge_words(nouns, [key], row_id, **bounds)


def compound_counts(reviews: DataFrame, text: str, keys: list[str], dictionary: DataFrame) -> DataFrame:
    """``keys, piece, lemma, pos, n``: dictionary pieces of the words of each group, counted. Words
    without spaces are cut along the best path; each distinct word is cut once."""
    words = reviews.select(*keys, F.explode(tx.word_tokens(text)).alias("word"))
    # written once: the words are read for their pieces and joined to them, the texts are not again
    counted = cut_lineage(words.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n")))
    pieces = lattice.tagged_pieces(counted, dictionary)
    return pieces.groupBy(*keys, "piece", "lemma", "pos").agg(F.sum("n").alias("n"))


def compare_universities(top: DataFrame, key: str = UNIVERSITY, k: int = 10) -> DataFrame:
    """Two clusters of universities in the plane of two principal components, with distance
    to the nearest centre and outlier flag. ``top`` is ``key, word, n, rank``."""
    chosen = top.filter(F.col("rank") <= k)
    placed = compare.principal_components(chosen, key)
    clusters = compare.two_clusters(chosen, placed, key)
    points = placed.join(clusters, key).withColumn("cluster", F.col("cluster") + 1)
    flagged = compare.centroid_outliers(points, "pc", "cluster")
    return flagged.select(
        key,
        F.get("pc", F.lit(0)).alias("pc1"),
        F.get("pc", F.lit(1)).alias("pc2"),
        "cluster",
        "distance_to_center",
        "is_noise",
    )


def topic_profile(top: DataFrame, topics=None, key: str = UNIVERSITY, k: int = 10) -> DataFrame:
    chosen = top.filter(F.col("rank") <= k)
    return words.topic_profile(chosen, key, *([topics] if topics else []))


def review_scores(
    reviews: DataFrame,
    lexicon: DataFrame,
    dictionary: DataFrame,
    text: str = TEXT,
    row_id: str = ROW,
    clean: Callable[[str], Column] = tx.hangul_only,
    default_pos: str = "Unknown",
    with_text: bool = True,
) -> DataFrame:
    """Reviews with noun, adjective and lemma columns and their mean polarity; reviews that
    score 0 are dropped, the others get their class.

    The texts are read once. Short columns of a review travel with its tokens; only the text
    itself is joined back, to the reviews that stay, unless ``with_text`` is off. Where dictionary
    and lexicon can be looked up inside lists, texts go to their row id and tokens never travel.
    """
    short = [c for c in reviews.columns if c not in (row_id, text)]
    keys = [row_id, *short]
    cleaned = reviews.withColumn("_clean", F.coalesce(clean(text), F.lit("")))
    tokens = tk.tag_tokens(cleaned, "_clean", keys, dictionary, default_pos, listed=True)
    columns = {
        "nouns": lambda t: F.when(t["pos"] == "Noun", t["lemma"]),
        "adjectives": lambda t: F.when(t["pos"] == "Adjective", t["lemma"]),
        "words": lambda t: t["word"],
    }
    polarity = list_lookup(lexicon.select("word", "polarity"), "word") if tk.is_listed(tokens) else None
    if polarity is not None:

        def worded(t: Column) -> Column:
            return F.struct(*[t[c].alias(c) for c in ("token_no", "lemma", "pos")], tk.lemma_column(t).alias("word"))

        def scored_word(t: Column) -> Column:
            return F.struct(
                *[t[c].alias(c) for c in ("token_no", "lemma", "pos", "word")],
                polarity(t["word"])["polarity"].alias("polarity"),
            )

        # non_zero would be pushed below the lists and score each a second time
        tokens = tk.nonempty(tokens.select(*keys, F.transform(F.transform("tokens", worded), scored_word).alias("tokens")))
        mean = st.mean_polarity_of("tokens")
    else:
        tokens = tk.as_rows(tokens)
        tokens = lookup_join(
            tokens.withColumn("word", tk.lemma_column(F.struct("lemma", "pos"))), lexicon, ["word"], "left"
        )
        mean = st.mean_polarity()
    scored = tk.regroup(tokens, keys, columns, extra=[mean.alias("sent_score")])
    scored = filters.non_zero(scored).withColumn("sentiment", sign_class_ko("sent_score"))
    if not with_text:
        return scored
    added = ["nouns", "adjectives", "words", "sent_score", "sentiment"]
    return reviews.select(row_id, text).join(scored, row_id).select(*reviews.columns, *added)


def clean_reviews(raw: DataFrame) -> DataFrame:
    """Emoji removed; missing or empty text and missing tags get their defaults."""
    return raw.withColumns(
        {
            TEXT: tx.empty_to(tx.remove_emojis(TEXT), NO_REVIEW),
            "tags": F.coalesce("tags", F.lit(NO_TAGS)),
        }
    )


def tag_frequencies(reviews: DataFrame, tags: str = "tags", k: int = 200) -> DataFrame:
    """Frequencies of normalised tag words."""
    normal = reviews.select(tx.normalize_tags(tags).alias("tags"))
    return words.term_cloud(tk.explode_tokens(normal, "tags", [], "whitespace"), k)


def merged_first_rows(
    df: DataFrame, keys: list[str], text: str, row_id: str, **bounds: int
) -> DataFrame:
    """First row of each group next to the merged text of the group (one row per part)."""
    parts = merging.merge_text(df, keys, text, row_id, **bounds)
    return lookup_join(parts, first_rows(df.drop(text), keys, row_id), keys)


def cluster_texts(
    reviews: DataFrame,
    text: str = TEXT,
    row_id: str = ROW,
    eps: float = 1.0,
    min_samples: int = 5,
    load_encoder=None,
    store=None,
) -> DataFrame:
    """Embed texts and cluster the embeddings by density. ``store`` keeps the embeddings
    (for example ``lambda df: materialize(df, path)``) so a model runs once per text."""
    if load_encoder is None:
        vectors = embedding.embed_hashing(reviews, text, row_id)
    else:
        vectors = embedding.embed_batches(reviews, text, row_id, load_encoder)
    if store is not None:
        vectors = store(vectors)
    return density.dbscan(vectors, row_id, "embedding", eps, min_samples)


__all__ = [
    "category_word_counts",
    "clean_reviews",
    "cluster_texts",
    "compare_universities",
    "filtered_sentiment",
    "flatten_crawl",
    "merge_shop_text",
    "merged_first_rows",
    "noun_lists",
    "preprocess_reviews",
    "null_profile",
    "review_scores",
    "sentiment_report",
    "tag_frequencies",
    "tagged_sentiment",
    "top_words_by_university",
    "topic_profile",
]
