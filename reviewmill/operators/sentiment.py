"""Sentiment per group under the four scoring definitions in use.

=============  ==========================================================================
token, drop    share of tokens per class among tokens found in the lexicon
token, neutral the same over all tokens, unknown words counting as Neutral
review         share of reviews per dominant class of the review
merged text    all reviews of a group read as one text, then as ``token, drop``
=============  ==========================================================================

A lexicon has the columns ``word, polarity``, one row per word. Scores are reported in the
columns ``positive_pct, neutral_pct, negative_pct, top_positive, top_neutral,
top_negative``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.constants import CLASSES
from reviewmill.functions.scoring import dominant_class, percentage, sign_class
from reviewmill.operators.keywords import ranked_list, top_k, top_words
from reviewmill.operators.skew import lookup_join
from reviewmill.operators.tokens import explode_tokens

REPORT_ORDER = ("Positive", "Neutral", "Negative")


def count_class_words(
    tokens: DataFrame, lexicon: DataFrame, keys: list[str], unmatched: str = "drop"
) -> DataFrame:
    """Occurrences ``n`` per ``keys, sentiment, word``.

    ``unmatched='drop'`` forgets unknown words, ``'neutral'`` counts them as Neutral, and
    ``'keep'`` folds them into one row per group with a null class and word.
    """
    # counting first leaves one row per distinct word for the join, and no hot rows
    counts = tokens.groupBy(*keys, "word").agg(F.count("word").alias("n"), F.count(F.lit(1)).alias("rows"))
    if unmatched == "drop":
        known = lookup_join(counts, lexicon, ["word"])
        return known.select(*keys, sign_class("polarity").alias("sentiment"), "word", "n")
    scored = lookup_join(counts, lexicon, ["word"], "left")
    if unmatched == "neutral":
        return scored.select(
            *keys,
            sign_class(F.coalesce("polarity", F.lit(0))).alias("sentiment"),
            "word",
            "n",
        )
    if unmatched == "keep":
        return (
            scored.withColumn("sentiment", sign_class("polarity"))
            .withColumn("word", F.when(F.col("polarity").isNotNull(), F.col("word")))
            .groupBy(*keys, "sentiment", "word")
            .agg(F.sum("rows").alias("n"))
        )
    raise ValueError(f"unmatched must be drop, neutral or keep, not {unmatched!r}")


def class_totals(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Tokens per class and in total; rows with a null class count in no column."""

    def total(name: str | None) -> Column:
        hit = F.col("sentiment") == name if name else F.col("sentiment").isNotNull()
        return F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0))

    return counts.groupBy(*keys).agg(
        *[total(name).alias(name.lower()) for name in CLASSES], total(None).alias("total")
    )


def percentages(digits: int | None = None) -> list[Column]:
    """Percentage columns over the columns of ``class_totals``."""
    return [
        percentage(name.lower(), "total", digits).alias(f"{name.lower()}_pct")
        for name in REPORT_ORDER
    ]


def _class_rows(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Per-class sums in the row shape of ``_report``."""
    return counts.groupBy(*keys, "sentiment").agg(F.sum("n").alias("n")).select(
        *keys,
        F.lit(0).alias("is_word"),
        "sentiment",
        F.lit(None).cast("string").alias("word"),
        "n",
        F.lit(1).alias("rank"),
    )


def _report(
    rows: DataFrame, keys: list[str], digits: int | None, suppress_pure: bool = False
) -> DataFrame:
    """One report row per group from class rows (``is_word = 0``, n texts or tokens) and
    ranked keyword rows (``is_word = 1``). At most a few rows per group arrive here."""

    def total(name: str | None) -> Column:
        known = F.col("sentiment") == name if name else F.col("sentiment").isNotNull()
        return F.coalesce(F.sum(F.when((F.col("is_word") == 0) & known, F.col("n"))), F.lit(0))

    def words(name: str) -> Column:
        return ranked_list("word", (F.col("is_word") == 1) & (F.col("sentiment") == name))

    wide = rows.groupBy(*keys).agg(
        *[total(name).alias(name.lower()) for name in CLASSES],
        total(None).alias("total"),
        *[F.array_join(words(name), ", ").alias(f"top_{name.lower()}") for name in CLASSES],
    )

    def listed(name: str) -> Column:
        column = F.col(f"top_{name.lower()}")
        if not suppress_pure:
            return column
        pure_elsewhere = F.lit(False)
        for other in ("Positive", "Negative"):
            if other != name:
                share = percentage(other.lower(), "total", digits)
                pure_elsewhere = pure_elsewhere | (share == 100)
        return F.when(pure_elsewhere, F.lit("")).otherwise(column)

    return wide.select(
        *keys,
        *percentages(digits),
        *[listed(name).alias(f"top_{name.lower()}") for name in REPORT_ORDER],
    )


def sentiment_by_token(
    tokens: DataFrame,
    lexicon: DataFrame,
    keys: list[str],
    unmatched: str = "drop",
    k: int = 5,
    digits: int | None = None,
) -> DataFrame:
    """Token-level report. Class sums and keywords read the same ``(keys, sentiment, word)``
    shuffle and meet in a union, so the text is scanned once. With ``unmatched='keep'``
    groups without any lexicon word stay, with null percentages."""
    counts = count_class_words(tokens, lexicon, keys, unmatched)
    ranked = top_words(counts, [*keys, "sentiment"], k).select(
        *keys, F.lit(1).alias("is_word"), "sentiment", "word", "n", "rank"
    )
    return _report(_class_rows(counts, keys).unionByName(ranked), keys, digits)


def polarity_counts(tokens: DataFrame, lexicon: DataFrame, keys: list[str]) -> DataFrame:
    """Positive, negative and neutral occurrences of lexicon words per group."""
    counts = tokens.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n"))
    known = lookup_join(counts, lexicon, ["word"])

    def total(hit: Column) -> Column:
        return F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0))

    return known.groupBy(*keys).agg(
        total(F.col("polarity") > 0).alias("positive_count"),
        total(F.col("polarity") < 0).alias("negative_count"),
        total(F.col("polarity") == 0).alias("neutral_count"),
    )


def _scored_tokens(
    df: DataFrame, text: str, keep: list[str], lexicon: DataFrame, splitter: str
) -> DataFrame:
    """All tokens with ``sentiment`` (null for unknown words); rows without tokens stay."""
    tokens = explode_tokens(df, text, keep, splitter, keep_empty_rows=True)
    return lookup_join(tokens, lexicon, ["word"], "left").withColumn(
        "sentiment", sign_class("polarity")
    )


def _class_counts() -> list[Column]:
    return [F.count_if(F.col("sentiment") == name).alias(name.lower()) for name in CLASSES]


def sentiment_by_review(
    df: DataFrame,
    text: str,
    row_id: str,
    lexicon: DataFrame,
    keys: list[str],
    k: int = 3,
    digits: int | None = 2,
    splitter: str = "whitespace",
    tie: str = "reference",
    suppress_pure: bool = False,
) -> DataFrame:
    """Share of reviews per dominant class, with the top words of each class.

    One scan and one token shuffle: grouping sets count the classes of each review and the
    words of each group side by side. The large first grouping is keyed by review, so a hot
    group is spread; what remains per group is one row per class and per distinct word.
    With ``suppress_pure`` a group that is 100 % Positive (or Negative) lists only the words
    of that class.
    """
    scored = _scored_tokens(df, text, [row_id, *keys], lexicon, splitter)
    known = scored.withColumn("word", F.when(F.col("sentiment").isNotNull(), F.col("word")))
    per_review = [*keys, row_id]
    per_word = [*keys, "sentiment", "word"]
    columns = [*keys, row_id, "sentiment", "word"]
    # `label` repeats the class: grouped columns are nulled in the sets that leave them out
    known = known.withColumn("label", F.col("sentiment"))
    counted = known.groupingSets([per_review, per_word], *columns).agg(
        F.grouping(row_id).alias("is_word"),
        *[F.count_if(F.col("label") == name).alias(name.lower()) for name in CLASSES],
    )
    review_class = dominant_class("positive", "negative", "neutral", tie)
    is_word = F.col("is_word") == 1
    merged = (
        counted.select(
            *keys,
            "is_word",
            F.when(is_word, F.col("sentiment")).otherwise(review_class).alias("sentiment"),
            F.when(is_word, F.col("word")).alias("word"),
            F.when(is_word, F.col("positive") + F.col("negative") + F.col("neutral"))
            .otherwise(1)
            .alias("n"),
        )
        .groupBy(*keys, "is_word", "sentiment", "word")
        .agg(F.sum("n").alias("n"))
        .filter("sentiment IS NOT NULL")
    )
    # a class has a single review row, hence rank 1: the rank filter never drops it
    ranked = top_k(
        merged, [*keys, "is_word", "sentiment"], [F.desc("n"), F.asc("word")], k
    )

    return _report(ranked, keys, digits, suppress_pure)


def sentiment_by_merged_text(
    df: DataFrame,
    text: str,
    lexicon: DataFrame,
    keys: list[str],
    k: int = 3,
    digits: int | None = 2,
    splitter: str = "whitespace",
) -> DataFrame:
    """Score each group as if its reviews were one text.

    Joining reviews by a space does not change the whitespace tokens, so the text is never
    built. Groups without a lexicon word get null percentages.
    """
    tokens = explode_tokens(df, text, keys, splitter, keep_empty_rows=True)
    return sentiment_by_token(tokens, lexicon, keys, "keep", k, digits)


def keyword_table_outer(counts: DataFrame, keys: list[str], k: int = 5) -> DataFrame:
    """Class slices of the top-k keyword table, outer-joined on the group; a class without
    words is null."""
    ranked = top_words(counts.filter("sentiment IS NOT NULL"), [*keys, "sentiment"], k)
    lists = ranked.groupBy(*keys, "sentiment").agg(
        F.array_join(ranked_list("word", F.lit(True)), ", ").alias("words")
    )
    slices = [
        lists.filter(F.col("sentiment") == name).select(
            *keys, F.col("words").alias(f"top_{name.lower()}")
        )
        for name in CLASSES
    ]
    first, second, third = slices
    return first.join(second, keys, "outer").join(third, keys, "outer")


def class_pivot(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Class counts as columns ``Positive, Neutral, Negative``; a missing class is 0."""
    wide = counts.groupBy(*keys).pivot("sentiment", ["Positive", "Neutral", "Negative"])
    return wide.agg(F.sum("n")).fillna(0)


def mean_polarity(min_length: int = 2) -> Column:
    """Aggregate over scored tokens: mean polarity of words of at least ``min_length``
    characters, 0 without any."""
    hit = F.when(F.length("word") >= min_length, F.col("polarity").cast("double"))
    return F.coalesce(F.avg(hit), F.lit(0.0))


def mean_polarity_of(tokens: str, min_length: int = 2) -> Column:
    """``mean_polarity`` of a list of scored tokens."""
    hits = F.filter(tokens, lambda t: (F.length(t["word"]) >= min_length) & t["polarity"].isNotNull())
    total = F.aggregate(hits, F.lit(0.0), lambda a, t: a + t["polarity"].cast("double"))
    return F.when(F.size(hits) > 0, total / F.size(hits)).otherwise(0.0)


def review_scores(
    df: DataFrame,
    words: str,
    row_id: str,
    lexicon: DataFrame,
    keep: list[str] | None = None,
    min_length: int = 2,
) -> DataFrame:
    """Mean polarity per review of the space-separated ``words`` column."""
    keys = [row_id, *(keep or [])]
    tokens = explode_tokens(df, words, keys, "space", keep_empty_rows=True)
    scored = lookup_join(tokens, lexicon, ["word"], "left")
    return scored.groupBy(*keys).agg(mean_polarity(min_length).alias("sent_score"))


def result_record(report: DataFrame, keys: list[str]) -> DataFrame:
    """Nested form: a ratio map and a keyword-list map per group."""
    ratios = F.create_map(
        *[x for n in REPORT_ORDER for x in (F.lit(n), F.col(f"{n.lower()}_pct"))]
    )
    words = F.create_map(
        *[
            x
            for n in REPORT_ORDER
            for x in (
                F.lit(n),
                F.filter(F.split(f"top_{n.lower()}", ", "), lambda w: w != ""),
            )
        ]
    )
    return report.select(*keys, ratios.alias("sentiment_ratios"), words.alias("top_keywords"))


def headed_report(report: DataFrame, name: str, heading: str = "Shop Name") -> DataFrame:
    """The seven report columns under their published headings; missing values are 0 and ''."""
    return report.select(
        F.col(name).alias(heading),
        *[
            F.coalesce(f"{label.lower()}_pct", F.lit(0.0)).alias(f"{label} (%)")
            for label in REPORT_ORDER
        ],
        *[
            F.coalesce(f"top_{label.lower()}", F.lit("")).alias(f"Top {label} Keywords")
            for label in REPORT_ORDER
        ],
    )


def report_table(
    report: DataFrame, name: str, ascending: bool = False, k: int = 3, width: int = 20
) -> DataFrame:
    """Display form of a report: sorted by Positive %, name cut to ``width`` characters,
    percentages with two decimals, at most ``k`` keywords per class."""

    def text(label: str) -> Column:
        return F.format_string("%.2f", F.coalesce(f"{label}_pct", F.lit(0.0)))

    def words(label: str) -> Column:
        return F.array_join(F.slice(F.split(f"top_{label}", ", "), 1, k), ", ")

    share = F.coalesce("positive_pct", F.lit(0.0))
    order = share.asc() if ascending else share.desc()
    return report.orderBy(order, F.asc(name)).select(
        F.substring(name, 1, width).alias("shop_name"),
        *[text(label).alias(f"{label}_pct") for label in ("positive", "neutral", "negative")],
        *[words(label).alias(f"top_{label}") for label in ("positive", "neutral", "negative")],
    )
