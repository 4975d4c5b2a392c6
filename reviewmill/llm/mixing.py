"""Mixing sources to target weights, in DataFrame operations only.

Every document gets a key that is random but fixed by its id. A source is its documents in
key order; how many words lie before a document is a prefix sum. The key range is cut into
equal buckets, so the prefix sum has two levels: bucket totals per source, then the rows of a
bucket. No task sees more than one bucket of a source, however large the source is.

A source with a budget of ``b`` words out of ``s`` is read ``b div s`` times as a whole, and
once more up to the word where the budget ends.

Defined results: a null text has no words; a source without words takes nothing; null is a
source of its own, after all others; rows that repeat (id and size equal) follow each other in
any order, which gives the same rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.common import stored, with_running_sums, words_in

KEY_BITS = 60
BUCKET_BITS = 12
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3

_SOURCE = ["_source", "_no_source"]


def hash_key(doc_id: str, seed: str) -> Column:
    """A number of KEY_BITS bits that depends on the id alone."""
    digest = F.md5(F.concat_ws(":", F.col(doc_id).cast("string"), F.lit(seed)))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """Add ``target`` to one row per source: its weight's share of all words, at most ``most``
    times its own; what is above goes to the others by weight.

    With the sources ordered by the level at which they are full, the level that fills the
    rest exactly is the largest of the levels reached when all earlier sources are full.
    """
    by_name = [F.col("_no_source").asc(), F.col("_source").asc()]
    named = with_running_sums(sizes, by_name, {}, "mix-sources")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    weighed = named.withColumns(
        {
            "weight": F.get(cycle, (F.col("row_index") % len(weights)).cast("int")).cast("long"),
            "limit": F.col("source_size") * most,
        }
    ).drop("row_index")
    full_at = F.col("limit") / F.col("weight")
    filled = with_running_sums(
        weighed, [full_at, *by_name], {"limits_before": "limit", "weights_before": "weight"}, "mix-levels"
    )
    words, total_weight = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (F.lit(words) - F.col("limits_before")) / (F.lit(total_weight) - F.col("weights_before"))
    highest = filled.agg(F.max(level)).first()[0]
    return weighed.select(
        *_SOURCE,
        "source_size",
        F.least(F.col("weight") * F.lit(highest), F.col("limit").cast("double")).alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_REPEATS,
    seed: str = "mix",
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    carry: bool = False,
) -> DataFrame:
    """Rows ``doc_id, size, source_size, target, taken, repeats, last_words``, one per document.

    ``repeats`` counts whole passes, ``last_words`` the words taken in the pass where the
    budget ends; ``taken = repeats * size + last_words``. ``weights`` go round the sources in
    the order of their names. With ``carry`` the columns of ``docs`` come along as the struct
    ``row``.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("_source"),
        F.col(source).isNull().alias("_no_source"),
        words_in(text).alias("size"),
        F.coalesce(hash_key(doc_id, seed), F.lit(0)).alias("_key"),
        *([F.struct(*[docs[c] for c in docs.columns]).alias("row")] if carry else []),
    ).withColumn("_bucket", F.shiftright("_key", KEY_BITS - BUCKET_BITS).cast("int"))
    narrow = stored(rows.drop("row"), "mix-sizes")
    buckets = stored(
        narrow.groupBy(*_SOURCE, "_bucket").agg(F.sum("size").alias("_words")), "mix-buckets"
    )
    sizes = buckets.groupBy(*_SOURCE).agg(F.sum("_words").alias("source_size"))
    targets = source_targets(sizes, weights, most)
    earlier = Window.partitionBy(*_SOURCE).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = buckets.withColumn("_begin", F.coalesce(F.sum("_words").over(earlier), F.lit(0)))
    offsets = begins.drop("_words").join(targets, _SOURCE)
    inside = (
        Window.partitionBy(*_SOURCE, "_bucket")
        .orderBy("_key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (rows if carry else narrow).join(offsets, [*_SOURCE, "_bucket"])
    placed = placed.withColumn(
        "_start", F.col("_begin") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    ).withColumn("_budget", F.round("target").cast("long"))
    some = F.col("source_size") > 0
    repeats = F.when(some, F.expr("_budget div source_size")).otherwise(0)
    rest = F.when(some, F.expr("_budget % source_size")).otherwise(0)
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_start")))
    result = placed.withColumns({"repeats": repeats.cast("long"), "last_words": last.cast("long")})
    return result.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("repeats") * F.col("size") + F.col("last_words")).alias("taken"),
        "repeats",
        "last_words",
        *(["row"] if carry else []),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The columns of ``docs``, one row per copy in the mix. Documents stay whole: the one in
    which a source's budget ends is in if at least half of its words are."""
    mixed = mix_sources(docs, carry=True, **options)
    more = (F.col("last_words") * 2 >= F.col("size")) & (F.col("last_words") > 0)
    copies = (F.col("repeats") + more.cast("long")).cast("int")
    repeated = mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies)))
    return repeated.select("row.*")


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(doc_id || ':mix'), 1, 15))::BIGINT AS key
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT ((SELECT sum(source_size) FROM sources) - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
         / ((SELECT sum(weight) FROM sources) - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM sources WINDOW before AS (
    ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size,
         least(weight * (SELECT max(level) FROM levels), (3 * source_size)::DOUBLE) AS target
  FROM sources
), placed AS (
  SELECT doc_id, size, source_size, target, round(target)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY key, doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), passes AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS repeats,
         CASE WHEN source_size > 0
           THEN greatest(0, least(size, budget % source_size - start)) ELSE 0 END AS last_words
  FROM placed
)
SELECT doc_id, size, source_size, target, repeats * size + last_words AS taken, repeats, last_words
FROM passes
"""
