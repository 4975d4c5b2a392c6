"""Text of a whole group as bounded parts.

A group may hold a third of all rows, so its merged text cannot be one value. The text is
cut into numbered parts; ``separator.join(parts in order)`` is the whole text, nothing is
dropped. A part holds the rows that begin within ``part_chars`` characters, so it is longer
than that by less than one text; groups below ``part_chars`` have exactly one part, number 0.

Where a row begins is a running length in three levels: rows in slices of ``slice_rows``
consecutive ids, slices in blocks of ``slice_rows``, blocks of a group. One task sees the
lengths of one slice, one block, or one group's blocks, never of all rows of a group. How
rows fall into slices changes nothing in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.operators.skew import cut_lineage, lookup_join
from reviewmill.operators.tokens import is_listed

SLICE_ROWS = 4096
PART_CHARS = 16_000_000


def _joined(order: str, value: str, separator: str) -> Column:
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(value))))
    return F.array_join(F.transform(pairs, lambda s: s[value]), separator)


def _before(partition: list[str], order: str, chars: str) -> Column:
    """Running length of all that comes earlier in the partition."""
    earlier = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(chars).over(earlier), F.lit(0))


def merge_text(
    df: DataFrame,
    keys: list[str],
    text: str,
    row_id: str,
    separator: str = " ",
    slice_rows: int = SLICE_ROWS,
    part_chars: int = PART_CHARS,
    output: str = "merged_text",
) -> DataFrame:
    """Rows ``keys, part_no, output``: texts of each group joined in ``row_id`` order.

    ``row_id`` is a unique integer. Null texts and rows with a null key are left out. The
    texts are read twice, for their lengths and for the parts, and the parts are shuffled.
    """
    present = F.col(text).isNotNull()
    for key in keys:
        present = present & F.col(key).isNotNull()
    slice_no = F.coalesce(F.floor(F.col(row_id) / slice_rows), F.lit(-1))
    rows = df.filter(present).select(
        *keys,
        slice_no.alias("_slice"),
        F.floor(slice_no / slice_rows).alias("_block"),
        F.col(row_id).alias("_id"),
        (F.length(text) + len(separator)).cast("long").alias("_chars"),
        F.col(text).alias("_text"),
    )
    block, one_slice = [*keys, "_block"], [*keys, "_block", "_slice"]
    slices = rows.groupBy(*one_slice).agg(F.sum("_chars").alias("_chars"))
    blocks = slices.groupBy(*block).agg(F.sum("_chars").alias("_chars"))
    begin = blocks.select(*block, _before(keys, "_block", "_chars").alias("_begin"))
    starts = slices.join(begin, block).select(
        *one_slice, (F.col("_begin") + _before(block, "_slice", "_chars")).alias("_begin")
    )
    placed = rows.join(starts, one_slice).withColumn(
        "part_no", F.floor((F.col("_begin") + _before(one_slice, "_id", "_chars")) / part_chars)
    )
    return placed.groupBy(*keys, "part_no").agg(_joined("_id", "_text", separator).alias(output))


def part_offsets(
    parts: DataFrame, keys: list[str], text: str, separator: str = " ", block_parts: int = SLICE_ROWS
) -> DataFrame:
    """Rows ``keys, part_no, begin, n_chars, digest``: where each part begins in the whole text
    of its group, its length and its MD5, without joining the parts. One task sees the lengths
    of one block of parts, or one group's blocks."""
    block = [*keys, "_block"]
    sized = cut_lineage(
        parts.select(
            *keys,
            "part_no",
            F.floor(F.col("part_no") / block_parts).alias("_block"),
            F.length(text).cast("long").alias("n_chars"),
            F.md5(F.col(text).cast("binary")).alias("digest"),
        ).withColumn("_chars", F.col("n_chars") + len(separator))
    )
    blocks = sized.groupBy(*block).agg(F.sum("_chars").alias("_chars"))
    begin = blocks.select(*block, _before(keys, "_block", "_chars").alias("_begin"))
    return sized.join(begin, block).select(
        *keys, "part_no", (F.col("_begin") + _before(block, "part_no", "_chars")).alias("begin"), "n_chars", "digest"
    )


def merge_words(
    tokens: DataFrame, keys: list[str], row_id: str, separator: str = "|", **bounds: int
) -> DataFrame:
    """Word lists of a group joined by ``|``: tokens per row first, then rows per group. ``tokens``
    are rows, or lists by row as ``tokens.class_words`` gives them on request."""

    def joined(pairs: Column) -> Column:
        return F.array_join(F.transform(F.sort_array(pairs), lambda s: s["word"]), separator).alias("_words")

    if is_listed(tokens):
        # merge_text reads its rows twice; written, the lists are built once
        per_row = cut_lineage(tokens.select(*keys, row_id, joined(F.col("tokens"))))
    else:
        per_row = tokens.groupBy(*keys, row_id).agg(joined(F.collect_list(F.struct("token_no", "word"))))
    return merge_text(per_row, keys, "_words", row_id, separator, output="words", **bounds)


def groups_with_matching_row(df: DataFrame, keys: list[str], match: Column) -> DataFrame:
    """Keys of groups of which one row satisfies ``match``, however much text the group has."""
    return df.filter(match).select(*keys).distinct()


def groups_with_literal(
    parts: DataFrame, keys: list[str], text: str, literal: str, separator: str = " "
) -> DataFrame:
    """Keys of groups whose whole merged text contains ``literal``, wherever parts are cut.

    A hit lies inside one part, or within ``len(literal)`` characters around a border; it may
    run over parts shorter than that. Each part is therefore looked at together with the ends
    of as many parts before it as the literal has characters.
    """
    reach = len(literal)
    unused = next(c for c in map(chr, range(1, reach + 3)) if c not in literal)
    ends = F.when(F.length(text) <= 2 * reach, F.col(text)).otherwise(
        F.concat(F.substring(text, 1, reach), F.lit(unused), F.substring(text, -reach, reach))
    )
    # text stays where it is: only whether it has the literal, and its ends, go on
    short = parts.select(
        *keys, "part_no", F.contains(F.col(text), F.lit(literal)).alias("_inside"), ends.alias("_ends")
    )
    around = Window.partitionBy(*keys).orderBy("part_no").rowsBetween(-reach, Window.currentRow)
    seam = F.array_join(F.collect_list("_ends").over(around), separator)
    tested = short.select(*keys, (F.col("_inside") | F.contains(seam, F.lit(literal))).alias("_hit"))
    return tested.filter("_hit").select(*keys).distinct()


def keep_groups(df: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    return lookup_join(df, groups, keys, "left_semi")
