"""Pairs of similar groups without the pairs that a common word makes.

``compare.cosine_similarity`` is the whole table: a word that all groups share forms a pair of
every two of them. The functions here answer two narrower questions exactly: which groups are at
least so similar, and which are the most similar ones of a group.

Words are ordered by the number of groups that hold them, rarest first. What a group still has
from a word on (its ``tail``, as a share of its length) bounds what that word and all more common
ones can add to a cosine. The rarest word that two groups share therefore has tails whose product
reaches their cosine; groups meet in such words only, and a common word, which stands last, seldom
is one. Candidates are then measured over all their words.

Defined results: rows with a null group, word or value are left out; a word that repeats in a group
adds up; a group of values 0 is similar to none; groups that share no word are no pair; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.operators.skew import cut_lineage, lookup_join

# groups of a word that meet in one task
WORD_GROUPS = 4096
# what rounding can take from a tail
SLACK = 1e-9
THRESHOLDS = (0.8, 0.5, 0.25, 0.0)


def weighted_entries(top: DataFrame, key: str, value: str = "n", word_groups: int = WORD_GROUPS) -> DataFrame:
    """Rows ``g, word, n, norm, tail, blocks, own``, written once: the length of the group, its share
    from this word on, in how many blocks the groups of the word are dealt, and the group's block."""
    named = top.select(F.col(key).alias("g"), F.col("word"), F.col(value).cast("double").alias("n"))
    summed = named.dropna().groupBy("g", "word").agg(F.sum("n").alias("n")).filter("n <> 0")
    summed = cut_lineage(summed)
    often = summed.groupBy("word").agg(F.count(F.lit(1)).alias("f"))
    of_group = Window.partitionBy("g")
    common_first = of_group.orderBy(F.desc("f"), F.desc("word")).rowsBetween(Window.unboundedPreceding, 0)
    square = F.col("n") * F.col("n")
    blocks = F.ceil(F.col("f") / word_groups).cast("int")
    placed = lookup_join(summed, often, ["word"]).select(
        "g",
        "word",
        "n",
        F.sqrt(F.sum(square).over(of_group)).alias("norm"),
        F.sqrt(F.sum(square).over(common_first)).alias("tail"),
        blocks.alias("blocks"),
        F.pmod(F.xxhash64("g"), blocks).cast("int").alias("own"),
    )
    return cut_lineage(placed.withColumn("tail", F.col("tail") / F.col("norm")))


def candidates(left: DataFrame, right: DataFrame, least: float, once: bool = False) -> DataFrame:
    """Distinct pairs ``g1, g2`` of rows of ``weighted_entries`` that hold every pair of cosine
    ``least`` or more, ``once`` for the pairs ``g1 < g2`` only. Groups of a hot word meet block by
    block."""
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    enough = F.lit(least - SLACK)
    one = left.filter(F.col("tail") >= enough).select(
        "word", F.col("g").alias("g1"), F.col("tail").alias("t1"), F.col("own").alias("b1"), every.alias("b2")
    )
    two = right.filter(F.col("tail") >= enough).select(
        "word", F.col("g").alias("g2"), F.col("tail").alias("t2"), every.alias("b1"), F.col("own").alias("b2")
    )
    both = one.join(two, ["word", "b1", "b2"])
    apart = F.col("g1") < F.col("g2") if once else F.col("g1") != F.col("g2")
    return both.filter(apart & (F.col("t1") * F.col("t2") >= enough)).select("g1", "g2").distinct()


def measured(pairs: DataFrame, entries: DataFrame) -> DataFrame:
    """``g1, g2, cosine`` of pairs, over all words of both."""
    one = entries.select(F.col("g").alias("g1"), "word", F.col("n").alias("n1"), F.col("norm").alias("m1"))
    two = entries.select(F.col("g").alias("g2"), "word", F.col("n").alias("n2"), F.col("norm").alias("m2"))
    met = pairs.join(one, "g1").join(two, ["g2", "word"])
    product = F.sum(F.col("n1") * F.col("n2")) / (F.first("m1") * F.first("m2"))
    return met.groupBy("g1", "g2").agg(product.alias("cosine"))


def similar_groups(top: DataFrame, key: str, at_least: float, value: str = "n", word_groups: int = WORD_GROUPS) -> DataFrame:
    """``g1, g2, cosine`` with ``g1 < g2`` for every two groups of cosine ``at_least`` (above 0) or more."""
    if not at_least > 0:
        raise ValueError("at_least must be above 0")
    entries = weighted_entries(top, key, value, word_groups)
    pairs = candidates(entries, entries, at_least, once=True)
    return measured(pairs, entries).filter(F.col("cosine") >= at_least)


def most_similar_groups(
    top: DataFrame,
    key: str,
    k: int,
    value: str = "n",
    thresholds: tuple[float, ...] = THRESHOLDS,
    word_groups: int = WORD_GROUPS,
) -> DataFrame:
    """``g1, g2, cosine, rank``: the ``k`` most similar groups of each, equal ones by name.

    A group that has ``k`` partners at a threshold is done, as all others are less similar; only
    the rest goes on to the next one. The last threshold is 0: any shared word.
    """
    entries = weighted_entries(top, key, value, word_groups)
    place = Window.partitionBy("g1").orderBy(F.desc("cosine"), "g2")
    found: DataFrame | None = None
    asking = entries
    for least in dict.fromkeys((*thresholds, 0.0)):
        near = measured(candidates(asking, entries, least), entries).filter(_reaches(least))
        near = near.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
        if least > 0:
            near = cut_lineage(near)
            done = near.filter(F.col("rank") == k).select(F.col("g1").alias("g"))
            near = near.join(done.withColumnRenamed("g", "g1"), "g1", "left_semi")
            asking = asking.join(done, "g", "left_anti")
        found = near if found is None else found.unionByName(near)
    return found.select("g1", "g2", "cosine", "rank")


def _reaches(least: float) -> Column:
    return F.col("cosine") >= least if least > 0 else F.lit(True)
