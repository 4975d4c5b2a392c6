"""Cutting unspaced words: the best path through a lattice of dictionary surfaces.

A word written without spaces (a stem with its particles, a compound noun) is cut into pieces. Every
substring that the dictionary knows is an edge; a single character may always be passed as unknown.
The best path has, in this order,

1. the fewest unknown characters,
2. the fewest pieces,
3. the longest first piece, then the longest second one, and so on,

so equal words are always cut alike. Neighbouring unknown characters then form one piece.

Each distinct word is cut once, however often it occurs. Its substrings, at most its length times
the longest surface, meet the dictionary by a join, and the path is folded over the positions of
the word from its end to its start with built-in functions; no task holds more than one word.
Words of more than ``LONGEST_WORD`` characters are cut at every LONGEST_WORD first, so a fold stays
bounded.

Defined results: null and empty words have no pieces; a surface is matched exactly; with an empty
dictionary every word is one unknown piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.operators.skew import cut_lineage, lookup_join

LONGEST_WORD = 256
UNKNOWN_COST = 1_000_000
MARK = "\x01"


def longest_surface(dictionary: DataFrame) -> int:
    return dictionary.agg(F.max(F.length("surface"))).first()[0] or 0


def _parts(words: DataFrame) -> DataFrame:
    """Rows ``word, part_no, part``: the word in parts of at most LONGEST_WORD characters."""
    numbers = F.explode(F.expr(f"sequence(0, (length(word) - 1) div {LONGEST_WORD})")).alias("part_no")
    rows = words.filter(F.length("word") > 0).select("word", numbers)
    part = F.expr(f"substring(word, cast(part_no * {LONGEST_WORD} + 1 as int), {LONGEST_WORD})")
    return rows.select("word", "part_no", part.alias("part"))


def _edges(parts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Rows ``part, edges``: start and size of every known substring."""
    surfaces = dictionary.select("surface").distinct()
    longest = longest_surface(surfaces)
    distinct = parts.select("part").distinct()
    starts = distinct.select("part", F.explode(F.expr("sequence(1, length(part))")).alias("start"))
    sizes = F.explode(F.expr(f"sequence(1, least({max(longest, 1)}, length(part) - start + 1))")).alias("size")
    cut = starts.select("part", "start", sizes)
    cut = cut.withColumn("surface", F.expr("substring(part, start, size)"))
    found = lookup_join(cut, surfaces, ["surface"], "left_semi")
    known = found.groupBy("part").agg(F.collect_list(F.struct("start", "size")).alias("edges"))
    return distinct.join(known, "part", "left")


def _best_path() -> Column:
    """Steps of the best path through ``part``: the size of a known piece as a negative number, 0 for
    an unknown character.

    The fold goes from the last start to the first and keeps the best rests so far, the nearest
    first: ``rests[i]`` begins ``i + 1`` characters after the start at hand. Rests compare by cost,
    then by their steps.
    """
    path = "struct<cost: bigint, steps: array<int>>"
    return F.expr(
        f"""
        aggregate(
          reverse(sequence(1, length(part))),
          array(cast(named_struct('cost', 0L, 'steps', array()) as {path})),
          (rests, at) -> concat(
            array(array_min(concat(
              transform(
                filter(coalesce(edges, array()), e -> e.start = at),
                e -> cast(named_struct(
                  'cost', rests[e.size - 1].cost + 1,
                  'steps', concat(array(-e.size), rests[e.size - 1].steps)) as {path})),
              array(cast(named_struct(
                'cost', rests[0].cost + {UNKNOWN_COST + 1}L,
                'steps', concat(array(0), rests[0].steps)) as {path}))))),
            rests),
          rests -> rests[0].steps)
        """
    )


def _pieces() -> Column:
    """The pieces along ``steps``: known ones between marks, so unknown characters stay together."""
    marked = F.expr(
        f"""
        aggregate(
          steps,
          named_struct('at', 1, 'text', ''),
          (done, step) -> named_struct(
            'at', done.at + if(step = 0, 1, -step),
            'text', concat(done.text, if(
              step = 0,
              substring(part, done.at, 1),
              concat('{MARK}', substring(part, done.at, -step), '{MARK}')))),
          done -> done.text)
        """
    )
    return F.filter(F.split(marked, MARK), lambda piece: piece != "")


def cut_words(words: DataFrame, dictionary: DataFrame, column: str = "word") -> DataFrame:
    """Rows ``word, pieces``, one per distinct word of ``column``. ``dictionary`` has ``surface``."""
    # a word that holds the mark itself is left out here and stays whole for the caller
    distinct = words.select(F.col(column).alias("word")).filter(~F.col("word").contains(MARK)).distinct()
    parts = cut_lineage(_parts(distinct))  # read for the starts, for words without edges, and for the order
    cut = _edges(parts, dictionary).withColumn("steps", _best_path()).select("part", _pieces().alias("own"))
    listed = parts.join(cut, "part").groupBy("word").agg(F.array_sort(F.collect_list(F.struct("part_no", "own"))).alias("p"))
    return listed.select("word", F.flatten(F.transform("p", lambda p: p["own"])).alias("pieces"))


def cut_tokens(tokens: DataFrame, dictionary: DataFrame, column: str = "word") -> DataFrame:
    """``tokens`` with ``piece_no`` and ``piece``, a row per piece; a token without letters is its own
    only piece. ``tokens`` should be counted already: every distinct word is looked up once."""
    rows = tokens.filter(F.length(column) > 0)
    wordlike = F.rlike(column, F.lit(r"^[\p{L}\p{M}]"))
    cut = cut_lineage(cut_words(rows.filter(wordlike), dictionary, column))  # measured, then joined
    cut = cut.select(F.col("word").alias(column), "pieces")
    found = lookup_join(rows, cut, [column], "left")
    pieces = F.coalesce("pieces", F.array(F.col(column)))
    return found.select(*tokens.columns, F.posexplode(pieces).alias("piece_no", "piece"))


def tagged_pieces(tokens: DataFrame, dictionary: DataFrame, column: str = "word", default_pos: str = "Unknown") -> DataFrame:
    """``cut_tokens`` with ``lemma`` and ``pos`` of every piece; ``dictionary`` is ``surface, lemma,
    pos``. Unknown pieces keep their surface as lemma."""
    entries = dictionary.select(F.col("surface").alias("piece"), F.col("lemma").alias("_lemma"), F.col("pos").alias("_pos"))
    found = lookup_join(cut_tokens(tokens, dictionary, column), entries, ["piece"], "left")
    fallback = (
        F.when(F.rlike("piece", F.lit(r"^\p{N}")), "Number")
        .when(F.rlike("piece", F.lit(r"^[\p{L}\p{M}]")), default_pos)
        .otherwise("Punctuation")
    )
    return found.select(
        *tokens.columns,
        "piece_no",
        "piece",
        F.coalesce("_lemma", "piece").alias("lemma"),
        F.coalesce(F.col("_pos"), fallback).alias("pos"),
    )
