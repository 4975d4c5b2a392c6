"""Relational tokenizer: tokens as rows, tagged by a join with a word dictionary.

A dictionary has the columns ``surface, lemma, pos``, one row per surface form. Token rows
keep the ordinal ``token_no``, so a text can be put together again in its own order; the
regrouping key is the row id, hence no group is larger than one text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions import text as tx
from reviewmill.functions.constants import CONTENT_POS, LEMMA_POS, PREDICATE_POS
from reviewmill.operators.skew import list_lookup, lookup_join

_PLAIN_SPLIT = {
    "space": lambda c: F.split(c, " "),
    "whitespace": lambda c: F.split(c, f"[{tx.WS}]+"),
    "delimiters": lambda c: F.split(c, r'[ ",()*]+'),
    "pipe": tx.split_pipe,
}


def explode_tokens(
    df: DataFrame,
    text: str,
    keep: list[str],
    splitter: str = "space",
    min_length: int = 0,
    keep_empty_rows: bool = False,
) -> DataFrame:
    """One row per token in column ``word``, next to the ``keep`` columns.

    ``space`` and ``pipe`` keep empty tokens; ``whitespace`` and ``delimiters`` never yield
    them. With ``keep_empty_rows`` a row without tokens stays, with a null word.
    """
    pieces = _PLAIN_SPLIT[splitter](F.col(text))
    clean = splitter in ("whitespace", "delimiters")
    if keep_empty_rows:
        rows = df.select(*keep, F.explode_outer(pieces).alias("word"))
        if clean:
            rows = rows.withColumn("word", F.when(F.col("word") != "", F.col("word")))
        return rows
    rows = df.select(*keep, F.explode(pieces).alias("word"))
    if clean:
        rows = rows.filter(F.col("word") != "")
    if min_length:
        rows = rows.filter(F.length("word") >= min_length)
    return rows


def tag_tokens(
    df: DataFrame,
    text: str,
    keep: list[str],
    dictionary: DataFrame,
    default_pos: str = "Unknown",
    normalize: Callable[[Column], Column] | None = None,
    keep_empty_rows: bool = False,
    listed: bool = False,
) -> DataFrame:
    """Tokens with ``token_no, surface, lemma, pos``.

    Digit runs default to Number, punctuation runs to Punctuation, other unknown words to
    ``default_pos`` with the surface as lemma. ``normalize`` rewrites a surface form before
    the lookup (spelling normalisation). With ``keep_empty_rows`` a text without tokens, or
    no text, leaves one row of nulls.

    ``listed`` asks for one row per distinct ``keep`` instead, its tokens as a list of structs in
    ``tokens`` by ``token_no``: for ``regroup``, which then has nothing to shuffle. Texts go to
    their key once; tokens never become rows. Where ``list_lookup`` cannot hold the dictionary,
    token rows are returned as without it.
    """
    if listed and (find := list_lookup(dictionary.select("surface", "lemma", "pos"), "surface")) is not None:
        return _tagged_lists(df, text, keep, find, default_pos, normalize, keep_empty_rows)
    explode = F.posexplode_outer if keep_empty_rows else F.posexplode
    rows = df.select(*keep, explode(tx.word_tokens(text)).alias("token_no", "surface"))
    if normalize is not None:
        rows = rows.withColumn("surface", normalize(F.col("surface")))
    entries = dictionary.select(
        "surface", F.col("lemma").alias("_lemma"), F.col("pos").alias("_pos")
    )
    tagged = lookup_join(rows, entries, ["surface"], "left")
    return tagged.select(
        *keep,
        "token_no",
        "surface",
        F.coalesce("_lemma", "surface").alias("lemma"),
        F.coalesce(F.col("_pos"), _fallback(F.col("surface"), default_pos)).alias("pos"),
    )


def _fallback(surface: Column, default_pos: str) -> Column:
    return (
        F.when(surface.rlike(r"^\p{N}"), "Number")
        .when(surface.rlike(r"^[\p{L}\p{M}]"), default_pos)
        .when(surface.isNotNull(), "Punctuation")
    )


def _tagged_lists(
    df: DataFrame,
    text: str,
    keep: list[str],
    find: Callable[[Column], Column],
    default_pos: str,
    normalize: Callable[[Column], Column] | None,
    keep_empty_rows: bool,
) -> DataFrame:
    def cut(one: Column) -> Column:
        def token(word: Column, place: Column) -> Column:
            surface = word if normalize is None else normalize(word)
            return F.struct(place.alias("token_no"), surface.alias("surface"))

        return F.transform(tx.word_tokens(one), token)

    def tag(t: Column) -> Column:
        return F.struct(
            t["token_no"].alias("token_no"),
            t["surface"].alias("surface"),
            F.coalesce(t["entry"]["lemma"], t["surface"]).alias("lemma"),
            F.coalesce(t["entry"]["pos"], _fallback(t["surface"], default_pos)).alias("pos"),
        )

    # rows that share a key are one text; their texts meet here, their tokens never travel
    texts = df.groupBy(*keep).agg(F.collect_list(F.col(text)).alias("_texts"))
    cuts = texts.select(*keep, F.flatten(F.transform("_texts", cut)).alias("tokens"))
    found = F.transform(
        "tokens",
        lambda t: F.struct(t["token_no"].alias("token_no"), t["surface"].alias("surface"), find(t["surface"]).alias("entry")),
    )
    rows = cuts.select(*keep, F.transform(found, tag).alias("tokens"))
    return rows if keep_empty_rows else nonempty(rows)


def nonempty(lists: DataFrame) -> DataFrame:
    """Rows with tokens. A filter would be pushed below and build each list a second time."""
    some = F.explode(F.filter(F.array("tokens"), lambda own: F.size(own) > 0)).alias("tokens")
    return lists.select(*[c for c in lists.columns if c != "tokens"], some)


def regroup(
    tokens: DataFrame,
    keys: list[str],
    columns: dict[str, Callable[[Column], Column]],
    separator: str = " ",
    extra: list[Column] | None = None,
) -> DataFrame:
    """Join the tokens of each row again, one text column per entry of ``columns``. ``tokens`` are
    rows, or lists as ``tag_tokens`` gives them on request, which are joined where they are.

    ``keys`` are the row id and further columns of the row that are to be kept; these should
    be short, as every token row repeats them. An entry is a function of the token as a struct; a
    null result leaves the token out. ``extra`` are further aggregates over the same tokens, for
    lists expressions over ``tokens``.
    """
    fields = {name: f"v{i}" for i, name in enumerate(columns)}
    if is_listed(tokens):
        pairs = F.transform(
            "tokens",
            lambda t: F.struct(t["token_no"].alias("token_no"), *[f(t).alias(fields[name]) for name, f in columns.items()]),
        )
        sized = tokens.select(*keys, F.sort_array(pairs).alias("_tokens"), *(extra or []))
        return _joined_columns(sized, keys, fields, separator)
    token = F.struct(*[F.col(c) for c in tokens.columns if c not in keys])
    values = [f(token).alias(fields[name]) for name, f in columns.items()]
    wanted = F.coalesce(*[F.when(f(token).isNotNull(), True) for f in columns.values()])
    # one sorted list of the tokens that any column wants, at most one text long
    listed = F.array_sort(F.collect_list(F.when(wanted, F.struct("token_no", *values))))
    grouped = tokens.groupBy(*keys).agg(listed.alias("_tokens"), *(extra or []))
    return _joined_columns(grouped, keys, fields, separator)


def is_listed(tokens: DataFrame) -> bool:
    return "tokens" in tokens.columns


def as_rows(tokens: DataFrame) -> DataFrame:
    """Token rows from lists; rows stay as they are."""
    if not is_listed(tokens):
        return tokens
    return tokens.select(*[c for c in tokens.columns if c != "tokens"], F.inline("tokens"))


def _joined_columns(grouped: DataFrame, keys: list[str], fields: dict[str, str], separator: str) -> DataFrame:
    def text(field: str) -> Column:
        return F.array_join(F.transform("_tokens", lambda t: t[field]), separator)

    others = [c for c in grouped.columns if c not in (*keys, "_tokens")]
    return grouped.select(*keys, *[text(f).alias(name) for name, f in fields.items()], *others)


def _selected(value: str, classes: list[str] | None) -> Callable[[Column], Column]:
    if classes is None:
        return lambda t: t[value]
    return lambda t: F.when(t["pos"].isin(classes), t[value])


def content_text(
    df: DataFrame,
    text: str,
    row_id: str,
    dictionary: DataFrame,
    classes: list[str] | None = CONTENT_POS,
    value: str = "lemma",
    default_pos: str = "Unknown",
    output: str = "processed_review",
    keep: list[str] | None = None,
) -> DataFrame:
    """``row_id, keep, output``: the space-joined lemmas of the selected classes, ``''`` for
    missing text. One scan and one shuffle of the texts by row id, which no hot shop can unbalance."""
    keys = [row_id, *(keep or [])]
    tokens = tag_tokens(df, text, keys, dictionary, default_pos, keep_empty_rows=True, listed=True)
    return regroup(tokens, keys, {output: _selected(value, classes)})


def pos_columns(
    df: DataFrame,
    text: str,
    row_id: str,
    dictionary: DataFrame,
    columns: dict[str, list[str]],
    default_pos: str = "Unknown",
    keep: list[str] | None = None,
) -> DataFrame:
    """One text column per part-of-speech selection, from a single tagging pass."""
    keys = [row_id, *(keep or [])]
    tokens = tag_tokens(df, text, keys, dictionary, default_pos, keep_empty_rows=True, listed=True)
    picks = {name: _selected("lemma", classes) for name, classes in columns.items()}
    return regroup(tokens, keys, picks)


def lemma_column(token: Column) -> Column:
    """Noun as is, verb and adjective in '다' form, anything else null."""
    lemma, pos = token["lemma"], token["pos"]
    return F.when(pos.isin(PREDICATE_POS), tx.predicate_form(lemma)).when(pos.isin(LEMMA_POS), lemma)


def lemmatize(
    df: DataFrame,
    text: str,
    row_id: str,
    dictionary: DataFrame,
    default_pos: str = "Unknown",
    output: str = "words",
    keep: list[str] | None = None,
) -> DataFrame:
    """``row_id, keep, output``: nouns and '다' forms of verbs and adjectives, in order."""
    keys = [row_id, *(keep or [])]
    tokens = tag_tokens(df, text, keys, dictionary, default_pos, keep_empty_rows=True, listed=True)
    return regroup(tokens, keys, {output: lemma_column})


def without_stop_words(tokens: DataFrame, stop: DataFrame, column: str = "word") -> DataFrame:
    """Anti-join with a stop-word table (column ``word``)."""
    words = stop.select(F.col("word").alias(column)).distinct()
    return lookup_join(tokens, words, [column], "left_anti")


def class_words(
    df: DataFrame,
    text: str,
    keep: list[str],
    dictionary: DataFrame,
    classes: list[str],
    stop: DataFrame | None = None,
    value: str = "lemma",
    min_length: int = 1,
    default_pos: str = "Unknown",
    listed: bool = False,
) -> DataFrame:
    """Token rows ``keep, token_no, word`` of the selected classes, minus stop words. ``listed``
    asks for lists in ``tokens``, one row per distinct ``keep`` that has words, as ``tag_tokens``."""
    tokens = tag_tokens(df, text, keep, dictionary, default_pos, listed=listed)
    if is_listed(tokens):
        find = None if stop is None else list_lookup(stop.select("word").distinct(), "word")
        if stop is None or find is not None:

            def wanted(t: Column) -> Column:
                own = t["pos"].isin(classes) & (F.length(t[value]) >= min_length)
                return own if stop is None else own & find(t[value]).isNull()

            def worded(t: Column) -> Column:
                return F.struct(t["token_no"].alias("token_no"), t[value].alias("word"))

            return nonempty(tokens.select(*keep, F.transform(F.filter("tokens", wanted), worded).alias("tokens")))
        tokens = as_rows(tokens)
    rows = tokens.filter(F.col("pos").isin(classes) & (F.length(value) >= min_length)).select(
        *keep, "token_no", F.col(value).alias("word")
    )
    return rows if stop is None else without_stop_words(rows, stop)


def keyword_contexts(
    df: DataFrame, text: str, keep: list[str], phrase: str, before: int = 3, after: int = 3
) -> DataFrame:
    """One row per whitespace token that contains the phrase: its index and the window of
    ``before`` tokens ahead and ``after - 1`` tokens behind it."""
    terms = df.select(*keep, tx.split_whitespace(text).alias("_terms"))
    positions = F.filter(
        F.transform("_terms", lambda t, i: F.when(t.contains(phrase), i)), lambda i: i.isNotNull()
    )
    hits = terms.select(*keep, "_terms", F.explode(positions).alias("index"))
    start = F.greatest(F.col("index") - before, F.lit(0))
    window = F.slice(F.col("_terms"), start + 1, F.col("index") + after - start)
    return hits.select(*keep, "index", F.array_join(window, " ").alias("context"))


def split_sentences(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    return df.select(*keep, F.posexplode(tx.sentences(text)).alias("sentence_no", "sentence"))
