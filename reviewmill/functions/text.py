"""Text functions: Column in, Column out, all inside JVM code generation.

Java's ``\\w`` and ``\\s`` are ASCII-only and would delete Hangul, so every
pattern spells out Unicode classes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmill.functions.constants import EMOJI_RANGES, PUNCTUATION_PAIRS, TAG_REPLACEMENTS

# Unicode whitespace, as one character-class body
WS = r"\s\x0B\x1C-\x1F\x{85}\p{Z}"
# the same whitespace as a character set
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# letters, numbers and underscore: a "word character" without combining marks
WORD = r"\p{L}\p{N}_"
EMOJI = "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in EMOJI_RANGES) + "]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- tokenizing -----------------------------------------------------------


def split_space(c: Column | str) -> Column:
    """Split on every single space; empty tokens are kept (``''`` -> ``['']``)."""
    return F.split(_col(c), " ")


def _drop_empty(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: t != "")


def split_whitespace(c: Column | str) -> Column:
    """Split on runs of whitespace; never yields empty tokens."""
    return _drop_empty(F.split(_col(c), f"[{WS}]+"))


def split_delimiters(c: Column | str) -> Column:
    """Split on space, double quote, comma, parentheses and star; no empties."""
    return _drop_empty(F.split(_col(c), r'[ ",()*]+'))


def split_pipe(c: Column | str) -> Column:
    return F.split(_col(c), "[|]")


def word_tokens(c: Column | str) -> Column:
    """Cut text into letter runs, digit runs and punctuation runs, in order."""
    return F.regexp_extract_all(
        _col(c), F.lit(rf"[\p{{L}}\p{{M}}]+|\p{{N}}+|[^{WS}\p{{L}}\p{{M}}\p{{N}}]+"), F.lit(0)
    )


def sentences(c: Column | str) -> Column:
    """Sentences with their closing punctuation, whitespace-trimmed."""
    found = F.regexp_extract_all(_col(c), F.lit(r"[^.!?]+[.!?]*"), F.lit(0))
    return _drop_empty(F.transform(found, strip))


# ---- cleaning -------------------------------------------------------------


def strip(c: Column | str) -> Column:
    """Trim any Unicode whitespace from both ends, in linear time."""
    return F.trim(_col(c), F.lit(WS_CHARS))


def collapse_whitespace(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(c), f"[{WS}]+", " "))


def remove_emojis(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), EMOJI + "+", "")


def has_emoji(c: Column | str) -> Column:
    return F.coalesce(_col(c).rlike(EMOJI), F.lit(False))


def remove_special(c: Column | str) -> Column:
    """Drop every character that is neither a word character nor whitespace."""
    return F.regexp_replace(_col(c), f"[^{WORD}{WS}]", "")


def remove_digits(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"\p{Nd}+", "")


def hangul_only(c: Column | str) -> Column:
    return strip(F.regexp_replace(_col(c), f"[^ㄱ-ㅎㅏ-ㅣ가-힣{WS}]", ""))


def remove_links(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), f"http[^{WS}]+", "")


def remove_mentions(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), f"@[^{WS}]+", "")


def unify_punctuation(c: Column | str) -> Column:
    sources = "".join(a for a, _ in PUNCTUATION_PAIRS)
    targets = "".join(b for _, b in PUNCTUATION_PAIRS)
    return F.translate(_col(c), sources, targets)


def replace_in_order(c: Column | str, pairs: list[tuple[str, str]]) -> Column:
    """Apply literal replacements one after the other; later ones see earlier results."""
    return reduce(lambda acc, p: F.replace(acc, F.lit(p[0]), F.lit(p[1])), pairs, _col(c))


def normalize_tags(c: Column | str, pairs: list[tuple[str, str]] = TAG_REPLACEMENTS) -> Column:
    """Reduce tag phrases to their keyword; a missing value becomes ``''``."""
    return F.coalesce(collapse_whitespace(replace_in_order(c, pairs)), F.lit(""))


def predicate_form(c: Column | str) -> Column:
    """Dictionary form of a verb or adjective: ends in '다'."""
    c = _col(c)
    return F.when(c.endswith("다"), c).otherwise(F.concat(c, F.lit("다")))


def empty_to(c: Column | str, default: str) -> Column:
    """Null and empty string both become the default."""
    c = _col(c)
    return F.when(c.isNull() | (c == ""), F.lit(default)).otherwise(c)


# ---- crawled fields -------------------------------------------------------


def last_line(c: Column | str) -> Column:
    """Last line of a rating label such as ``'별점\\n4.5'``."""
    return F.element_at(F.split(strip(c), "\n"), -1)


def without(c: Column | str, label: str) -> Column:
    return strip(F.replace(_col(c), F.lit(label), F.lit("")))


# ---- lookups and slices ---------------------------------------------------


def first_items(items: Column | str, k: int) -> Column:
    return F.slice(_col(items), 1, k)


def map_get(m: Column | str, key: str, default: object) -> Column:
    return F.coalesce(F.try_element_at(_col(m), F.lit(key)), F.lit(default))
