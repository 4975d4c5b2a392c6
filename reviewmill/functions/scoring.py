"""Scoring arithmetic: polarity sign, percentages, rounding, dominant class."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmill.functions.constants import CLASSES_KO


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sign_class(score: Column | str, labels: dict[str, str] | None = None) -> Column:
    """Class of a score by its sign; null stays null."""
    names = labels or {}
    score = _col(score)
    return (
        F.when(score > 0, names.get("Positive", "Positive"))
        .when(score < 0, names.get("Negative", "Negative"))
        .when(score.isNotNull(), names.get("Neutral", "Neutral"))
    )


def sign_class_ko(score: Column | str) -> Column:
    return sign_class(score, CLASSES_KO)


def percentage(part: Column | str, whole: Column | str, digits: int | None = None) -> Column:
    """``part / whole * 100``; an empty whole gives null. Rounding is half-even."""
    value = F.try_divide(_col(part).cast("double"), _col(whole).cast("double")) * 100
    return value if digits is None else F.bround(value, digits)


def dominant_class(
    positive: Column | str, negative: Column | str, neutral: Column | str, tie: str = "reference"
) -> Column:
    """Largest of three counts. Ties go Positive, Negative, Neutral in that order, so
    text without a single match is Positive; ``tie='neutral'`` makes it Neutral."""
    p, n, u = _col(positive), _col(negative), _col(neutral)
    ranked = (
        F.when((p >= n) & (p >= u), "Positive").when(n >= u, "Negative").otherwise("Neutral")
    )
    if tie == "reference":
        return ranked
    if tie == "neutral":
        return F.when(p + n + u == 0, "Neutral").otherwise(ranked)
    raise ValueError(f"tie must be 'reference' or 'neutral', not {tie!r}")


def fixed2(c: Column | str) -> Column:
    return F.format_string("%.2f", _col(c))
