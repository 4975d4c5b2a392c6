"""Column functions: text cleaning, tokenizing and scoring arithmetic."""

from reviewmill.functions import constants, scoring, text

__all__ = ["constants", "scoring", "text"]
