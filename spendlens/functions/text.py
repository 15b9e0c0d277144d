"""Token estimates and prompt text helpers, as plain Column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rule of thumb for English text.
CHARS_PER_TOKEN = 4
WORDS_PER_TOKEN = 0.75

# Phrases that cost tokens and add nothing.
FILLER_PHRASES = (
    "You are an expert analyst.",
    "You are an expert data analyst.",
    "I need you to",
    "Please make sure to",
    "Please be thorough.",
    "Make sure to",
    "and be thorough in your analysis",
)


def estimate_tokens_of(chars: Column) -> Column:
    """Estimated tokens of a text with this many characters, rounded up."""
    return F.ceil(chars / F.lit(CHARS_PER_TOKEN))


def estimate_tokens(text: Column, method: str = "chars") -> Column:
    """Estimated tokens, rounded up: characters / 4, or words / 0.75."""
    if method == "chars":
        return estimate_tokens_of(F.length(text))
    if method == "words":
        return F.ceil(F.regexp_count(text, F.lit(r"\S+")) / F.lit(WORDS_PER_TOKEN))
    raise ValueError(f"unknown method {method!r}: use 'chars' or 'words'")


def phrase_pattern(phrases: Sequence[str]) -> str:
    """Case-insensitive pattern that matches any phrase literally, longest first."""
    if not phrases:
        raise ValueError("no phrases given")
    ordered = sorted(phrases, key=len, reverse=True)
    return "(?iu)" + "|".join(re.escape(p) for p in ordered)


def like_any(column: Column, patterns: Sequence[str]) -> Column:
    """``ILIKE ANY``: true when one of the patterns matches."""
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | column.ilike(pattern)
    return hit


def score_label(score: Column, low: float = -0.3, high: float = 0.3) -> Column:
    """Positive above ``high``, Negative below ``low``, otherwise Neutral."""
    return (
        F.when(score > high, "Positive").when(score < low, "Negative").otherwise("Neutral")
    )
