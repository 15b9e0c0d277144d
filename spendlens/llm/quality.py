"""Quality rules: a table of thresholds compiled into one Spark projection.

Measures of a text (words, their characters, symbols, stop words, lines, repeated
lines and words) and the rules over them are plain Spark expressions. A rule
compares a measure with a share of another in whole numbers, so no verdict hangs
on rounding.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import fresh, replacing

#: Words of a window that counts as repeated when it occurs again.
REPEAT_WINDOW = 8

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on", "with", "as", "be",
    "by", "this", "are", "at", "from",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "im", "ist",
    "dem", "nicht", "ein", "als", "eine",
    "de", "la", "le", "et", "les", "en", "un", "du", "une", "est", "que", "pour", "dans", "qui", "au",
    "sur", "pas", "par", "avec", "ou",
    "el", "y", "los", "se", "del", "las", "por", "con", "una", "no", "para", "es", "su", "al", "lo",
)

# ASCII white space, and the characters counted as symbols.
_BLANKS = " \t\n\v\f\r"
_BLANK_RUN = r"[\x20\x09-\x0D]+"
_SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """``measure`` is at least or at most ``percent`` of ``of``, which is a measure or a number.

    ``base`` rules make ``base_failed``; all rules together make ``kept``.
    """

    name: str
    measure: str
    least: bool
    percent: int
    of: str | int
    base: bool = False

    def holds(self, measures: dict[str, Column]) -> Column:
        of = F.lit(self.of).cast("bigint") if isinstance(self.of, int) else measures[self.of]
        value, bound = measures[self.measure] * 100, of * self.percent
        return value >= bound if self.least else value <= bound


RULES = (
    Rule("enough words", "n_words", True, 100, 20, base=True),
    Rule("few repeated words", "n_repeat_words", False, 30, "n_words", base=True),
    Rule("words not too short", "word_chars", True, 200, "n_words"),
    Rule("words not too long", "word_chars", False, 1500, "n_words"),
    Rule("few symbols", "n_symbols", False, 10, "n_words"),
    Rule("some stop words", "n_stop_words", True, 2, "n_words"),
    Rule("few repeated lines", "n_dup_lines", False, 50, "n_lines"),
)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated_words(words: Column, window: int) -> Column:
    """Words inside windows that occur twice or more in ``words``, by 64-bit window hashes."""

    def covered(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(pairs: Column) -> Column:
            def twice(pair, j):
                before = F.when(j > 0, pairs[j - 1]["h"] == pair["h"]).otherwise(F.lit(False))
                after = F.when(
                    j + 1 < F.size(pairs), pairs[j + 1]["h"] == pair["h"]
                ).otherwise(F.lit(False))
                return before | after

            places = F.array_sort(F.transform(F.filter(pairs, twice), lambda p: p["i"]))
            start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
            return F.aggregate(
                places,
                start,
                lambda a, p: F.struct(
                    (a["n"] + window - F.greatest(F.lit(0), a["upto"] - p)).alias("n"),
                    (p + window).alias("upto"),
                ),
                lambda a: a["n"],
            )

        once = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(once, 0).otherwise(_let(ordered, repeated))

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - window)
        return F.transform(starts, lambda i: F.xxhash64(*[hashes[i + k] for k in range(window)]))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    found = _let(hashes, lambda h: _let(windows(h), covered))
    return F.when(F.size(words) <= window, 0).otherwise(found).cast("bigint")


def _measured(text: Column, window: int) -> Column:
    """All measures of a text as one struct."""

    def of_words(words: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(_BLANKS)) != "")
        stop = F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))
        counts = {
            "n_words": F.size(words),
            "word_chars": F.length(F.array_join(words, "")),
            "n_symbols": F.regexp_count(text, F.lit(_SYMBOLS)),
            "n_stop_words": F.size(stop),
            "n_lines": F.size(lines),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": _repeated_words(words, window),
        }
        return F.struct(*[c.cast("bigint").alias(name) for name, c in counts.items()])

    trimmed = F.trim(text, F.lit(_BLANKS))
    none = F.array().cast("array<string>")
    return _let(F.when(trimmed == "", none).otherwise(F.split(trimmed, _BLANK_RUN)), of_words)


MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_stop_words", "n_lines", "n_dup_lines", "n_repeat_words",
)


def quality(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    window: int = REPEAT_WINDOW,
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with the measures of each whole text, ``base_failed``, ``failed`` and ``kept``.

    Words are runs without ASCII white space; lines count where they hold a word.
    ``failed`` names the broken rules and ``kept`` is true where there is none. Null and empty
    texts have no words and fail. Rows stay as they are, repeated or not, and
    columns with an output's name are replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    outputs = (*MEASURES, "base_failed", "failed", "kept")

    def judged(m: Column) -> Column:
        measures = {name: m[name] for name in MEASURES}
        broken = [F.when(~r.holds(measures), F.lit(r.name)) for r in rules]
        base = [~r.holds(measures) for r in rules if r.base]
        return F.struct(
            *[m[name].alias(name) for name in MEASURES],
            reduce(Column.__or__, base, F.lit(False)).alias("base_failed"),
            F.array_compact(F.array(*broken)).alias("failed"),
        )

    rows = replacing(docs, *outputs)
    (name,) = fresh(rows, "_quality")
    found = F.col(name)
    return rows.withColumn(name, _let(_measured(text, window), judged)).select(
        *rows.columns,
        *[found[output].alias(output) for output in (*MEASURES, "base_failed", "failed")],
        (F.size(found["failed"]) == 0).alias("kept"),
    )
