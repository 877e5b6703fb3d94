"""Quality rules: a table of thresholds compiled into one Spark projection."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
# Frequent function words of English, German, French and Spanish (fixed values).
STOP_WORDS = (
    "the", "and", "of", "to", "in", "is", "that", "it", "was", "for", "on", "are", "with", "this", "be", "at",
    "by", "from", "not", "a", "as",
    "der", "die", "das", "und", "ist", "von", "den", "des", "dem", "ein", "eine", "zu", "mit", "nicht", "auf", "für",
    "le", "la", "les", "de", "du", "et", "est", "un", "une", "que", "qui", "dans", "en", "des", "pour", "pas", "au",
    "el", "los", "las", "y", "es", "una", "por", "con", "no", "se", "para", "su",
)


@dataclass(frozen=True)
class Rule:
    """A measure and its bounds, both included; None is no bound."""

    name: str
    measure: Callable[[], Column]
    least: float | None = None
    most: float | None = None

    def broken(self) -> Column:
        value = self.measure()
        below = value < F.lit(float(self.least)) if self.least is not None else F.lit(False)
        above = value > F.lit(float(self.most)) if self.most is not None else F.lit(False)
        return below | above


def _ratio(part: str, whole: str) -> Callable[[], Column]:
    return lambda: F.col(part).cast("double") / F.greatest(F.col(whole), F.lit(1))


RULES: tuple[Rule, ...] = (
    Rule("word_count", lambda: F.col("n_words").cast("double"), least=10, most=200_000),
    Rule("mean_word_length", _ratio("word_chars", "n_words"), least=2, most=15),
    Rule("symbols_per_word", _ratio("n_symbols", "n_words"), most=0.25),
    Rule("stop_word_share", _ratio("n_stop_words", "n_words"), least=0.01),
    Rule("repeated_line_share", _ratio("n_dup_lines", "n_lines"), most=0.3),
    Rule("repeated_word_share", _ratio("n_repeat_words", "n_words"), most=0.2),
)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column) -> Column:
    """Words lying in 5-word windows that occur twice or more, first ones included.

    Windows are compared by 64-bit hashes. Texts whose windows all differ, the
    normal case, end after one hash set; only others are sorted.
    """
    windows = F.transform(
        F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW))
    )

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(placed, lambda s: let(F.sort_array(twice(s)), spread))

    def twice(s: Column) -> Column:
        same = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda k: F.when(k > 0, s[k]["h"] == F.get(s, k - 1)["h"]).otherwise(F.lit(False))
            | F.coalesce(s[k]["h"] == F.get(s, k + 1)["h"], F.lit(False)),
        )
        return F.transform(same, lambda k: s[k]["i"])

    def spread(starts: Column) -> Column:
        steps = F.zip_with(
            starts,
            F.slice(starts, 2, F.size(starts)),
            lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))),
        )
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(
        let(
            windows,
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)),
        )
    )


def measures(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """All measures and verdicts of each document, one row in, one row out.

    Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words,
    n_stop_words (long), broken_rules (names of the rules broken), base_failed and
    kept (boolean) to doc_id. Only doc_id and text are read, so other columns may
    have any name. A null or empty text has no words and fails; rows with equal or
    null doc_id are measured like any other.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    blank = F.trim(text, F.lit(SPACE))
    words = F.when(F.length(blank) == 0, F.array().cast("array<string>")).otherwise(
        F.split(blank, "[ \\t\\n\\x0B\\f\\r]+")
    )
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(x, F.lit(SPACE))) > 0)
    split = docs.select(
        "doc_id",
        words.alias("words"),
        lines.alias("lines"),
        F.length(F.translate(text, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    counted = split.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.size(F.filter("words", lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
    )
    broken = F.array_compact(F.array(*[F.when(rule.broken(), F.lit(rule.name)) for rule in rules]))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    judged = counted.withColumn("broken_rules", broken).withColumn("base_failed", base)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))
