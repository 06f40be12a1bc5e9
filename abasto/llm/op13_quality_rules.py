"""Quality rules: a table of thresholds, compiled into one Spark projection.

A rule bounds a measure, or the share that one measure has of another, from below, from above or both. ``judge`` turns
the table into one array column with the names of the rules a text breaks; shares are compared as whole-number products,
so nothing is rounded. Everything is built-in functions: nothing is shuffled and no user function runs.

Measures of a whole text:

- words are runs of characters other than blank and ``\\x09-\\x0D``; lines are what ``\\n`` parts, those with a word count;
- ``n_repeat_words``: words in windows of three that the text holds twice or more, the first one included. Windows are
  sorted by a 64-bit hash with their places, equal neighbours give the places, and places less than three apart share words;
- stop words are counted without case and without the marks around them, in four languages.

Null text: as an empty one (no words, so it fails the base rules). Repeated or null ``doc_id``: every row is judged on its
own. Empty table: no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 3

# Frequent function words of four languages.
STOP_WORDS = {
    "en": "the be to of and that have with is in it for on this by as at from or an are was not",
    "fr": "le la les de des du et en un une que qui dans pour sur est pas au aux avec par ce il elle",
    "es": "el la los las de del y en un una que por para con se no es al lo su como más",
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an",
}


@dataclass(frozen=True)
class Rule:
    """``low`` and ``high`` bound ``measure``, or 100 times its share of ``of``."""

    name: str
    measure: str
    of: str | None = None
    low: int | None = None
    high: int | None = None


# What every text has to pass before the other rules are looked at.
BASE = [
    Rule("base_length", "n_words", low=50),
    Rule("base_repeats", "n_repeat_words", of="n_words", high=50),
]

RULES = [
    Rule("long", "n_words", high=1_000_000),
    Rule("word_length", "word_chars", of="n_words", low=200, high=1500),
    Rule("symbols", "n_symbols", of="n_words", high=25),
    Rule("letters", "n_letter_words", of="n_words", low=70),
    Rule("stop_words", "n_stop_words", low=2),
    Rule("repeated_lines", "n_dup_lines", of="n_lines", high=50),
    Rule("bullet_lines", "n_bullet_lines", of="n_lines", high=90),
    Rule("cut_lines", "n_cut_lines", of="n_lines", high=50),
]


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body, or a lambda in it, uses it."""
    return F.transform(F.array(value), body)[0]


def _count(values: Column, test) -> Column:
    return F.size(F.filter(values, test)).cast("bigint")


def _repeat_words(words: Column) -> Column:
    """Words covered by windows whose hash another window has too."""

    def windows(words: Column) -> Column:
        starts = F.slice(words, 1, F.greatest(F.size(words) - WINDOW + 1, F.lit(0)))
        rest = range(1, WINDOW)
        return F.transform(
            starts,
            lambda word, place: F.struct(
                F.xxhash64(word, *(F.get(words, place + step) for step in rest)).alias("hash"), place.alias("place")
            ),
        )

    def repeated(found: Column) -> Column:
        def twice(window: Column, place: Column) -> Column:
            before, after = F.get(found, place - 1)["hash"], F.get(found, place + 1)["hash"]
            return before.eqNullSafe(window["hash"]) | after.eqNullSafe(window["hash"])

        return F.transform(F.filter(found, twice), lambda window: window["place"])

    def covered(places: Column) -> Column:
        reach = F.transform(
            places, lambda place, number: F.least(F.lit(WINDOW), F.coalesce(F.get(places, number + 1) - place, F.lit(WINDOW)))
        )
        return F.aggregate(reach, F.lit(0).cast("bigint"), lambda total, more: total + more)

    found = _let(words, lambda value: F.sort_array(windows(value)))
    places = F.sort_array(_let(found, repeated))
    return _let(places, covered)


def measure(docs: DataFrame, *kept: Column) -> DataFrame:
    """``doc_id`` and the measures of every row, beside what else is to be kept of it."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), *kept)
    others = texts.columns[2:]
    parts = texts.select(
        "*",
        F.array_remove(F.split("text", "[ \\t-\\r]+"), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: F.translate(line, BLANKS, "") != "").alias("lines"),
    )
    stop_words = sorted({word for words in STOP_WORDS.values() for word in words.split()})
    return parts.select(
        "doc_id",
        *others,
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.translate("text", BLANKS, "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(F.col("words")).alias("n_repeat_words"),
        _count(F.col("words"), lambda word: word.rlike("\\p{L}")).alias("n_letter_words"),
        _count(F.col("words"), lambda word: F.lower(F.btrim(word, F.lit(".,;:!?()\"'"))).isin(stop_words)).alias("n_stop_words"),
        _count(F.col("lines"), lambda line: F.ltrim(line).rlike("^[-*•]")).alias("n_bullet_lines"),
        _count(F.col("lines"), lambda line: F.rtrim(line).rlike("(\\.\\.\\.|…)$")).alias("n_cut_lines"),
    )


def broken(rule: Rule) -> Column:
    """Whether a row breaks a rule. A share of nothing is no share: such a rule is kept."""
    value, whole = F.col(rule.measure), F.lit(1) if rule.of is None else F.col(rule.of)
    scaled = value if rule.of is None else value * 100
    tests = []
    if rule.low is not None:
        tests.append(scaled < whole * rule.low)
    if rule.high is not None:
        tests.append(scaled > whole * rule.high)
    if not tests:
        raise ValueError(f"rule {rule.name} has no bound")
    test = tests[0] if len(tests) == 1 else tests[0] | tests[1]
    return test if rule.of is None else (whole > 0) & test


def failures(rules: Sequence[Rule]) -> Column:
    """The names of the rules that a row breaks, in the table's order."""
    names = F.array(*(F.when(broken(rule), F.lit(rule.name)) for rule in rules)).cast("array<string>")
    return F.array_compact(names)


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE, *kept: Column) -> DataFrame:
    """The measures of every document, what it fails, and whether it is kept."""
    judged = measure(docs, *kept).select(
        "*", (F.size(failures(base)) > 0).alias("base_failed"), failures(rules).alias("failed_rules")
    )
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def accept(docs: DataFrame, rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE) -> DataFrame:
    """The documents that break no rule, with their own columns."""
    row = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row")
    return judge(docs, rules, base, row).filter("kept").select("row.*")
