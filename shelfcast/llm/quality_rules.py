"""Quality rules: one threshold table compiled into one projection.

Every measure is a built-in column expression over the whole text; the
table names a measure, its lowest and its highest accepted value, and
``judge`` turns the whole table into columns of a single projection (no
user function, no shuffle, no second read).

Defined results: a null or empty text has no words, every count is 0 and it
fails the base rule; a text of white space only likewise.  Repeated rows
are judged one by one.  Columns other than ``doc_id`` and ``text`` are kept
by ``judge`` and may carry any name.  An empty table gives an empty result.
A word window is compared by a 64-bit hash of its three words inside one
text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CHARS, read_table, word_array

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Frequent function words of the corpus languages (fixed values).
STOP_WORDS = (
    "the", "of", "and", "to", "in", "that", "is", "it", "for", "with",
    "der", "die", "und", "das", "den", "zu", "ist", "von", "mit", "sich",
    "le", "la", "les", "de", "des", "et", "que", "un", "en", "pour",
    "el", "los", "las", "y", "por", "con", "del", "una", "se", "no",
)


@dataclass(frozen=True)
class Rule:
    """``low <= measure <= high``; a null bound is open, a null measure passes."""

    name: str
    measure: Callable[[dict[str, Column]], Column]
    low: float | None = None
    high: float | None = None

    def passes(self, m: dict[str, Column]) -> Column:
        value, ok = self.measure(m), F.lit(True)
        if self.low is not None:
            ok = ok & (value >= F.lit(self.low))
        if self.high is not None:
            ok = ok & (value <= F.lit(self.high))
        return F.coalesce(ok, F.lit(True))


def _ratio(top: str, bottom: str) -> Callable[[dict[str, Column]], Column]:
    return lambda m: m[top] / F.nullif(m[bottom], F.lit(0))


# The threshold table.
RULES: tuple[Rule, ...] = (
    Rule("word_length", _ratio("word_chars", "n_words"), 2.0, 15.0),
    Rule("symbol_words", _ratio("n_symbols", "n_words"), None, 1.5),
    Rule("stop_words", lambda m: m["n_stop_words"], 2, None),
    Rule("letter_words", _ratio("n_letter_words", "n_words"), 0.6, None),
    Rule("dup_lines", _ratio("n_dup_lines", "n_word_lines"), None, 0.5),
    Rule("bullet_lines", _ratio("n_bullet_lines", "n_word_lines"), None, 0.9),
    Rule("ellipsis_lines", _ratio("n_ellipsis_lines", "n_word_lines"), None, 0.4),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, evaluated once (bound as a lambda variable)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column, n: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    Windows are hashed; only a text with two equal hashes sorts them.  Equal
    neighbours of the sorted windows give the repeated positions, and each
    position covers the words up to the next one, three at most.
    """
    at = F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0)))

    def key(i: Column) -> Column:
        return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

    def covered(s: Column) -> Column:
        def repeated(x: Column, k: Column) -> Column:
            before = F.get(s, k - 1).getField("h")
            after = F.get(s, k + 1).getField("h")
            return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

        starts = F.sort_array(F.transform(F.filter(s, repeated), lambda x: x["i"]))
        return _let(starts, lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1), x + 3) - x)),
            F.lit(0), lambda a, b: a + b,
        ))

    def over(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_let(ordered, covered))

    return F.when(n < 3, F.lit(0)).otherwise(_let(F.transform(at, key), over))


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with the measures, one ``rule_<name>`` flag per rule,
    ``base_failed`` and ``kept``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    own = [c for c in docs.columns]
    arrays = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in own]).alias("__doc"),
        text.alias("__text"), word_array(F.col("text")).alias("__words"), F.split(text, "\n").alias("__lines"),
    )

    def removed(chars: str) -> Column:
        return F.char_length(F.translate(F.col("__text"), chars, ""))

    words, lines = F.col("__words"), F.filter(F.col("__lines"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    stops = F.array(*[F.lit(w) for w in STOP_WORDS])
    starts = F.ltrim
    counted = arrays.select(
        "__doc",
        F.size(words).cast("long").alias("n_words"),
        removed(SPACE_CHARS).cast("long").alias("word_chars"),
        (F.char_length("__text") - removed(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _repeat_words(words, F.size(words)).cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_word_lines"),
        F.size(F.filter(lines, lambda x: starts(x).rlike(r"^[-*•]"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[ \t-\r]*$"))).cast("long").alias("n_ellipsis_lines"),
        F.size(F.array_intersect(F.split(F.lower("__text"), r"[^\p{L}]+"), stops)).cast("long").alias("n_stop_words"),
        F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))).cast("long").alias("n_letter_words"),
    )
    names = [c for c in counted.columns if c != "__doc"]
    m = {c: F.col(c) for c in names}
    base_failed = (m["n_words"] < MIN_WORDS) | (m["n_repeat_words"] * 100 > m["n_words"] * MAX_REPEAT_PERCENT)
    verdict = ~base_failed
    for r in rules:
        verdict = verdict & r.passes(m)
    return counted.select(
        F.col("__doc"), *names, *[r.passes(m).alias(f"rule_{r.name}") for r in rules],
        base_failed.alias("base_failed"), verdict.alias("kept"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules over all ``documents``."""
    judged = judge(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        F.col("__doc.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )
