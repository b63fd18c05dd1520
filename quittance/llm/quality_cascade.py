"""Quality rules in a short-circuit cascade, made of Spark's own expressions only.

Each rule says when a text fails. On a bounded sample every rule is timed and its failures
are counted; rules then run in the order of failures per second of cost, and a text that
fails one is not put to the next (CASE evaluates its branches in order). The order changes
the work, never the verdict.

Windows of words are compared by 64-bit hashes within one text. Everything is computed within
the row: nothing is shuffled, and a text of any length stays one row.

Defined results: a null text counts as empty, has no words and fails; equal rows are judged
each; a null doc_id is kept as it is; an empty table gives an empty result (with nothing to
sample, rules keep their given order); other columns don't matter.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quittance.llm.common import SPACE, store

#: Rows on which costs and selectivities are estimated, about.
SAMPLE_ROWS = 1000
WINDOW = 5
SYMBOLS = "#*$%&|<>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it.

    The optimizer may put an expression in place of a column's name, also where a function
    runs for each element of an array; a lambda's variable stays a variable.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def repeated_words(words: Column, size: int = WINDOW) -> Column:
    """Words covered by windows of ``size`` words that occur twice or more in the text."""

    def windows(hashes: Column) -> Column:
        parts = lambda x, i: [x, *(F.get(hashes, i + k) for k in range(1, size))]
        return F.transform(F.slice(hashes, 1, F.size(hashes) - (size - 1)), lambda x, i: F.xxhash64(*parts(x, i)))

    def repeats(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))

        def beside(ordered: Column) -> Column:
            same = lambda x, i: (F.get(ordered, i)["h"] == x["h"])
            alike = lambda x, i: F.coalesce(same(x, i - 1), F.lit(False)) | F.coalesce(same(x, i + 1), F.lit(False))
            return F.sort_array(F.transform(F.filter(ordered, alike), lambda x: x["at"]))

        return let(placed, beside)

    def covered(places: Column) -> Column:
        each = F.transform(places, lambda x, i: F.least(F.lit(size), F.coalesce(F.get(places, i + 1) - x, F.lit(size))))
        return F.aggregate(each, F.lit(0), lambda total, x: total + x)

    def count(windows: Column) -> Column:
        distinct = F.size(F.array_distinct(windows)) == F.size(windows)
        return F.when(distinct, 0).otherwise(let(repeats(windows), covered))

    some = F.when(F.size(words) < size + 1, 0).otherwise(
        let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: let(windows(hashes), count))
    )
    return some.cast("long")


def lines(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))


def count_in(text: Column, others: str) -> Column:
    """Code points left of a text without those that the pattern ``others`` takes."""
    return F.length(F.regexp_replace(text, others, ""))


def base(text: Column) -> Column:
    """The counts that the rules below use, as a struct of longs."""
    return let(
        F.coalesce(text, F.lit("")),
        lambda t: let(
            words(t),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                count_in(t, f"[{SPACE}]+").cast("long").alias("word_chars"),
                count_in(t, f"[^{SYMBOLS}]+").cast("long").alias("n_symbols"),
                let(lines(t), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                repeated_words(w).alias("n_repeat_words"),
            ),
        ),
    )


class Rule(NamedTuple):
    name: str
    fails: Callable[[Column], Column]  # of a text that isn't null


def _share(part: Callable[[Column], Column], whole: Callable[[Column], Column], most: float) -> Callable[[Column], Column]:
    return lambda text: part(text) > F.lit(most) * F.greatest(whole(text), F.lit(1))


def _word_count(text: Column) -> Column:
    return F.size(words(text))


def _letters(text: Column) -> Column:
    return count_in(text, "[^\\p{L}]+")


def _length(lines: Column) -> Column:
    return F.length(F.array_join(lines, ""))


#: The rules every text has to pass first.
BASE = (
    Rule("few_words", lambda t: _word_count(t) < 10),
    Rule("repeated_words", lambda t: let(words(t), lambda w: 100 * repeated_words(w) > 20 * F.size(w))),
)

#: Further signs of text that is no prose. All are shares, so long texts are judged as short ones.
SIGNS = (
    # a sign that stands alone is a word too, so a list of words with bars between them has 0.5 a word at most
    Rule("symbols", _share(lambda t: count_in(t, f"[^{SYMBOLS}]+"), _word_count, 0.1)),
    Rule("capitals", _share(lambda t: count_in(t, "[^\\p{Lu}]+"), _letters, 0.6)),
    Rule("exclamations", _share(lambda t: count_in(t, "[^!]+"), _word_count, 0.5)),
    # by length: a short heading that comes again says little about a long text
    Rule("duplicate_lines", lambda t: let(lines(t), lambda x: _length(x) - _length(F.array_distinct(x)) > 0.3 * _length(x))),
    Rule(
        "word_length",
        lambda t: let(
            count_in(t, f"[{SPACE}]+") / F.greatest(_word_count(t), F.lit(1)), lambda mean: (mean < 2) | (mean > 20)
        ),
    ),
)


class Estimate(NamedTuple):
    rule: Rule
    seconds: float
    failures: int


def estimate(docs: DataFrame, rules: tuple[Rule, ...], sample_rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """What each rule costs and rejects on a sample, best first: failures per second."""
    total = docs.count()
    fraction = min(1.0, sample_rows / max(1, total))
    drawn = docs.select("text") if fraction == 1 else docs.select("text").sample(fraction, seed=11)
    sample = store(drawn.select(F.coalesce("text", F.lit("")).alias("text")).repartition(1))
    found = []
    for rule in rules:
        counted = sample.agg(F.count_if(rule.fails(F.col("text"))).alias("n"))
        counted.first()  # plans and compiles
        began = time.perf_counter()
        failures = counted.first()["n"]
        found.append(Estimate(rule, time.perf_counter() - began, failures))
    return sorted(found, key=lambda e: -e.failures / e.seconds)


def verdict(text: Column, rules: list[Rule]) -> Column:
    """The name of the first rule that fails, null if none does; later ones are not evaluated."""
    text = F.coalesce(text, F.lit(""))
    if not rules:
        return F.lit(None).cast("string")
    branches = F.when(rules[0].fails(text), rules[0].name)
    for rule in rules[1:]:
        branches = branches.when(rule.fails(text), rule.name)
    return branches


def in_order(docs: DataFrame, rules: tuple[Rule, ...], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    return [e.rule for e in estimate(docs, rules, sample_rows)]


def keep(docs: DataFrame, rules: tuple[Rule, ...] = BASE + SIGNS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that pass all rules, with their columns."""
    return docs.where(verdict(F.col("text"), in_order(docs, rules, sample_rows)).isNull())


def judge(docs: DataFrame, rules: tuple[Rule, ...] = SIGNS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Counts, the base rules' verdict and the whole one, per document."""
    failed = verdict(F.col("text"), in_order(docs, rules, sample_rows))
    counted = docs.select("doc_id", base(F.col("text")).alias("base"), failed.alias("failed_rule"))
    base_failed = (F.col("base.n_words") < 10) | (100 * F.col("base.n_repeat_words") > 20 * F.col("base.n_words"))
    return counted.select(
        "doc_id",
        "base.*",
        base_failed.alias("base_failed"),
        (~base_failed & F.col("failed_rule").isNull()).alias("kept"),
    )
