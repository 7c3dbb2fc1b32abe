"""Operator 6, quality rules as weak supervision, in DataFrame functions alone.

Each rule looks at a document's statistics and votes good (1) or bad (-1), or abstains (0).
Expectation-maximisation over the counts of vote patterns estimates, for either
class, how often each rule casts each vote (its accuracy and coverage), and the share of
good documents; a document is kept if its posterior probability of being good is at least 0.5.
It replaces "all rules must pass"; the base rules below are the contract's own.

Statistics are computed row by row, in linear or n log n time, without a shuffle.  The
patterns are counted by Spark; at most 3 ** len(RULES) counts reach the driver, whatever the table.

Defined results: a null text has no words; repeated rows and null ids are judged row by
row; repeated rows count in the estimate as often as they occur; an empty table gives no rows;
ties at 0.5 are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANK_CLASS, BLANKS, let, table, written

SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Pseudo-counts: a rule's votes agree with the class, so neither class can swap its meaning.
PRIOR_AGREE, PRIOR_OTHER, STEPS = 8.0, 2.0, 40


def _removed(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more: sort the windows, mark equal neighbours."""

    def marked(s: Column) -> Column:
        same = lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])
        return F.transform(F.filter(s, lambda x, k: F.coalesce(same(x, k), F.lit(False))), lambda x: x["p"])

    def covered(p: Column) -> Column:  # each window adds up to 3 words, fewer if the next one overlaps it
        steps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def windows(w: Column) -> Column:
        hashes = lambda x, k: F.struct(F.xxhash64(x, F.get(w, k + 1), F.get(w, k + 2)).alias("h"), k.alias("p"))
        return F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), hashes)

    positions = let(F.sort_array(windows(words)), lambda s: F.sort_array(F.coalesce(marked(s), F.array().cast("array<int>"))))
    return let(positions, covered)


def statistics(text: Column) -> Column:
    """A struct of the contract's counts and of those that the rules need."""
    text = F.coalesce(text, F.lit(""))
    has_word = lambda line: F.length(F.translate(line, BLANKS, "")) > 0

    def told(t: Column) -> Column:
        words = F.filter(F.split(t, BLANK_CLASS), lambda w: w != "")
        lines = F.filter(F.split(t, "\n"), has_word)
        line_counts = let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct")))
        word_counts = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).alias("repeat")))
        return F.struct(
            word_counts.alias("words"),
            line_counts.alias("lines"),
            F.length(F.translate(t, BLANKS, "")).cast("long").alias("word_chars"),
            _removed(t, SYMBOLS).cast("long").alias("n_symbols"),
            _removed(t, "!").cast("long").alias("n_shouts"),
            _removed(t, ".").cast("long").alias("n_stops"),
            F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
            F.length(F.regexp_replace(t, r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        )

    return let(text, told)


def with_statistics(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The columns ``keep`` of ``docs`` as struct ``row``, and the statistics as columns."""
    row = F.struct(*[docs[f"`{c}`"] for c in keep])
    found = docs.select(row.alias("row"), statistics(F.col("text").cast("string")).alias("s"))
    n, repeat = F.col("s.words.n"), F.col("s.words.repeat")
    return found.select(
        "row",
        n.alias("n_words"),
        F.col("s.word_chars").alias("word_chars"),
        F.col("s.n_symbols").alias("n_symbols"),
        (F.col("s.lines.n") - F.col("s.lines.distinct")).cast("long").alias("n_dup_lines"),
        repeat.alias("n_repeat_words"),
        F.col("s.lines.n").cast("long").alias("n_lines"),
        F.col("s.n_shouts").alias("n_shouts"),
        F.col("s.n_stops").alias("n_stops"),
        F.col("s.n_upper").alias("n_upper"),
        F.col("s.n_letters").alias("n_letters"),
    )


def _vote(bad: str, good: str) -> Column:
    return F.when(F.expr(bad), F.lit(-1)).when(F.expr(good), F.lit(1)).otherwise(F.lit(0))


def rules() -> dict[str, Column]:
    """The rules' votes, from the statistics."""
    return {
        "symbols": _vote("10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
        "shouting": _vote("5 * n_shouts > n_words", "50 * n_shouts <= n_words"),
        "capitals": _vote("10 * n_upper > 3 * n_letters", "10 * n_upper <= n_letters and n_letters > 0"),
        "repeats": _vote("100 * n_repeat_words > 30 * n_words", "100 * n_repeat_words <= 15 * n_words"),
        "lines": _vote("10 * n_dup_lines > 3 * n_lines", "n_dup_lines = 0 and n_lines > 3"),
        "word_length": _vote("10 * word_chars < 38 * n_words or word_chars > 11 * n_words", "word_chars between 4 * n_words and 8 * n_words"),
        "letters": _vote("100 * n_letters < 75 * word_chars", "100 * n_letters >= 90 * word_chars and word_chars > 0"),
        "sentences": _vote("100 * n_stops < n_words or 2 * n_stops > n_words", "n_stops between 0.03 * n_words and 0.3 * n_words"),
    }


def estimate(patterns: list[tuple[tuple[int, ...], int]], n_rules: int) -> tuple[float, list[dict[int, float]]]:
    """Log-odds of good before any vote, and for each rule the log-odds that each vote adds.

    ``patterns``: distinct vote tuples with counts.  The start takes any bad vote for true, since most rules
    look at one defect each and call a text with another one good.
    """
    weight = {v: 0.1 if -1 in v else 0.9 for v, _ in patterns}
    prior, tables = 0.0, [dict.fromkeys((-1, 0, 1), 0.0) for _ in range(n_rules)]
    for _ in range(STEPS):
        good = PRIOR_AGREE + sum(c * weight[v] for v, c in patterns)
        bad = PRIOR_OTHER + sum(c * (1 - weight[v]) for v, c in patterns)
        prior = math.log(good / bad)
        for k in range(n_rules):
            n = {(x, y): PRIOR_AGREE if x == y else PRIOR_OTHER for x in (-1, 0, 1) for y in (-1, 1)}
            for v, c in patterns:
                n[v[k], 1] += c * weight[v]
                n[v[k], -1] += c * (1 - weight[v])
            all_good, all_bad = (sum(n[x, y] for x in (-1, 0, 1)) for y in (1, -1))
            tables[k] = {x: math.log(n[x, 1] / all_good) - math.log(n[x, -1] / all_bad) for x in (-1, 0, 1)}
        for v, _ in patterns:
            z = prior + sum(t[x] for t, x in zip(tables, v))
            weight[v] = 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))
    return prior, tables


def rate(docs: DataFrame, keep: tuple[str, ...] | None = None) -> DataFrame:
    """``row`` (the columns ``keep``, or all), the statistics, base_failed, quality (posterior) and kept.

    The statistics are written to the shared scratch folder: they are read twice, and cost most.
    """
    votes = rules()
    measured = written(with_statistics(docs, keep or tuple(docs.columns)), "quality")
    counted = measured.select(*[v.alias(k) for k, v in votes.items()]).groupBy(*votes).count().collect()
    patterns = sorted((tuple(r[k] for k in votes), r["count"]) for r in counted)
    prior, tables = estimate(patterns, len(votes))
    z = F.lit(prior)
    for vote, worth in zip(votes.values(), tables):
        z = z + F.when(vote == 1, F.lit(worth[1])).when(vote == -1, F.lit(worth[-1])).otherwise(F.lit(worth[0]))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rated = measured.withColumn("base_failed", failed).withColumn("quality", 1 / (1 + F.exp(-z)))
    return rated.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))


def op6_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate(table(spark, sf_dir, "documents"), ("doc_id",)).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


__all__ = ["statistics", "with_statistics", "rules", "estimate", "rate", "op6_weak_supervision"]
