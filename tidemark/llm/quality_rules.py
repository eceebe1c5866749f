"""Quality rules: fixed base rules, then a decision list learned from labelled statistics.

Sequential covering: a rule for the label 0 grows by the threshold test with the largest
information gain until it covers no row of label 1, is pruned on held-back rows, and is
kept while it is precise there; the rows it covers leave, and the next rule grows on the
rest.  The list is emitted as one ordered `when` expression over the statistics, so it
runs inside the plan like a hand-written filter.  Statistics are built-in functions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BLANK_CHARACTERS, where_late, words_of

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
#: The fit reads at most so many labelled rows, those with the smallest hash of their id.
FIT_ROWS = 6_000
#: Of the pruning rows a rule covers, so large a share must be of label 0.
LEAST_PRECISION = 0.95
_MOST_TESTS, _MOST_RULES, _LEAST_COVERED = 4, 24, 3

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LEARNED_FROM = ("n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share",
                "digit_share", "mark_share", "words_per_line")


def statistics(rows: DataFrame) -> DataFrame:
    """Adds the statistics of `text` to rows (which has no column of their names, and no null text)."""
    text = F.col("text")
    without = lambda pattern: F.length(text) - F.length(F.regexp_replace(text, pattern, ""))
    staged = rows.select(
        "*",
        words_of(text).alias("words"),
        F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(BLANK_CHARACTERS)) != "").alias("lines"),
        without(r"[#*$%&|<>]").cast("bigint").alias("n_symbols"),
        without("[A-Z]").alias("n_upper"),
        without("[0-9]").alias("n_digits"),
        without("[!?]").alias("n_marks"),
    )
    last = F.size("words") - WINDOW + 1
    windows = F.when(last < 1, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice("words", i, WINDOW)))
    )
    staged = staged.select(
        *[c for c in staged.columns if c not in ("words", "lines")],
        F.size("words").cast("bigint").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("bigint"), lambda a, w: a + F.length(w)).alias("word_chars"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        windows.alias("windows"),
    )
    # Only texts with a repeated window are sorted; equal windows are then neighbours.
    entries = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    staged = staged.withColumn("sorted", F.when(repeated, F.sort_array(entries))).drop("windows")
    twin = lambda e, i: (F.get("sorted", i - 1)["h"].eqNullSafe(e["h"])) | (F.get("sorted", i + 1)["h"].eqNullSafe(e["h"]))
    staged = staged.withColumn("places", F.sort_array(F.transform(F.filter("sorted", twin), lambda e: e["at"]))).drop("sorted")
    covered = F.transform("places", lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get("places", i + 1) - at, F.lit(WINDOW))))
    staged = staged.withColumn(
        "n_repeat_words", F.coalesce(F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0).cast("bigint"))
    ).drop("places")
    share = lambda part, whole: F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), F.lit(0.0))
    return staged.withColumns(
        {
            "mean_word": share("word_chars", "n_words"),
            "symbol_share": share("n_symbols", "word_chars"),
            "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "distinct_share": share("n_distinct", "n_words"),
            "upper_share": share("n_upper", "word_chars"),
            "digit_share": share("n_digits", "word_chars"),
            "mark_share": share("n_marks", "word_chars"),
            "words_per_line": share("n_words", "n_lines"),
        }
    )


def base_failed() -> Column:
    n, repeated = F.col("n_words"), F.col("n_repeat_words")
    return (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n)


@dataclass(frozen=True)
class Test:
    """`statistic` above (or, if not `above`, at or below) `threshold`."""

    statistic: str
    above: bool
    threshold: float

    def holds(self, values: np.ndarray, names: tuple[str, ...]) -> np.ndarray:
        column = values[:, names.index(self.statistic)]
        return column > self.threshold if self.above else column <= self.threshold

    def column(self) -> Column:
        statistic = F.col(self.statistic).cast("double")
        return statistic > self.threshold if self.above else statistic <= self.threshold


Rule = tuple[Test, ...]


def _covers(rule: Rule, values: np.ndarray, names: tuple[str, ...]) -> np.ndarray:
    held = np.ones(len(values), bool)
    for test in rule:
        held &= test.holds(values, names)
    return held


def _best_test(values: np.ndarray, bad: np.ndarray, names: tuple[str, ...]) -> Test | None:
    """The test with the largest gain of information about the label 0 over the rows given."""
    before, best, found = np.log2(bad.mean()), 1e-9, None
    for name, column in zip(names, values.T):
        distinct = np.unique(column)
        edges = (distinct[1:] + distinct[:-1]) / 2
        if len(edges) > 400:
            edges = np.unique(np.quantile(edges, np.linspace(0, 1, 400)))
        if not len(edges):
            continue
        order = np.argsort(column, kind="stable")
        below = np.searchsorted(column[order], edges, side="right")
        hits = np.concatenate([[0], np.cumsum(bad[order])])[below]
        for above, p, n in ((False, hits, below), (True, bad.sum() - hits, len(bad) - below)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / n) - before), -1.0)
            at = int(np.argmax(gain))
            if gain[at] > best:
                best, found = gain[at], Test(name, above, float(edges[at]))
    return found


def _grow(values: np.ndarray, bad: np.ndarray, names: tuple[str, ...]) -> Rule:
    rule: Rule = ()
    while len(rule) < _MOST_TESTS and bad.any() and not bad.all():
        test = _best_test(values, bad, names)
        if test is None:
            break
        held = test.holds(values, names)
        values, bad, rule = values[held], bad[held], (*rule, test)
    return rule


def _prune(rule: Rule, values: np.ndarray, bad: np.ndarray, names: tuple[str, ...]) -> tuple[Rule, float, int]:
    """The shortest prefix with the best (right - wrong) / covered on the held-back rows."""
    def worth(prefix: Rule) -> tuple[float, int]:
        held = _covers(prefix, values, names)
        right, n = int(bad[held].sum()), int(held.sum())
        return ((2 * right - n) / n if n else -1.0), n

    prefixes = [rule[:k] for k in range(1, len(rule) + 1)]
    best = max(prefixes, key=lambda prefix: (worth(prefix)[0], -len(prefix)))
    value, covered = worth(best)
    return best, (value + 1) / 2, covered


def learn_list(values: np.ndarray, label: np.ndarray, names: tuple[str, ...] = LEARNED_FROM) -> list[Rule]:
    """Ordered rules for label 0; rows that none covers keep the default, label 1."""
    bad = label == 0
    held_back = np.arange(len(values)) % 3 == 2
    rules: list[Rule] = []
    left = np.ones(len(values), bool)
    while len(rules) < _MOST_RULES and bad[left & ~held_back].any():
        grown = _grow(values[left & ~held_back], bad[left & ~held_back], names)
        if not grown:
            break
        rule, precision, covered = _prune(grown, values[left & held_back], bad[left & held_back], names)
        if precision < LEAST_PRECISION or covered < _LEAST_COVERED:
            break
        rules.append(rule)
        left &= ~_covers(rule, values, names)
    return rules


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> list[Rule]:
    """Learn from the statistics of at most `rows` labelled documents, whose values alone come to the driver.

    Labels without an id or a quality are left out, and ids with contradicting labels too.  Of
    the rows that share an id one counts, that with the smallest values.
    """
    sample = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("doc_id", "quality")
    )
    chosen = docs.join(F.broadcast(sample), "doc_id").select("doc_id", "quality", F.coalesce(docs["text"], F.lit("")).alias("text"))
    values = F.struct("quality", *dict.fromkeys([*BASE, *LEARNED_FROM]))
    found = (
        statistics(chosen).groupBy("doc_id").agg(F.min(values).alias("v")).orderBy(F.xxhash64("doc_id"), "doc_id")
        .select("v.quality", *[F.col(f"v.{c}").cast("double") for c in LEARNED_FROM]).collect()
    )
    if not found:
        return []
    data = np.array([tuple(r) for r in found], float)
    return learn_list(data[:, 1:], data[:, 0])


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that covers a row, null if none does."""
    chain = F
    for k, rule in enumerate(rules):
        condition = rule[0].column()
        for test in rule[1:]:
            condition &= test.column()
        chain = chain.when(condition, F.lit(k))
    return F.lit(None).cast("int") if chain is F else chain


def judged(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per row of docs: doc_id, the base statistics, base_failed, rule, kept.

    Null text counts as empty: no words, so the base rules reject it.  Repeated rows and
    null ids each keep a row; other columns are ignored; without labels the list is
    empty and only the base rules decide.
    """
    rows = docs.select("doc_id", F.coalesce(docs["text"], F.lit("")).alias("text"))
    marked = statistics(rows).withColumns({"base_failed": base_failed(), "rule": verdict(rules)})
    return marked.select("doc_id", *BASE, "base_failed", "rule", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"))


def kept_rows(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of docs that pass, with their columns as they were."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    marked = statistics(docs.select(whole, F.coalesce(docs["text"], F.lit("")).alias("text")))
    passed = (~base_failed() & verdict(rules).isNull()).alias("passed")
    return where_late(marked.select("row", passed), F.col("passed")).select("row.*")
